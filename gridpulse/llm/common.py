"""Shared helpers of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..operators.shared import checkpoint_dir, cut, deleted, scratch, ship, stored, swept

__all__ = [
    "WHITE", "checkpoint_dir", "count_words", "cut", "deleted", "join_counted", "join_named", "maybe_in", "numbered", "scratch", "ship", "stored",
    "swept", "table", "text_of", "unit_hash", "without", "words",
]

#: The white space that separates words: space, tab, line feed, vertical tab, form feed, carriage return.
WHITE = " \t\n\x0b\x0c\r"


def text_of(name: str = "text") -> Column:
    """The text, with null as the empty text."""
    return F.coalesce(F.col(name), F.lit(""))


def words(text: Column) -> Column:
    """The words ``[^\\x20\\x09-\\x0D]+`` of a text, in order."""
    spaced = F.translate(text, WHITE[1:], " " * (len(WHITE) - 1))
    return F.array_remove(F.split(spaced, " "), "")


def count_words(text: Column) -> Column:
    return F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")).cast("long")


def without(text: Column, chars: str) -> Column:
    """The text without any of some characters."""
    return F.translate(text, chars, "")


def unit_hash(*parts: Column) -> Column:
    """A number in [0, 1) that depends only on the parts; any engine with MD5 finds the same one."""
    digest = F.md5(F.concat_ws(":", *[p.cast("string") for p in parts]))
    return F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") / float(1 << 48)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def maybe_in(df: DataFrame, key: str, keys: DataFrame, bits: int | None = None) -> DataFrame:
    """The rows of ``df`` whose key, a 64-bit hash, may be among those of ``keys``, which are cut: all that are, and few
    others. Used before a shuffle that an exact join ends. The keys become a bitmap of 2^bits bits, about sixteen
    for each key but at most 2^25 (4 MB), which reaches the tasks as the value of a scalar subquery; beyond that many
    keys it would let too much pass and all rows are left to the join."""
    if bits is None:
        bits = max(10, (16 * keys.count() - 1).bit_length())
        if bits > 25 + 3:
            return df
    bits = min(bits, 25)
    n = 1 << (bits - 6)

    def place(c: Column) -> Column:
        return c.bitwiseAND(F.lit(n - 1))

    def bit(c: Column) -> Column:
        return F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(c, 40).bitwiseAND(F.lit(63)).cast("int"))

    k = keys.columns[0]
    held = keys.groupBy(place(F.col(k)).alias("id")).agg(F.bit_or(bit(F.col(k))).alias("bits"))
    every = df.sparkSession.range(0, n, 1, 1).join(F.broadcast(held), "id", "left")  # at most n rows of 16 bytes
    word = F.struct("id", F.coalesce("bits", F.lit(0).cast("long")).alias("bits"))
    bitmap = cut(every.agg(F.transform(F.sort_array(F.collect_list(word)), lambda w: w["bits"]).alias("bitmap")))
    return df.where(F.get(bitmap.scalar(), place(F.col(key)).cast("int")).bitwiseAND(bit(F.col(key))) != 0)


#: A key is hot if it has more than one in so many of the rows; so there are fewer hot keys than this number.
HOT = 1000


def join_counted(left: DataFrame, right: DataFrame, key: str, count: str, how: str = "inner") -> DataFrame:
    """left joined with right, which has one row for each key and in ``count`` about how many rows of left have it,
    "inner" or "left". Rows of hot keys, of which there are fewer than HOT, are joined by broadcast where they are, so
    none makes one task larger than the others. ``right`` is read several times and should be cut. Null keys match
    nothing."""
    total = right.agg(F.sum(count)).first()[0] or 0
    hot = right.where(F.col(count) > max(total // HOT, 1000))
    n_hot = hot.count()
    if not n_hot:
        return left.join(right, key, how)
    near = left.join(F.broadcast(hot), key)
    rest = left.join(F.broadcast(hot.select(key)), key, "left_anti").join(right, key, how)
    return near.unionByName(rest)


def join_named(left: DataFrame, right: DataFrame, key: str, how: str = "inner") -> DataFrame:
    """`join_counted` where nothing is known of the counts: left, which should be cut, is counted first."""
    counts = cut(left.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("__n")).where("__n > 1000"))
    if counts.isEmpty():
        return left.join(right, key, how)
    counted = cut(right.join(counts, key, "left").withColumn("__n", F.coalesce("__n", F.lit(1))))
    return join_counted(left, counted, key, "__n", how).drop("__n")


def numbered(rows: DataFrame, keys: list[str], out: str) -> DataFrame:
    """The rows with the long ``out``: 0 for a row whose keys no other row has, else its number among those with
    these keys, without gaps. Which of the rows that agree gets which number is open; all else is a property of the
    data. Only rows with repeated keys are shuffled, dealt by the task that they come from, too, so that a key with very
    many rows is numbered by many tasks. Null keys agree."""
    part, first = "__part", "__first"
    rows = rows.withColumn(part, F.spark_partition_id())
    same = cut(rows.groupBy(*keys).agg(F.count("*").alias("__n")).where("__n > 1").select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)]))
    if same.isEmpty():
        return rows.drop(part).withColumn(out, F.lit(0).cast("long"))
    alike = lambda: [F.col(k).eqNullSafe(F.col(f"__{i}")) for i, k in enumerate(keys)]
    some = cut(rows.join(same, alike(), "left_semi"))
    counts = some.groupBy(*keys, part).agg(F.count("*").alias("__n"))
    before = F.sum("__n").over(W.partitionBy(*keys).orderBy(part)) - F.col("__n")  # a row for each task at most
    firsts = counts.select(*[F.col(k).alias(f"__{i}") for i, k in enumerate(keys)], F.col(part).alias("__of"), before.alias(first))
    number = F.row_number().over(W.partitionBy(*keys, part).orderBy(F.lit(0))) - 1
    some = some.withColumn(out, number).join(firsts, [*alike(), F.col(part) == F.col("__of")])
    some = some.withColumn(out, F.col(out) + F.col(first)).select(*[c for c in rows.columns if c != part], out)
    return rows.join(same, alike(), "left_anti").drop(part).withColumn(out, F.lit(0).cast("long")).unionByName(some)
