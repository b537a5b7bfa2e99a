"""Which rows of a table have changed: a hash tree over buckets of keys.

Rows fall into buckets by the hash of their key; a bucket's hash is made of those of its rows, and a node's of those of its
children, up to one root. Two trees are compared from the root: a level is looked at only below nodes that differ, and rows
only in buckets that differ. The tree of the last run is a small table, kept beside the rows' hashes, which lie in a
folder for each first branch; so a run over an unchanged table reads one hash, and a run over a changed one the folders with
changes.

Nulls and edge cases: null keys and null values are values of their own; rows that share a key are one entry, whose hash
counts them; the order of rows and columns doesn't matter; tables with other columns differ in all rows; empty tables have
a root of their own.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .shared import cut

#: Children of a node and levels below the root: 4,096 buckets.
BRANCH, LEVELS = 16, 3


def _text(c: str) -> Column:
    """A column as text, without losing its type's nulls: null is told from every text."""
    return F.coalesce(F.concat(F.lit("="), F.col(f"`{c}`").cast("string")), F.lit("~"))


def _number(text: Column) -> Column:
    """60 bits of a text's MD5; any engine finds the same."""
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("long")


def row_hashes(df: DataFrame, key: str) -> DataFrame:
    """bucket, key (text, null as null), hash and n: a row for each key."""
    names = sorted(df.columns)
    row = _number(F.concat_ws("|", *[F.concat(F.lit(f"{c}:"), F.length(_text(c)), F.lit(":"), _text(c)) for c in names]))
    rows = df.select(F.col(f"`{key}`").cast("string").alias("key"), _text(key).alias("name"), row.alias("row"))
    rows = rows.groupBy("key", "name").agg(F.sum(F.col("row").cast("decimal(38,0)")).cast("string").alias("hash"), F.count("*").alias("n"))
    bucket = (_number(F.col("name")) % (BRANCH**LEVELS)).cast("int")
    return rows.select(bucket.alias("bucket"), "key", F.md5(F.concat_ws(":", "hash", "n")).alias("hash"), "n")


def tree(hashes: DataFrame) -> DataFrame:
    """level (0 is the root), node, hash, n: of the nodes that have rows."""
    # What a bucket's rows have in common is their sum, so it is counted where the rows are.
    leaf = hashes.groupBy(F.col("bucket").alias("node")).agg(F.sum(_number(F.concat_ws(":", F.coalesce("key", F.lit("~~")), "hash")).cast("decimal(38,0)")).cast("string").alias("hash"), F.sum("n").alias("n"))
    level = cut(leaf.select(F.lit(LEVELS).alias("level"), "node", F.md5(F.concat_ws(":", "hash", "n")).alias("hash"), "n"))
    out = level
    for k in range(LEVELS - 1, -1, -1):
        up = level.groupBy(F.floor(F.col("node") / BRANCH).cast("int").alias("node"))
        children = F.sort_array(F.collect_list(F.struct("node", "hash")))  # at most BRANCH
        level = up.agg(F.md5(F.to_json(children)).alias("hash"), F.sum("n").alias("n")).select(F.lit(k).alias("level"), "node", "hash", "n")
        out = out.union(level)
    root = out.where("level = 0")
    none = root.sparkSession.createDataFrame([(0, 0, "empty", 0)], "level int, node int, hash string, n long")
    return cut(out.union(none.join(root, "level", "left_anti")))


def changed_buckets(old: DataFrame, new: DataFrame) -> DataFrame:
    """bucket: those whose rows differ, found from the root down."""
    differ = old.sparkSession.range(1).select(F.lit(0).alias("node"))
    for level in range(LEVELS + 1):
        here = [t.where(F.col("level") == level).join(differ, "node", "left_semi").select("node", F.col("hash").alias(h)) for t, h in ((old, "a"), (new, "b"))]
        found = cut(here[0].join(here[1], "node", "full").where("NOT (a <=> b)").select("node"))
        if level == LEVELS or found.isEmpty():
            return found.select(F.col("node").alias("bucket"))
        differ = found.select(F.explode(F.sequence(F.col("node") * BRANCH, F.col("node") * BRANCH + BRANCH - 1)).alias("node"))


def changed_rows(old: DataFrame, new: DataFrame, buckets: DataFrame) -> DataFrame:
    """key and change (inserted, deleted or changed) of the keys whose rows differ, from the hashes in some buckets."""
    a, b = (t.join(F.broadcast(buckets), "bucket", "left_semi").select("key", F.col("hash").alias(h)) for t, h in ((old, "a"), (new, "b")))
    a, b = a.withColumnRenamed("key", "ka"), b.withColumnRenamed("key", "kb")
    change = F.when(F.col("a").isNull(), "inserted").when(F.col("b").isNull(), "deleted").otherwise("changed")
    return a.join(b, F.col("ka").eqNullSafe(F.col("kb")), "full").where("NOT (a <=> b)").select(F.coalesce("ka", "kb").alias("key"), change.alias("change"))


def save(hashes: DataFrame, path: str) -> None:
    """The tree, and the rows' hashes in a folder for each first branch."""
    top = F.floor(F.col("bucket") / BRANCH ** (LEVELS - 1)).cast("int")
    hashes = cut(hashes)
    hashes.withColumn("top", top).write.mode("overwrite").partitionBy("top").parquet(f"{path}/rows")
    tree(hashes).write.mode("overwrite").parquet(f"{path}/tree")


def changes_since(spark: SparkSession, path: str, df: DataFrame, key: str) -> DataFrame:
    """The changes of a table since its tree was saved. Only the saved rows of first branches with changes are read."""
    hashes = cut(row_hashes(df, key))
    buckets = changed_buckets(spark.read.parquet(f"{path}/tree"), tree(hashes))
    tops = sorted(r.top for r in buckets.select(F.floor(F.col("bucket") / BRANCH ** (LEVELS - 1)).cast("int").alias("top")).distinct().collect())  # BRANCH at most
    schema = "bucket int, key string, hash string, n long, top int"
    old = spark.read.schema(schema).parquet(f"{path}/rows").where(F.col("top").isin(tops))
    return changed_rows(old, hashes, buckets)


def touched_elements(changed: DataFrame, *links: DataFrame) -> DataFrame:
    """node: the elements whose features may differ: those of the components, over the old and new links (src, dst) together,
    of changed elements (node)."""
    from .components import components

    edges = None
    for some in links:
        both = some.select(F.col("src").cast("long").alias("a"), F.col("dst").cast("long").alias("b")).where("a IS NOT NULL AND b IS NOT NULL")
        edges = both if edges is None else edges.union(both)
    found = components(edges)
    roots = found.join(changed.select("node"), "node", "left_semi").select("root").distinct()
    return cut(found.join(roots, "root", "left_semi").select("node").union(changed.select("node")).distinct())
