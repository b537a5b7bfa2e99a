import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridpulse.llm import sharding


def checked(df, n):
    rows = sharding.assign(df).collect()
    assert len(rows) == n
    held = {s: sorted(r.slot for r in rows if r.shard == s) for s in range(8)}
    assert all(v == list(range(len(v))) for v in held.values())
    assert max(map(len, held.values())) - min(map(len, held.values())) <= 1
    return rows


def test_odd_rows_and_empty_tables(odd, none):
    rows = checked(odd, 10)
    one = next(r for r in rows if r.doc_id == 7)
    text = odd.where("doc_id = 7").first().text.encode()
    assert one["size"] == len(text) + 1 and one.crc == zlib.crc32(text)
    assert {(r["size"], r.crc) for r in rows if r.doc_id in (1, 2)} == {(1, 0)}
    checked(none, 0)


def test_groups_stay_whole_and_a_hot_one_is_split_evenly(spark):
    rows = spark.range(3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, F.lit("hot")).when(F.col("id") % 3 == 1, (F.col("id") / 9).cast("int").cast("string")).otherwise(F.concat(F.lit("u"), "id")).alias("text"),
    )
    got = checked(rows, 3000)
    groups = {}
    for r in got:
        groups.setdefault(bytes(r.group), Counter())[r.shard] += 1
    small = [c for c in groups.values() if 1 < sum(c.values()) < 100]
    assert sum(len(c) == 1 for c in small) > 0.9 * len(small)
    cut = sum(sum(c.values()) ** 2 - sum(v * v for v in c.values()) for c in small)
    assert cut < 0.1 * sum(sum(c.values()) ** 2 for c in small)


@pytest.mark.parametrize("n", [1, 7, 8, 9, 65])
def test_few_rows(spark, n):
    checked(spark.range(n).selectExpr("id AS doc_id", "'same' AS text"), n)


def test_a_hot_id_is_dealt_like_others(spark):
    rows = spark.range(4000).selectExpr("if(id % 3 = 0, 5, if(id % 3 = 1, null, id)) AS doc_id", "if(id % 2 = 0, 'same', concat('t', id)) AS text")
    checked(rows, 4000)


def test_fewer_links_are_cut_than_by_hash(spark):
    """Against shards by the hash of the id alone: pairs of equal texts in different shards."""
    rows = spark.range(4000).selectExpr("id AS doc_id", "concat('t', int(id / 4)) AS text")

    def cut(placed):
        n = Counter((bytes(r.group), r.shard) for r in placed)
        total = Counter(bytes(r.group) for r in placed)
        return sum(v * v for v in total.values()) - sum(v * v for v in n.values())

    got = checked(rows, 4000)
    base = rows.selectExpr("unhex(md5(text)) AS group", "pmod(xxhash64(doc_id), 8) AS shard").collect()
    assert cut(got) < 0.1 * cut(base)
