"""Sharding by balanced label propagation (native).

Documents with equal texts are linked. Every document starts in a shard by the hash of its id and text. In each round,
joins tell every part of a group (its documents in one shard) where most of its neighbours are, and parts move
there as far as quotas allow: a move from shard i to j needs a move back or free room in j. Documents without
links stay out of the rounds; they fill what the linked ones leave. Finally every shard gives what it holds above
its quota, documents without links first, to those below, so counts are at most one apart (law `rows`).

Groups are counted before they are joined and parts move as counts, so a group with a third of all documents is
at most one row per shard; its documents learn their shard from their group's row and a hash. Places are found
by counting buckets of rows first, so no shard is sorted in one task.

Nulls and edge cases: a null text counts as the empty text; a null id hashes like any other value; repeated rows
are separate documents of one group, numbered so that each has a hash of its own; an empty table stays empty; other columns are ignored by `assign`.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, join_named, numbered, text_of


@dataclass(frozen=True)
class Params:
    """bucket: rows to a bucket at least, when places are counted; max_buckets: buckets of a shard at most, so
    that their table (a row each) can be broadcast."""

    shards: int = 8
    rounds: int = 6
    bucket: int = 64
    max_buckets: int = 12_500
    seed: int = 0


def _dice(seed: int, *parts: Column) -> Column:
    """A number in [0, 1) that depends on the parts only."""
    return F.pmod(F.xxhash64(F.lit(seed), *parts), F.lit(1 << 30)) / float(1 << 30)


def _moves(parts: DataFrame, room: DataFrame, turn: int, p: Params) -> DataFrame:
    """The parts (group, shard, n) after one round. room: shard, free."""
    by_group = W.partitionBy("group")
    wish = F.max(F.struct("n", _dice(p.seed, "group", "shard").alias("die"), "shard")).over(by_group)["shard"]
    wishes = parts.withColumn("to", wish)
    flows = cut(
        wishes.where("to != shard").groupBy(F.col("shard").alias("i"), F.col("to").alias("j")).agg(F.sum("n").alias("x"))
    )
    back = flows.select(F.col("j").alias("i"), F.col("i").alias("j"), F.col("x").alias("y"))
    net = flows.join(back, ["i", "j"], "left").withColumn("swap", F.least("x", F.coalesce("y", F.lit(0))))
    extra = F.sum(F.col("x") - F.col("swap")).over(W.partitionBy("j"))
    room = room.select(F.col("shard").alias("j"), F.greatest("free", F.lit(0)).alias("free"))
    share = (F.col("swap") + (F.col("x") - F.col("swap")) * F.least(F.lit(1.0), F.col("free") / F.greatest(extra, F.lit(1)))) / F.col("x")
    # A row for each pair of shards.
    share = net.join(F.broadcast(room), "j", "left").select(F.col("i").alias("shard"), F.col("j").alias("to"), share.alias("share"))
    moved = wishes.join(F.broadcast(share), ["shard", "to"], "left").withColumn("part", F.col("n") * F.coalesce("share", F.lit(0.0)))
    whole = F.floor("part")
    go = whole + (_dice(p.seed + turn, "group", "shard") < F.col("part") - whole).cast("long")
    return (
        moved.withColumn("go", go)
        .select("group", F.explode(F.array(
            F.struct("shard", (F.col("n") - F.col("go")).alias("n")), F.struct(F.col("to").alias("shard"), F.col("go").alias("n"))
        )).alias("x"))
        .where("x.n > 0")
        .groupBy("group", "x.shard")
        .agg(F.sum("x.n").alias("n"))
    )


def _propagate(rows: DataFrame, total: int, p: Params) -> DataFrame:
    """group, total, parts (array of shard and cumulative count) for every group of two documents or more."""
    parts = rows.groupBy("group", "shard").agg(F.count("*").alias("n"))
    size = F.sum("n").over(W.partitionBy("group"))
    parts = cut(parts.withColumn("size", size).where("size > 1").select("group", "shard", "n"))
    shards = rows.sparkSession.range(p.shards).select(F.col("id").cast("int").alias("shard"))
    for turn in range(1, p.rounds + 1):
        load = parts.groupBy("shard").agg(F.sum("n").alias("load"))
        room = shards.join(load, "shard", "left").select("shard", (F.lit(total // p.shards) - F.coalesce("load", F.lit(0))).alias("free"))
        parts = cut(_moves(parts, room, turn, p))
    before = F.sum("n").over(W.partitionBy("group").orderBy("shard"))
    return (
        parts.withColumn("upto", before)
        .groupBy("group")
        .agg(F.sum("n").alias("total"), F.sort_array(F.collect_list(F.struct("upto", "shard"))).alias("parts"))
    )


def _settle(rows: DataFrame, total: int, p: Params) -> DataFrame:
    """Adds the final shard and slot: rows have shard, group, linked and size of the group (total)."""
    buckets = max(1, min(p.max_buckets, -(-total // (p.shards * p.bucket))))
    # Linked documents come first and stay; a group keeps together unless it is larger than a bucket.
    spread = F.floor(F.col("total") / p.bucket).cast("int") + 1
    of = F.xxhash64(F.col("group"), F.lit(p.seed)).bitwiseAND(F.lit((1 << 40) - 1)) + F.pmod(F.col("die"), spread)
    rows = rows.withColumn("bucket", F.when(F.col("linked"), F.pmod(of, F.lit(buckets))).otherwise(buckets + F.pmod(F.col("die"), F.lit(buckets))).cast("int"))
    counts = cut(rows.groupBy("shard", "bucket").agg(F.count("*").alias("n")))
    offset = F.sum("n").over(W.partitionBy("shard").orderBy("bucket")) - F.col("n")
    offsets = counts.select("shard", "bucket", offset.alias("offset"))
    shards = rows.sparkSession.range(p.shards).select(F.col("id").cast("int").alias("shard"))
    quota = F.lit(total // p.shards) + (F.col("shard") < total % p.shards).cast("int")
    sums = shards.join(counts.groupBy("shard").agg(F.sum("n").alias("held")), "shard", "left")
    sums = sums.select("shard", F.coalesce("held", F.lit(0)).alias("held"), quota.cast("long").alias("quota"))
    over, under = F.greatest(F.col("held") - F.col("quota"), F.lit(0)), F.greatest(F.col("quota") - F.col("held"), F.lit(0))
    upto = W.orderBy("shard")  # a row for each shard
    sums = cut(
        sums.select("shard", "held", "quota", (F.sum(over).over(upto) - over).alias("out"), (F.sum(under).over(upto) - under).alias("start"), under.alias("room"))
    )
    # Documents above the quota are numbered through; each shard below it takes an interval of the numbers.
    takers = sums.agg(F.sort_array(F.collect_list(F.struct("start", "room", "shard", "held"))).alias("takers"))
    placed = (
        rows.withColumn("rank", F.row_number().over(W.partitionBy("shard", "bucket").orderBy("group", "doc_id", "at")) - 1)
        .join(F.broadcast(offsets), ["shard", "bucket"])
        .join(F.broadcast(sums.select("shard", "quota", "out")), "shard")
        .crossJoin(F.broadcast(takers))  # one row of at most `shards` intervals
        .withColumn("rank", F.col("rank") + F.col("offset"))
        .withColumn("number", F.col("out") + F.col("rank") - F.col("quota"))
    )
    taker = F.get(
        F.filter("takers", lambda t: (F.col("number") >= t["start"]) & (F.col("number") < t["start"] + t["room"])), F.lit(0)
    )
    stays = F.col("rank") < F.col("quota")
    return placed.withColumn("taker", F.when(~stays, taker)).select(
        "doc_id", "size", "crc", "group", "linked",
        F.coalesce(F.col("taker.shard"), F.col("shard")).alias("shard"),
        F.when(stays, F.col("rank")).otherwise(F.col("taker.held") + F.col("number") - F.col("taker.start")).cast("long").alias("slot"),
    )


def assign(docs: DataFrame, params: Params | None = None) -> DataFrame:
    """doc_id, size (UTF-8 bytes and one), crc, group (of equal texts), linked, shard and slot of every document."""
    p = params or Params()
    t = text_of()
    group = F.unhex(F.md5(t))
    rows = cut(
        docs.select(
            "doc_id",
            (F.octet_length(t) + 1).cast("long").alias("size"),
            F.crc32(t).cast("long").alias("crc"),
            group.alias("group"),
        )
    )
    rows = numbered(rows, ["doc_id", "group"], "at")
    rows = cut(
        rows.withColumns(
            {
                "shard": F.pmod(F.xxhash64("doc_id", "group", "at", F.lit(p.seed)), F.lit(p.shards)).cast("int"),
                "die": F.shiftrightunsigned(F.xxhash64(F.lit(p.seed + 1), "doc_id", "group", "at"), 8),
            }
        )
    )
    total = rows.count()
    groups = _propagate(rows, total, p)
    # The document's share of its group, by hash, finds its part.
    found = join_named(rows, groups, "group", "left")
    at = F.pmod(F.col("die"), F.col("total"))
    part = F.get(F.filter("parts", lambda x: x["upto"] > at), F.lit(0))["shard"]
    labelled = found.select(
        "doc_id", "size", "crc", "group", "at", "die",
        F.col("total").isNotNull().alias("linked"),
        F.coalesce("total", F.lit(1)).alias("total"),
        F.coalesce(part, F.col("shard")).alias("shard"),
    )
    return _settle(cut(labelled), total, p)
