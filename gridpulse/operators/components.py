"""Connected components of a distributed edge list by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import cut


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())


#: Edges to a task, about. A graph of no more is kept in one partition, where rounds need no shuffle; one that needs fewer
#: tasks than Spark's shuffles have is dealt to so many.
EDGES = 200_000


def _dealt(edges: DataFrame, key: str, n: int) -> DataFrame:
    tasks = -(-n // EDGES) or 1
    if tasks == 1:
        return edges.coalesce(1)
    few = tasks < int(edges.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return edges.repartition(tasks, key) if few else edges


def _round(edges: DataFrame, n: int) -> DataFrame:
    """A large star (each node's larger neighbours go to its smallest neighbour or itself) and a small star (each
    node's smaller neighbours go to the smallest); both keep the components. n: about how many edges there are."""
    both = _dealt(edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))), "a", n)
    low = both.groupBy("a").agg(F.min("b").alias("m"))
    large = _dealt(both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.least("a", "m").alias("b")), "a", n)
    low = large.groupBy("a").agg(F.min("b").alias("m"))
    small = large.join(low, "a").select(F.when(F.col("b") == F.col("m"), F.col("a")).otherwise(F.col("b")).alias("a"), F.col("m").alias("b"))
    return cut(_dealt(small.where("a != b"), "a", n).distinct())


def contracted(edges: DataFrame, rounds: int) -> DataFrame:
    """Edges a > b with the same components, brought closer to their smallest nodes by some rounds."""
    edges = cut(edges.where("a != b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    n = edges.count() if rounds else 0
    for _ in range(rounds):
        edges = _round(edges, n)
    return edges


def components(edges: DataFrame, rounds: int = 60) -> DataFrame:
    """node, root for every node with an edge; ``edges`` has columns a and b of one orderable type.

    Rounds of alternating stars follow until nothing changes (Kiveris et al. 2014). Minima are aggregated before they
    are shuffled and each round is written to the checkpoint folder, so no node's neighbourhood is ever gathered in one
    task. Null nodes and loops are ignored.
    """
    edges = contracted(edges, 0)
    state = _state(edges)
    for _ in range(rounds):
        edges = _round(edges, state[0])
        state, before = _state(edges), state
        if state == before:
            break
    else:
        raise RuntimeError(f"components have not settled in {rounds} rounds")
    roots = edges.select(F.col("b").alias("node")).distinct().withColumn("root", F.col("node"))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
