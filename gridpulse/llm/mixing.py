"""Mixing sources to target weights (native).

Words are summed per source, targets follow from the weights, and each source gets a repetition rate. A document
is emitted floor(rate) times, plus once more if a hash of the seed, its id and its text falls below the fraction. The
draw depends on nothing else, so reruns agree on any cluster; rows with the same id and text are numbered, and each
draws for itself.

Nulls and edge cases: a null text has size 0 and draws like an empty one, a null source is a source (last in order), a
null id draws like any other value; a source without words has rate 0; an empty table stays empty. Columns of the input
are kept, whatever their names; the names that begin with __mix are used here.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import count_words, cut, numbered, text_of, unit_hash

#: Up to so many sources the rates are broadcast (about 100 bytes each); beyond it Spark joins by shuffling.
MAX_BROADCAST_SOURCES = 50_000


def targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0) -> DataFrame:
    """source, source_size, target, rate from one row per source (source, source_size).

    Sources by code point, null last, take the weights in turn. A target stops at ``cap`` times its source and
    the excess is shared again by weight. That has a closed form: with the sources sorted by cap / weight, the
    first ones stop and the rest share what is left. The windows run over one row per source.
    """
    order = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(order) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (turn + 1).cast("int"))
    s = sizes.withColumn("weight", weight).withColumn("most", cap * F.col("source_size"))
    by = W.orderBy(F.col("most") / F.col("weight"), F.col("source").asc_nulls_last())
    before, after = by.rowsBetween(W.unboundedPreceding, -1), by.rowsBetween(0, W.unboundedFollowing)
    everything = W.rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    left = F.sum("source_size").over(everything) - F.coalesce(F.sum("most").over(before), F.lit(0.0))
    s = s.withColumn("share", left / F.sum("weight").over(after))
    # The first source whose cap is not reached fixes the share of all that follow.
    free = F.when(F.col("share") * F.col("weight") <= F.col("most"), F.col("share"))
    level = F.first(free, ignorenulls=True).over(by.rowsBetween(W.unboundedPreceding, 0))
    target = F.coalesce(F.least(level * F.col("weight"), F.col("most")), F.col("most"))
    rate = F.when(F.col("source_size") > 0, target / F.col("source_size")).otherwise(F.lit(0.0))
    return s.select("source", "source_size", target.alias("target"), rate.alias("rate"))


def drawn(docs: DataFrame, id: str = "doc_id") -> DataFrame:
    """Adds what the draw of a row depends on: the text's MD5 __mix_text and, where id and text repeat, a number
    __mix_at."""
    return numbered(docs.withColumn("__mix_text", F.md5(text_of())), [id, "__mix_text"], "__mix_at")


def copies(rate: Column, id: str = "doc_id", seed: int = 0) -> Column:
    """How often a document is emitted: floor(rate), plus one with probability of the fraction."""
    whole = F.floor(rate)
    draw = unit_hash(F.lit(seed), F.coalesce(F.col(id).cast("string"), F.lit("null")), F.col("__mix_text"), F.col("__mix_at"))
    return (whole + (draw < rate - whole).cast("int")).cast("int")


def _with_rates(docs: DataFrame, rates: DataFrame, source: str) -> DataFrame:
    """The documents with the struct __mix of their source's figures."""
    rates = cut(rates)
    keyed = rates.select(F.col("source").alias("__mix_source"), F.struct("source_size", "target", "rate").alias("__mix"))
    if keyed.count() <= MAX_BROADCAST_SOURCES:
        keyed = F.broadcast(keyed)
    return docs.join(keyed, F.col(source).eqNullSafe(F.col("__mix_source")), "left").drop("__mix_source")


def plan(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0, seed: int = 0) -> DataFrame:
    """doc_id, size, source_size, target, taken for each document. The texts are read once."""
    sized = docs.select("doc_id", "source", count_words(text_of()).alias("size"), F.md5(text_of()).alias("__mix_text"))
    sized = cut(numbered(cut(sized), ["doc_id", "__mix_text"], "__mix_at"))
    sums = sized.groupBy("source").agg(F.sum("size").alias("source_size"))
    mixed = _with_rates(sized, targets(sums, weights, cap), "source")
    n = copies(F.col("__mix.rate"), seed=seed)
    return mixed.select("doc_id", "size", "__mix.source_size", "__mix.target", (F.col("size") * n).alias("taken"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), cap: float = 3.0, seed: int = 0) -> DataFrame:
    """The documents, each as often as the mix takes it, with the columns of ``docs``. Only texts of rows with the same
    id and text are shuffled."""
    sums = docs.groupBy("source").agg(F.sum(count_words(text_of())).alias("source_size"))
    mixed = _with_rates(drawn(docs), targets(sums, weights, cap), "source")
    n = copies(F.col("__mix.rate"), seed=seed)
    return mixed.withColumn("__mix_copy", F.explode(F.array_repeat(F.lit(0), n))).select(*[F.col(f"`{c}`") for c in docs.columns])
