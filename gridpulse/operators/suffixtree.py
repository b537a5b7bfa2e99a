"""Root cause from the order of alarm codes: a prediction suffix tree for each cause.

A tree holds, for each context of up to ``depth`` codes that a cause's sequences contain, how often each code follows. It is a
table, counted by one grouped sum over all sequences. The probability of a code after a context backs off to the context
without its oldest code, with a weight that falls with the context's count, down to the shares of single codes; a sequence's
cause is the one under which the sequence, and the cause itself, are likeliest. Scoring joins the places of the sequences
with the table; no model is held by the driver but the list of causes.

Nulls and edge cases: null and empty sequences are scored by the shares of the causes; null codes are a code of their own;
sequences without a cause are not trained on; codes and contexts never seen back off to what is left of them; ties go to
the smaller cause; without any cause nothing can be fitted (ValueError); an empty table gives an empty result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import cut, small


def _codes(sequence: str, length: int) -> Column:
    s = F.coalesce(F.col(sequence), F.array().cast("array<string>"))
    s = F.transform(s, lambda c: F.coalesce(F.concat(F.lit("="), c), F.lit("?")))
    return F.slice(s, F.greatest(F.size(s) - length + 1, F.lit(1)), length)


def _places(df: DataFrame, depth: int, *keys: str) -> DataFrame:
    """keys, place, order, context and code: for each place of a sequence in ``codes`` its contexts of 0 to depth codes."""
    at = df.select(*keys, "codes", F.explode(F.sequence(F.lit(1), F.size("codes"))).alias("place")).where("size(codes) > 0")
    order = F.explode(F.sequence(F.lit(0), F.least(F.lit(depth), F.col("place") - 1))).alias("order")
    some = at.select(*keys, "codes", "place", order)
    context = F.slice("codes", F.col("place") - F.col("order"), F.col("order"))
    return some.select(*keys, "place", "order", context.alias("context"), F.element_at("codes", F.col("place")).alias("code"))


class SuffixTrees:
    """``weight``: a context that was seen so often counts as much as the one that it backs off to."""

    def __init__(self, label: str = "dominant_root_cause", sequence: str = "alarm_sequence", depth: int = 4, length: int = 20, weight: float = 2.0):
        self.label, self.sequence, self.depth, self.length, self.weight = label, sequence, depth, length, weight

    def fit(self, df: DataFrame) -> SuffixTrees:
        known = df.where(F.col(self.label).isNotNull()).select(F.col(self.label).alias("cause"), _codes(self.sequence, self.length).alias("codes"))
        causes = {r.cause: r.n for r in known.groupBy("cause").agg(F.count("*").alias("n")).collect()}  # a row for each cause
        if not causes:
            raise ValueError("no sequence has a cause")
        self.causes = {c: n / sum(causes.values()) for c, n in sorted(causes.items())}
        counts = _places(known, self.depth, "cause").groupBy("context", "code", "cause").agg(F.count("*").alias("n"))
        # By context and code, the counts under all causes in one row; by context their sums.
        self.counts = cut(counts.groupBy("context", "code").agg(F.map_from_entries(F.collect_list(F.struct("cause", "n"))).alias("seen")))
        sums = counts.groupBy("context", "cause").agg(F.sum("n").alias("n"))
        self.sums = cut(sums.groupBy("context").agg(F.map_from_entries(F.collect_list(F.struct("cause", "n"))).alias("all")))
        self.vocabulary = max(1, self.counts.where("size(context) = 0").count())
        return self

    def likelihoods(self, df: DataFrame, key: str) -> DataFrame:
        """key and likelihood, a map from each cause to the logarithm of its share times that of the sequence."""
        # Orders of one place meet in one array; the longest comes last.
        places = _places(df.select(F.col(key).alias("key"), _codes(self.sequence, self.length).alias("codes")), self.depth, "key")
        found = places.join(small(self.counts), ["context", "code"], "left").join(small(self.sums), "context", "left")
        entry = F.struct("order", F.map_entries("seen").alias("seen"), F.map_entries("all").alias("sums"))
        orders = found.groupBy("key", "place").agg(F.sort_array(F.collect_list(entry)).alias("orders"))
        base = 1.0 / (self.vocabulary + 1)

        def number(entries: Column, cause: str) -> Column:
            hit = F.filter(F.coalesce(entries, F.array().cast("array<struct<key:string,value:bigint>>")), lambda e: e["key"] == cause)
            return F.coalesce(F.get(hit, F.lit(0))["value"], F.lit(0)).cast("double")

        def probability(cause: str) -> Column:
            step = lambda p, o: (number(o["seen"], cause) + self.weight * p) / (number(o["sums"], cause) + self.weight)
            return F.log(F.aggregate("orders", F.lit(base), step))

        sums = orders.groupBy("key").agg(*[F.sum(probability(c)).alias(f"l{i}") for i, c in enumerate(self.causes)])
        every = df.select(F.col(key).alias("key")).join(sums, "key", "left")
        entries = [x for i, (c, share) in enumerate(self.causes.items()) for x in (F.lit(c), F.coalesce(f"l{i}", F.lit(0.0)) + F.log(F.lit(share)))]
        return every.select(F.col("key").alias(key), F.create_map(*entries).alias("likelihood"))

    def score(self, df: DataFrame, key: str = "incident") -> DataFrame:
        """The rows with predicted_root_cause and confidence, the cause's share of all likelihoods. The key is unique."""
        names = [c for c in df.columns if c not in ("predicted_root_cause", "confidence")]
        entries = F.map_entries("likelihood")
        best = F.array_max(F.transform(entries, lambda e: e["value"]))
        total = F.aggregate(entries, F.lit(0.0), lambda a, e: a + F.exp(e["value"] - F.col("__best")))
        judged = self.likelihoods(df, key).withColumn("__best", best)
        cause = F.array_min(F.transform(F.filter(entries, lambda e: e["value"] == F.col("__best")), lambda e: e["key"]))
        judged = judged.select(F.col(key).alias("__key"), cause.alias("predicted_root_cause"), (1 / total).alias("confidence"))
        rows = df.select(*names)
        return rows.join(judged, rows[key] == F.col("__key")).select(*[rows[c] for c in names], "predicted_root_cause", "confidence")
