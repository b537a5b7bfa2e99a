"""Quality rules with risk-controlled thresholds (native).

A rule rejects a document whose signal exceeds a cutoff. Labelled documents are split by a hash of their id. One half
proposes: for each stratum and signal the cutoff that gains most. The other half, the holdout, certifies: the
proposals of a stratum act together, and the hypothesis "they reject more than ``risk`` of the good documents" has to be
refuted by the exact binomial tail. Cutoffs are tested from the loosest on, all signals at once and none beyond its
proposal, and testing stops at the first that isn't refuted (fixed-sequence testing, so one stratum is one test); the
level is divided by the number of strata that propose anything, which the first half settles (Bonferroni). So with
probability 1 - delta, no stratum loses more than ``risk`` of its good documents. With risk and delta of 5 % a stratum
alone needs 59 good documents in the holdout, one of four 86, and none of them rejected.

Nulls and edge cases: a null text has no words; a null language is a stratum of its own; labels without a
quality are ignored, and of several labels for one document the worst counts; repeated documents are rated one
by one; a stratum without labels, or with too few to certify anything, knows the base rules only. Other columns are kept.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from dataclasses import dataclass, field
from functools import reduce
from operator import or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import WHITE, cut, join_named, text_of, unit_hash, without, words

SYMBOLS = "#*$%&|<>"
SHOUTS = "!ABCDEFGHIJKLMNOPQRSTUVWXYZ"
WINDOW = 5
#: Signals per mille, each with the numerator and the denominator among the measures.
SIGNALS = {
    "symbols": ("n_symbols", "word_chars"),
    "dup_lines": ("n_dup_lines", "n_lines"),
    "repeats": ("n_repeat_words", "n_words"),
    "shouts": ("n_shouts", "word_chars"),
}
CUTOFFS = (1000, 700, 500, 400, 300, 200, 150, 100, 75, 50, 30, 20, 10, 5, 2)


#: Up to so many labels or strata (about 50 bytes each) are broadcast; beyond it Spark joins by shuffling.
MAX_BROADCAST = 200_000


@dataclass(frozen=True)
class Params:
    """risk: the share of good documents that the signals together may reject in a stratum; delta: the chance
    that this fails anywhere; weight: good documents lost count so many times a bad one caught when a cutoff is
    proposed."""

    risk: float = 0.05
    delta: float = 0.05
    weight: int = 10
    cutoffs: tuple[int, ...] = field(default=CUTOFFS)


def _repeated(hashes: Column) -> Column:
    """Words in windows that occur twice or more: sort windows by hash, keep those with an equal neighbour,
    then measure the union of their spans in text order."""
    pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def spans(s: Column) -> Column:
        twice = F.filter(s, lambda e, j: (F.get(s, j - 1)["h"] == e["h"]) | (F.get(s, j + 1)["h"] == e["h"]))
        return F.aggregate(
            F.sort_array(F.transform(twice, lambda e: e["i"])),
            F.struct(F.lit(0).alias("end"), F.lit(0).alias("n")),
            lambda a, p: F.struct(
                (p + WINDOW).alias("end"), (a["n"] + p + WINDOW - F.greatest(p, a["end"])).alias("n")
            ),
            lambda a: a["n"],
        )

    return F.when(F.size(hashes) == F.size(F.array_distinct(hashes)), F.lit(0)).otherwise(
        F.get(F.transform(F.array(pairs), spans), F.lit(0))
    )


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body(value) with the value computed once, however often the body names it and wherever Spark moves it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _measures(t: Column) -> Column:
    lines = F.filter(F.split(t, "\n"), lambda x: F.length(without(x, WHITE)) > 0)

    def hashes(word: Column) -> Column:
        windows = F.transform(
            F.sequence(F.lit(0), F.size(word) - WINDOW),
            lambda i: F.xxhash64(*[F.get(word, i + k) for k in range(WINDOW)]),
        )
        return F.when(F.size(word) >= WINDOW, windows).otherwise(F.array().cast("array<bigint>"))

    def all_of(word: Column, line: Column, repeated: Column) -> Column:
        parts = {
            "n_words": F.size(word),
            "word_chars": F.length(without(t, WHITE)),
            "n_symbols": F.length(t) - F.length(without(t, SYMBOLS)),
            "n_dup_lines": F.size(line) - F.size(F.array_distinct(line)),
            "n_repeat_words": repeated,
            "n_lines": F.size(line),
            "n_shouts": F.length(t) - F.length(without(t, SHOUTS)),
        }
        return F.struct(*[v.cast("long").alias(k) for k, v in parts.items()])

    return _let(
        words(t),
        lambda w: _let(lines, lambda x: _let(_let(hashes(w), _repeated), lambda r: all_of(w, x, r))),
    )


def measure(docs: DataFrame, out: str = "measures", text: str = "text") -> DataFrame:
    """Adds one struct column with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines and
    n_shouts of the whole text, all long. A column of its name is replaced. It comes out of a generator, so a filter
    on it is not pushed below and the text is measured once."""
    return docs.select(*[c for c in docs.columns if c.lower() != out.lower()], F.explode(F.array(_measures(text_of(text)))).alias(out))


def base_failed(m: Column) -> Column:
    return (m["n_words"] < 10) | (100 * m["n_repeat_words"] > 20 * m["n_words"])


def signal(m: Column, name: str) -> Column:
    """A signal per mille, rounded down; 0 where there is nothing to measure."""
    num, den = SIGNALS[name]
    return F.floor(F.when(m[den] > 0, 1000 * m[num] / m[den]).otherwise(0.0)).cast("long")


def _stratum(lang: str) -> Column:
    return F.coalesce(F.concat(F.lit("="), F.col(lang)), F.lit("(null)"))


def binomial_tail(k: Column, n: Column, p: float) -> Column:
    """P(X <= k) for X ~ Binomial(n, p); 1 where k is above the mean, which no test needs exactly."""
    odds = p / (1 - p)
    first = n * F.lit(math.log1p(-p))
    total = F.aggregate(
        F.when(k > 0, F.sequence(F.lit(1).cast("long"), k)).otherwise(F.array().cast("array<bigint>")),
        F.struct(first.alias("ln"), F.exp(first).alias("sum")),
        lambda a, i: F.struct(
            (a["ln"] + F.log((n - i + 1) / i * odds)).alias("ln"),
            (a["sum"] + F.exp(a["ln"] + F.log((n - i + 1) / i * odds))).alias("sum"),
        ),
        lambda a: a["sum"],
    )
    return F.when(k > n * p, F.lit(1.0)).otherwise(total)


def known_labels(labels: DataFrame) -> DataFrame:
    """doc_id and good, one row for each document with a label."""
    rows = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull())
    return cut(rows.groupBy("doc_id").agg((F.min("quality") > 0).alias("good")))


def fit(rated: DataFrame, params: Params | None = None) -> DataFrame:
    """stratum and a cutoff for each signal (null: no rule), a row for each stratum with a certified rule, from labelled
    documents: doc_id, lang, good and the measures m. Only counts leave the rows."""
    p = params or Params()
    last = len(p.cutoffs) - 1

    def step(s: str) -> Column:
        """How many cutoffs, from the loosest, leave the document in; it is rejected by every later one."""
        return sum(((signal(F.col("m"), s) <= c).cast("int") for c in p.cutoffs), F.lit(0))

    rows = cut(
        rated.select(
            _stratum("lang").alias("stratum"), "good", (unit_hash(F.lit("half"), F.col("doc_id")) < 0.5).alias("tune"), F.struct(*[step(s).alias(s) for s in SIGNALS]).alias("step")
        )
    )
    each = F.explode(F.array(*[F.struct(F.lit(s).alias("signal"), F.col(f"step.{s}").alias("step")) for s in SIGNALS]))
    tuned = rows.where("tune").select("stratum", "good", each.alias("x")).groupBy("stratum", "x.signal", "x.step")
    tuned = tuned.agg(F.sum(F.when(F.col("good"), -p.weight).otherwise(1)).alias("gain"))
    # What a cutoff rejects: all whose step is at most its place.
    gains = tuned.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(last)))).where("step <= at").groupBy("stratum", "signal", "at").agg(F.sum("gain").alias("gain"))
    best = gains.groupBy("stratum", "signal").agg(F.max_by("at", F.struct(F.col("gain"), -F.col("at"))).alias("at"), F.max("gain").alias("gain"))
    one = [F.max(F.when(F.col("signal") == s, F.col("at"))).alias(f"at_{s}") for s in SIGNALS]
    proposed = cut(best.where("gain > 0").groupBy("stratum").agg(*one))
    n_strata = proposed.count()
    held = join_named(rows.where("good AND NOT tune"), _few(proposed), "stratum")
    # Together the signals reject a document from the first place on that one of them does, within its proposal.
    first = F.array_min(F.array(*[F.when(F.col(f"step.{s}") <= F.col(f"at_{s}"), F.col(f"step.{s}")) for s in SIGNALS]))
    counts = cut(held.groupBy("stratum", first.alias("first")).agg(F.count("*").alias("n")))
    places = counts.withColumn("at", F.explode(F.sequence(F.lit(0), F.lit(last))))
    places = places.groupBy("stratum", "at").agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("first") <= F.col("at"), F.col("n"))), F.lit(0)).alias("k"))
    refuted = binomial_tail(F.col("k"), F.col("n"), p.risk) <= p.delta / max(n_strata, 1)
    passed = places.withColumn("ok", refuted).groupBy("stratum").agg(F.coalesce(F.min(F.when(~F.col("ok"), F.col("at"))), F.lit(last + 1)).alias("stopped"))
    grid = F.array(*[F.lit(c) for c in p.cutoffs])
    cutoffs = [F.get(grid, F.least(F.col(f"at_{s}"), F.col("stopped") - 1)).alias(s) for s in SIGNALS]
    # F.least skips nulls; a signal that proposed nothing has no rule.
    cutoffs = [F.when(F.col(f"at_{s}").isNotNull(), c).alias(s) for s, c in zip(SIGNALS, cutoffs)]
    return cut(proposed.join(passed.where("stopped > 0"), "stratum").select("stratum", *cutoffs))


def _few(df: DataFrame) -> DataFrame:
    """Marked for broadcast if the rows, which are cut, are few."""
    return F.broadcast(df) if df.count() <= MAX_BROADCAST else df


def judge(rated: DataFrame, rules: DataFrame, m: str) -> DataFrame:
    """Adds base_failed and kept to the struct ``m`` of measures. Rows without a rule for their stratum stay."""
    found = rules.select(F.col("stratum").alias("__stratum"), F.struct(*SIGNALS).alias("__most"))
    joined = rated.join(_few(found), _stratum("lang") == F.col("__stratum"), "left")
    c = F.col(m)
    over = [F.coalesce(signal(c, s) > F.col(f"__most.{s}"), F.lit(False)) for s in SIGNALS]
    out = c.withField("base_failed", base_failed(c)).withField("kept", ~base_failed(c) & ~reduce(or_, over))
    return joined.withColumn(m, out).drop("__stratum", "__most")


def rate(docs: DataFrame, labels: DataFrame, params: Params | None = None) -> DataFrame:
    """doc_id, lang and the struct measures, with base_failed and kept in it, of every document. Each text is measured
    once, and only its measures are shuffled to meet the labels."""
    measured = cut(measure(docs.select("doc_id", "lang", "text"), "measures").select("doc_id", "lang", "measures"))
    known = measured.withColumnRenamed("measures", "m").join(_few(known_labels(labels)), "doc_id")
    return judge(measured, fit(known, params), "measures")


def keep(docs: DataFrame, labels: DataFrame, params: Params | None = None) -> DataFrame:
    """The documents that the rules keep, with their own columns only. Labelled texts are measured twice; they are
    shuffled if there are too many labels to broadcast."""
    known = docs.select("doc_id", "lang", "text").join(_few(known_labels(labels)), "doc_id")
    rules = fit(measure(known, "m").select("doc_id", "lang", "good", "m"), params)
    judged = judge(measure(docs, "__measures"), rules, "__measures")
    return judged.where("__measures.kept").select(*[F.col(f"`{c}`") for c in docs.columns])
