"""Secret scans: a random forest that removes false positives (native).

Candidates are long runs of key characters with a digit, every one of a word. Each has features of its length, its
character transitions, how much of it a dictionary of the corpus covers, its path (the source and the separators in it)
and the words around it, to which belongs what stands before it in its own word. A forest trained on labelled findings
scores every candidate of the corpus. Documents are dealt into folds by a hash of their id, and a fold is scored by a
forest that has seen none of its documents, so a score is never the memory of a label.

Nulls and edge cases: a null or empty text has no candidates; a null source is one of its own; long texts are
scanned whole; a text may hold a candidate several times, a row for each; documents with a null id are a fold's like
others; if the findings of the other folds have labels of one kind only there is nothing to learn, and a candidate
gets their share of secrets as its score; without findings the score is null and every candidate is kept. Columns other
than doc_id, text and source are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, text_of, unit_hash, words

KEY = r"[A-Za-z0-9+/_\-]{16,}={0,2}"
#: A run of key characters with what stands between it and the run before.
EACH = rf"(?s)\G(.*?)({KEY})"
NUMBERS = ("length", "digits", "hex", "upper", "turns", "bigrams", "vowels", "coverage", "separators")


@dataclass(frozen=True)
class Params:
    """max_findings: about so many labelled findings train the forest, chosen by hash; min_count: a word is in
    the dictionary if the corpus has it so often."""

    folds: int = 2
    trees: int = 40
    depth: int = 6
    buckets: int = 64
    max_findings: int = 20_000
    min_count: int = 20
    gram: int = 4
    threshold: float = 0.5
    seed: int = 7


def candidates(docs: DataFrame) -> DataFrame:
    """doc_id, source, word (its place among the words), place (among the word's runs), candidate, before2, before,
    after, quoted (a quote is right before it)."""
    t = text_of()
    w = docs.where(t.rlike(KEY)).select("doc_id", "source", words(t).alias("w"))
    word = F.col("w")
    around = F.transform(
        word,
        lambda x, i: F.when(
            x.rlike(KEY) & x.rlike("[0-9]"),
            F.struct(
                i.cast("long").alias("word"),
                x.alias("x"),
                F.lower(F.get(word, i - 2)).alias("left2"),
                F.lower(F.get(word, i - 1)).alias("left"),
                F.lower(F.get(word, i + 1)).alias("after"),
            ),
        ),
    )
    some = w.select("doc_id", "source", F.explode(F.filter(around, lambda x: x.isNotNull())).alias("c"))
    gaps, runs = (F.regexp_extract_all("c.x", F.lit(EACH), F.lit(k)) for k in (1, 2))
    each = some.select("doc_id", "source", "c", gaps.alias("gaps"), runs.alias("runs"))
    # The run before each run; the list is longer by one, whose row has no run and goes.
    each = each.withColumn("prior", F.concat(F.array(F.lit("")), "runs"))
    each = each.select("doc_id", "source", "c", F.posexplode(F.arrays_zip("gaps", "runs", "prior")).alias("place", "r"))
    each = each.where(F.col("r.runs").rlike("[0-9]"))
    # Names and signs before the run in its word, without quotes and brackets.
    text = F.translate(F.lower(F.concat("r.prior", "r.gaps")), "\"'`()[]{}<>", "")
    each = each.withColumn("inner", F.regexp_extract_all(text, F.lit(r"[\p{L}\p{N}_.+/\-]+|[^\p{L}\p{N}_.+/\-]+"), F.lit(0)))
    n = F.size("inner")
    last = F.get("inner", n - 1)
    return each.select(
        "doc_id",
        "source",
        F.col("c.word").alias("word"),
        F.col("place").cast("long").alias("place"),
        F.col("r.runs").alias("candidate"),
        F.when(n == 0, F.col("c.left2")).when(n == 1, F.col("c.left")).otherwise(F.get("inner", n - 2)).alias("before2"),
        F.when(n == 0, F.col("c.left")).otherwise(last).alias("before"),
        F.col("c.after").alias("after"),
        F.col("r.gaps").rlike("[\"'`]$").alias("quoted"),
    )


def dictionary(docs: DataFrame, params: Params) -> DataFrame:
    """gram: those in the corpus's frequent words of letters, counted over all documents."""
    spoken = docs.select(F.explode(words(F.lower(text_of()))).alias("w")).groupBy("w").count()
    known = spoken.where((F.col("count") >= params.min_count) & F.col("w").rlike(rf"^\p{{L}}{{{params.gram},}}$"))
    return known.select(F.explode(_grams(F.col("w"), params.gram)).alias("gram")).distinct()


def _grams(text: Column, n: int) -> Column:
    return F.regexp_extract_all(text, F.lit(f"(?=(.{{{n}}}))"), F.lit(1))


def _count(text: Column, chars: str) -> Column:
    return F.regexp_count(text, F.lit(chars))


def features(found: DataFrame, grams: DataFrame, params: Params) -> DataFrame:
    """The candidates with the numbers and the words of the forest."""
    c, n = F.col("candidate"), F.length("candidate")
    pairs = _grams(c, 2)
    distinct = found.select("candidate").distinct()
    covered = (
        distinct.select("candidate", F.explode(_grams(F.lower(c), params.gram)).alias("gram"))
        .join(grams, "gram")
        .groupBy("candidate")
        .agg(F.count("*").alias("covered"))
    )
    turns = r"(?<=[a-z])(?=[A-Z0-9])|(?<=[A-Z])(?=[a-z0-9])|(?<=[0-9])(?=[A-Za-z])"
    shape = distinct.join(covered, "candidate", "left").select(
        "candidate",
        n.cast("double").alias("length"),
        (_count(c, "[0-9]") / n).alias("digits"),
        (_count(c, "[0-9a-f]") / n).alias("hex"),
        (_count(c, "[A-Z]") / n).alias("upper"),
        (_count(c, turns) / n).alias("turns"),
        (F.size(F.array_distinct(pairs)) / F.size(pairs)).alias("bigrams"),
        (_count(c, "[aeiouAEIOU]") / n).alias("vowels"),
        (F.coalesce("covered", F.lit(0)) / (n - params.gram + 1)).alias("coverage"),
        _count(c, r"[/_\-+=]").cast("double").alias("separators"),
    )
    mark = lambda name, value: F.concat(F.lit(name), F.coalesce(value, F.lit("")))
    # Words only: the signs between a name and a candidate are left to `reviewed`.
    said = lambda name: F.when(F.col(name).rlike(r"\p{L}"), F.col(name))
    tokens = F.array(mark("path:", F.col("source")), mark("b:", F.coalesce(said("before"), said("before2"))), mark("a:", said("after")))
    return found.join(shape, "candidate").withColumn("tokens", tokens)


def train(rated: DataFrame, params: Params) -> PipelineModel | float | None:
    """A model from features with a label (0 or 1); the share of secrets if all labels are equal; None without."""
    total, ones = rated.agg(F.count("*"), F.sum("label")).first()
    if not total:
        return None
    if ones in (0, total):
        return float(ones) / total
    share = params.max_findings / total
    some = rated.where(unit_hash(F.lit("findings"), F.col("doc_id"), F.col("word"), F.col("place")) < share) if share < 1 else rated
    # Bounded, so it fits one partition; in one order, so that reruns draw the same bags.
    some = cut(some.repartition(1).sortWithinPartitions("doc_id", "word", "place", "candidate"))
    forest = RandomForestClassifier(
        numTrees=params.trees, maxDepth=params.depth, seed=params.seed, labelCol="label", featuresCol="vector"
    )
    words_in = HashingTF(inputCol="tokens", outputCol="hashed", numFeatures=params.buckets)
    vector = VectorAssembler(inputCols=[*NUMBERS, "hashed"], outputCol="vector")
    return Pipeline(stages=[words_in, vector, forest]).fit(some)


def scan(docs: DataFrame, findings: DataFrame | None = None, params: Params | None = None) -> DataFrame:
    """doc_id, word, place, candidate, score and secret for every candidate.

    findings: doc_id, word, place, label of reviewed candidates; without a place a label is for all of the word.
    Without findings `reviewed` gives labels.
    """
    p = params or Params()
    found = cut(candidates(docs))
    rated = features(found, dictionary(docs, p), p)
    rated = cut(rated.withColumn("fold", F.pmod(F.xxhash64("doc_id", F.lit(p.seed)), F.lit(p.folds)).cast("int")))
    findings = reviewed(rated) if findings is None else findings
    key = [c for c in ("doc_id", "word", "place") if c in findings.columns]
    labels = findings.groupBy(*key).agg(F.max("label").cast("double").alias("label"))
    labelled = cut(rated.join(labels, key))
    out = None
    for fold in range(p.folds):
        own = rated.where(F.col("fold") == fold)
        model = train(labelled.where(F.col("fold") != fold), p)
        if isinstance(model, PipelineModel):
            scored = model.transform(own).withColumn("score", F.get(vector_to_array("probability"), F.lit(1)))
        else:
            scored = own.withColumn("score", F.lit(model).cast("double"))
        secret = F.coalesce(F.col("score") >= p.threshold, F.lit(True))
        scored = scored.select("doc_id", "word", "place", "candidate", "score", secret.alias("secret"))
        out = scored if out is None else out.union(scored)
    return out


def reviewed(found: DataFrame) -> DataFrame:
    """Labels from the signs around a candidate, which the forest doesn't see: assigned and quoted is a secret, neither
    and a plain number is none. The others have no label."""
    assigned = F.coalesce(F.col("before").isin("=", ":", ":=", "=>"), F.lit(False))
    number = F.col("candidate").rlike("^[0-9]+$")
    label = F.when(assigned & F.col("quoted"), 1).when(number & ~assigned & ~F.col("quoted"), 0)
    return found.select("doc_id", "word", "place", label.alias("label")).where("label is not null")
