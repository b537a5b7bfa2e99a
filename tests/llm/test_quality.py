import math
import random

import pytest
from pyspark.sql import functions as F

from gridpulse.llm import quality

LABELS = "doc_id long, quality int"


def brute(text):
    t = text or ""
    words = [w for w in t.replace("\t", " ").replace("\n", " ").replace("\x0b", " ").replace("\x0c", " ").replace("\r", " ").split(" ") if w]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    twice = {w for w in windows if windows.count(w) > 1} if len(windows) < 500 else set(windows)
    covered = {i + k for i, w in enumerate(windows) if w in twice for k in range(5)}
    lines = [x for x in t.split("\n") if x.strip(" \t\n\x0b\x0c\r")]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in t), len(lines) - len(set(lines)), len(covered)


def test_measures_by_brute_force(spark):
    rnd = random.Random(0)
    texts = [None, "", " ", "a b c d e a b c d e", "a b c d e f a b c d e", "x\n\nx\n x", "a " * 300, "#$ é|漢\x0b<"]
    texts += ["".join(rnd.choice(["a", "b", " ", "\n", "# "]) + " " for _ in range(rnd.randint(0, 60))) for _ in range(60)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in quality.measure(df).collect():
        assert tuple(r.measures)[:5] == brute(r.text), r.text


def test_odd_rows_and_empty_tables(spark, odd, none):
    labels = spark.createDataFrame([(4, 1), (5, None), (None, 0), (6, 0), (6, 1)], LABELS)
    got = quality.rate(odd, labels).collect()
    assert len(got) == 10 and all(r.measures.kept is not None for r in got)
    assert {r.doc_id for r in quality.keep(odd, labels).collect()} == {5, 6, None}
    assert quality.keep(odd, labels).columns == odd.columns
    assert quality.keep(odd, labels.limit(0)).count() == 4
    assert quality.rate(none, labels).count() == 0
    assert quality.rate(odd.withColumn("Measures", F.lit("x")), labels).where("measures.kept").count() == 4


@pytest.mark.parametrize("n,k,p", [(10, 0, 0.1), (100, 3, 0.05), (2000, 12, 0.0125), (50, 0, 0.02)])
def test_binomial_tail(spark, n, k, p):
    exact = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    tail = quality.binomial_tail(F.col("k"), F.col("n"), p)
    got = spark.createDataFrame([(k, n)], "k long, n long").select(tail).first()[0]
    assert got == pytest.approx(exact if k <= n * p else 1.0, rel=1e-9)


def test_certified_rules_hold_the_risk_and_need_enough_labels(spark):
    good = "plain words that say something of interest to every reader number{} again"
    bad = "junk ### $$$ words *** that && say %%% nothing ||| at ### all {} $$$"
    rows = [(i, (bad if i % 4 == 0 else good).format(i), "en") for i in range(6000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 != 0).cast("int").alias("quality"))
    kept = {r.doc_id for r in quality.keep(docs, labels).collect()}
    assert kept == {i for i, *_ in rows if i % 4}
    assert fitted(docs, labels.where("doc_id < 60")) == []


def fitted(docs, labels):
    known = quality.measure(docs.join(quality.known_labels(labels), "doc_id"), "m").select("doc_id", "lang", "good", "m")
    return quality.fit(known).collect()


def test_rules_that_would_reject_good_documents_are_not_certified(spark):
    rows = [(i, "## words of good and of bad documents alike are here to be read " + str(i), "en") for i in range(4000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    labels = docs.select("doc_id", (F.col("doc_id") % 4 != 0).cast("int").alias("quality"))
    assert fitted(docs, labels) == []


def test_a_stratum_stands_alone(spark, monkeypatch):
    """A hundred strata; one has enough labels, one too few, one a signal that good documents share, one no label."""
    plain = "plain words that say something of interest to every reader number{} again"
    junk = plain + " ### $$$ &&& %%% |||"
    rows = []
    for stratum, n in (("many", 4000), ("few", 60), ("shared", 4000), ("none", 100), *((f"x{i}", 4) for i in range(96))):
        rows += [(len(rows), (junk if i % 4 == 0 or stratum == "shared" else plain).format(i), stratum, i % 4 != 0) for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, good boolean")
    labels = docs.where("lang != 'none'").select("doc_id", F.col("good").cast("int").alias("quality"))
    for most in (quality.MAX_BROADCAST, 0):
        monkeypatch.setattr(quality, "MAX_BROADCAST", most)
        kept = {r.doc_id for r in quality.keep(docs.drop("good"), labels).collect()}
        assert kept == {i for i, _, stratum, good in rows if good or stratum != "many"}
        assert kept == {r.doc_id for r in quality.rate(docs, labels).where("measures.kept").collect()}


def test_the_share_of_good_documents_lost_stays_below_the_risk(spark):
    """Good and bad documents overlap in a signal; the share lost is told from documents that had no label."""
    rnd = random.Random(6)
    rows = []
    for i in range(12000):
        good = i % 3 > 0
        signs = rnd.choices(range(12), [100] + [1] * 11 if good else [1] * 12)[0]
        rows.append((i, f"plain words that say something of interest to every reader number{i} again " + " ".join(f"#{c}" for c in "abcdefghijkl"[:signs]), "en", good))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, good boolean")
    labels = docs.where("doc_id < 6000").select("doc_id", F.col("good").cast("int").alias("quality"))
    lost = quality.rate(docs, labels, quality.Params(weight=1)).join(docs.select("doc_id", "good"), "doc_id").where("doc_id >= 6000 AND NOT measures.kept")
    good, bad = (lost.where(c).count() for c in ("good", "NOT good"))
    assert good <= 0.05 * 4000 and bad > 200


def test_the_given_tables_certify_a_rule(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.01/{t}.parquet") for t in ("documents", "labels"))
    assert [r.stratum for r in fitted(docs, labels)] == ["=en"]
    assert quality.rate(docs, labels).where("NOT measures.kept AND NOT measures.base_failed").count() > 0
