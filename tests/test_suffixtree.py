"""Prediction suffix trees against plain recursion, and causes that only order tells apart."""

import math
import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from gridpulse.operators import models, suffixtree

ROW = "incident string, alarm_sequence array<string>, dominant_root_cause string"


def accuracy(df):
    return df.agg(F.avg((F.col("dominant_root_cause") == F.col("predicted_root_cause")).cast("double"))).first()[0]


def test_three_codes_in_two_orders(spark):
    """Both causes are made of the same three codes, in blocks of other orders."""
    rnd = random.Random(8)
    rows = []
    for i in range(400):
        cause = rnd.choice(["POWER", "LINK"])
        blocks = [["a", "b", "c"], ["c", "a"], ["b", "a", "c", "b"]] if cause == "POWER" else [["a", "b", "a"], ["c", "b", "c"], ["a", "c", "b"]]
        codes = [c for _ in range(3) for c in rnd.choice(blocks)]
        rows.append((str(i), codes, cause))
    df = models.stratified_split(spark.createDataFrame(rows, ROW), "dominant_root_cause", "incident")
    held = df.where("not train")
    assert accuracy(suffixtree.SuffixTrees().fit(df.where("train")).score(held)) > 0.95


def test_order_that_pairs_do_not_hold(spark):
    """The causes differ in the order of three codes alone."""
    rnd = random.Random(9)
    rows = []
    for i in range(300):
        first = rnd.random() < 0.5
        noise = [rnd.choice("xyz") for _ in range(4)]
        rows.append((str(i), [*noise[:2], *("pqr" if first else "prq"), *noise[2:], *("prs" if first else "pqs")], "A" if first else "B"))
    df = models.stratified_split(spark.createDataFrame(rows, ROW), "dominant_root_cause", "incident")
    fit = lambda: suffixtree.SuffixTrees().fit(df.where("train"))
    held = df.where("not train")
    assert accuracy(fit().score(held)) > 0.97
    key = lambda m: sorted((r.incident, r.predicted_root_cause, round(r.confidence, 9)) for r in m.score(held).collect())
    assert key(fit()) == key(fit())


def plain(train, codes, cause, depth, weight, length=20):
    counts, vocabulary = defaultdict(int), set()
    for s, c in train:
        s = s[-length:]
        vocabulary |= set(s)
        if c == cause:
            for i, x in enumerate(s):
                for k in range(min(depth, i) + 1):
                    counts[tuple(s[i - k : i]), x] += 1
    sums = defaultdict(int)
    for (context, _), n in counts.items():
        sums[context] += n
    out, codes = math.log(sum(c == cause for _, c in train) / len(train)), codes[-length:]
    for i, x in enumerate(codes):
        p = 1 / (len(vocabulary) + 1)
        for k in range(min(depth, i) + 1):
            context = tuple(codes[i - k : i])
            p = (counts[context, x] + weight * p) / (sums[context] + weight)
        out += math.log(p)
    return out


def test_likelihoods_by_recursion(spark):
    rnd = random.Random(10)
    train = [([rnd.choice("abcd") for _ in range(rnd.randint(0, 30))], rnd.choice("XYZ")) for _ in range(60)]
    model = suffixtree.SuffixTrees(depth=3).fit(spark.createDataFrame([(str(i), s, c) for i, (s, c) in enumerate(train)], ROW))
    asked = [["a", "b"], ["e", "a", "e"], [], ["d"] * 25, [rnd.choice("abcde") for _ in range(12)]]
    df = spark.createDataFrame([(str(i), s, None) for i, s in enumerate(asked)], ROW)
    for r in model.likelihoods(df, "incident").collect():
        for cause in "XYZ":
            assert abs(r.likelihood[cause] - plain(train, asked[int(r.incident)], cause, 3, 2.0)) < 1e-9


def test_odd_rows_and_empty_tables(spark):
    rows = [("1", ["a", None, "b"], "X"), ("2", None, "X"), ("3", [], "Y"), ("4", ["b"], None), ("5", [None], "Y"), ("6", ["a"] * 5000, "X")]
    df = spark.createDataFrame([(*r, 1, "x") for r in rows], ROW + ", place int, codes string")
    model = suffixtree.SuffixTrees().fit(df)
    out = model.score(df)
    assert out.count() == 6 and {r.predicted_root_cause for r in out.collect()} == {"X", "Y"} and {"place", "codes"} <= set(out.columns)
    assert model.score(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        suffixtree.SuffixTrees().fit(df.limit(0))
