import random
from collections import Counter

import numpy as np
import pytest

from gridpulse.llm import suffixes as S


def brute(texts, depth):
    """(bytes, removed, spans, kept) of each text."""
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + depth] for d in data for i in range(len(d) - depth + 1))
    out = []
    for d in data:
        gone = np.zeros(len(d) + 2, bool)
        for i in range(len(d) - depth + 1):
            if seen[d[i : i + depth]] > 1:
                gone[i + 1 : i + 1 + depth] = True
        flags = gone[1:-1]
        out.append((len(d), int(flags.sum()), int((np.diff(gone.astype(int)) == 1).sum()), bytes(np.frombuffer(d, np.uint8)[~flags])))
    return out


def check(spark, texts, depth):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in S.dedup(df, depth).collect()}
    assert [got[i] for i in range(len(texts))] == brute(texts, depth)


def edited(rnd, text, n):
    text = list(text)
    for _ in range(n):
        text[rnd.randrange(len(text))] = rnd.choice("abcxyz é漢")
    return "".join(text)


@pytest.mark.parametrize("depth", [2, 7, 40, 400])
def test_by_brute_force(spark, depth):
    rnd = random.Random(depth)
    prose = lambda n: "".join(rnd.choice("ab cé") for _ in range(n))
    base, passage = prose(6 * depth), prose(2 * depth)
    texts = [prose(5 * depth) for _ in range(5)] + [base] * 4 + [edited(rnd, base, 1 + k % 4) for k in range(25)]
    texts += [prose(rnd.randrange(3 * depth)) + passage + prose(rnd.randrange(depth)) for _ in range(12)]
    texts += ["a" * (4 * depth), "ab" * (2 * depth), "a" * depth, "a" * (depth - 1), "word " * depth, "", None, passage[: depth - 1], passage[1 : 1 + depth]]
    check(spark, texts, depth)


def test_texts_longer_than_a_chunk(spark, monkeypatch):
    monkeypatch.setattr(S, "CHUNK", 97)
    rnd = random.Random(3)
    base = "".join(rnd.choice("abcdef") for _ in range(3000))
    check(spark, [base, base[500:1800] + "x" + base[1801:], edited(rnd, base, 9), base[:999]], 30)


def test_few_rows_reach_the_later_passes(spark, monkeypatch):
    """A thousand copies of a text are decided in the first pass; only runs with an edit in them go on."""
    sizes = []
    plain = S._pass
    monkeypatch.setattr(S, "_pass", lambda rows, place: sizes.append(rows.count()) or plain(rows, place))
    rnd = random.Random(4)
    base = "".join(rnd.choice("abcdef ") for _ in range(4000))
    texts = [base] * 300 + [edited(rnd, base, 1)] + ["".join(rnd.choice("ghij") for _ in range(4000)) for _ in range(20)]
    check(spark, texts, 400)
    first, second = sizes
    assert 301 * 20 < first < 301 * 90 and second < 400


def test_anchors_depend_on_the_window_alone():
    rnd = random.Random(5)
    text = "".join(rnd.choice("ab") for _ in range(900)).encode()
    whole = S.anchors(np.frombuffer(text, np.uint8), 100)
    for i in (0, 17, 399, 800):
        assert S.anchors(np.frombuffer(text[i : i + 100], np.uint8), 100).tolist() == [whole[i] - i]
    assert (whole >= np.arange(len(whole))).all() and (whole + 50 <= np.arange(len(whole)) + 100).all()
    prose = np.frombuffer("".join(rnd.choice("abcdefgh ") for _ in range(200_000)).encode(), np.uint8)
    assert len(set(S.anchors(prose, 400).tolist())) < 200_000 / 80


def test_odd_rows_and_empty_tables(spark, odd, none):
    got = S.dedup(odd, 40)
    assert set(odd.columns) <= set(got.columns) and got.count() == odd.count()
    rows = odd.select("doc_id", "text").collect()
    want = sorted((str(r.doc_id), *b) for r, b in zip(rows, brute([r.text for r in rows], 40)))
    assert sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept)) for r in got.collect()) == want
    assert S.dedup(none).count() == 0 and S.digests(none).count() == 0
    clash = odd.withColumnRenamed("size", "h").withColumnRenamed("ids", "kept").withColumnRenamed("fp", "bytes").withColumnRenamed("shard", "n_spans")
    assert S.digests(clash).count() == odd.count()


def test_planted_passages_of_over_50_words(spark):
    """A passage in two documents is found if it has 400 bytes; one of as many words with fewer bytes isn't one for the
    contract. n_bytes is the length of the whole text, whatever is removed."""
    rnd = random.Random(8)
    word = lambda n: "".join(rnd.choice("abcdefghijklmnop") for _ in range(n))
    prose = lambda words, n: " ".join(word(n) for _ in range(words))
    clean = [prose(150, 6) for _ in range(40)]
    long, short = [prose(60, 7) for _ in range(20)], [prose(55, 5) for _ in range(20)]
    assert min(map(len, long)) >= 400 and max(map(len, short)) < 398
    planted = [f"{prose(40, 6)} {p} {prose(40, 6)}" for p in long + short for _ in range(2)]
    texts = clean + planted
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in S.digests(df, 400).collect()}
    assert [got[i].n_bytes for i in range(len(texts))] == [len(t) for t in texts]
    assert {i for i in got if got[i].n_removed} == set(range(40, 80))
    assert all(len(long[(i - 40) // 2]) <= got[i].n_removed <= len(long[(i - 40) // 2]) + 4 for i in range(40, 80))
