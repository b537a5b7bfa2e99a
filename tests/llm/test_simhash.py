import random

import numpy as np
import pytest
import xxhash

from gridpulse.llm import simhash as s


def brute(text, n):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").translate(dict.fromkeys(map(ord, "\t\n\x0b\x0c\r"), " ")).split(" ") if w]
    grams = [" ".join(words[i : i + n]) for i in range(max(1, len(words) - n + 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def test_fingerprints_by_brute_force(spark, odd, none):
    for r in odd.select("text").collect():
        assert s.simhash(r.text, 4) == brute(r.text, 4)
    assert s.simhash("ÀB \x85 c\x1cd", 4) == brute("ÀB \x85 c\x1cd", 4)
    assert s.fingerprints(none).count() == 0


def pairs_of(x, radius):
    return {(i, j) for i in range(len(x)) for j in range(len(x)) if bin(int(x[i] ^ x[j])).count("1") <= radius}


@pytest.mark.parametrize("radius", [0, 2, 4])
def test_forest_by_brute_force(radius):
    rnd = np.random.default_rng(radius)
    x = rnd.integers(0, 64, 200).astype(np.uint64) << np.uint64(7)
    i, j = s.Forest(x, np.zeros(200, int)).search(x, np.zeros(200, int), radius)
    assert set(zip(i.tolist(), j.tolist())) == pairs_of(x, radius)


def families(seed, n=40, size=12):
    rnd = random.Random(seed)
    out = []
    for _ in range(n):
        centre = rnd.getrandbits(64)
        for _ in range(size):
            x = centre
            for b in rnd.sample(range(64), rnd.randint(0, 5)):
                x ^= 1 << b
            out.append(x)
    return sorted(set(out))


@pytest.mark.parametrize("limit", [1024, 8])
def test_components_of_links_by_brute_force(spark, monkeypatch, limit):
    from gridpulse.operators.components import components

    monkeypatch.setattr(s, "LIMIT", limit)
    x = families(limit)
    label = list(range(len(x)))
    for i in range(len(x)):
        for j in range(i):
            if bin(x[i] ^ x[j]).count("1") <= 4:
                a, b = label[i], label[j]
                label = [min(a, b) if v in (a, b) else v for v in label]
    signed = [v - (1 << 64) if v >> 63 else v for v in x]
    df = spark.createDataFrame([(v,) for v in signed], "fp long")
    root = {r.node: r.root for r in components(s.links(df)).collect()}
    groups, want = {}, {}
    for v, l in zip(signed, label):
        groups.setdefault(root.get(v, v), set()).add(v)
        want.setdefault(l, set()).add(v)
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, want.values()))


def test_every_choice_of_blocks_covers_the_radius():
    rnd = random.Random(5)
    for n in (10, 10_000, 10**7, 10**12):
        masks = [m for m, _ in s._choices(n, 4)]
        for _ in range(300):
            d = sum(1 << b for b in rnd.sample(range(64), 4))
            assert any(not d & m for m in masks)


def test_odd_rows_and_empty_tables(spark, odd, none):
    got = {(r.doc_id, r.component_id) for r in s.near_duplicates(odd).collect()}
    assert {(1, 1), (2, 1), (3, 1), (5, 5), (6, 5), (None, 1)} <= got
    kept = s.keep_one(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id) == [1, 4, 5, 7]
    assert s.near_duplicates(none).count() == s.keep_one(none).count() == 0


def test_near_copies_are_found_and_others_left(spark):
    rnd = random.Random(2)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    base = [word() for _ in range(1500)]
    near = base[:700] + ["changed"] + base[701:]
    rows = [(0, " ".join(base)), (1, " ".join(near)), (2, " ".join(base)), (3, " ".join(word() for _ in range(1500)))]
    got = {r.doc_id: r.component_id for r in s.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {0: 0, 1: 0, 2: 0, 3: 3}


def test_keep_one_finds_copies_at_similarity_0_8(spark):
    rnd = random.Random(8)
    word = lambda: "".join(rnd.choice("abcdefghij") for _ in range(6))
    rows, similar = [], 0
    for k in range(200):
        base = [word() for _ in range(300)]
        near = list(base)
        for i in rnd.sample(range(300), rnd.randint(2, 9)):
            near[i] = word()
        x, y = ({tuple(w[i : i + 5]) for i in range(296)} for w in (base, near))
        similar += len(x & y) >= 0.8 * len(x | y)
        rows += [(2 * k, " ".join(base)), (2 * k + 1, " ".join(near))]
    got = s.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).count()
    assert 50 < similar < 200 and 400 - similar <= got <= 400 - 0.98 * similar


def test_keep_one_tells_documents_apart_by_text(spark):
    text = lambda x: " ".join(f"{x}{i}" for i in range(30))
    rows = [(None, text("a")), (None, text("b")), (None, text("b")), (1, text("c")), (1, text("d")), (2, text("d"))]
    got = s.keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert sorted((r.doc_id or 0, r.text) for r in got) == [(0, text("a")), (0, text("b")), (1, text("c")), (1, text("d"))]
