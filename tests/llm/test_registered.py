"""The registered queries against SQL, or a brute-force version where SQL can't express them."""

import datetime
import hashlib
import re
import zlib
from collections import defaultdict

import duckdb
import public_tokenizers
import pytest
import sentencepiece

from gridpulse.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("documents", "labels", "pages", "embeddings")


def norm(v):
    if isinstance(v, float):
        return f"{v:.9g}"
    return v.isoformat() if isinstance(v, datetime.datetime) else str(v)


@pytest.fixture(scope="module")
def texts(spark):
    return {r.doc_id: r.text or "" for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_matches_sql(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    df = QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    cur = duck.execute(ORACLES[name])
    there = [c[0] for c in cur.description]
    assert sorted(there) == columns
    want = sorted(tuple(norm(r[there.index(c)]) for c in columns) for r in cur.fetchall())
    assert sorted(tuple(norm(r[c]) for c in columns) for r in df.collect()) == want


def test_op3_finds_the_planted_tokens(spark, texts):
    got = {(r.doc_id, r.candidate) for r in QUERIES["op3_secret_scan"](spark, SF).collect() if r.secret}
    planted = {(i, k) for i, t in texts.items() for k in re.findall(r'token = "([0-9a-f]{40})"', t)}
    assert planted <= got and len(got - planted) <= 0.1 * len(got)


def test_op4_keeps_the_law(spark, texts):
    rows = QUERIES["op4_sharding"](spark, SF).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    held = defaultdict(list)
    for r in rows:
        held[r.shard].append(r.slot)
        data = texts[r.doc_id].encode()
        assert (r["size"], r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "rows", None)
    assert all(sorted(v) == list(range(len(v))) for v in held.values())
    sizes = [len(held[s]) for s in range(8)]
    assert max(sizes) - min(sizes) <= 1


def test_op8_by_brute_force(spark, texts):
    from test_simhash import brute

    prints = {i: brute(t, 4) for i, t in texts.items()}
    label = {i: i for i in prints}
    ids = sorted(prints)
    for a in ids:
        for b in ids:
            if a < b and bin(prints[a] ^ prints[b]).count("1") <= 4 and label[a] != label[b]:
                low, high = sorted((label[a], label[b]))
                label = {i: low if x == high else x for i, x in label.items()}
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in QUERIES["op8_simhash"](spark, SF).collect()}
    assert got == {i: (f"{prints[i]:016x}", label[i]) for i in prints}


def test_op9_by_brute_force(spark, texts):
    from test_linededup import grams

    places = defaultdict(list)
    for i in sorted(texts):
        for n, line in enumerate(texts[i].split("\n")):
            if line.strip(" \t\n\x0b\x0c\r"):
                places[line].append((i, n))
    lines = sorted(places)
    sets = [grams(x) for x in lines]
    holders = defaultdict(list)
    label = list(range(len(lines)))
    for i, s in enumerate(sets):
        common = defaultdict(int)
        for g in s:
            for j in holders[g]:
                common[j] += 1
            holders[g].append(i)
        for j, k in common.items():
            if k >= 0.8 * (len(s) + len(sets[j]) - k) and label[i] != label[j]:
                low, high = sorted((label[i], label[j]))
                label = [low if x == high else x for x in label]
    groups = defaultdict(list)
    for x, line in zip(label, lines):
        groups[x] += places[line]
    want = {(*p, *min(g)) for g in groups.values() if len(g) > 1 for p in g}
    got = {(r.doc_id, r.line, r.kept_doc_id, r.kept_line) for r in QUERIES["op9_line_dedup"](spark, SF).collect()}
    assert len(got & want) >= 0.995 * len(want) and len(got - want) <= 0.005 * len(want)


def test_op10_is_the_library(spark, texts):
    lib = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    for r in QUERIES["op10_sentencepiece"](spark, SF).collect():
        ids = lib.encode(texts[r.doc_id], add_eos=True)
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (len(ids), sha(" ".join(map(str, ids))), sha(lib.decode(ids)))
