import random

import public_tokenizers
import pytest

from gridpulse.llm import pieces

PATH = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def v():
    return pieces.Vocabulary(PATH)


def odd_texts():
    rnd = random.Random(0)
    al = " ▁ab\n\té漢\U0001f600eth  ing\x00ñ0#"
    return ["".join(rnd.choice(al) for _ in range(rnd.randint(0, 40))) for _ in range(2000)] + ["", " ", "  ", "▁", "\n", " a ", "a" * 3000, "the " * 2000, "é" * 60]


def test_ids_and_texts_are_the_librarys(v):
    texts = odd_texts()
    ids = v.encode(texts)
    assert ids == v.library.encode(texts, add_eos=True)
    assert [v.decode(x) for x in ids] == v.library.decode(ids)


def test_heap_and_list_agendas_agree(v, monkeypatch):
    some = [t.replace(" ", pieces.MARK) for t in odd_texts()[:300] if 0 < len(t) < 40]
    short = [v.merge(t) for t in some]
    monkeypatch.setattr(pieces, "LONG", 0)
    assert [v.merge(t) for t in some] == short


def test_decoding_odd_ids(v):
    for ids in ([], [2], [0, 5, 300], [3 + 0xE6], [300, 3 + 0xFF, 301]):
        assert v.decode(ids) == v.library.decode(ids)


def test_a_small_memo_changes_nothing(v, monkeypatch):
    monkeypatch.setattr(pieces, "MEMO", 10)
    texts = [f"some words {i} and the words {i % 7}" for i in range(60)]
    assert [v.encode([t])[0] for t in texts] == v.library.encode(texts, add_eos=True)
    v.forget()


def test_a_difference_stops_the_job(v):
    v.learn(["▁abc"])
    v.memo["▁abc"] = (5,)
    with pytest.raises(ValueError):
        v.check(["▁abc"])
    v.forget()


def test_odd_rows_and_empty_tables(spark, odd, none, v):
    out = pieces.encode(odd, PATH, check=1, size=10)
    assert out.columns == [c for c in odd.columns if c not in ("ids", "decoded", "n_tokens")] + ["n_tokens", "ids", "decoded"]
    for r in out.collect():
        want = v.library.encode(r.text or "", add_eos=True)
        assert (r.n_tokens, list(r.ids), r.decoded) == (len(want), want, v.library.decode(want))
    assert pieces.encode(none, PATH).count() == 0
