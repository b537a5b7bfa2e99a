"""SentencePiece encoding and decoding for merge-type vocabularies, in Arrow batches.

Encoding keeps an agenda of adjacent symbol pairs that form a piece, ordered by score and then by place, and
merges the best one until none is left; characters without a piece fall back to bytes. The agenda is a heap, or for
the short segments that most texts consist of a list in text order, of which the best entry is looked up each time.
Vocabularies that normalise texts are refused when they are loaded. No piece of such a
vocabulary holds a space mark after another character (checked when it is loaded; otherwise a text is one
segment), so a text splits before each run of spaces into segments that no merge can cross. Segments repeat, so
a task keeps their ids in a bounded memo. A share of the segments that enter the memo and a share of the whole
texts are checked against the library; a difference stops the job.

Nulls and edge cases: a null text counts as the empty text, which has no pieces but those asked for at the ends;
very long texts are encoded whole; repeated rows are encoded alike; other columns are kept. The columns added
are n_tokens, ids, decoded; of the input's columns, those of the same names (in any case) are replaced.
"""

from __future__ import annotations

import heapq
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from .common import ship

MARK = "▁"
#: Segments that a task remembers in each of two turns; at about 200 bytes each this stays below 200 MB.
MEMO = 500_000
NONE = float("-inf")
#: Longer segments are not remembered, and have a heap for an agenda.
LONG = 48


class Vocabulary:
    """A merge-type vocabulary read through the library."""

    def __init__(self, path: str):
        import sentencepiece

        self.library = lib = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = "".join(chr(c) for c in range(1, 0x110000) if not 0xD800 <= c < 0xE000 and c != 0x20)
        if lib.normalize(plain) != MARK + plain or lib.normalize(" a  b ") != "▁▁a▁▁b▁":
            raise ValueError(f"{path} changes texts before it encodes them")
        self.ids: dict[str, int] = {}
        self.bytes = [0] * 256
        self.texts: list[bytes] = []
        for i in range(lib.get_piece_size()):
            piece = lib.id_to_piece(i)
            if lib.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
            elif not (lib.is_control(i) or lib.is_unknown(i) or lib.is_unused(i)):
                self.ids[piece] = i
            self.texts.append(self._text(i, piece))
        self.scores = {piece: lib.get_score(i) for piece, i in self.ids.items()}
        self.end = lib.eos_id()
        parted = not any(MARK in p.lstrip(MARK) for p in self.ids)
        self.segment = re.compile(f"{MARK}*[^{MARK}]+|{MARK}+" if parted else ".+", re.DOTALL)
        self.memo: dict[str, tuple[int, ...]] = {}
        self.old: dict[str, tuple[int, ...]] = {}

    def _text(self, i: int, piece: str) -> bytes:
        """What an id adds to a decoded text; the unknown id makes it invalid, so the library decodes it."""
        if self.library.is_byte(i):
            return bytes((int(piece[3:5], 16),))
        if self.library.is_unknown(i):
            return b"\xff"
        return b"" if self.library.is_control(i) else piece.replace(MARK, " ").encode()

    def merge(self, text: str) -> list[int]:
        """The ids of one segment by the agenda."""
        if len(text) <= LONG:
            return self._ids(self._merge_short(list(text)))
        symbols: list[str | None] = list(text)
        n = len(symbols)
        before, after = list(range(-1, n - 1)), [*range(1, n), -1]
        agenda: list[tuple[float, int, int, str]] = []
        scores = self.scores

        def offer(a: int, b: int) -> None:
            pair = symbols[a] + symbols[b]
            if (score := scores.get(pair)) is not None:
                heapq.heappush(agenda, (-score, a, b, pair))

        for i in range(n - 1):
            offer(i, i + 1)
        while agenda:
            _, a, b, pair = heapq.heappop(agenda)
            if symbols[a] is None or symbols[b] is None or after[a] != b or symbols[a] + symbols[b] != pair:
                continue  # one of the two has been merged since
            symbols[a], symbols[b] = pair, None
            after[a] = c = after[b]
            if c >= 0:
                before[c] = a
                offer(a, c)
            if before[a] >= 0:
                offer(before[a], a)
        return self._ids([s for s in symbols if s is not None])

    def _merge_short(self, symbols: list[str]) -> list[str]:
        """The same with the agenda as a plain list in text order, which is faster for few symbols."""
        get = self.scores.get
        agenda = [get(a + b, NONE) for a, b in zip(symbols, symbols[1:])]
        while agenda and (best := max(agenda)) > NONE:
            i = agenda.index(best)
            symbols[i] += symbols.pop(i + 1)
            del agenda[i]
            if i:
                agenda[i - 1] = get(symbols[i - 1] + symbols[i], NONE)
            if i < len(agenda):
                agenda[i] = get(symbols[i] + symbols[i + 1], NONE)
        return symbols

    def _ids(self, symbols: list[str]) -> list[int]:
        out: list[int] = []
        for s in symbols:
            if (i := self.ids.get(s)) is not None:
                out.append(i)
            else:
                out += [self.bytes[b] for b in s.encode()]
        return out

    def learn(self, new: list[str]) -> None:
        self.memo |= {s: tuple(self.merge(s)) for s in new}

    def check(self, some: list[str]) -> None:
        """Compares segments with the library. It puts a mark before each text itself, so a segment with one is
        given without it, and any other behind a line feed, which merges with nothing."""
        lead = [s[0] != MARK or s.count(MARK) == len(s) for s in some]
        plain = ["\n" + s if x else s[1:] for s, x in zip(some, lead, strict=True)]
        feed = self.library.encode("\n")
        for s, x, their in zip(some, lead, self.library.encode(plain, num_threads=1), strict=True):
            own = list(self.memo[s])
            if own != (their[len(feed) :] if x else their) or x and their[: len(feed)] != feed:
                raise ValueError(f"segment {s!r}: {own} here, {their} by the library")

    def forget(self) -> None:
        self.memo, self.old = {}, {}

    def encode(self, texts: list[str], check: int = 1) -> list[list[int]]:
        """The ids of whole texts with an end id; one in ``check`` new segments is compared with the library."""
        find, memo, out = self.segment.findall, self.memo, []
        parts = [find(MARK + t.replace(" ", MARK)) if t else [] for t in texts]
        new = {s for p in parts for s in p if s not in memo}
        if len(memo) + len(new) > MEMO:
            # The segments in use since the last turn are kept at hand, the others are forgotten.
            self.old, self.memo = memo, {}
            memo, new = self.memo, {s for p in parts for s in p}
        if self.old and new:
            memo |= {s: self.old[s] for s in new if s in self.old}
            new = {s for s in new if s not in self.old}
        new = list(new)
        self.learn(new)
        self.check(new[::check])
        for p in parts:
            ids: list[int] = []
            for s in p:
                ids += memo[s]
            ids.append(self.end)
            out.append(ids)
        for s in new:
            if len(s) > LONG:
                del memo[s]
        return out

    def decode(self, ids: list[int]) -> str:
        """The text of ids, without the space that encoding puts first. Ids whose bytes are no text, which
        encoding never makes, are left to the library."""
        texts = self.texts
        try:
            text = b"".join([texts[i] for i in ids]).decode()
        except UnicodeDecodeError:
            return self.library.decode(ids)
        return text[1:] if text[:1] == " " else text


_loaded: dict[str, Vocabulary] = {}


def vocabulary(path: str) -> Vocabulary:
    """The vocabulary of this worker, loaded once."""
    if path not in _loaded:
        _loaded[path] = Vocabulary(path)
    return _loaded[path]


def _pieces_of(batch: pa.RecordBatch, text: int, size: int) -> Iterator[pa.RecordBatch]:
    """Parts of a batch with about `size` bytes of text each."""
    start = total = 0
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_pylist()
    for i, n in enumerate(lengths):
        if total and total + n > size:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if batch.num_rows > start:
        yield batch.slice(start)


def encode(docs: DataFrame, path: str, check: int = 8, text: str = "text", size: int = 2 << 20) -> DataFrame:
    """The documents with n_tokens, ids (an end id only, no sampling) and decoded.

    ``check``: one in so many whole texts, by place in the batch, is also encoded and decoded by the library and
    compared, and so is one in so many new segments (1: all). ``size``: bytes of text held at a time.
    """
    added = ("n_tokens", "ids", "decoded")
    docs = docs.select(*[c for c in docs.columns if c.lower() not in added])
    names = [*docs.columns, *added]
    at = names.index(text)
    schema = T.StructType(
        [
            *docs.schema.fields,
            T.StructField("n_tokens", T.LongType()),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.StringType()),
        ]
    )

    def coded(v: Vocabulary, part: pa.RecordBatch) -> pa.RecordBatch:
        texts = [t or "" for t in part.column(at).to_pylist()]
        ids = v.encode(texts, check)
        back = [v.decode(x) for x in ids]
        their = v.library.encode(texts[::check], num_threads=1, add_eos=True)
        if ids[::check] != their or back[::check] != v.library.decode(their, num_threads=1):
            raise ValueError("a text is encoded or decoded in another way by the library")
        found = [pa.array([len(x) for x in ids], pa.int64()), pa.array(ids, pa.list_(pa.int32())), pa.array(back, pa.string())]
        return pa.RecordBatch.from_arrays([*part.columns, *found], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        v = vocabulary(path)
        try:
            for batch in batches:
                for part in _pieces_of(batch, at, size):
                    yield coded(v, part)
        finally:  # the worker stays for other tasks
            v.forget()
            pa.default_memory_pool().release_unused()

    ship(docs.sparkSession)
    return docs.mapInArrow(run, schema)
