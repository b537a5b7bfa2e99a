"""Repeated passages by a depth-limited radix sort of suffixes.

The suffixes of all texts, as UTF-8 bytes, are put in order only through their first ``depth`` bytes, by most-significant-digit
passes: a pass deals the suffixes that still share a bucket to new buckets by their next digit, and a suffix that is
alone in its bucket takes no further part. Suffixes that share a bucket when all ``depth`` bytes are used up are the
starts of repeated windows, and there are no others.

Digits are long strings of bytes, and neighbouring suffixes go through the passes together, as a run:

1. A suffix's first digit is the half of its window that begins at its anchor, the place with the least hash in it. A
   suffix has the same anchor wherever its window stands, neighbouring suffixes mostly share one, and about one place in
   a hundred (at depth 400) is an anchor, so a run of that many suffixes is one row. Nearly all runs are alone in their
   buckets, and end here.
2. Of what is left, suffixes at STEP neighbouring offsets from the anchor share a digit: the bytes that all their windows
   hold.
3. Then each suffix is on its own, and its digit is the whole window.

A run whose windows, taken together, occur twice in a bucket is decided in that pass, all of its suffixes at once, and one of
its copies stands for it in the next; so copies of a text cost one pass, whatever their number. Buckets are counted with
partial sums before the shuffle and never gathered: neither a passage that is in every document nor a text that is there
a million times makes a large task. Buckets are named by 128-bit hashes of the digits so far.

Nulls and edge cases: a null text is an empty one; a text shorter than the depth has no window and stays whole, as does an
empty one; windows overlap freely, within a text too ("aaaa..." repeats itself); repeated rows and texts are all removed,
the first included; rows are told apart by their texts alone, so null and repeated ids don't matter; what remains of a
text may end within a character, so it is bytes. An empty table gives an empty result. Other columns are kept, whatever
their names, but for those that the result has itself.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, join_counted, join_named, maybe_in, ship, stored

DEPTH = 400
#: Suffixes that share the second digit, at most.
STEP = 16
#: Bytes that are hashed at a time.
CHUNK = 1 << 18
#: A fixed odd number that spreads hashes.
SPREAD = np.uint64(0x9E3779B97F4A7C15)

RUNS = "h binary, at int, n int, off int, key binary, whole binary"


def _powers(base: int, n: int) -> np.ndarray:
    return np.concatenate([[np.uint64(1)], np.cumprod(np.full(n, np.uint64(base)), dtype=np.uint64)])


_SIZE = CHUNK + (1 << 13)
_BASE = int(SPREAD), pow(int(SPREAD), -1, 1 << 64)
_POWERS = tuple(_powers(b, _SIZE) for b in _BASE)


def anchors(data: np.ndarray, depth: int) -> np.ndarray:
    """The anchor of each window of ``depth`` bytes: among the halves that begin in it and end in it, the place of the one
    with the least hash, the first of equals. Depends on the window's bytes alone."""
    half = depth // 2
    power, inverse = _POWERS if len(data) <= _SIZE else (_powers(b, len(data)) for b in _BASE)
    # The sum of b[i + t] * p^t over t below half, from sums of b[j] * p^j.
    sums = np.concatenate([[np.uint64(0)], np.cumsum(data * power[: len(data)], dtype=np.uint64)])
    n = len(data) - half + 1
    rolled = (sums[half:] - sums[:-half]) * inverse[:n]
    rolled = (rolled ^ (rolled >> np.uint64(31))) * SPREAD
    least = (rolled & np.uint64(0xFFFFFFFF00000000)) | np.arange(n, dtype=np.uint64)
    # The least of depth - half + 1 neighbours, by doubling.
    width, want = 1, depth - half + 1
    while 2 * width <= want:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < want:
        least = np.minimum(least[: len(least) - (want - width)], least[want - width :])
    return (least & np.uint64(0xFFFFFFFF)).astype(np.int64)


def runs_of(text: bytes, depth: int) -> Iterator[tuple[int, int, int, bytes, bytes]]:
    """(at, n, off, key, whole): n suffixes from ``at`` with one anchor, ``off`` bytes behind the first of them; the hash of
    their first digit and that of all their windows together."""
    half, view = depth // 2, memoryview(text)
    digest = xxhash.xxh3_128_digest
    for start in range(0, len(text) - depth + 1, CHUNK):
        part = np.frombuffer(text, np.uint8, min(CHUNK + depth - 1, len(text) - start), start)
        at = anchors(part, depth)
        first = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1])
        for i, n, a in zip(first.tolist(), np.diff(first, append=len(at)).tolist(), at[first].tolist()):
            i, a = start + i, start + a
            yield i, n, a - i, digest(view[a : a + half]), digest(view[i : i + n - 1 + depth], a - i)


def _runs(depth: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    types = (pa.binary(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary())
    names = [c.split()[0] for c in RUNS.split(", ")]

    def batch_of(rows: list) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for batch in batches:
            for h, text in zip(batch.column("h"), batch.column("bytes")):
                h, text = h.as_py(), text.as_buffer()
                for r in runs_of(text.to_pybytes(), depth):
                    rows.append((h, *r))
                    if len(rows) == 1 << 15:
                        yield batch_of(rows)
                        rows = []
        if rows:
            yield batch_of(rows)

    return run


def _hash(*parts: Column) -> Column:
    return F.unhex(F.md5(F.concat(*parts)))


def _number(c: Column) -> Column:
    return F.concat(F.lit("|"), c.cast("string"), F.lit("|")).cast("binary")


def _pass(rows: DataFrame, place: tuple[str, ...]) -> tuple[DataFrame, DataFrame]:
    """One pass over runs (h, at, n, ..., done, key, whole), which are cut: those that it finds to be repeated (h, at, n), and
    of those in buckets with different runs one for each (its place and key), with ``done`` where it is known to be
    repeated."""
    kinds = rows.groupBy("key", "whole").agg(F.count("*").alias("copies"), F.bool_or("done").alias("done"), F.min(F.struct(*place)).alias("one"))
    kinds = stored(kinds)
    mixed = cut(kinds.groupBy("key").agg(F.count("*").alias("kinds")).where("kinds > 1"))
    rest = join_counted(kinds, mixed, "key", "kinds").select("one.*", (F.col("done") | (F.col("copies") > 1)).alias("done"), "key")
    return _copies(rows, kinds), cut(rest)


def _copies(rows: DataFrame, kinds: DataFrame) -> DataFrame:
    """The runs (h, at, n) of rows that aren't done whose whole has copies."""
    return join_counted(rows.where("not done"), kinds.where("copies > 1").select("whole", "copies"), "whole", "copies").select("h", "at", "n")


def _repeated_keys(runs: DataFrame) -> DataFrame:
    """The runs of buckets that hold more than one, with ``done``."""
    keys = cut(runs.groupBy("key").agg(F.count("*").alias("members")).where("members > 1"))
    some = maybe_in(runs.withColumn("__k", F.xxhash64("key")), "__k", cut(keys.select(F.xxhash64("key").alias("k"))))
    return join_counted(some.drop("__k"), keys, "key", "members").drop("members")


def _one_each(texts: DataFrame, wanted: DataFrame) -> DataFrame:
    """The texts whose hash is in ``wanted``, which is cut and has one row for each, once, joined with it. Copies meet in
    the task that reads them and then by their hash."""
    some = maybe_in(texts.withColumn("__h", F.xxhash64("h")), "__h", cut(wanted.select(F.xxhash64("h").alias("k")).distinct())).select("h", "bytes")
    return some.groupBy("h").agg(F.first("bytes").alias("bytes")).join(wanted, "h")


def _with_bytes(rest: DataFrame, texts: DataFrame, depth: int) -> DataFrame:
    """Runs with the bytes of their windows."""
    lists = cut(rest.groupBy("h").agg(F.collect_list(F.struct("at", "n", "off", "done", "key")).alias("runs")))  # of one text
    piece = F.transform("runs", lambda r: r.withField("bytes", F.substring(F.col("bytes"), r["at"] + 1, r["n"] + (depth - 1))))
    return _one_each(texts, lists).select("h", F.explode(piece).alias("r")).select("h", "r.*")


def _blocks(runs: DataFrame, depth: int, step: int) -> DataFrame:
    """Parts of runs at offsets of one block of ``step``, with their digits; from, the run's place, leads back to its
    bytes."""
    block = F.explode(F.sequence(F.floor((F.col("off") - F.col("n") + 1) / step), F.floor(F.col("off") / step))).alias("block")
    parts = runs.select("*", block).withColumn("high", F.least(F.col("off"), F.col("block") * step + step - 1).cast("int"))
    parts = parts.withColumn("low", F.greatest(F.col("off") - F.col("n") + 1, F.col("block") * step).cast("int"))
    sub = lambda start, length: F.substring(F.col("bytes"), (start + 1).cast("int"), F.lit(length) if isinstance(length, int) else length.cast("int"))
    shared = sub(F.col("off") - F.col("block") * step, depth - step + 1)
    every = sub(F.col("off") - F.col("high"), F.col("high") - F.col("low") + depth)
    key = _hash("key", _number(F.col("block")), shared)
    return parts.select(
        "h", (F.col("at") + F.col("off") - F.col("high")).alias("at"), (F.col("high") - F.col("low") + 1).alias("n"), F.col("high").alias("off"), "done",
        key.alias("key"), _hash(key, _number(F.col("high")), every).alias("whole"), F.col("at").alias("from"),
    )


def _windows(rest: DataFrame, held: DataFrame, depth: int) -> DataFrame:
    """The single suffixes of parts, whose bytes are in the runs that they are from."""
    bytes_of = held.select("h", F.col("at").alias("from"), "bytes")
    one = rest.join(bytes_of, ["h", "from"]).select("*", F.explode(F.sequence(F.col("at"), F.col("at") + F.col("n") - 1)).alias("i"))
    window = F.substring(F.col("bytes"), F.col("i") - F.col("from") + 1, F.lit(depth))
    return one.select("h", F.col("i").alias("at"), F.lit(1).alias("n"), "done", _hash("key", _number(F.col("off") + F.col("at") - F.col("i")), window).alias("whole"))


def _texts(docs: DataFrame, text: str) -> DataFrame:
    data = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    return docs.select(data.alias("bytes")).select(F.unhex(F.md5("bytes")).alias("h"), "bytes")


def repeated_windows(docs: DataFrame, depth: int = DEPTH, text: str = "text") -> DataFrame:
    """h, at, n: for texts, told by their 128-bit hash, the starts at .. at + n - 1 of windows of ``depth`` bytes that start
    anywhere else, too. Each start is given once."""
    if depth < 2:
        raise ValueError("a depth of two bytes or more")
    ship(docs.sparkSession)
    step = max(1, min(STEP, depth // 8))
    texts = _texts(docs, text).where(F.length("bytes") >= depth)
    runs = stored(texts.mapInArrow(_runs(depth), RUNS)).withColumn("done", F.lit(False))
    first, rest = _pass(cut(_repeated_keys(runs)), ("h", "at", "n", "off"))
    held = cut(_with_bytes(rest, texts, depth))
    second, rest = _pass(cut(_blocks(held, depth, step)), ("h", "at", "n", "off", "from"))
    alone = cut(_windows(rest, held, depth))
    kinds = cut(alone.groupBy("whole").agg(F.count("*").alias("copies")).where("copies > 1"))
    return first.union(second).union(_copies(alone, kinds)).distinct()


def _removed(depth: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            removed, spans, kept = [], [], []
            for data, starts in zip(batch.column("bytes"), batch.column("starts")):
                data, out, end, n, gone = data.as_py(), [], 0, 0, 0
                for s in sorted(starts.as_py(), key=lambda s: s["at"]):
                    if s["at"] > end or not n:
                        out.append(data[end : s["at"]])
                        n, end = n + 1, s["at"]
                    upto = max(end, s["at"] + s["n"] - 1 + depth)
                    gone, end = gone + upto - end, upto
                removed.append(gone)
                spans.append(n)
                kept.append(b"".join([*out, data[end:]]))
            arrays = [batch.column("h"), pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(kept, pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["h", "n_removed", "n_spans", "kept"])

    return run


def removals(docs: DataFrame, depth: int = DEPTH, text: str = "text") -> DataFrame:
    """h, n_removed, n_spans, kept (the bytes that remain) for each text, told by its hash, that loses anything."""
    starts = repeated_windows(docs, depth, text).groupBy("h").agg(F.collect_list(F.struct("at", "n")).alias("starts"))  # of one text
    return _one_each(_texts(docs, text), cut(starts)).mapInArrow(_removed(depth), "h binary, n_removed long, n_spans long, kept binary")


#: Columns that the results have beside those of the documents.
RESULT = ("n_bytes", "n_removed", "n_spans", "kept")


def _joined(docs: DataFrame, gone: DataFrame, own: Column, depth: int, text: str) -> DataFrame:
    """The documents' columns with those of gone, by the hash of the text, and ``own`` as kept where nothing goes."""
    data = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    names = [c for c in docs.columns if c.lower() not in (*RESULT, "__h", "__own")]
    rows = docs.select(*[F.col(f"`{c}`") for c in names], F.unhex(F.md5(data)).alias("__h"), F.length(data).cast("long").alias("n_bytes"), own.alias("__own"))
    both = join_named(rows, stored(gone.withColumnRenamed("h", "__h")), "__h", "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("long")).alias(c)
    return both.select(*[F.col(f"`{c}`") for c in names], "n_bytes", zero("n_removed"), zero("n_spans"), F.coalesce("kept", "__own").alias("kept"))


def dedup(docs: DataFrame, depth: int = DEPTH, text: str = "text") -> DataFrame:
    """The documents with n_bytes, n_removed, n_spans (maximal runs of removed bytes) and kept, the bytes of the text without
    each byte that a repeated string of ``depth`` bytes covers."""
    data = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    return _joined(docs, removals(docs, depth, text), data, depth, text)


def digests(docs: DataFrame, depth: int = DEPTH, text: str = "text") -> DataFrame:
    """As `dedup`, without the text and with the SHA-256 of the kept bytes as ``kept``: no text is joined."""
    data = F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary")
    gone = removals(docs, depth, text).withColumn("kept", F.sha2("kept", 256))
    return _joined(docs, gone, F.sha2(data, 256), depth, text).drop(text)
