"""Hard-negative mining with lists that clusters of anchors share.

Anchors go to cells by direction, and those of a cell to clusters of a bounded number. Candidates go to cells and blocks in
the same way. Where a cluster meets a block, the block's candidates are sorted once, by the highest score that any anchor
of the cluster can have with them: an anchor is within some angle of the cluster's centre, so it is at least the
candidate's angle to the centre less that angle away from the candidate. Every anchor walks this one list from its top
and leaves it when the bound of the next candidate certifies that none of the rest can be among its best.

Anchors first meet the blocks of their own cell. The scores found there decide which other cells they ask: a small table
of cells (at most CELLS for each dimension; their directions, widths and lengths) bounds what each may hold. Only pairs of
cluster and block in which an anchor asks are formed. Positives are walked first, then negatives inside the band that
each positive sets.

Scores are exact inner products of whole numbers; ties go to the smaller id.

Nulls and edge cases: rows without an id, without a label or whose vector takes no part are dropped; rows that share an id
are rows of their own, an anchor's own row alone is excluded, and ties between them are open; vectors of another length
than the anchor's are not its candidates; vectors of length zero have a direction of zeros and score 0; equal vectors and
one label for all rows are like any others; an anchor without rows of its label, and a positive whose band no row is
in, give no rows; a negative score of a positive leaves its band empty; an empty table gives an empty result. Scores beyond
64 bits become the least or greatest long, and count as such. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, ship
from .mtree import GREATEST, LEAST

#: Anchors of a cluster, candidates of a block, cells at most, rows of the sample that they come from, and candidates that
#: are scored at a time.
ANCHORS, BLOCK, CELLS, SAMPLE, STEP = 1024, 8192, 256, 4096, 256

ROW = "row long, vec_id long, label long, v array<double>, dim int, cell int, cosine double, length double"


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _unit(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Directions and lengths; scaled first, so that no square overflows."""
    most = np.abs(x).max(axis=-1, keepdims=True, initial=0)
    y = np.divide(x, most, out=np.zeros_like(x), where=most > 0)
    size = np.sqrt((y**2).sum(axis=-1, keepdims=True))
    return np.divide(y, size, out=y, where=size > 0), (size * most)[..., 0]


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact inner products of all rows of q and x as 64-bit numbers, cut at their range."""
    if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * x.shape[1] < 2**53:
        return (q @ x.T).astype(np.int64)
    whole = np.array([[int(v) for v in r] for r in q], object) @ np.array([[int(v) for v in r] for r in x], object).T
    return np.clip(whole, LEAST, GREATEST).astype(np.int64)


#: What rounding may add to an angle, in radians.
SLACK = 1e-6


def highest(cosine: np.ndarray, width: float | np.ndarray, length: np.ndarray) -> np.ndarray:
    """The highest score, for an anchor of length 1 within ``width`` of a direction, with vectors of a length at an angle
    of this cosine to the direction."""
    apart = np.clip(np.arccos(np.clip(cosine, -1, 1)) - width - SLACK, 0, np.pi)
    return length * np.cos(apart)


def _floor(bound: np.ndarray, length: np.ndarray) -> np.ndarray:
    """The bound for anchors of a length as whole numbers, never too low."""
    b = bound * length
    b = np.floor(b + 1e-9 * np.abs(b) + 1e-6)
    inside = np.abs(b) < 2.0**62
    return np.where(inside, np.where(inside, b, 0).astype(np.int64), np.where(b < 0, LEAST, GREATEST))


def _sorted(anchors: np.ndarray, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The shared list: the order of x by its bound, the bounds in this order and the anchors' lengths."""
    units, lengths = _unit(anchors)
    centre, _ = _unit(units.sum(axis=0))
    width = float(np.arccos(np.clip(units @ centre, -1, 1)).max(initial=0))
    directions, far = _unit(x)
    bound = highest(directions @ centre, width, far)
    order = np.argsort(-bound, kind="stable")
    return order, bound[order], lengths


class Best:
    """The k best (score, id) of each of n lists."""

    def __init__(self, n: int, k: int, floors: np.ndarray):
        self.k, self.floor = k, floors.copy()
        self.place = self.score = self.id = np.empty(0, np.int64)

    def add(self, place: np.ndarray, score: np.ndarray, ids: np.ndarray) -> None:
        place, score, ids = (np.concatenate(c) for c in ((self.place, place), (self.score, score), (self.id, ids)))
        order = np.lexsort((ids, ~score, place))
        place, score, ids = place[order], score[order], ids[order]
        rank = np.arange(len(place)) - np.searchsorted(place, place)
        self.place, self.score, self.id = (c[rank < self.k] for c in (place, score, ids))
        full = rank == self.k - 1
        self.floor[place[full]] = np.maximum(self.floor[place[full]], score[full])


def walk(anchors: dict[str, np.ndarray], x: dict[str, np.ndarray], low: np.ndarray, high: np.ndarray, k: int, alike: bool, seen: Callable[[int], None] = lambda n: None) -> Best:
    """The k best of the rows x of the anchor's label (alike) or of other labels, for each anchor and each of its bands:
    low and high, both anchors x bands, are the scores that count; an empty band has low above high. List i of the
    result is the band i % bands of the anchor i // bands. seen: told how many scores are computed."""
    m, bands = low.shape
    best = Best(m * bands, k, low.ravel())
    order, bound, lengths = _sorted(anchors["v"], x["v"])
    active = np.arange(m)
    for start in range(0, len(order), STEP):
        # An anchor has ended when no band can gain; equal scores may still win by their id.
        gain = (_floor(bound[start], lengths[active])[:, None] >= best.floor.reshape(m, bands)[active]) & (low <= high)[active]
        active = active[gain.any(axis=1)]
        if not len(active):
            break
        rows = order[start : start + STEP]
        s = scores(anchors["v"][active], x["v"][rows])
        seen(s.size)
        fits = (anchors["label"][active][:, None] == x["label"][rows]) == alike
        fits &= anchors["row"][active][:, None] != x["row"][rows]
        for band in range(bands):
            at = active * bands + band
            a, c = np.nonzero(fits & (s >= best.floor[at][:, None]) & (s <= high[active, band][:, None]))
            if len(a):
                best.add(at[a], s[a, c], x["vec_id"][rows[c]])
    return best


def _columns(table: pa.Table, names: tuple[str, ...]) -> dict[str, np.ndarray]:
    return {"v": _matrix(table["v"])} | {c: table[c].to_numpy() for c in names}


FOUND = "row long, anchor_id long, band int, vec_id long, score long"


def _meet(k: int, alike: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(block: pa.Table, asked: pa.Table) -> pa.Table:
        if not block.num_rows or not asked.num_rows:
            return pa.table({c.split()[0]: pa.array([], pa.int32() if " int" in c else pa.int64()) for c in FOUND.split(", ")})
        a, x = _columns(asked, ("row", "vec_id", "label")), _columns(block, ("row", "vec_id", "label"))
        best = walk(a, x, _matrix(asked["low"]), _matrix(asked["high"]), k, alike)
        bands = _matrix(asked["low"]).shape[1]
        at = best.place // bands
        return pa.table({"row": a["row"][at], "anchor_id": a["vec_id"][at], "band": (best.place % bands).astype(np.int32), "vec_id": best.id, "score": best.score})

    return run


def _directions(rows: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Directions of some rows for each length: at most CELLS of a bounded sample by hash, one for each block."""
    some = rows.where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / max(n, 1)) * (1 << 30))).select("v").limit(4 * SAMPLE)
    out: dict[int, list] = {}
    for v in sorted({tuple(r.v) for r in some.collect()}, key=hash):
        out.setdefault(len(v), []).append(v)
    most = max(1, min(CELLS, n // BLOCK))
    return {d: _unit(np.array(v[:most]))[0] for d, v in out.items()}


def _placed(directions: dict[int, np.ndarray]) -> Callable:
    """Adds dim, the cell of the nearest direction, the cosine to it and the length."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            sizes = np.asarray(lists.value_lengths())
            cell, cosine, length = np.zeros(len(lists), np.int32), np.zeros(len(lists)), np.zeros(len(lists))
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                units, length[at] = _unit(_matrix(lists.take(pa.array(at))))
                near = units @ directions.get(dim, np.zeros((1, dim))).T
                cell[at] = c = np.argmax(near, axis=1)
                cosine[at] = near[np.arange(len(at)), c]
            arrays = [*batch.columns, pa.array(sizes, pa.int32()), pa.array(cell), pa.array(cosine), pa.array(length)]
            yield pa.RecordBatch.from_arrays(arrays, names=[*batch.schema.names, "dim", "cell", "cosine", "length"])

    return run


ASK = "row long, vec_id long, label long, v array<double>, low array<long>, high array<long>, dim int, acell int, apart int, cell int"


def _others(directions: dict[int, np.ndarray], cells: dict[int, np.ndarray]) -> Callable:
    """A row for each anchor and other cell that may hold one of its best. cells: for each dimension the numbers of the
    cells, their widths and greatest lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sizes = np.asarray(batch.column("v").value_lengths())
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                for start in range(0, len(at), 128):
                    part = batch.take(pa.array(at[start : start + 128]))
                    units, lengths = _unit(_matrix(part.column("v")))
                    number, width, longest = cells[dim]
                    number = number.astype(int)
                    cosine = units @ directions.get(dim, np.zeros((1, dim)))[number].T
                    bound = highest(cosine, width, longest)
                    low, high, floor = (_matrix(part.column(c)) for c in ("low", "high", "floor"))
                    gain = (_floor(bound, lengths[:, None])[:, :, None] >= floor[:, None]) & (low <= high)[:, None]
                    ask = gain.any(axis=2) & (number != part.column("acell").to_numpy()[:, None])
                    a, c = np.nonzero(ask)
                    if len(a):
                        some = part.take(pa.array(a)).drop_columns(["floor"])
                        yield pa.RecordBatch.from_arrays([*some.columns, pa.array(number[c], pa.int32())], names=[*some.schema.names, "cell"])

    return run


class Space:
    """Candidates in cells and blocks, anchors in cells and clusters."""

    def __init__(self, rows: DataFrame, anchors: Column):
        """rows: vec_id, label and v, all there."""
        ship(rows.sparkSession)
        rows = cut(rows.select(F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), "v"))
        self.directions = _directions(rows, rows.count())
        placed = cut(rows.mapInArrow(_placed(self.directions), ROW))
        # A row for each cell: how wide it is, how long its longest vector is, how many blocks and clusters it has.
        about = placed.groupBy("dim", "cell").agg(
            F.min("cosine").alias("cosine"), F.max("length").alias("length"), F.ceil(F.count("*") / BLOCK).cast("int").alias("parts"), F.ceil(F.count_if(anchors) / ANCHORS).cast("int").alias("aparts")
        )
        about = cut(about)
        self.cells: dict[int, np.ndarray] = {}
        for dim, some in self._by_dim(about).items():
            self.cells[dim] = np.array([(r.cell, np.arccos(np.clip(r.cosine, -1, 1)), r.length) for r in some], float).T
        self.parts = F.broadcast(about.select("dim", "cell", "parts", "aparts"))
        deal = lambda n: F.pmod(F.xxhash64("row"), F.col(n)).cast("int")
        dealt = placed.join(self.parts, ["dim", "cell"])
        self.blocks = dealt.withColumn("part", deal("parts")).select(*[F.col(c).alias(c) for c in ("row", "vec_id", "label", "v", "dim", "cell", "part")])
        self.anchors = cut(dealt.where(anchors).withColumn("apart", deal("aparts")).select("row", "vec_id", "label", "v", "dim", F.col("cell").alias("acell"), "apart"))

    @staticmethod
    def _by_dim(about: DataFrame) -> dict[int, list]:
        out: dict[int, list] = {}
        for r in about.collect():  # at most CELLS rows for each dimension
            out.setdefault(r.dim, []).append(r)
        return out

    def _met(self, asked: DataFrame, k: int, alike: bool) -> DataFrame:
        """The walks of anchors (ASK) through the blocks of the cells that they ask."""
        asked = asked.join(self.parts.select("dim", "cell", "parts"), ["dim", "cell"])
        asked = cut(asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1))).drop("parts"))
        keys = ("dim", "cell", "part", "acell", "apart")
        pairs = asked.select(*[F.col(c).alias(c) for c in keys]).distinct()  # of cluster and block
        blocks = self.blocks.join(pairs, ["dim", "cell", "part"])
        return blocks.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_meet(k, alike), FOUND)

    def best(self, anchors: DataFrame, k: int, alike: bool) -> DataFrame:
        """row, anchor_id, band, vec_id, score, rank: the k best rows within each band of anchors, which have low and high."""
        first = anchors.withColumn("cell", F.col("acell"))
        near = cut(self._met(first, k, alike))
        third = near.groupBy("row", "band").agg(F.count("*").alias("n"), F.min("score").alias("least")).where(F.col("n") >= k)
        floors = third.groupBy("row").agg(F.map_from_entries(F.collect_list(F.struct("band", "least"))).alias("floors"))  # bands of one anchor
        known = F.transform("low", lambda x, i: F.greatest(x, F.coalesce(F.try_element_at("floors", i), x)))
        rest = anchors.join(floors, "row", "left").withColumn("floor", known)
        rest = rest.select("row", "vec_id", "label", "v", "low", "high", "dim", "acell", "apart", "floor").mapInArrow(_others(self.directions, self.cells), ASK)
        found = near.union(self._met(rest, k, alike))
        order = W.partitionBy("row", "band").orderBy(F.desc("score"), "vec_id")
        return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 3, least: int = 50, most: int = 95) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``rows``: vec_id, label and v, an array of whole doubles, null if it takes no part; ``anchors``: a condition on vec_id. An
    anchor's positives are its best rows of its label. Its negatives for a positive are the best rows of other labels that
    score at least ``least`` and at most ``most`` percent of the positive.
    """
    rows = rows.where("vec_id is not null and label is not null and v is not null").select("vec_id", "label", "v")
    space = Space(rows, anchors)
    any_score = F.array(F.lit(LEAST)), F.array(F.lit(GREATEST))
    asked = space.anchors.withColumn("low", any_score[0]).withColumn("high", any_score[1])
    pairs = cut(space.best(asked, positives, True).select("row", F.col("vec_id").alias("positive_id"), F.col("score").alias("positive_score"), F.col("rank").alias("number")))
    hundred = F.lit(100).cast("long")

    def share(p: Column, percent: int, whole: Callable[[Column], Column]) -> Column:
        """percent of p, made whole; quotient and remainder apart, so that no product leaves 64 bits."""
        return F.call_function("div", p, hundred) * percent + whole(p % hundred * percent / 100).cast("long")

    low = F.transform("scores", lambda p: F.when(p >= 0, share(p, least, F.ceil)).otherwise(GREATEST))
    high = F.transform("scores", lambda p: F.when(p >= 0, share(p, most, F.floor)).otherwise(LEAST))
    pad = lambda a, x: F.concat(a, F.array_repeat(F.lit(x), F.lit(positives) - F.size(a)))
    bands = pairs.groupBy("row").agg(F.transform(F.sort_array(F.collect_list(F.struct("number", "positive_score"))), lambda x: x["positive_score"]).alias("scores"))  # few of one anchor
    bands = bands.select("row", pad(low, GREATEST).alias("low"), pad(high, LEAST).alias("high"))
    asked = cut(space.anchors.join(bands, "row"))
    found = space.best(asked, negatives, False).withColumn("number", F.col("band") + 1)
    return found.join(pairs, ["row", "number"]).select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))
