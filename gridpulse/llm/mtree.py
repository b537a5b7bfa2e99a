"""Exact top-k search with M-trees.

Vectors go to the nearest of some pivots, and those of a pivot to trees of a bounded number of rows. A tree is an M-tree:
pages of a bounded number of entries, each entry with a centre, a covering radius and its distance to the parent's
centre. A query walks a tree best first: the pages with the highest bounds on the score are opened next, a few at a time,
and the walk ends when no bound reaches the k-th best score. Scores of vectors are not computed where the stored
distances and the triangle inequality already bound them below it. Many queries walk a tree together, so that those that
open the same page are scored by one product of matrices.

Each query first walks a tree of its own pivot. The k-th best score found there decides which other trees it goes to: a
small table of pivots, radii and lengths bounds the scores of each. The best of all trees are ranked last. Queries and
trees meet in blocks.

Scores are exact inner products of whole numbers. Ties go to the smaller id: a page that can only tie is opened
only if it may hold a smaller id.

Nulls and edge cases: rows without an id, and vectors that are null, empty or hold null or non-finite components,
take no part; rows are told apart even if they share an id: each is a candidate, and each that is asked for has an answer
of its own; vectors of another length than the query's are not its candidates; a tie between rows of one id is open; equal vectors fill pages like any others;
an empty table gives an empty result; scores outside 64 bits become the
least or greatest long, and rank as such. Other columns are ignored.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import cut, ship

#: Entries of a page, vectors of a tree and queries of a block.
PAGE = 128
TREE = 4096
QUERIES = 1024
#: Pivots at most, and about so many vectors that they are taken from, by hash.
PIVOTS = 256
SAMPLE = 4096
#: Pages that a query opens at a time.
WIDTH = 4
LEAST, GREATEST = -(1 << 63), (1 << 63) - 1
INNER = ("centres", "radius", "parent", "square", "least", "below")


def quantised(embedding: Column, scale: int = 1024) -> Column:
    """floor(scale * x) of each component as a whole double; null if the vector takes no part. A double of 2^53 and
    more is whole as it is."""
    x = F.transform(embedding, lambda v: v.cast("double") * scale)
    fine = (F.size(x) > 0) & F.forall(x, lambda v: v.isNotNull() & (F.abs(v) < float("inf")))  # NaN is above all
    return F.when(fine, F.transform(x, lambda v: F.when(F.abs(v) < float(1 << 53), F.floor(v).cast("double")).otherwise(v)))


def _lengths(rows: np.ndarray) -> np.ndarray:
    return np.sqrt((rows**2).sum(axis=-1))


def _bound(norm: np.ndarray, near: np.ndarray, square: np.ndarray, more: np.ndarray = np.inf) -> np.ndarray:
    """The highest score with vectors at least so far and at most so long, for queries of a squared length, and no
    higher than ``more``. What is beyond the range of doubles bounds nothing."""
    b = np.fmin(np.fmin((norm + square - np.maximum(near, 0) ** 2) / 2, np.sqrt(norm) * np.sqrt(square)), more)
    b = b + 1e-9 * (norm + square) + 1e-6
    return np.where(np.isnan(b), np.inf, b)


class Tree:
    """An M-tree over rows of whole numbers x with ids; ``rows`` tells rows apart. Built once, read by many queries."""

    @np.errstate(over="ignore", invalid="ignore")
    def __init__(self, ids: np.ndarray, rows: np.ndarray, x: np.ndarray):
        order = np.lexsort((rows, ids))
        self.ids, self.rows, self.x = ids[order], rows[order], x[order]
        self.square = (self.x**2).sum(axis=1)
        self.pages: list[dict] = []
        self.root = self._page(np.arange(len(x)), 0)

    def _distance(self, rows: np.ndarray, centre: int) -> np.ndarray:
        return _lengths(self.x[rows] - self.x[centre])

    def _page(self, rows: np.ndarray, centre: int) -> int:
        """Adds the page of some rows and those below it; its entries have their distances to the centre."""
        if len(rows) <= PAGE:
            self.pages.append({"centre": centre, "rows": rows, "parent": self._distance(rows, centre)})
            return len(self.pages) - 1
        n = min(PAGE, -(-2 * len(rows) // PAGE))
        centres = rows[np.linspace(0, len(rows) - 1, n).astype(int)]
        at = np.argmin(((self.square[rows])[:, None] - 2 * self.x[rows] @ self.x[centres].T + self.square[centres]), axis=1)
        if (at == at[0]).all():  # equal vectors: by number
            at = np.arange(len(rows)) * n // len(rows)
        entries = []
        for k in np.unique(at):
            part, c = rows[at == k], centres[k]
            d = self._distance(part, c)
            entries.append((c, d.max(), self._distance(np.array([c]), centre)[0], self.square[part].max(), self.ids[part].min(), self._page(part, c)))
        self.pages.append({"centre": centre, **{k: np.array(v) for k, v in zip(INNER, zip(*entries))}})
        return len(self.pages) - 1

    def _scores(self, q: np.ndarray, rows: np.ndarray) -> np.ndarray:
        """Exact scores of all queries with some rows."""
        x = self.x[rows]
        if np.abs(q).max(initial=0) * np.abs(x).max(initial=0) * x.shape[1] < 2**53:
            return (q @ x.T).astype(np.int64)
        whole = np.array([[int(v) for v in r] for r in q], object) @ np.array([[int(v) for v in r] for r in x], object).T
        return np.clip(whole, LEAST, GREATEST).astype(np.int64)

    @np.errstate(over="ignore", invalid="ignore")
    def search(self, own: np.ndarray, q: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query's place, score, id) of the k best rows, fewer if they score below the floor, for the queries q, whose
        own rows don't count."""
        m, norm = len(q), (q**2).sum(axis=1)
        lowest = floor.copy()  # the k-th best score so far, or the floor
        last = np.full(m, GREATEST)  # the id that goes with it
        best = tuple(np.empty(0, np.int64) for _ in range(3))

        def may(i: np.ndarray, b: np.ndarray, least: np.ndarray) -> np.ndarray:
            b = np.clip(np.floor(b), LEAST, GREATEST)
            return (b > lowest[i]) | (b == lowest[i]) & (least <= last[i])

        start = np.arange(m)
        centre = self.pages[self.root]["centre"]
        # What waits: the query, its bound for a page, the page, its least id and the query's distance to its centre.
        wait = (start, np.full(m, np.inf), np.full(m, self.root), np.full(m, LEAST), _lengths(q - self.x[centre]))
        while len(wait[0]):
            order = np.lexsort((-wait[1], wait[0]))
            wait = tuple(w[order] for w in wait)
            i = wait[0]
            turn = np.arange(len(i)) - np.searchsorted(i, i)  # the place among the query's pages
            now = tuple(w[turn < WIDTH] for w in wait)
            later = [tuple(w[turn >= WIDTH] for w in wait)]
            found = [best]
            by_page = np.argsort(now[2], kind="stable")
            numbers, starts = np.unique(now[2][by_page], return_index=True)
            for number, at in zip(numbers.tolist(), np.split(by_page, starts[1:]), strict=True):
                page, i, far = self.pages[number], now[0][at], now[4][at]
                # |d(query, centre) - d(entry, centre)| is the least distance to the entry, none computed yet.
                least_far = np.abs(far[:, None] - page["parent"])
                if "rows" in page:
                    rows = page["rows"]
                    open_ = may(i[:, None], _bound(norm[i][:, None], least_far, self.square[rows]), self.ids[rows])
                    some = open_.any(axis=1), open_.any(axis=0)
                    i, rows, open_ = i[some[0]], rows[some[1]], open_[some[0]][:, some[1]]
                    scores = self._scores(q[i], rows)
                    take = np.nonzero(open_ & (scores >= lowest[i][:, None]) & (self.rows[rows] != own[i][:, None]))
                    found.append((i[take[0]], scores[take], self.ids[rows[take[1]]]))
                else:
                    b = _bound(norm[i][:, None], least_far - page["radius"], page["square"])
                    a, e = np.nonzero(may(i[:, None], b, page["least"]))
                    d = _lengths(self.x[page["centres"][e]] - q[i[a]])
                    b = _bound(norm[i[a]], d - page["radius"][e], page["square"][e])
                    later.append((i[a], b, page["below"][e], page["least"][e], d))
            if len(found) > 1:
                place, score, ids = (np.concatenate(c) for c in zip(*found, strict=True))
                order = np.lexsort((ids, ~score, place))
                place, score, ids = place[order], score[order], ids[order]
                rank = np.arange(len(place)) - np.searchsorted(place, place)
                best = place[rank < k], score[rank < k], ids[rank < k]
                full = rank == k - 1
                lowest[place[full]], last[place[full]] = score[full], ids[full]
            wait = tuple(np.concatenate(c) for c in zip(*later, strict=True))
            stay = may(wait[0], wait[1], wait[3])
            wait = tuple(w[stay] for w in wait)
        return best


def _matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    flat = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return flat.flatten().to_numpy(zero_copy_only=False).reshape(len(flat), -1)


def _pivots(rows: DataFrame, n: int) -> dict[int, np.ndarray]:
    """Some vectors for each length: at most PIVOTS of a bounded sample by hash, one for each tree."""
    some = rows.where(F.pmod(F.xxhash64("v"), F.lit(1 << 30)) < int(min(1.0, SAMPLE / max(n, 1)) * (1 << 30))).select("v").limit(4 * SAMPLE)
    out: dict[int, list] = {}
    for v in sorted({tuple(r.v) for r in some.collect()}, key=lambda v: hash(v)):
        out.setdefault(len(v), []).append(v)
    most = max(1, min(PIVOTS, n // TREE))
    return {d: np.array(v[:most]) for d, v in out.items()}


def _placed(pivots: dict[int, np.ndarray]) -> Callable:
    """Adds the nearest pivot (cell) and the distance to it (far). Vectors of a length without a pivot share a cell about
    the origin."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("v")
            sizes = np.asarray(lists.value_lengths())
            cell, far = np.zeros(len(lists), np.int32), np.zeros(len(lists))
            for dim in np.unique(sizes).tolist():
                at = np.flatnonzero(sizes == dim)
                x = _matrix(lists.take(pa.array(at)))
                p = pivots.get(dim, np.zeros((1, dim)))
                cell[at] = c = np.argmin((p**2).sum(axis=1) - 2 * x @ p.T, axis=1)
                far[at] = _lengths(x - p[c])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(cell), pa.array(far)], names=[*batch.schema.names, "cell", "far"])

    return run


TREES = "dim int, cell int, part int, low double, high double, square double, tree binary"


def _build(table: pa.Table) -> pa.Table:
    tree = Tree(table["vec_id"].to_numpy(), table["row"].to_numpy(), _matrix(table["v"]))
    far = table["far"].to_numpy()
    keys = {c: table[c][:1] for c in ("dim", "cell", "part")}
    meta = {"low": [far.min()], "high": [far.max()], "square": [tree.square.max()]}
    return pa.table({**keys, **meta, "tree": pa.array([pickle.dumps(tree)], pa.binary())})


FOUND = "row long, query_id long, vec_id long, score long"


def _search(k: int) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(trees: pa.Table, queries: pa.Table) -> pa.Table:
        names = [c.split()[0] for c in FOUND.split(", ")]
        if not trees.num_rows or not queries.num_rows:
            return pa.table({n: pa.array([], pa.int64()) for n in names})
        tree = pickle.loads(trees["tree"][0].as_py())
        own = queries["row"].to_numpy()
        place, score, ids = tree.search(own, _matrix(queries["v"]), k, queries["floor"].to_numpy().copy())
        return pa.table(dict(zip(names, (own[place], queries["vec_id"].to_numpy()[place], ids, score), strict=True)))

    return run


def _meet(trees: DataFrame, queries: DataFrame, blocks: DataFrame, k: int) -> DataFrame:
    """The searches of queries (with dim, cell, part of a tree) in their trees. Blocks are of queries with one home cell,
    which ask for much the same trees, and a tree goes to those blocks only that have a query for it."""
    keys = ("dim", "cell", "part", "home", "block")
    asked = queries.join(blocks, ["dim", "home"]).withColumn("block", F.pmod(F.xxhash64("row"), F.col("blocks")).cast("int"))
    asked = cut(asked.select(*keys, "row", "vec_id", "v", "floor"))
    pairs = asked.select(*[F.col(c).alias(c) for c in keys]).distinct()
    spread = trees.select(*[F.col(c).alias(c) for c in ("dim", "cell", "part", "tree")]).join(pairs, ["dim", "cell", "part"])
    return spread.groupBy(*keys).cogroup(asked.groupBy(*keys)).applyInArrow(_search(k), FOUND)


def _others(pivots: dict[int, np.ndarray], meta: dict[int, np.ndarray]) -> Callable:
    """A row for each tree that may hold one of the best, but for the one walked already."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                q = np.array(batch.column("v")[i].as_py())
                trees, floor = meta[len(q)], batch.column("floor")[i].as_py()
                p = pivots.get(len(q), np.zeros((1, len(q))))
                far, cell = _lengths(p - q), trees[:, 0].astype(int)
                d, low, high, square = far[cell], trees[:, 2], trees[:, 3], trees[:, 4]
                norm = float(q @ q)
                b = _bound(norm, np.maximum(d - high, low - d), square, (p @ q)[cell] + np.sqrt(norm) * high)
                go = np.clip(np.floor(b), LEAST, GREATEST) >= floor
                go &= (cell != batch.column("cell")[i].as_py()) | (trees[:, 1] != batch.column("part")[i].as_py())
                n = int(go.sum())
                if n:
                    row = batch.slice(i, 1).select(["row", "vec_id", "v", "floor", "dim", "home"])
                    some = pa.Table.from_batches([row]).take(pa.array(np.zeros(n, np.int64)))
                    cells = pa.array(trees[go, 0].astype(np.int32)), pa.array(trees[go, 1].astype(np.int32))
                    some = some.append_column("cell", cells[0]).append_column("part", cells[1])
                    yield from some.combine_chunks().to_batches()

    return run


def top_k(vectors: DataFrame, queries: Column, k: int = 10) -> DataFrame:
    """query_id, rank, vec_id, score: the k best rows for each row that the condition ``queries`` on vec_id picks.

    ``vectors`` has vec_id and v, arrays of whole doubles, null if they take no part.
    """
    ship(vectors.sparkSession)
    rows = cut(vectors.where("vec_id is not null and v is not null").select(F.col("vec_id").cast("long").alias("vec_id"), "v", F.monotonically_increasing_id().alias("row")))
    n = rows.count()
    pivots = _pivots(rows, n)
    placed = cut(rows.mapInArrow(_placed(pivots), "vec_id long, v array<double>, row long, cell int, far double").withColumn("dim", F.size("v")))
    asked = placed.where(queries).withColumn("home", F.col("cell"))
    # A row for each cell with a query.
    blocks = F.broadcast(cut(asked.groupBy("dim", "home").agg(F.ceil(F.count("*") / QUERIES).cast("int").alias("blocks"))))
    parts = placed.groupBy("dim", "cell").agg(F.ceil(F.count("*") / TREE).cast("int").alias("parts"))
    part = F.pmod(F.xxhash64("row"), F.col("parts")).cast("int").alias("part")
    dealt = placed.join(F.broadcast(parts), ["dim", "cell"])  # a row for each pivot, and each other length
    trees = cut(dealt.select("dim", "cell", part, "vec_id", "row", "v", "far").groupBy("dim", "cell", "part").applyInArrow(_build, TREES))
    first = asked.join(F.broadcast(trees.groupBy("dim", "cell").agg(F.min("part").alias("part"))), ["dim", "cell"])
    first = first.withColumn("floor", F.lit(LEAST))
    near = cut(_meet(trees, first, blocks, k))
    # The table of trees: a few numbers for every TREE vectors.
    meta: dict[int, list] = {}
    for t in trees.select("dim", "cell", "part", "low", "high", "square").toLocalIterator():
        meta.setdefault(t.dim, []).append(tuple(t)[1:])
    floors = near.groupBy("row").agg(F.count("*").alias("n"), F.min("score").alias("least"))
    floors = floors.where(F.col("n") >= k).select("row", "least")
    rest = first.drop("floor").join(floors, "row", "left").withColumn("floor", F.coalesce("least", F.lit(LEAST)))
    rest = rest.select("row", "vec_id", "v", "floor", "dim", "home", "cell", "part").mapInArrow(
        _others(pivots, {d: np.array(v, float) for d, v in meta.items()}), "row long, vec_id long, v array<double>, floor long, dim int, home int, cell int, part int"
    )
    found = near.union(_meet(trees, rest, blocks, k))
    order = W.partitionBy("row").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
    )
