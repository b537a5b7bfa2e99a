"""Sequential rules over an ordered table, folded in chunks.

A rule that reads all rows in order, one after the other, with a state, is no single task: the rows are cut into chunks
of consecutive rows, and every chunk is folded at once from an assumed state. Then the state that a chunk was entered
with is compared with the one that the chunk before has left, and only chunks for which they differ are folded again,
until none differs. After round r the first r chunks are right whatever the rule, so it ends, and the result is that of
the sequential rule. Rules that forget, as those of incidents do, need two or three rounds; one that never forgets needs as
many as there are chunks. A task holds one chunk and one state.
"""

from __future__ import annotations

from collections.abc import Callable
from typing import Protocol

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .sessions import running_number
from .shared import cut, ship

#: Rows of a chunk.
CHUNK = 20_000


class Rule(Protocol):
    def enter(self, state: bytes | None) -> None:
        """Starts from a state that a rule has left; None: from the start."""

    def step(self, row: dict) -> int | None:
        """The label of a row; None: that which was current when the state was left."""

    def leave(self) -> tuple[bytes, int | None]:
        """The state, equal bytes for states that go on alike, and the current label (None as in step)."""


OUT = "chunk long, row_id long, label long, state binary"


def _fold(rule: Callable[[], Rule], order: list[tuple[str, str]], row_id: str) -> Callable[[pa.Table, pa.Table], pa.Table]:
    def run(rows: pa.Table, entry: pa.Table) -> pa.Table:
        state = rule()
        state.enter(entry["state"][0].as_py() if entry.num_rows else None)
        rows = rows.sort_by(order)
        labels = [state.step(row) for batch in rows.to_batches(1024) for row in batch.to_pylist()]
        left, label = state.leave()
        n = len(labels)
        columns = [rows["chunk"].to_pylist()[:1] * (n + 1), [*rows[row_id].to_pylist(), None], [*labels, label], [None] * n + [left]]
        return pa.table(dict(zip(("chunk", "row_id", "label", "state"), (pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int64(), pa.int64(), pa.binary()))))))

    return run


def fold_in_chunks(rows: DataFrame, extra: DataFrame | None, on: str, rule: Callable[[], Rule], time: str, row_id: str, size: int | None = None, rounds: Callable[[int, int], None] = lambda number, chunks: None) -> DataFrame:
    """row_id, label: what the rule says of each row, in order of (time, row_id), which are not null. ``extra`` is joined on
    ``on`` once the rows are numbered. rounds: told the number of each round and how many chunks it folds."""
    ship(rows.sparkSession)
    size = size or CHUNK
    numbered = running_number(rows, F.lit(True), time, row_id)
    numbered = numbered.withColumn("chunk", F.floor((F.col("number") - 1) / size)).drop("number")
    if extra is not None:
        numbered = numbered.join(extra, on, "left")
    dealt = cut(numbered)
    fold = _fold(rule, [(time, "ascending"), (row_id, "ascending")], row_id)

    def folded(some: DataFrame, entries: DataFrame) -> DataFrame:
        return cut(some.groupBy("chunk").cogroup(entries.groupBy("chunk")).applyInArrow(fold, OUT))

    exits = lambda out: out.where("state IS NOT NULL").select(F.col("chunk").alias("of"), "label", "state")
    used = cut(dealt.select("chunk").distinct().withColumn("digest", F.lit("")))
    outs = [folded(dealt, used.select("chunk", F.lit(None).cast("binary").alias("state")).limit(0))]
    left = exits(outs[0])
    rounds(0, used.count())
    latest = used.select("chunk", F.lit(0).alias("round"))
    while True:
        entries = left.select((F.col("of") + 1).alias("chunk"), "state", F.sha2("state", 256).alias("now"))
        todo = cut(entries.join(used, "chunk").where("now != digest").select("chunk", "state", "now"))
        n = todo.count()
        if not n:
            break
        rounds(len(outs), n)
        again = F.col("chunk")
        some = dealt.join(todo.select(again.alias("chunk")), "chunk", "left_semi")
        out = folded(some.select(*[F.col(c).alias(c) for c in some.columns]), todo.select(again.alias("chunk"), F.col("state").alias("state")))
        changed = todo.select("chunk", F.col("now").alias("digest"))
        used = cut(used.join(changed.select("chunk"), "chunk", "left_anti").union(changed))
        latest = cut(latest.join(changed.select("chunk"), "chunk", "left_anti").union(changed.select("chunk", F.lit(len(outs)).alias("round"))))
        left = cut(left.join(exits(out).select("of"), "of", "left_anti").union(exits(out)))
        outs.append(out)
    final = outs[0].withColumn("round", F.lit(0))
    for number, out in enumerate(outs[1:], 1):
        final = final.union(out.withColumn("round", F.lit(number)))
    final = final.where("state IS NULL").join(latest, ["chunk", "round"])
    # What was current when a chunk was entered; one row for each chunk.
    before = F.last("label", ignorenulls=True).over(W.orderBy("of").rowsBetween(W.unboundedPreceding, -1))
    current = left.select(F.col("of").alias("chunk"), before.alias("current"))
    return final.join(current, "chunk").select("row_id", F.coalesce("label", "current").alias("label"))
