"""Sequential rules in chunks equal the rule over all rows, whatever the chunks."""

import datetime as dt
import pickle
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gridpulse.operators import chunks, incidents

T0 = dt.datetime(2024, 1, 1)


def rules():
    """Within a function, so that they are sent to Python workers by value."""

    class Running:
        """A rule that never forgets: the label is the sum of all ids so far."""

        def __init__(self):
            self.sum = 0

        def enter(self, state):
            self.sum = pickle.loads(state) if state else 0

        def step(self, row):
            self.sum += row["alarm_id"]
            return self.sum

        def leave(self):
            return pickle.dumps(self.sum), None

    class Marks:
        """A label that lasts for chunks: the last id that seven divides."""

        def __init__(self):
            self.last = None

        def enter(self, state):
            pass

        def step(self, row):
            self.last = row["alarm_id"] if row["alarm_id"] % 7 == 0 else self.last
            return self.last

        def leave(self):
            return b"", self.last

    return Running, Marks


def storm(rnd, n, elements, degree):
    """Alarms of one component without a quiet minute."""
    names = [f"e{i}" for i in range(elements)]
    near = {e: {e} for e in names}
    links = [(i, rnd.randrange(i)) for i in range(1, elements)] + [(rnd.randrange(elements), rnd.randrange(elements)) for _ in range((degree - 2) * elements // 2)]
    for a, b in links:
        near[names[a]].add(names[b])
        near[names[b]].add(names[a])
    rows, t = [], 0
    for i in rnd.sample(range(10 * n), n):
        t += rnd.choice([0, 1, 7, 30])
        rows.append((i, t, rnd.choice(names)))
    return sorted(rows, key=lambda r: (r[1], r[0])), near


def frames(spark, rows, near):
    alarms = spark.createDataFrame([(i, T0 + dt.timedelta(seconds=t), e) for i, t, e in rows], "alarm_id long, alarm_time timestamp, entity_id string")
    return alarms.repartition(3), spark.createDataFrame([(a, b) for a, s in near.items() for b in s], "entity string, neighbour string")


def plain(rule, rows, near):
    return {i: str(rule.of(t * 1_000_000, i, e, near[e])) for i, t, e in rows}


@pytest.mark.parametrize("mode", ["exact", "seeded"])
@pytest.mark.parametrize("degree", [3, 12])
def test_one_component_without_quiet_time(spark, monkeypatch, mode, degree):
    rows, near = storm(random.Random(degree), 1500, 60, degree)
    alarms, nb = frames(spark, rows, near)
    monkeypatch.setattr(chunks, "CHUNK", 90)
    told, sizes = [], []
    whole = incidents.fold_in_chunks
    monkeypatch.setattr(incidents, "fold_in_chunks", lambda *a, **k: whole(*a, rounds=lambda number, n: told.append(n), **k))
    plain_fold = chunks._fold
    monkeypatch.setattr(chunks, "_fold", lambda *a: sizes.append(a) or plain_fold(*a))
    got = {r.alarm_id: r.incident for r in incidents.correlate(alarms, nb, 300, mode).collect()}
    rule = incidents.OpenIncident(300) if mode == "exact" else incidents.Seeds(300)
    assert got == plain(rule, rows, near)
    assert told[0] == 17 and len(told) < 10  # far fewer rounds than chunks
    assert sum(told) < 17 * 6


def test_no_task_holds_more_than_a_chunk(spark):
    rows, near = storm(random.Random(1), 700, 30, 4)
    alarms, _ = frames(spark, rows, near)
    seen = chunks.running_number(alarms, F.lit(True), "alarm_time", "alarm_id").collect()
    assert sorted(r.number for r in seen) == list(range(1, 701))
    assert max(Counter((r.number - 1) // 50 for r in seen).values()) == 50


def test_a_rule_that_never_forgets_needs_a_round_for_each_chunk(spark):
    rows, near = storm(random.Random(2), 100, 5, 2)
    alarms, _ = frames(spark, rows, near)
    told = []
    got = chunks.fold_in_chunks(alarms, None, "entity_id", rules()[0], "alarm_time", "alarm_id", 20, lambda number, n: told.append(n))
    want, total = {}, 0
    for i, _, _ in rows:
        total += i
        want[i] = total
    assert {r.row_id: r.label for r in got.collect()} == want and told == [5, 4, 3, 2, 1]


def test_labels_last_over_chunks(spark):
    rows = [(i, i, "e") for i in range(1, 60)]
    alarms, _ = frames(spark, rows, {"e": {"e"}})
    got = chunks.fold_in_chunks(alarms, None, "entity_id", rules()[1], "alarm_time", "alarm_id", 3)
    assert {r.row_id: r.label for r in got.collect()} == {i: i // 7 * 7 or None for i in range(1, 60)}


def test_alarms_without_a_place_and_empty_tables(spark):
    rows = [(1, T0, "a"), (2, None, "a"), (3, T0, None), (4, T0, "b"), (5, T0, "zz")]
    alarms = spark.createDataFrame(rows, "alarm_id long, alarm_time timestamp, entity_id string")
    nb = spark.createDataFrame([("a", "a"), ("a", "b"), ("b", "a"), ("b", "b")], "entity string, neighbour string")
    for mode in ("exact", "seeded"):
        got = {r.alarm_id: r.incident for r in incidents.correlate(alarms, nb, 60, mode).collect()}
        assert got == {1: "1", 2: "2", 3: "3", 4: "1", 5: "5"}
        assert incidents.correlate(alarms.limit(0), nb, 60, mode).count() == 0
