"""Updated rules equal those of all alarms, and other sessions aren't read."""

import datetime as dt
import random

import pytest

from gridpulse.operators import rules, rulestate, sessions

T0 = dt.datetime(2024, 1, 1)
ROW = "alarm_id long, entity_id string, alarm_time timestamp, alarm_code string"


def some(rnd, n, elements=6, days=3):
    return [(i, f"e{rnd.randrange(elements)}", T0 + dt.timedelta(seconds=rnd.randrange(days * 86_400), microseconds=rnd.choice([0, 0, 250_000])), rnd.choice("abcde")) for i in range(n)]


def key(df):
    return sorted((tuple(round(v, 6) if isinstance(v, float) else v for v in r) for r in df.collect()), key=str)


def whole(spark, rows, gap):
    return rules.propagation_rules(sessions.session_codes(sessions.sessionize(spark.createDataFrame(rows, ROW), gap, ["entity_id"])), 0.01, 0.05)


@pytest.mark.parametrize("seed", range(2))
def test_random_splits_in_any_order(spark, seed):
    rnd = random.Random(seed)
    rows = some(rnd, 500)
    shuffled = rnd.sample(rows, len(rows))
    parts = [shuffled[:300], shuffled[300:302], shuffled[302:], shuffled[290:310]]  # the last is known already
    state = rulestate.start(spark.createDataFrame(parts[0], ROW), 1800)
    for part in parts[1:]:
        state, _ = rulestate.update(state, spark.createDataFrame(part, ROW))
    got, want = key(rulestate.rules(state, 0.01, 0.05)), key(whole(spark, rows, 1800))
    assert got == want and len(want) > 10
    again = rulestate.start(spark.createDataFrame(rows, ROW), 1800)
    for name in ("sessions", "delays", "codes", "total"):
        assert key(getattr(state, name)) == key(getattr(again, name))


def test_only_touched_sessions_are_read(spark, tmp_path):
    rnd = random.Random(5)
    rows = some(rnd, 800, elements=20, days=20)
    state = rulestate.start(spark.createDataFrame(rows, ROW), 1800)
    state.save(f"{tmp_path}/1")
    state = rulestate.RuleState.load(spark, f"{tmp_path}/1", 1800)
    near = next(r for r in rows if r[1] == "e3")
    new = [(9000, "e3", near[2] + dt.timedelta(seconds=1800), "a"), (9001, "e4", T0 + dt.timedelta(days=90), "b"), (9002, "e4", T0 + dt.timedelta(days=90, seconds=5), "c")]
    after, read = rulestate.update(state, spark.createDataFrame(new, ROW))
    read = read.collect()
    assert near[0] in {r.alarm_id for r in read} and {r.entity_id for r in read} == {"e3"} and len(read) < 12
    assert key(rulestate.rules(after, 0.0, 0.0)) == key(rules.propagation_rules(sessions.session_codes(sessions.sessionize(spark.createDataFrame(rows + new, ROW), 1800, ["entity_id"])), 0.0, 0.0))


def test_odd_rows_and_empty_tables(spark):
    odd = spark.createDataFrame([(None, "e", T0, "a"), (1, None, T0, "a"), (2, "e", None, "a"), (3, "e", T0, None), (4, "e", T0, "b"), (4, "e", T0, "b")], ROW)
    state = rulestate.start(odd.limit(0), 60)
    assert rulestate.rules(state).count() == 0
    state, read = rulestate.update(state, odd)
    assert state.sessions.count() == 2 and read.count() == 0 and state.total.first().n == 1
    assert rulestate.rules(state, 0.0, 0.0).count() <= 1
