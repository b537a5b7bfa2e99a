"""Hand-made cases, and sequential rules on random cases."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from gridpulse.functions.labels import library_root_cause, raw_root_cause
from gridpulse.operators import changes, features, graph, incidents, sequences, sessions
from gridpulse.operators.components import components
from gridpulse.sources import schema, sinks

T0 = dt.datetime(2024, 1, 1)


def edges(spark, pairs):
    return spark.createDataFrame(pairs, "a long, b long")


def test_betweenness_of_a_path(spark):
    got = {r.node: r.betweenness for r in graph.betweenness(edges(spark, [(1, 2), (2, 3), (3, 4), (4, 5)]), 5).collect()}
    assert got[3] == pytest.approx(4 / 6) and got[1] == 0 and got[2] == pytest.approx(3 / 6)


def test_betweenness_of_a_star(spark):
    got = {r.node: r.betweenness for r in graph.betweenness(edges(spark, [(0, i) for i in range(1, 6)]), 10).collect()}
    assert got[0] == pytest.approx(1.0) and got[3] == 0


def test_clustering_of_a_triangle_with_a_tail(spark):
    got = {r.node: r.clustering for r in graph.clustering(edges(spark, [(1, 2), (1, 3), (2, 3), (3, 4)])).collect()}
    assert got == {1: 1.0, 2: 1.0, 3: pytest.approx(1 / 3), 4: 0.0}


def test_edges_drop_loops_and_repeats(spark):
    links = spark.createDataFrame([(1, 2), (2, 1), (3, 3), (None, 4)], "src long, dst long")
    assert [tuple(r) for r in graph.undirected_edges(links).collect()] == [(1, 2)]


def test_hierarchy_depths(spark):
    rows = [(0, None)] + [(i, i - 1) for i in range(1, 26)] + [(100, 101), (101, 100), (200, 201), (201, 202), (202, 201), (300, 999)]
    got = {r.ID: r.HIERARCHY_DEPTH for r in graph.hierarchy_depths(spark.createDataFrame(rows, "ID long, PARENT_NE_ID_FK long")).collect()}
    assert [got[i] for i in (0, 1, 20, 21, 22, 25)] == [0, 1, 20, 21, 21, 21]
    assert got[100] == 2 and got[200] == 3 and got[300] == 0


@pytest.mark.parametrize("seed", range(3))
def test_components_of_random_graphs(spark, seed):
    rnd = random.Random(seed)
    pairs = [(rnd.randrange(60), rnd.randrange(60)) for _ in range(45)]
    label = {x: x for p in pairs if p[0] != p[1] for x in p}
    for _ in label:
        for a, b in pairs:
            if a != b:
                label[a] = label[b] = min(label[a], label[b])
    assert {r.node: r.root for r in components(edges(spark, pairs)).collect()} == label


def test_session_gap_boundary(spark):
    rows = [(1, T0), (2, T0 + dt.timedelta(minutes=30)), (3, T0 + dt.timedelta(minutes=60, microseconds=1))]
    df = spark.createDataFrame(rows, "alarm_id long, alarm_time timestamp")
    assert [r.session_id for r in sessions.sessionize(df).orderBy("alarm_id").collect()] == ["1", "1", "2"]


def test_keyless_and_keyed_sessions_agree(spark):
    rnd = random.Random(1)
    rows = [(i, T0 + dt.timedelta(seconds=rnd.randrange(400_000)), "x") for i in range(200)]
    df = spark.createDataFrame(rows, "alarm_id long, alarm_time timestamp, k string")
    a = {r.alarm_id: r.session_id for r in sessions.sessionize(df).collect()}
    b = {r.alarm_id: r.session_id.split("#")[1] for r in sessions.sessionize(df, partition_by=["k"]).collect()}
    assert a == b


def fold(rows, near, window):
    """One open incident at a time."""
    out, held, last, n = {}, set(), None, 0
    for i, t, e in rows:
        if last is not None and t - last <= window and held & near[e]:
            held |= near[e]
        else:
            n, held = n + 1, {e}
        out[i], last = n, t
    return out


def seeds(rows, near, window):
    out, n = {}, 0
    for i, t, e in rows:
        if i in out:
            continue
        n += 1
        out[i] = n
        for j, u, f in rows:
            if j not in out and 0 <= u - t <= window and f in near[e]:
                out[j] = n
    return out


def chained(rows, near, window):
    label = {i: i for i, _, _ in rows}
    for _ in rows:
        for i, t, e in rows:
            for j, u, f in rows:
                if abs(t - u) <= window and f in near[e]:
                    label[i] = label[j] = min(label[i], label[j])
    return label


def parts(labels):
    groups = {}
    for i, x in labels.items():
        groups.setdefault(x, set()).add(i)
    return sorted(map(sorted, groups.values()))


@pytest.mark.parametrize("mode,rule", [("exact", fold), ("seeded", seeds), ("components", chained)])
@pytest.mark.parametrize("seed", range(2))
def test_incidents_follow_the_rule(spark, mode, rule, seed):
    rnd = random.Random(seed)
    names = [f"e{i}" for i in range(8)]
    near = {e: {e} for e in names}
    for _ in range(5):
        a, b = rnd.sample(names, 2)
        near[a].add(b)
        near[b].add(a)
    rows = sorted(((i, rnd.randrange(20_000), rnd.choice(names)) for i in range(50)), key=lambda r: (r[1], r[0]))
    alarms = spark.createDataFrame([(i, T0 + dt.timedelta(seconds=t), e) for i, t, e in rows], "alarm_id long, alarm_time timestamp, entity_id string")
    nb = spark.createDataFrame([(a, b) for a, s in near.items() for b in s], "entity string, neighbour string")
    got = {r.alarm_id: r.incident for r in incidents.correlate(alarms, nb, 900, mode).collect()}
    assert parts(got) == parts(rule(rows, near, 900))


def test_sequences_in_parts_are_whole(spark):
    rows = [(i, T0 + dt.timedelta(minutes=13 * (i * 37 % 50)), "abc"[i % 3] if i % 7 else None) for i in range(50)]
    alarms = spark.createDataFrame([*rows, (None, T0, "x"), (90, None, "x")], "alarm_id long, alarm_time timestamp, alarm_code string")
    of = spark.createDataFrame([(i, "big" if i < 45 else "small") for i in range(50)] + [(90, "big")], "alarm_id long, incident string")
    got = {(r.incident, r.part): r for r in incidents.sequence_parts(alarms, of, 20).collect()}
    assert sorted(got) == [("big", 0), ("big", 1), ("big", 2), ("small", 0)]
    want = [c for i, t, c in sorted(rows, key=lambda r: (r[1], r[0])) if i < 45]
    assert sum((list(got["big", k].alarm_sequence) for k in range(3)), []) == want and len(got["big", 2].alarm_sequence) == 5
    assert got["big", 0].end_time <= got["big", 1].start_time
    assert incidents.sequence_parts(alarms.limit(0), of).count() == 0


def test_labels_keep_the_order_of_rules(spark):
    df = spark.createDataFrame([("bgpRetransmitNeighbor", None), ("snmpTrap", None), (None, "OUTAGE"), ("x", "outage"), ("lossRate", "DETERIORATION")], "i string, c string")
    got = [r[0] for r in df.select(library_root_cause(F.col("i"), F.col("c"))).collect()]
    assert got == ["BACKHAUL_ISSUE", "CONFIGURATION_ERROR", "UNKNOWN", "HARDWARE_FAILURE", "PACKET_LOSS"]
    raw = spark.createDataFrame([("Power",), (" ",), (None,), ("odd",)], "t string").select(raw_root_cause(F.col("t"))).collect()
    assert [r[0] for r in raw] == ["POWER_ISSUE", "UNKNOWN", "UNKNOWN", "UNKNOWN"]


def test_columns_are_found_in_any_case(spark):
    assert schema.find_columns(["entity_id", "Open_Time", "X"], fallback={"severity": "x"}) == {"ne_id": "entity_id", "timestamp": "Open_Time", "severity": "X"}


def test_topo_layer_bins(spark):
    df = spark.createDataFrame([(d,) for d in (0, 1, 2, 5, 6, 15, 16)], "d int").select(graph.topo_layer(F.col("d")))
    assert [r[0] for r in df.collect()] == [0, 0, 1, 1, 2, 2, 3]


def test_export_fills_what_is_no_number(spark):
    df = spark.createDataFrame([(" a ", "1.5", None), ("", "2", 1.0), ("b", "x", 2.0)], "NE_ID string, p string, q double")
    got = {r.entity_id: list(r.features) for r in sinks.export_entity_features(df, ["p", "q", "absent"]).collect()}
    assert got == {"a": [1.5, 0.0, 0.0], "b": [0.0, 2.0, 0.0]}


def test_sequences_are_cut_and_padded_on_the_left(spark):
    df = spark.createDataFrame([("i", ["a", "b", "z"]), ("j", []), ("k", ["a"])], "incident string, alarm_sequence array<string>")
    vocab = spark.createDataFrame([("a", 2), ("b", 3)], "code string, index int")
    got = {r.incident: list(r.indices) for r in sequences.encode_sequences(df, vocab, 2).collect()}
    assert got == {"i": [3, 1], "j": [0, 0], "k": [0, 2]}


def test_fingerprint_sees_a_swap(spark):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "ID long, v string")
    b = spark.createDataFrame([(2, "x"), (1, "y")], "ID long, v string")
    prints = [changes.table_fingerprint(t, "ID").first() for t in (a, b, a.orderBy("v"))]
    assert prints[0].key_sum == prints[1].key_sum and prints[0].fingerprint != prints[1].fingerprint == prints[1].fingerprint
    assert prints[0].fingerprint == prints[2].fingerprint


def test_training_set_by_number(spark):
    alarms = spark.createDataFrame([(1, 5, "A"), (2, None, "B"), (3, 6, None)], "alarm_id long, entity_id long, root_cause string")
    master = spark.createDataFrame([(5, "NE-5"), (6, "NE-6")], "ID long, NE_ID string")
    assert [r.alarm_id for r in features.training_set(alarms, master).collect()] == [1]
