"""SQL for the registered queries, over the same tables."""

from __future__ import annotations

from collections.abc import Sequence

from ..functions import elements as el
from ..functions import labels as lb
from .fixtures import ctes

ORACLES: dict[str, str] = {}


def _add(name: str, views: Sequence[str], select: str, steps: str = "", recursive: bool = False) -> None:
    parts = [p for p in (ctes(*views) if views else "", steps.strip().strip(",")) if p]
    ORACLES[name] = (f"WITH {'RECURSIVE ' if recursive else ''}" + ",\n".join(parts) + "\n" if parts else "") + select


def _rules(text: str, rules: Sequence[tuple[str, Sequence[str]]], otherwise: str) -> str:
    whens = " ".join(f"WHEN {' OR '.join(f"contains({text}, '{k}')" for k in keys)} THEN '{label}'" for label, keys in rules)
    return f"CASE {whens} ELSE '{otherwise}' END"


_LIBRARY = f"""CASE WHEN alarm_identifier IS NULL THEN 'UNKNOWN'
 WHEN contains(upper(coalesce(classification, '')), 'OUTAGE') THEN {_rules("lower(alarm_identifier)", lb.OUTAGE_RULES, "HARDWARE_FAILURE")}
 WHEN contains(upper(coalesce(classification, '')), 'DETERIORATION') THEN {_rules("lower(alarm_identifier)", lb.DETERIORATION_RULES, "LINK_CONGESTION")}
 ELSE {_rules("lower(alarm_identifier)", lb.IDENTIFIER_RULES, "UNKNOWN")} END"""
_RAW = f"CASE WHEN probable_cause IS NULL OR trim(probable_cause) = '' THEN 'UNKNOWN' ELSE {_rules('lower(probable_cause)', lb.FREE_TEXT_RULES, 'UNKNOWN')} END"
_CASES = lambda c, d: f"CASE {c} {' '.join(f"WHEN '{k}' THEN {v}" for k, v in d.items())} ELSE 0 END"

_LABELLED = f"""
labelled AS (SELECT a.*, coalesce(l.label, 'UNKNOWN') AS root_cause FROM alarms a
  LEFT JOIN (SELECT alarm_code, min({_LIBRARY}) AS label FROM alarm_library GROUP BY ALL) l USING (alarm_code)),"""
_KEYED = """
gaps AS (SELECT *, epoch_us(alarm_time) - epoch_us(lag(alarm_time) OVER (PARTITION BY entity_id ORDER BY alarm_time, alarm_id)) AS g FROM {source}),
sessions AS (SELECT *, entity_id || '#' || (sum(CASE WHEN g IS NULL OR g > 43200000000 THEN 1 ELSE 0 END) OVER (PARTITION BY entity_id ORDER BY alarm_time, alarm_id))::BIGINT AS session_id FROM gaps),"""
_CODES = _KEYED.format(source="alarms") + """
many AS (SELECT session_id FROM sessions GROUP BY ALL HAVING count(*) > 1),
firsts AS (SELECT session_id, alarm_code AS code, min((alarm_time, alarm_id)) AS f, min(alarm_time) AS "first", max(alarm_time) AS "last" FROM sessions SEMI JOIN many USING (session_id) GROUP BY ALL),
codes AS (SELECT session_id, code, (row_number() OVER (PARTITION BY session_id ORDER BY f))::INT AS place, "first", "last" FROM firsts),"""
_PAIRS = _CODES + """
pairs AS (SELECT x.session_id, x.code AS a, y.code AS b, (epoch_us(y."last") - epoch_us(x."last")) / 1e6 AS delay FROM codes x JOIN codes y USING (session_id) WHERE x.place < y.place),"""
_RULES = _PAIRS + """
stats AS (SELECT a, b, count(*) AS n, avg(delay) FILTER (delay BETWEEN 0 AND 3600) AS m, stddev_pop(delay) FILTER (delay BETWEEN 0 AND 3600) AS s, min(delay) FILTER (delay BETWEEN 0 AND 3600) AS lo, max(delay) FILTER (delay BETWEEN 0 AND 3600) AS hi FROM pairs GROUP BY ALL),
known AS (SELECT code AS a, count(*) AS k FROM codes GROUP BY ALL),
rated AS (SELECT *, n / (SELECT count(DISTINCT session_id) FROM codes) AS support, n / k AS confidence FROM stats JOIN known USING (a)),
rules AS (SELECT a AS antecedent, b AS consequent, n AS count, support, confidence, m, s, lo, hi, (row_number() OVER (PARTITION BY a ORDER BY confidence DESC, b))::INT AS rank
  FROM rated WHERE support >= 0.005 AND confidence >= 0.10),"""
_SCORED = _LABELLED + _KEYED.format(source="labelled") + """
scored AS (SELECT alarm_id, alarm_time AS open_time, entity_id, alarm_code, severity, root_cause AS predicted_root_cause, (alarm_id % 100) / 100.0::DOUBLE AS confidence, session_id AS incident FROM sessions),"""
_EDGES = """
edges AS (SELECT DISTINCT least(src, dst) AS a, greatest(src, dst) AS b FROM topology_links WHERE src <> dst),
both_ways AS (SELECT a AS node, b AS other FROM edges UNION ALL SELECT b, a FROM edges),
deg AS (SELECT node, count(*) AS degree FROM both_ways GROUP BY ALL),"""
_CLUSTER = """
triangles AS (SELECT x.node, count(*) / 2 AS t FROM both_ways x JOIN both_ways y ON x.node = y.node AND x.other <> y.other JOIN both_ways z ON z.node = x.other AND z.other = y.other GROUP BY ALL),
cluster AS (SELECT node, CASE WHEN degree > 1 THEN 2.0 * coalesce(t, 0) / (degree * (degree - 1)) ELSE 0.0 END AS clustering FROM deg LEFT JOIN triangles USING (node)),"""
_COMPONENTS = """
reach AS (SELECT node AS root, node FROM deg UNION SELECT r.root, e.other FROM reach r JOIN both_ways e ON r.node = e.node WHERE e.other > r.root),
comp AS (SELECT node, min(root) AS component FROM reach GROUP BY node),
sizes AS (SELECT component, count(*) AS component_size FROM comp GROUP BY ALL),"""
_DEPTH = """
walk AS (SELECT ID, ID AS at, 0 AS depth, [ID] AS seen, false AS done FROM network_elements
  UNION ALL SELECT w.ID, p.ID, w.depth + 1, list_append(w.seen, p.ID), list_contains(w.seen, p.ID) FROM walk w
  JOIN network_elements n ON n.ID = w.at JOIN network_elements p ON p.ID = n.PARENT_NE_ID_FK WHERE NOT w.done AND w.depth <= 20),
depths AS (SELECT ID, max(depth) AS HIERARCHY_DEPTH FROM walk GROUP BY ID),"""
_NEIGHBOURS = _EDGES + """
nb AS (SELECT x.NE_ID AS entity, y.NE_ID AS neighbour FROM both_ways JOIN network_elements x ON x.ID = node JOIN network_elements y ON y.ID = other
  UNION SELECT NE_ID, NE_ID FROM network_elements),"""
_HEALTH = """
isis AS (SELECT * FROM topology_links WHERE link_type = 'isis'),
o AS (SELECT src AS ID, max(SOURCE_UTILIZATION) AS SRC_MAX_UTILIZATION, avg(SOURCE_UTILIZATION) AS SRC_AVG_UTILIZATION, max(SOURCE_ERROR_RATE) AS SRC_MAX_ERROR_RATE,
  max(SOURCE_DROP_RATE) AS SRC_MAX_DROP_RATE, count(*) FILTER (SOURCE_UTILIZATION_SEVERITY = 'CRITICAL') AS SRC_CRITICAL_LINKS,
  count(*) FILTER (SOURCE_UTILIZATION_SEVERITY = 'WARNING') AS SRC_WARNING_LINKS, count(*) AS SRC_LINK_COUNT FROM isis GROUP BY src),
i AS (SELECT dst AS ID, max(TARGET_UTILIZATION) AS DST_MAX_UTILIZATION, avg(TARGET_UTILIZATION) AS DST_AVG_UTILIZATION, max(TARGET_ERROR_RATE) AS DST_MAX_ERROR_RATE, max(TARGET_DROP_RATE) AS DST_MAX_DROP_RATE FROM isis GROUP BY dst),
h0 AS (SELECT ID, coalesce(SRC_MAX_UTILIZATION, 0) AS SRC_MAX_UTILIZATION, coalesce(SRC_AVG_UTILIZATION, 0) AS SRC_AVG_UTILIZATION, coalesce(SRC_MAX_ERROR_RATE, 0) AS SRC_MAX_ERROR_RATE,
  coalesce(SRC_MAX_DROP_RATE, 0) AS SRC_MAX_DROP_RATE, coalesce(SRC_CRITICAL_LINKS, 0) AS SRC_CRITICAL_LINKS, coalesce(SRC_WARNING_LINKS, 0) AS SRC_WARNING_LINKS, coalesce(SRC_LINK_COUNT, 0) AS SRC_LINK_COUNT,
  coalesce(DST_MAX_UTILIZATION, 0) AS DST_MAX_UTILIZATION, coalesce(DST_AVG_UTILIZATION, 0) AS DST_AVG_UTILIZATION, coalesce(DST_MAX_ERROR_RATE, 0) AS DST_MAX_ERROR_RATE, coalesce(DST_MAX_DROP_RATE, 0) AS DST_MAX_DROP_RATE
  FROM o FULL JOIN i USING (ID)),
health AS (SELECT *, SRC_MAX_UTILIZATION * 10 + SRC_MAX_ERROR_RATE * 100 + SRC_MAX_DROP_RATE * 100 + SRC_CRITICAL_LINKS * 5 AS LINK_HEALTH_SCORE FROM h0),"""
_AGED = """
hw AS (SELECT SOURCE_NE_ID AS ID, max(WARRANTY_DATE) AS w, min(MANUFACTURE_DATE) AS m FROM hardware_details WHERE IS_DELETED = 0 GROUP BY ALL),
aged AS (SELECT n.*, coalesce(floor((epoch_us(TIMESTAMP '2005-01-01') - epoch_us(m)) / 86400000000.0), -1)::BIGINT AS NE_AGE_DAYS,
  coalesce(floor((epoch_us(w) - epoch_us(TIMESTAMP '2005-01-01')) / 86400000000.0), -999)::BIGINT AS WARRANTY_REMAINING_DAYS FROM network_elements n LEFT JOIN hw USING (ID) WHERE IS_DELETED = 0),
elements AS (SELECT *, (WARRANTY_REMAINING_DAYS < 0)::INT AS WARRANTY_EXPIRED FROM aged),"""
_GRAPH = _EDGES + _CLUSTER + _COMPONENTS + """
graph AS (SELECT n.ID, coalesce(degree, 0) AS GRAPH_DEGREE, coalesce(clustering, 0.0) AS CLUSTERING_COEF, coalesce(component_size, 1) AS COMPONENT_SIZE, (coalesce(degree, 0) = 1)::INT AS IS_LEAF,
  (coalesce(degree, 0) = 0)::INT AS IS_ISOLATED, CASE WHEN coalesce(degree, 0) <= 1 THEN 0 WHEN degree <= 5 THEN 1 WHEN degree <= 15 THEN 2 ELSE 3 END AS TOPO_LAYER
  FROM network_elements n LEFT JOIN deg ON deg.node = n.ID LEFT JOIN cluster ON cluster.node = n.ID LEFT JOIN comp ON comp.node = n.ID LEFT JOIN sizes USING (component)),"""
_COMPLETE = " + ".join(f"(GEOGRAPHY_L{i}_ID_FK IS NOT NULL)::INT" for i in range(1, 5))
_ENC = lambda c, t: f"(dense_rank() OVER (ORDER BY coalesce({c}, 'UNKNOWN')) - 1)::INT AS {c}_ENC"
_SUMMARY = _LABELLED + _KEYED.format(source="labelled") + """
modes AS (SELECT session_id, root_cause, count(*) AS n FROM sessions GROUP BY ALL),
modal AS (SELECT session_id, arg_min(root_cause, (-n, root_cause)) AS dominant_root_cause FROM modes GROUP BY ALL),
summary AS (SELECT session_id AS incident, min(alarm_time) AS start_time, max(alarm_time) AS end_time, string_agg(DISTINCT entity_id, ',' ORDER BY entity_id) AS ne_ids,
  list(alarm_code ORDER BY alarm_time, alarm_id) AS seq, count(*) AS alarm_count FROM sessions GROUP BY ALL),"""

NE, HW, TL, AL, LIB, KPI = ("network_elements",), ("hardware_details",), ("topology_links",), ("alarms",), ("alarm_library",), ("kpi_history",)

_add("src1_load_network_elements", NE + HW, "SELECT ID, NE_ID, NE_AGE_DAYS, WARRANTY_REMAINING_DAYS, WARRANTY_EXPIRED, 'UNKNOWN' AS NE_CATEGORY, 0 AS PROTOCOL_HEALTH_SCORE FROM elements", _AGED)
_add("src2_load_topology_links", TL, "SELECT src, dst, link_type, round(SOURCE_UTILIZATION, 6) AS SOURCE_UTILIZATION FROM topology_links WHERE dst IS NOT NULL AND (link_type = 'isis' OR link_type = 'bgp' AND src % 50 <> 0)")
_add("src3_load_alarm_library", LIB, "SELECT * FROM alarm_library WHERE alarm_code NOT LIKE '%\\_3' ESCAPE '\\' AND alarm_code NOT LIKE '%\\_2' ESCAPE '\\'")
_add("src4_read_table", (), "SELECT p_partkey, p_name, p_size FROM part WHERE p_size > 20")
_add("src5_load_alarms", AL, """SELECT alarm_id, entity_id AS ne_id, alarm_code, severity, alarm_time AS "timestamp", probable_cause AS root_cause FROM alarms WHERE alarm_time > TIMESTAMP '2024-01-15'""")
_add("src6_load_kpi_definitions", KPI, """SELECT 'gridpulse_kpi_counter' AS "table", count(DISTINCT ne_id) AS n FROM kpi_history""")
_add("src7_stream_alarms", AL, "SELECT alarm_id, alarm_time, entity_id, alarm_code FROM alarms")
_add("src8_read_results", AL + LIB, """SELECT alarm_id, open_time, entity_id, predicted_root_cause, confidence, '[{"a": 1}]' AS propagation_alarms FROM scored WHERE alarm_id % 10 <> 0""", _SCORED)
_add("snk1_write_table", AL, "SELECT strftime(alarm_time, '%Y-%m-%d') AS day, count(*) AS n FROM alarms GROUP BY ALL")
_add("snk2_write_csv", AL, "SELECT severity, count(*) AS n FROM alarms GROUP BY ALL")
_add("snk3_nest_rules", AL, "SELECT antecedent, count(*) AS n, string_agg(consequent, ',' ORDER BY rank) AS consequents FROM rules GROUP BY ALL", _RULES)
_FEATURES = "concat_ws(',', coalesce(GEOGRAPHY_L1_ID_FK, 0)::BIGINT, IS_VIRTUAL, coalesce(GEOGRAPHY_L3_ID_FK, 0)::BIGINT, 0, 0, ID)"
_add("snk4_export_entity_features", NE, f"SELECT NE_ID AS entity_id, {_FEATURES} AS features FROM network_elements")
_add("sc13_assemble", NE, f"SELECT ID, {_FEATURES} AS features FROM network_elements")
_add("prj1_resolve_columns", AL, "SELECT alarm_id, entity_id AS ne_id, alarm_code, severity, probable_cause AS root_cause, NULL::VARCHAR AS status, NULL::VARCHAR AS domain FROM alarms")
_add("prj3_ensure_columns", NE, "SELECT ID, NULL::VARCHAR AS ADMIN_STATE, 'NONE' AS CATEGORY, VENDOR FROM network_elements")
_add("flt1_active_only", NE, "SELECT ID, NE_ID FROM network_elements WHERE IS_DELETED = 0")
_add("flt5_label_alarms", AL, f"SELECT alarm_id, {_RAW} AS root_cause FROM alarms")
_add("jn2_label_alarms", AL + LIB, "SELECT alarm_id, root_cause FROM labelled", _LABELLED)
_valid = "('POWER_ISSUE', 'BACKHAUL_ISSUE', 'LINK_CONGESTION', 'PACKET_LOSS')"
_add("sc1_library_root_cause", LIB, f"SELECT alarm_code, {_LIBRARY} AS label, CASE WHEN {_LIBRARY} IN {_valid} THEN {_LIBRARY} ELSE 'UNKNOWN' END AS valid_label FROM alarm_library")
_add("sc2_raw_root_cause", AL, f"SELECT alarm_id, {_RAW} AS label FROM alarms")
_state = lambda k: f"(CASE (ID + {k}) % 4 WHEN 0 THEN 1 WHEN 1 THEN 0 ELSE -1 END)"
_add("sc4_protocol_health", NE, f"SELECT ID, {_state(0)} + {_state(1)} + {_state(5)} AS health FROM network_elements")
_add("sc5_tech_generation", NE, f"SELECT ID, {_CASES('TECHNOLOGY', el.GENERATIONS)} AS generation FROM network_elements")
_add("sc6_encode_categoricals", NE, f"SELECT ID, {_ENC('NE_TYPE', 0)}, {_ENC('TECHNOLOGY', 0)}, {_ENC('VENDOR', 0)}, 0 AS CATEGORY_ENC, IS_VIRTUAL AS IS_VIRTUAL_NUM, 0 AS IS_SECURED_NUM, (PARENT_NE_ID_FK IS NOT NULL)::INT AS HAS_PARENT FROM network_elements")
_rounds = lambda *c: ", ".join(f"round({x}, 6) AS {x}" for x in c)
_floats = ("SRC_MAX_UTILIZATION", "SRC_AVG_UTILIZATION", "SRC_MAX_ERROR_RATE", "SRC_MAX_DROP_RATE", "DST_MAX_UTILIZATION", "DST_AVG_UTILIZATION", "DST_MAX_ERROR_RATE", "DST_MAX_DROP_RATE", "LINK_HEALTH_SCORE")
_add("ag2_link_health", TL, f"SELECT ID, SRC_CRITICAL_LINKS, SRC_WARNING_LINKS, SRC_LINK_COUNT, {_rounds(*_floats)} FROM health", _HEALTH)
_add("gr1_undirected_edges", TL, "SELECT a, b FROM edges", _EDGES)
_add("gr2_graph_features", NE + TL, "SELECT * REPLACE (round(CLUSTERING_COEF, 6) AS CLUSTERING_COEF) FROM graph", _GRAPH, True)
_add("gr3_group_betweenness", TL, """SELECT v AS node, round(coalesce(b, 0) / ((n - 1) * (n - 2)), 9) AS betweenness FROM nodes LEFT JOIN (
  SELECT x.v, sum(x.c * y.c / z.c) AS b FROM sig x JOIN sig y ON y.s = x.v JOIN sig z ON z.s = x.s AND z.v = y.v AND z.k = x.k + y.k WHERE x.k > 0 AND y.k > 0 GROUP BY x.v) USING (v), (SELECT count(*) AS n FROM nodes)""", _EDGES + """
pairs AS (SELECT DISTINCT least(a // 10, b // 10) AS a, greatest(a // 10, b // 10) AS b FROM edges WHERE a // 10 <> b // 10),
e AS MATERIALIZED (SELECT a, b FROM pairs UNION SELECT b, a FROM pairs), nodes AS (SELECT DISTINCT a AS v FROM e),
walks AS (SELECT v AS s, v, 0 AS k FROM nodes UNION SELECT s, e.b, k + 1 FROM walks JOIN e ON e.a = v WHERE k < 20),
far AS MATERIALIZED (SELECT s, v, min(k) AS k FROM walks GROUP BY ALL),
sig AS (SELECT v AS s, v, 0 AS k, 1::DOUBLE AS c FROM nodes
  UNION ALL SELECT sig.s, e.b, sig.k + 1, sum(c) FROM sig JOIN e ON e.a = sig.v JOIN far ON far.s = sig.s AND far.v = e.b AND far.k = sig.k + 1 GROUP BY sig.s, e.b, sig.k)""", True)
_add("gr4_clustering", TL, f"SELECT node, {_rounds('clustering')} FROM cluster", _EDGES + _CLUSTER)
_add("gr5_components", TL, "SELECT node, component, component_size FROM comp JOIN sizes USING (component)", _EDGES + _COMPONENTS, True)
_add("gr6_hierarchy_features", NE, f"SELECT ID, HIERARCHY_DEPTH, (PARENT_NE_ID_FK IS NULL)::INT AS IS_ROOT_NODE, {_COMPLETE} AS GEO_COMPLETENESS FROM network_elements JOIN depths USING (ID)", _DEPTH, True)
_add("gr7_entity_neighbours", NE + TL, "SELECT entity, neighbour FROM nb", _NEIGHBOURS)
_HOPS = """
h AS (SELECT grp, node, 0 AS hop FROM starts UNION ALL SELECT h.grp, other, hop + 1 FROM h JOIN both_ways USING (node) WHERE hop < 2),
hops AS (SELECT grp, node, min(hop) AS hop FROM h GROUP BY ALL),"""
_add("gr8_k_hop", NE + TL, 'SELECT grp AS "group", node, hop FROM hops', _EDGES + "starts AS (SELECT ID AS grp, ID AS node FROM network_elements)," + _HOPS, True)
_ADJ = _EDGES + """
adj AS (SELECT node, other FROM both_ways WHERE node IN (SELECT ID FROM network_elements) AND other IN (SELECT ID FROM network_elements) UNION ALL SELECT ID, ID FROM network_elements),
sc AS (SELECT node, power(count(*) + 1e-6, -0.5) AS s FROM adj GROUP BY node),
norm AS (SELECT adj.node AS i, adj.other AS j, x.s * y.s AS weight FROM adj JOIN sc x ON x.node = adj.node JOIN sc y ON y.node = adj.other),"""
_add("gr9_normalized_adjacency", NE + TL, f"SELECT i, j, {_rounds('weight')} FROM norm", _ADJ)
_add("gr10_propagate_features", NE + TL, f"SELECT ID, {_rounds('x', 'y')} FROM f2", _ADJ + """
f0 AS (SELECT ID, IS_VIRTUAL::DOUBLE AS x, (ID % 10)::DOUBLE AS y FROM network_elements),
f1 AS (SELECT i AS ID, sum(x * weight) AS x, sum(y * weight) AS y FROM norm JOIN f0 ON f0.ID = j GROUP BY i),
f2 AS (SELECT i AS ID, sum(x * weight) AS x, sum(y * weight) AS y FROM norm JOIN f1 ON f1.ID = j GROUP BY i)""")
_add("wn1_sessionize", AL, """SELECT alarm_id, (sum(CASE WHEN g IS NULL OR g > 1800000000 THEN 1 ELSE 0 END) OVER (ORDER BY alarm_time, alarm_id))::BIGINT AS session_id
  FROM (SELECT *, epoch_us(alarm_time) - epoch_us(lag(alarm_time) OVER (ORDER BY alarm_time, alarm_id)) AS g FROM alarms)""")
_add("wn1_sessionize_by_entity", AL, "SELECT alarm_id, session_id FROM sessions", _KEYED.format(source="alarms"))
_add("wn2_session_codes", AL, 'SELECT session_id, code, place, "first", "last" FROM codes', _CODES)
_add("jn9_propagation_pairs", AL, "SELECT session_id, a, b, round(delay, 6) AS delay FROM pairs", _PAIRS)
_add("ag6_propagation_rules", AL, """SELECT antecedent, consequent, count, round(support, 6) AS support, round(confidence, 6) AS confidence, round(m, 3) AS avg_delay_sec,
  round(s, 3) AS std_delay_sec, round(lo, 3) AS min_delay_sec, round(hi, 3) AS max_delay_sec, rank FROM rules""", _RULES)
ORACLES["ag6_incremental_rules"] = ORACLES["ml7_selective_retraining"] = ORACLES["ag6_propagation_rules"]
_predict = "SELECT alarm_id, coalesce(n, 0) AS n, coalesce(c, '') AS consequents FROM alarms LEFT JOIN (SELECT antecedent, count(*) AS n, string_agg(consequent, ',' ORDER BY rank) AS c FROM rules WHERE {} GROUP BY ALL) ON antecedent = alarm_code"
_add("jn7_predict_propagation", AL, _predict.format("rank <= 5"), _RULES)
_add("sc15_consequents_json", AL, """SELECT alarm_id, coalesce(to_json(c)::VARCHAR, '[]') AS propagation_alarms, coalesce(len(c), 0) AS propagation_count
  FROM alarms LEFT JOIN (SELECT antecedent, list(consequent ORDER BY rank) AS c FROM rules WHERE rank <= 5 GROUP BY ALL) ON antecedent = alarm_code""", _RULES)
_add("jn8_predict_propagation_confident", AL, _predict.format("confidence >= 0.12"), _RULES)
_day = "(PARTITION BY ne_id ORDER BY us RANGE BETWEEN {} PRECEDING AND CURRENT ROW)"
_near, _far, _last = _day.format(86_400_000_000 - 1), _day.format(7 * 86_400_000_000 - 1), "(PARTITION BY ne_id ORDER BY us ROWS BETWEEN 12 PRECEDING AND CURRENT ROW)"
_add("wn3_kpi_window_features", KPI, """SELECT ne_id, ts, round(coalesce(m, kpi_value), 6) AS kpi_mean, round(s, 6) AS kpi_std, round(coalesce(nullif(low, 0), kpi_value), 6) AS kpi_min, round(coalesce(nullif(high, 0), kpi_value), 6) AS kpi_max,
  round(trend, 6) AS kpi_trend, round(CASE WHEN m <> 0 THEN (kpi_value - m) / m WHEN m = 0 THEN 0.0 END, 6) AS kpi_pct_change_1h, round(CASE WHEN mf <> 0 THEN (kpi_value - mf) / mf ELSE 0.0 END, 6) AS kpi_pct_change_24h,
  round((kpi_value - m) / s, 6) AS kpi_z_score, (kpi_value > 80)::INT AS kpi_above_threshold, hour(ts)::INT AS hour_of_day, (isodow(ts) - 1)::INT AS day_of_week, (hour(ts) IN (9, 10, 11, 19, 20, 21))::INT AS is_peak_hour, is_anomaly FROM v""", f"""
k AS (SELECT *, epoch_us(ts) AS us FROM kpi_history), r AS (SELECT *, row_number() OVER (PARTITION BY ne_id ORDER BY us)::DOUBLE AS rn FROM k),
v AS (SELECT *, CASE WHEN count(*) OVER {_near} >= 3 THEN avg(kpi_value) OVER {_near} END AS m, greatest(coalesce(CASE WHEN count(*) OVER {_near} >= 3 THEN stddev_samp(kpi_value) OVER {_near} END, 1.0), 0.001) AS s,
  CASE WHEN count(*) OVER {_near} >= 3 THEN min(kpi_value) OVER {_near} END AS low, CASE WHEN count(*) OVER {_near} >= 3 THEN max(kpi_value) OVER {_near} END AS high,
  CASE WHEN count(*) OVER {_far} >= 3 THEN avg(kpi_value) OVER {_far} END AS mf, CASE WHEN count(*) OVER {_last} >= 3 THEN regr_slope(kpi_value, rn) OVER {_last} ELSE 0.0 END AS trend FROM r)""")
_add("in3_correlate", NE + TL + AL, "SELECT alarm_id, coalesce(least(root, alarm_id), alarm_id)::VARCHAR AS incident FROM alarms LEFT JOIN (SELECT node, min(root) AS root FROM closed GROUP BY node) ON node = alarm_id", _NEIGHBOURS + """
near AS (SELECT x.alarm_id AS a, y.alarm_id AS b FROM alarms x JOIN nb ON nb.entity = x.entity_id JOIN alarms y ON y.entity_id = nb.neighbour
  AND abs(epoch_us(x.alarm_time) - epoch_us(y.alarm_time)) <= 1800000000 AND x.alarm_id <> y.alarm_id),
closed AS (SELECT a AS root, a AS node FROM near UNION SELECT c.root, n.b FROM closed c JOIN near n ON n.a = c.node WHERE n.b > c.root)""", True)
_add("ag7_summarise_incidents", AL + LIB, "SELECT incident, start_time, end_time, ne_ids, array_to_string(seq, ',') AS alarm_sequence, alarm_count, dominant_root_cause FROM summary JOIN modal ON session_id = incident", _SUMMARY)
_add("ag7_sequence_parts", AL + LIB, "SELECT incident, part, min(alarm_time) AS start_time, max(alarm_time) AS end_time, string_agg(alarm_code, ',' ORDER BY rn) AS alarm_sequence FROM p GROUP BY ALL", _SUMMARY + """
q AS (SELECT session_id AS incident, alarm_time, alarm_code, row_number() OVER (PARTITION BY session_id ORDER BY alarm_time, alarm_id) AS rn FROM sessions),
p AS (SELECT *, ((rn - 1) // 4)::INT AS part FROM q)""")
_add("ag9_incident_report", AL + LIB, """SELECT incident, min(open_time) AS "from", max(open_time) AS "to", count(*) AS alarm_count, round(avg(confidence), 6) AS avg_confidence, max(confidence) AS max_confidence, count(DISTINCT entity_id) AS entities,
  floor((epoch_us(max(open_time)) - epoch_us(min(open_time))) / 60000000)::BIGINT AS duration_minutes, any_value(rc) AS root_cause_distribution, any_value(sv) AS severity_distribution, any_value(p) AS primary_root_cause
  FROM scored JOIN rcs USING (incident) JOIN svs USING (incident) GROUP BY incident""", _SCORED + """
rc AS (SELECT incident, predicted_root_cause AS v, count(*) AS n FROM scored GROUP BY ALL), rcs AS (SELECT incident, string_agg(v || '=' || n, ',' ORDER BY v) AS rc, arg_min(v, (-n, v)) AS p FROM rc GROUP BY ALL),
sv AS (SELECT incident, upper(severity) AS v, count(*) AS n FROM scored GROUP BY ALL), svs AS (SELECT incident, string_agg(v || '=' || n, ',' ORDER BY v) AS sv FROM sv GROUP BY ALL)""")
_add("ag10_global_summary", AL + LIB, """SELECT 'total_alarms' AS metric, '' AS item, count(*)::DOUBLE AS value FROM scored UNION ALL SELECT 'total_incidents', '', count(DISTINCT incident) FROM scored
UNION ALL SELECT 'avg_confidence', '', round(avg(confidence), 6) FROM scored UNION ALL SELECT 'root_cause', predicted_root_cause, count(*) FROM scored GROUP BY ALL UNION ALL SELECT 'severity', severity, count(*) FROM scored GROUP BY ALL
UNION ALL (SELECT 'top_entity', entity_id, count(*) FROM scored GROUP BY ALL ORDER BY count(*) DESC, entity_id LIMIT 20)""", _SCORED)
_add("ag11_top_causes", AL + LIB, "SELECT predicted_root_cause, count(*) AS n FROM scored GROUP BY ALL ORDER BY n DESC, predicted_root_cause LIMIT 10", _SCORED)
_TOP = "(SELECT incident, count(*) AS alarm_count FROM scored GROUP BY ALL ORDER BY alarm_count DESC, incident LIMIT {})"
_add("st2_top_incidents", AL + LIB, f"SELECT incident, alarm_count, printf('INC-%04d', row_number() OVER (ORDER BY alarm_count DESC, incident)) AS number FROM {_TOP.format(100)}", _SCORED)
_add("jn11_incident_ne_details", NE + AL + LIB, "SELECT DISTINCT incident, entity_id AS ne_id, NE_NAME AS ne_name, NE_TYPE AS ne_type, TECHNOLOGY AS technology, VENDOR AS vendor, DOMAIN AS domain FROM scored LEFT JOIN network_elements ON NE_ID = entity_id", _SCORED)
_add("jn13_at_risk_elements", NE + TL + AL + LIB, "SELECT grp AS incident, NE_ID AS ne_id, hop FROM hops JOIN network_elements ON ID = node WHERE hop > 0", _SCORED + _EDGES + f"""
starts AS (SELECT DISTINCT incident AS grp, ID AS node FROM scored JOIN network_elements ON NE_ID = entity_id WHERE incident IN (SELECT incident FROM {_TOP.format(100)})),""" + _HOPS, True)
_add("cp1_build_master_features", NE + HW + TL, f"""SELECT ID, {_ENC('NE_TYPE', 0)}, {_ENC('TECHNOLOGY', 0)}, {_ENC('VENDOR', 0)}, {_ENC('DOMAIN', 0)}, {_ENC('NE_STATUS', 0)}, NE_AGE_DAYS, WARRANTY_REMAINING_DAYS, WARRANTY_EXPIRED,
  {_CASES('TECHNOLOGY', el.GENERATIONS)} AS TECH_GENERATION, IS_VIRTUAL AS IS_VIRTUAL_NUM, 0 AS IS_SECURED_NUM, 0 AS BGP_STATUS_NUM, 0 AS OSPF_STATUS_NUM, 0 AS LLDP_STATUS_NUM, 0 AS PROTOCOL_HEALTH_SCORE,
  GRAPH_DEGREE, round(CLUSTERING_COEF, 6) AS CLUSTERING_COEF, COMPONENT_SIZE, IS_LEAF, IS_ISOLATED, TOPO_LAYER, HIERARCHY_DEPTH, (PARENT_NE_ID_FK IS NULL)::INT AS IS_ROOT_NODE, {_COMPLETE} AS GEO_COMPLETENESS,
  GEOGRAPHY_L1_ID_FK, GEOGRAPHY_L2_ID_FK, GEOGRAPHY_L3_ID_FK, GEOGRAPHY_L4_ID_FK, {', '.join(f'round(coalesce({c}, 0), 6) AS {c}' for c in _floats if c not in ('DST_AVG_UTILIZATION', 'DST_MAX_DROP_RATE'))},
  coalesce(SRC_CRITICAL_LINKS, 0) AS SRC_CRITICAL_LINKS, coalesce(SRC_WARNING_LINKS, 0) AS SRC_WARNING_LINKS FROM elements JOIN graph USING (ID) JOIN depths USING (ID) LEFT JOIN health USING (ID)""",
  _AGED + _GRAPH + _DEPTH.replace("network_elements", "elements") + _HEALTH, True)
_sum = lambda c: f"SELECT '{c}' AS feature, count({c}) AS known, round(min({c}), 6)::DOUBLE AS lowest, round(avg({c}), 6) AS mean, round(max({c}), 6)::DOUBLE AS highest FROM health"
_add("cp4_feature_summary", TL, " UNION ALL ".join(_sum(c) for c in ("SRC_MAX_UTILIZATION", "SRC_LINK_COUNT", "LINK_HEALTH_SCORE")), _HEALTH)
_add("jn5_training_set", NE + AL + LIB, "SELECT alarm_id, ID, VENDOR, root_cause FROM labelled JOIN network_elements ON NE_ID = entity_id", _LABELLED)
_add("jn6_enrich_alarms", NE + AL, "SELECT alarm_id, ID FROM alarms LEFT JOIN (SELECT * FROM network_elements WHERE IS_DELETED = 0) ON NE_ID = entity_id")
_add("jn12_node_labels", NE + AL + LIB, "SELECT ID, coalesce(label, 'UNKNOWN') AS label FROM network_elements LEFT JOIN (SELECT entity_id, arg_min(root_cause, (-n, root_cause)) AS label FROM (SELECT entity_id, root_cause, count(*) AS n FROM labelled GROUP BY ALL) GROUP BY ALL) ON entity_id = NE_ID", _LABELLED)
_add("sc11_build_vocab", AL, 'SELECT alarm_code AS code, (row_number() OVER (ORDER BY alarm_code) + 1)::INT AS "index" FROM (SELECT DISTINCT alarm_code FROM alarms)')
_add("sc12_encode_sequences", AL + LIB, """SELECT incident, array_to_string(list_concat(list_transform(range(0, greatest(0, 6 - len(seq))), lambda x: 0), list_transform(list_slice(seq, greatest(len(seq) - 5, 1), len(seq)), lambda c: coalesce(m[c], 1))), ',') AS indices FROM summary, vocab""", _SUMMARY + """
seen AS (SELECT DISTINCT unnest(seq) AS c FROM summary WHERE alarm_count > 3), vocab AS (SELECT map_from_entries(list((c, i))) AS m FROM (SELECT c, row_number() OVER (ORDER BY c) + 1 AS i FROM seen))""")
_add("sc14_standardize", NE, "SELECT ID, round((IS_VIRTUAL - (SELECT avg(IS_VIRTUAL) FROM network_elements)) / ((SELECT stddev_pop(IS_VIRTUAL) FROM network_elements) + 1e-6), 6) AS IS_VIRTUAL, round((coalesce(GEOGRAPHY_L3_ID_FK, 0) - (SELECT avg(coalesce(GEOGRAPHY_L3_ID_FK, 0)) FROM network_elements)) / ((SELECT stddev_pop(coalesce(GEOGRAPHY_L3_ID_FK, 0)) FROM network_elements) + 1e-6), 6) AS GEOGRAPHY_L3_ID_FK FROM network_elements")
_add("ag12_table_fingerprint", NE, "SELECT *, md5(n || ':' || key_sum || ':' || row_hash) AS fingerprint FROM s", "s AS (SELECT count(*) AS n, sum(ID)::BIGINT AS key_sum, sum(('0x' || substr(md5(ID || '|' || NE_ID || '|' || coalesce(TECHNOLOGY, '~')), 1, 10))::BIGINT)::BIGINT AS row_hash FROM network_elements)")
_add("ag12_changed_rows", NE, """SELECT ID::VARCHAR AS key, CASE WHEN ID % 50 = 1 THEN 'inserted' ELSE 'changed' END AS change FROM network_elements WHERE ID % 50 = 1 OR ID % 53 = 0
  UNION ALL SELECT (-ID)::VARCHAR, 'deleted' FROM network_elements WHERE ID % 61 = 0 AND ID > 0""")
_add("ag13_changes_since", AL, "SELECT count(*) AS new_alarms, count(*) > 100 AS retrain_needed FROM alarms WHERE alarm_time > TIMESTAMP '2024-01-25'")
_add("ag14_load_summary", NE + TL + AL, """SELECT 'elements' AS "table", count(*) AS n, 0 AS labelled FROM network_elements UNION ALL SELECT 'links', count(*), 0 FROM topology_links UNION ALL SELECT 'alarms', count(*), count(*) FROM alarms""")
_GUESS = _LABELLED + f"g AS (SELECT *, {_RAW} AS raw FROM labelled), guesses AS (SELECT *, CASE WHEN alarm_id % 3 > 0 THEN root_cause ELSE raw END AS guess FROM g),"
_add("ag15_classification_report", AL + LIB, """SELECT class, round(p, 6) AS precision, round(r, 6) AS recall, round(CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1, support, round((SELECT avg((root_cause = guess)::INT) FROM guesses), 6) AS accuracy FROM t""", _GUESS + """
classes AS (SELECT root_cause AS class FROM guesses UNION SELECT guess FROM guesses),
n AS (SELECT class, (SELECT count(*) FROM guesses WHERE root_cause = class) AS support, (SELECT count(*) FROM guesses WHERE guess = class) AS guessed, (SELECT count(*) FROM guesses WHERE root_cause = class AND guess = class) AS hits FROM classes),
t AS (SELECT class, support, CASE WHEN guessed > 0 THEN hits / guessed ELSE 0 END AS p, CASE WHEN support > 0 THEN hits / support ELSE 0 END AS r FROM n)""")
_add("ml6_accept_model", AL + LIB, "SELECT round(avg((root_cause = guess)::INT), 6) AS old_accuracy, round(avg((root_cause = raw)::INT), 6) AS new_accuracy, avg((root_cause = raw)::INT) >= avg((root_cause = guess)::INT) - 0.02 AS accepted FROM guesses", _GUESS)
# The sequential rules, a row after another: the state goes from row to row.
_ORDERED = _NEIGHBOURS + """
near AS (SELECT entity, list(DISTINCT neighbour) AS near FROM nb GROUP BY ALL),
o AS MATERIALIZED (SELECT alarm_id, entity_id, epoch_us(alarm_time) AS us, coalesce(near, [entity_id]) AS near, row_number() OVER (ORDER BY alarm_time, alarm_id) AS rn FROM alarms LEFT JOIN near ON entity = entity_id),"""
_add("in1_correlate_exact", NE + TL + AL, "SELECT alarm_id, first::VARCHAR AS incident FROM f", _ORDERED + """
f AS (SELECT rn, alarm_id, us, [entity_id] AS held, alarm_id AS first FROM o WHERE rn = 1
  UNION ALL SELECT o.rn, o.alarm_id, o.us, CASE WHEN o.us - f.us <= 1800000000 AND list_has_any(f.held, o.near) THEN list_distinct(f.held || o.near) ELSE [o.entity_id] END,
  CASE WHEN o.us - f.us <= 1800000000 AND list_has_any(f.held, o.near) THEN f.first ELSE o.alarm_id END FROM f JOIN o ON o.rn = f.rn + 1)""", True)
_SEEDED = _ORDERED + """
f AS (SELECT rn, alarm_id, alarm_id AS first, [{'id': alarm_id, 'us': us, 'near': list_append(near, entity_id)}] AS seeds FROM o WHERE rn = 1
  UNION ALL SELECT rn, alarm_id, coalesce(hit, alarm_id), CASE WHEN hit IS NULL THEN list_append(seeds, {'id': alarm_id, 'us': us, 'near': list_append(near, entity_id)}) ELSE seeds END
  FROM (SELECT *, list_filter(seeds, lambda s: list_contains(s.near, entity_id))[1].id AS hit
    FROM (SELECT o.*, list_filter(f.seeds, lambda s: o.us - s.us <= 1800000000) AS seeds FROM f JOIN o ON o.rn = f.rn + 1)))"""
_add("in2_correlate_seeded", NE + TL + AL, "SELECT alarm_id, first::VARCHAR AS incident FROM f", _SEEDED, True)
_add("snk5_write_report", NE + TL + AL + LIB, """SELECT number, alarm_count, p AS primary_root_cause, alarm_count AS alarms, (SELECT count(DISTINCT entity_id) FROM scored s WHERE s.incident = t.incident) AS affected_elements,
  (SELECT count(DISTINCT NE_ID) FROM hops JOIN network_elements ON ID = node WHERE hop > 0 AND grp = t.incident) AS at_risk,
  (SELECT count(*) FROM (SELECT DISTINCT incident, alarm_code FROM scored) c JOIN rules ON antecedent = c.alarm_code WHERE c.incident = t.incident) AS propagation, first_alarm, last_alarm
  FROM numbered t JOIN ends USING (incident) JOIN modes USING (incident)""", _SCORED + _EDGES + f"""
numbered AS (SELECT incident, alarm_count, printf('INC-%04d', row_number() OVER (ORDER BY alarm_count DESC, incident)) AS number FROM {_TOP.format(100)}),
ends AS (SELECT incident, arg_min(alarm_id, (open_time, alarm_id)) AS first_alarm, arg_max(alarm_id, (open_time, alarm_id)) AS last_alarm FROM scored GROUP BY ALL),
modes AS (SELECT incident, arg_min(v, (-n, v)) AS p FROM (SELECT incident, predicted_root_cause AS v, count(*) AS n FROM scored GROUP BY ALL) GROUP BY ALL),
starts AS (SELECT DISTINCT incident AS grp, ID AS node FROM scored JOIN network_elements ON NE_ID = entity_id WHERE incident IN (SELECT incident FROM numbered)),""" + _HOPS
  + _RULES.replace("gaps AS", "gaps2 AS").replace("FROM gaps)", "FROM gaps2)").replace("sessions AS", "sessions2 AS").replace("FROM sessions", "FROM sessions2"), True)
# Streams: what the watermark, ten minutes behind the last row, has closed.
_LATE = "(SELECT epoch_us(max({})) - 600000000 FROM {})"
_add("sm2_sessionize_stream", AL, f"""SELECT entity_id, min(alarm_time) AS start, max(alarm_time) AS "end", count(*) AS alarms, count(DISTINCT alarm_code) AS codes FROM s
  GROUP BY entity_id, n HAVING epoch_us(max(alarm_time)) + 43200000000 <= {_LATE.format('alarm_time', 'alarms')}""", """
g AS (SELECT *, epoch_us(alarm_time) - epoch_us(lag(alarm_time) OVER (PARTITION BY entity_id ORDER BY alarm_time)) AS g FROM alarms),
s AS (SELECT *, sum(CASE WHEN g < 43200000000 THEN 0 ELSE 1 END) OVER (PARTITION BY entity_id ORDER BY alarm_time ROWS UNBOUNDED PRECEDING) AS n FROM g)""")
_add("sm3_correlate_stream", NE + TL + AL, f"""SELECT alarm_id, entity_id, alarm_time, first::VARCHAR AS incident FROM f JOIN alarms USING (alarm_id)
  WHERE epoch_us(alarm_time) <= {_LATE.format('alarm_time', 'alarms')}""", _SEEDED, True)
_add("sm4_kpi_stream", KPI, f"""SELECT ne_id, make_timestamp(w) AS start, make_timestamp(w + 86400000000) AS "end", round(avg(kpi_value), 6) AS kpi_mean, round(coalesce(stddev_samp(kpi_value), 1.0), 6) AS kpi_std,
  round(min(kpi_value), 6) AS kpi_min, round(max(kpi_value), 6) AS kpi_max, count(*) AS points FROM w GROUP BY ne_id, w HAVING w + 86400000000 <= {_LATE.format('ts', 'kpi_history')}""", """
w AS (SELECT *, unnest([epoch_us(ts) // 43200000000 * 43200000000, epoch_us(ts) // 43200000000 * 43200000000 - 43200000000]) AS w FROM kpi_history)""")
_add("sm5_reload_rules", AL, """SELECT alarm_id, (SELECT count(*) FROM rules WHERE antecedent = alarm_code AND (alarm_time < TIMESTAMP '2024-01-15' OR confidence >= 0.12)) AS n,
  CASE WHEN alarm_time < TIMESTAMP '2024-01-15' THEN '1' ELSE '2' END AS version FROM alarms""", _RULES)
ORACLES["sm4_kpi_features_stream"] = f"SELECT * EXCLUDE (is_anomaly) FROM ({ORACLES['wn3_kpi_window_features']}) WHERE epoch_us(ts) <= (SELECT epoch_us(max(CAST(ts AS TIMESTAMP))) - 600000000 FROM events)"
