"""The registered queries on the fixture views."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import elements as el
from ..functions import labels as lb
from ..operators import boosting, changes, convolution, evaluate, features, graph, hashtree, incidents, kpi, links, models, report, retrain, rules, rulestate, sequences, sessions, store, suffixtree
from ..operators.shared import checkpoint_dir, cut, stored
from ..sources import loaders, schema, sinks
from ..streaming import kpifeatures, seeded, streams
from .fixtures import view

AS_OF = "2005-01-01"
GAP = 12 * 3600
SUPPORT, CONFIDENCE = 0.005, 0.10
QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def _folder(spark: SparkSession) -> str:
    return f"{checkpoint_dir(spark)}/{uuid.uuid4()}"


def _rounded(df: DataFrame, digits: int = 6) -> DataFrame:
    return df.select(*[F.round(c, digits).alias(c) if t == "double" else F.col(c) for c, t in df.dtypes])


# Sources and sinks


def _elements(s: SparkSession, d: str) -> DataFrame:
    return loaders.load_network_elements(view(s, d, "network_elements"), view(s, d, "hardware_details"), AS_OF)


@query
def src1_load_network_elements(s, d):
    names = ("ID", "NE_ID", "NE_AGE_DAYS", "WARRANTY_REMAINING_DAYS", "WARRANTY_EXPIRED", "NE_CATEGORY", "PROTOCOL_HEALTH_SCORE")
    return _elements(s, d).select(*names)


@query
def src2_load_topology_links(s, d):
    t = view(s, d, "topology_links")
    isis = t.where("link_type = 'isis'").withColumnsRenamed({"src": "SOURCE_NE_ID", "dst": "TARGET_NE_ID", "SOURCE_UTILIZATION": "UTIL"})
    bad = F.when(F.col("src") % 50 == 0, F.concat(F.lit("x"), F.col("src"))).otherwise(F.col("src").cast("string"))
    bgp = t.where("link_type = 'bgp'").select(bad.alias("SOURCE_NE_ID"), F.col("dst").alias("TARGET_NE_ID"))
    found = loaders.load_topology_links(
        [loaders.LinkSource("isis", isis, renames={"UTIL": "SOURCE_UTILIZATION"}), loaders.LinkSource("bgp", bgp), loaders.LinkSource("lldp", None)]
    )
    return found.select("src", "dst", "link_type", F.round("SOURCE_UTILIZATION", 6).alias("SOURCE_UTILIZATION"))


@query
def src3_load_alarm_library(s, d):
    marks = {"DELETED": F.col("alarm_code").endswith("_3").cast("int"), "ENABLED": (~F.col("alarm_code").endswith("_2")).cast("int")}
    return loaders.load_alarm_library(view(s, d, "alarm_library").withColumns(marks)).select("alarm_code", "alarm_identifier", "classification")


@query
def src4_read_table(s, d):
    return loaders.read_table(s, f"{d}/part.parquet", ["p_partkey", "p_name", "p_size"], "p_size > 20")


def _raw_alarms(s: SparkSession, d: str) -> DataFrame:
    """The alarms under the names of a source table."""
    names = {"alarm_time": "OPEN_TIME", "entity_id": "ENTITY_ID", "alarm_code": "ALARM_CODE", "severity": "severity", "probable_cause": "PROBABLE_CAUSE"}
    return view(s, d, "alarms").withColumnsRenamed(names)


@query
def src5_load_alarms(s, d):
    return loaders.load_alarms(_raw_alarms(s, d), "2024-01-15", keep=["alarm_id"]).select("alarm_id", "ne_id", "alarm_code", "severity", "timestamp", "root_cause")


@query
def src6_load_kpi_definitions(s, d):
    view(s, d, "kpi_history").groupBy("ne_id").agg(F.count("*").alias("n")).createOrReplaceTempView("gridpulse_kpi_counter")
    found = loaders.load_kpi_definitions(s, ("gridpulse_kpi_formula", "gridpulse_kpi_counter"))
    there = {n: df for n, df in found.items() if df is not None}
    return changes.load_summary(there).select("table", "n")


def _alarm_files(s: SparkSession, d: str) -> str:
    path = _folder(s)
    view(s, d, "alarms").repartition(4).write.parquet(path)
    return path


def _run(s: SparkSession, df: DataFrame) -> DataFrame:
    """What a stream writes until its input is used up."""
    out, state = _folder(s), _folder(s)
    df.writeStream.format("parquet").option("path", out).option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return s.read.schema(df.schema).parquet(out)


@query
def src7_stream_alarms(s, d):
    return _run(s, streams.stream_alarms(s, _alarm_files(s, d), files=1)).select("alarm_id", "alarm_time", "entity_id", "alarm_code")


def _scored(s: SparkSession, d: str) -> DataFrame:
    """Alarms with a predicted cause, a confidence and an incident that follow from the tables alone."""
    a = lb.label_alarms(view(s, d, "alarms"), view(s, d, "alarm_library"), min_raw_share=0.5)
    a = sessions.sessionize(a, GAP, ["entity_id"])
    return a.select(
        "alarm_id", F.col("alarm_time").alias("open_time"), "entity_id", "alarm_code", "severity",
        F.col("root_cause").alias("predicted_root_cause"), (F.col("alarm_id") % 100 / 100.0).alias("confidence"), F.col("session_id").alias("incident"),
    )


@query
def src8_read_results(s, d):
    path = _folder(s)
    extra = [F.lit("").alias("alarm_name"), F.lit(0).alias("propagation_count"), F.lit('[{"a": 1}]').alias("propagation_alarms")]
    names = [c.split()[0] for c in loaders.RESULT_SCHEMA.split(", ")]
    bad = F.when(F.col("alarm_id") % 10 == 0, "no time").otherwise(F.date_format("open_time", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    sinks.write_csv(_scored(s, d).select("*", *extra).withColumn("open_time", bad).select(*names), path)
    return loaders.read_results(s, path).select("alarm_id", "open_time", "entity_id", "predicted_root_cause", "confidence", "propagation_alarms")


@query
def snk1_write_table(s, d):
    path = _folder(s)
    sinks.write_table(view(s, d, "alarms"), path, "alarm_time")
    return s.read.parquet(path).groupBy(F.col("day").cast("string").alias("day")).agg(F.count("*").alias("n"))


@query
def snk2_write_csv(s, d):
    path = _folder(s)
    sinks.write_csv(view(s, d, "alarms").groupBy("severity").agg(F.count("*").alias("n")), path)
    return s.read.csv(path, header=True, schema="severity string, n long")


def _codes(s: SparkSession, d: str) -> DataFrame:
    return sessions.session_codes(sessions.sessionize(view(s, d, "alarms"), GAP, ["entity_id"]))


def _rules(s: SparkSession, d: str) -> DataFrame:
    return rules.propagation_rules(_codes(s, d), SUPPORT, CONFIDENCE)


@query
def snk3_nest_rules(s, d):
    nested = sinks.nest_rules(_rules(s, d))
    return nested.select("antecedent", F.size("rules").cast("long").alias("n"), F.array_join(F.transform("rules", lambda r: r["consequent"]), ",").alias("consequents"))


EXPORTED = ("GEOGRAPHY_L1_ID_FK", "IS_VIRTUAL", "GEOGRAPHY_L3_ID_FK", "TECHNOLOGY", "NO_SUCH_COLUMN", "ID")


@query
def snk4_export_entity_features(s, d):
    out = sinks.export_entity_features(view(s, d, "network_elements"), EXPORTED)
    return out.select("entity_id", F.array_join(F.col("features").cast("array<bigint>"), ",").alias("features"))


@query
def snk5_write_report(s, d):
    path = _folder(s)
    ne = view(s, d, "network_elements")
    rows = report.write_report(_scored(s, d), _rules(s, d), ne, ne, view(s, d, "topology_links"), 100)
    sinks.write_json(rows, path)
    found = s.read.schema(rows.schema).json(path)  # JSON leaves out nulls, so a column may be in no row
    sizes = [F.coalesce(F.size(c), F.lit(0)).cast("long").alias(c) for c in ("alarms", "affected_elements", "at_risk", "propagation")]
    first, last = F.get("alarms", F.lit(0))["alarm_id"], F.element_at("alarms", -1)["alarm_id"]
    return found.select("number", "alarm_count", "primary_root_cause", *sizes, first.alias("first_alarm"), last.alias("last_alarm"))


# Schema, filters, labels, scalar functions


@query
def prj1_resolve_columns(s, d):
    return schema.resolve_columns(_raw_alarms(s, d), keep=["alarm_id"]).select("alarm_id", "ne_id", "alarm_code", "severity", "root_cause", "status", "domain")


@query
def prj3_ensure_columns(s, d):
    df = schema.ensure_columns(view(s, d, "network_elements"), {"ADMIN_STATE": F.lit(None).cast("string"), "CATEGORY": F.lit("NONE"), "VENDOR": F.lit("?")})
    return df.select("ID", "ADMIN_STATE", "CATEGORY", "VENDOR")


@query
def flt1_active_only(s, d):
    return schema.active_only(view(s, d, "network_elements")).select("ID", "NE_ID")


@query
def flt5_label_alarms(s, d):
    return lb.label_alarms(view(s, d, "alarms"), view(s, d, "alarm_library"), 0.1).select("alarm_id", "root_cause")


@query
def jn2_label_alarms(s, d):
    return lb.label_alarms(view(s, d, "alarms"), view(s, d, "alarm_library"), 0.5).select("alarm_id", "root_cause")


VALID = ("POWER_ISSUE", "BACKHAUL_ISSUE", "LINK_CONGESTION", "PACKET_LOSS")


@query
def sc1_library_root_cause(s, d):
    label = lb.library_root_cause(F.col("alarm_identifier"), F.col("classification"))
    known = lb.library_root_cause(F.col("alarm_identifier"), F.col("classification"), VALID)
    return view(s, d, "alarm_library").select("alarm_code", label.alias("label"), known.alias("valid_label"))


@query
def sc2_raw_root_cause(s, d):
    return view(s, d, "alarms").select("alarm_id", lb.raw_root_cause(F.col("probable_cause")).alias("label"))


@query
def sc4_protocol_health(s, d):
    status = lambda k: F.get(F.array(F.lit("UP"), F.lit("DOWN"), F.lit("YET_TO_START"), F.lit(None).cast("string")), (F.col("ID") + k) % 4)
    return view(s, d, "network_elements").select("ID", el.protocol_health(status(0), status(1), status(5)).alias("health"))


@query
def sc5_tech_generation(s, d):
    return view(s, d, "network_elements").select("ID", el.tech_generation(F.col("TECHNOLOGY")).alias("generation"))


@query
def sc6_encode_categoricals(s, d):
    df = el.static_features(view(s, d, "network_elements"))
    return df.select("ID", "NE_TYPE_ENC", "TECHNOLOGY_ENC", "VENDOR_ENC", "CATEGORY_ENC", "IS_VIRTUAL_NUM", "IS_SECURED_NUM", "HAS_PARENT")


# Links and graph


@query
def ag2_link_health(s, d):
    return _rounded(links.link_health(view(s, d, "topology_links")))


def _edges(s: SparkSession, d: str) -> DataFrame:
    return cut(graph.undirected_edges(view(s, d, "topology_links")))


@query
def gr1_undirected_edges(s, d):
    return graph.undirected_edges(view(s, d, "topology_links"))


@query
def gr2_graph_features(s, d):
    return _rounded(graph.graph_features(view(s, d, "network_elements"), view(s, d, "topology_links")))


@query
def gr3_betweenness(s, d):
    return _rounded(graph.betweenness(_edges(s, d), k=500), 9)


@query
def gr3_group_betweenness(s, d):
    """Betweenness, from all nodes, of the graph of parent groups: two are linked if any of their elements are."""
    group = lambda c: F.floor(F.col(c) / 10)
    pairs = _edges(s, d).select(F.least(group("a"), group("b")).alias("a"), F.greatest(group("a"), group("b")).alias("b")).where("a < b").distinct()
    return _rounded(graph.betweenness(pairs, k=1_000_000), 9)


@query
def gr4_clustering(s, d):
    return _rounded(graph.clustering(_edges(s, d)))


@query
def gr5_components(s, d):
    return graph.component_sizes(_edges(s, d))


@query
def gr6_hierarchy_features(s, d):
    return graph.hierarchy_features(view(s, d, "network_elements")).select("ID", "HIERARCHY_DEPTH", "IS_ROOT_NODE", "GEO_COMPLETENESS")


def _neighbours(s: SparkSession, d: str) -> DataFrame:
    return graph.entity_neighbours(view(s, d, "network_elements"), view(s, d, "topology_links"))


@query
def gr7_entity_neighbours(s, d):
    return _neighbours(s, d)


@query
def gr8_k_hop(s, d):
    starts = view(s, d, "network_elements").select(F.col("ID").alias("group"), F.col("ID").alias("node"))
    return graph.k_hop(starts, _edges(s, d), 2)


@query
def gr9_normalized_adjacency(s, d):
    return _rounded(graph.normalized_adjacency(view(s, d, "network_elements").select("ID"), _edges(s, d)))


@query
def gr10_propagate_features(s, d):
    ne = view(s, d, "network_elements").select("ID", F.col("IS_VIRTUAL").cast("double").alias("x"), (F.col("ID") % 10).cast("double").alias("y"))
    return _rounded(graph.propagate_features(ne, graph.normalized_adjacency(ne, _edges(s, d)), ["x", "y"], 2))


# Sessions and rules


@query
def wn1_sessionize(s, d):
    df = sessions.sessionize(view(s, d, "alarms"), 1800)
    return df.select("alarm_id", F.col("session_id").cast("long").alias("session_id"))


@query
def wn1_sessionize_by_entity(s, d):
    return sessions.sessionize(view(s, d, "alarms"), GAP, ["entity_id"]).select("alarm_id", "session_id")


@query
def wn2_session_codes(s, d):
    return _codes(s, d)


@query
def jn9_propagation_pairs(s, d):
    return _rounded(rules.propagation_pairs(_codes(s, d)))


@query
def ag6_propagation_rules(s, d):
    delays = ("avg_delay_sec", "std_delay_sec", "min_delay_sec", "max_delay_sec")
    return _rounded(_rules(s, d).withColumns({c: F.round(c, 3) for c in delays}))


@query
def ag6_incremental_rules(s, d):
    """The same rules after a start with some alarms, in order of neither time nor id, and an update with the others."""
    a = view(s, d, "alarms")
    state = rulestate.start(a.where("alarm_id % 3 <> 0 AND alarm_time < '2024-01-20'"), GAP)
    state.save(path := _folder(s))
    state, _ = rulestate.update(rulestate.RuleState.load(s, path, GAP), a)
    delays = ("avg_delay_sec", "std_delay_sec", "min_delay_sec", "max_delay_sec")
    return _rounded(rulestate.rules(state, SUPPORT, CONFIDENCE).withColumns({c: F.round(c, 3) for c in delays}))


def _predicted(s: SparkSession, d: str, k: int | None, least: float) -> DataFrame:
    df = rules.predict_propagation(view(s, d, "alarms"), _rules(s, d), k, least)
    codes = F.array_join(F.transform(F.coalesce("propagation", F.array()), lambda x: x["consequent"]), ",")
    return df.select("alarm_id", F.col("propagation_count").cast("long").alias("n"), codes.alias("consequents"))


@query
def jn7_predict_propagation(s, d):
    return _predicted(s, d, 5, 0.0)


@query
def sc15_consequents_json(s, d):
    """The expected consequents of each alarm as a JSON array."""
    df = rules.predict_propagation(view(s, d, "alarms"), _rules(s, d), 5)
    names = F.transform(F.coalesce("propagation", F.array()), lambda x: x["consequent"])
    return df.select("alarm_id", F.to_json(names).alias("propagation_alarms"), F.json_array_length(F.to_json(names)).cast("long").alias("propagation_count"))


@query
def jn8_predict_propagation_confident(s, d):
    return _predicted(s, d, None, 0.12)


# KPI series


@query
def wn3_kpi_window_features(s, d):
    return _rounded(kpi.kpi_window_features(view(s, d, "kpi_history"), 80.0, 86_400, 7 * 86_400))


# Incidents and reports


def _labelled(s: SparkSession, d: str) -> DataFrame:
    return lb.label_alarms(view(s, d, "alarms"), view(s, d, "alarm_library"), 0.5)


@query
def in3_correlate(s, d):
    return incidents.correlate(view(s, d, "alarms"), _neighbours(s, d))


@query
def in2_correlate_seeded(s, d):
    return incidents.correlate(view(s, d, "alarms"), _neighbours(s, d), mode="seeded")


@query
def in1_correlate_exact(s, d):
    return incidents.correlate(view(s, d, "alarms"), _neighbours(s, d), mode="exact")


def _summaries(s: SparkSession, d: str) -> DataFrame:
    a = sessions.sessionize(_labelled(s, d), GAP, ["entity_id"])
    return incidents.summarise_incidents(a, a.select("alarm_id", F.col("session_id").alias("incident")))


@query
def ag7_summarise_incidents(s, d):
    return _summaries(s, d).withColumns({"ne_ids": F.array_join("ne_ids", ","), "alarm_sequence": F.array_join("alarm_sequence", ",")})


@query
def ag7_sequence_parts(s, d):
    """The codes of incidents in parts of four."""
    a = sessions.sessionize(_labelled(s, d), GAP, ["entity_id"])
    parts = incidents.sequence_parts(a.drop("session_id"), a.select("alarm_id", F.col("session_id").alias("incident")), 4)
    return parts.withColumn("alarm_sequence", F.array_join("alarm_sequence", ","))


@query
def ag9_incident_report(s, d):
    text = lambda c: F.array_join(F.transform(F.map_entries(c), lambda e: F.concat_ws("=", e["key"], e["value"])), ",")
    df = report.incident_report(_scored(s, d))
    return _rounded(df.withColumns({c: text(c) for c in ("root_cause_distribution", "severity_distribution")}))


@query
def ag10_global_summary(s, d):
    return _rounded(report.global_summary(_scored(s, d)))


@query
def ag11_top_causes(s, d):
    return report.top_causes(_scored(s, d))


@query
def st2_top_incidents(s, d):
    return report.top_incidents(_scored(s, d), 100)


@query
def jn11_incident_ne_details(s, d):
    return report.incident_ne_details(_scored(s, d), view(s, d, "network_elements"))


@query
def jn13_at_risk_elements(s, d):
    some = _scored(s, d).join(report.top_incidents(_scored(s, d), 100).select("incident"), "incident", "left_semi")
    return report.at_risk_elements(some, view(s, d, "network_elements"), view(s, d, "topology_links"))


# Features


def _master(s: SparkSession, d: str) -> DataFrame:
    return features.build_master_features(_elements(s, d), view(s, d, "topology_links"))


@query
def cp1_build_master_features(s, d):
    names = [c for c in features.FEATURES if c not in ("BETWEENNESS", "AZIMUTH", "ELECTRICAL_TILT", "MECHANICAL_TILT", "OPERATIONAL_STATE_ENC", "CATEGORY_ENC", "NE_STAGE_ENC", "ADMIN_STATE_ENC")]
    return _rounded(_master(s, d).select("ID", *names))


@query
def cp4_feature_summary(s, d):
    return _rounded(features.feature_summary(links.link_health(view(s, d, "topology_links")), ["SRC_MAX_UTILIZATION", "SRC_LINK_COUNT", "LINK_HEALTH_SCORE"]))


@query
def jn5_training_set(s, d):
    return features.training_set(_labelled(s, d), view(s, d, "network_elements")).select("alarm_id", "ID", "VENDOR", "root_cause")


@query
def jn6_enrich_alarms(s, d):
    ne = schema.active_only(view(s, d, "network_elements"))
    found, lost = features.enrich_alarms(view(s, d, "alarms"), ne)
    return found.select("alarm_id", "ID").union(lost.select("alarm_id", F.lit(None).cast("long")))


@query
def jn12_node_labels(s, d):
    return features.node_labels(_labelled(s, d), view(s, d, "network_elements"))


@query
def sc11_build_vocab(s, d):
    return sequences.build_vocab(_summaries(s, d))


@query
def sc12_encode_sequences(s, d):
    some = _summaries(s, d)
    out = sequences.encode_sequences(some, sequences.build_vocab(some.where("alarm_count > 3")), 6)
    return out.select("incident", F.array_join("indices", ",").alias("indices"))


@query
def sc13_assemble(s, d):
    out = features.assemble(view(s, d, "network_elements"), EXPORTED)
    return out.select("ID", F.array_join(F.col("features").cast("array<bigint>"), ",").alias("features"))


@query
def sc14_standardize(s, d):
    return _rounded(features.standardize(view(s, d, "network_elements").select("ID", "IS_VIRTUAL", "GEOGRAPHY_L3_ID_FK"), ["IS_VIRTUAL", "GEOGRAPHY_L3_ID_FK"]))


# Changes and evaluation


@query
def ag12_table_fingerprint(s, d):
    return changes.table_fingerprint(view(s, d, "network_elements").select("ID", "NE_ID", "TECHNOLOGY"), "ID")


@query
def ag12_changed_rows(s, d):
    """Elements that were added, removed or changed since a former state of the table was hashed."""
    now = view(s, d, "network_elements").select("ID", "NE_ID", "TECHNOLOGY")
    before = now.where("ID % 50 <> 1").withColumn("TECHNOLOGY", F.when(F.col("ID") % 53 == 0, "OLD").otherwise(F.col("TECHNOLOGY")))
    gone = now.where("ID % 61 = 0").selectExpr("-ID AS ID", "NE_ID", "TECHNOLOGY")
    path = _folder(s)
    hashtree.save(hashtree.row_hashes(before.union(gone.where("ID < 0")), "ID"), path)
    return hashtree.changes_since(s, path, now, "ID")


@query
def ag13_changes_since(s, d):
    return changes.changes_since(view(s, d, "alarms"), "2024-01-25")


@query
def ag14_load_summary(s, d):
    return changes.load_summary({"elements": view(s, d, "network_elements"), "links": view(s, d, "topology_links"), "alarms": _labelled(s, d)})


def _guesses(s: SparkSession, d: str) -> DataFrame:
    """Two labels of each alarm and a third that is often the first."""
    a = _labelled(s, d).withColumn("raw", lb.raw_root_cause(F.col("probable_cause")))
    return a.withColumn("guess", F.when(F.col("alarm_id") % 3 > 0, F.col("root_cause")).otherwise(F.col("raw")))


@query
def ag15_classification_report(s, d):
    return _rounded(evaluate.classification_report(_guesses(s, d), "root_cause", "guess"))


@query
def ml6_accept_model(s, d):
    return _rounded(evaluate.accept_model(_guesses(s, d), "root_cause", "guess", "raw"))


# Models

PIVOTS = 500


def _declared(s: SparkSession, d: str) -> DataFrame:
    """All declared features of every element."""
    return stored(features.build_master_features(_elements(s, d), view(s, d, "topology_links"), PIVOTS))


#: Training rows to a task, about.
ROWS = 100_000


def _training(s: SparkSession, d: str) -> tuple[DataFrame, DataFrame]:
    """The master features and the labelled alarms with the model's features, split. The alarms of one small file would come
    as one task, and each level of each tree with them; they are dealt to as many tasks as run at once, or more."""
    master = _declared(s, d)
    known = [c for c in features.FEATURES if c in master.columns]
    labelled = _labelled(s, d)
    rows = models.stratified_split(features.training_set(labelled, master.select("NE_ID", *known)), "root_cause", "alarm_id")
    tasks = max(s.sparkContext.defaultParallelism, view(s, d, "alarms").count() // ROWS)
    return master, stored(rows.repartition(tasks, "alarm_id").sortWithinPartitions("alarm_id"))


def _model(s: SparkSession, d: str) -> tuple[models.RootCauseModel, DataFrame]:
    rows = _training(s, d)[1]
    return models.RootCauseModel(features.FEATURES, trees=300, depth=8).fit(rows.where("train")), rows


@query
def ml1_root_cause_model(s, d):
    model, rows = _model(s, d)
    return evaluate.classification_report(model.score(rows.where("not train")), "root_cause", "predicted_root_cause")


@query
def ml1_boosted_causes(s, d):
    """Boosted trees on the training rows, rated on the others."""
    rows = _training(s, d)[1]
    model = boosting.BoostedTrees(features.FEATURES, rounds=12, depth=4).fit(rows.where("train"))
    return evaluate.classification_report(model.score(rows.where("not train")), "root_cause", "predicted_root_cause")


@query
def ml2_score_alarms(s, d):
    model, rows = _model(s, d)
    return models.score_alarms(rows, model, _rules(s, d))


KPI_COLUMNS = ("kpi_mean", "kpi_std", "kpi_min", "kpi_max", "kpi_trend", "kpi_pct_change_24h", "hour_of_day")


@query
def ml3_isolation_forest(s, d):
    df = cut(kpi.kpi_window_features(view(s, d, "kpi_history"), 80.0, 86_400, 7 * 86_400))
    rate = df.agg(F.avg("is_anomaly")).first()[0] or 0.0
    forest = models.IsolationForest(KPI_COLUMNS, trees=200).fit(df, min(0.1, rate + 0.02))
    return forest.score(df).select("ne_id", "ts", "anomaly_score", "anomaly", "is_anomaly")


@query
def ml4_topology_cause_model(s, d):
    return models.TopologyCauseModel(features.FEATURES).fit_score(_declared(s, d), view(s, d, "topology_links"), _labelled(s, d))


@query
def ml4_graph_convolution(s, d):
    """Causes of all elements by a convolution trained on those with alarms."""
    model = convolution.GraphConvolution(features.FEATURES, hidden=16, epochs=25)
    return model.fit_score(_declared(s, d), view(s, d, "topology_links"), _labelled(s, d))


@query
def ml5_sequence_cause_model(s, d):
    rows = cut(models.stratified_split(_summaries(s, d), "dominant_root_cause", "incident"))
    scored = models.SequenceCauseModel().fit(rows.where("train")).score(rows.where("not train"))
    return evaluate.classification_report(scored, "dominant_root_cause", "predicted_root_cause")


@query
def ml5_suffix_trees(s, d):
    """Causes from the order of codes, rated on sequences that the trees haven't seen."""
    rows = cut(models.stratified_split(_summaries(s, d), "dominant_root_cause", "incident"))
    scored = suffixtree.SuffixTrees().fit(rows.where("train")).score(rows.where("not train"))
    return evaluate.classification_report(scored, "dominant_root_cause", "predicted_root_cause")


@query
def ml7_incremental_run(s, d):
    ne, t, a = view(s, d, "network_elements"), view(s, d, "topology_links"), view(s, d, "alarms")
    out = _folder(s)
    jobs = dict(
        on_topology=lambda: links.link_health(t).write.mode("overwrite").parquet(f"{out}/health"),
        on_alarms=lambda: _rules(s, d).write.mode("overwrite").parquet(f"{out}/rules"),
    )
    state, first = changes.incremental_run(ne, t, a.where("alarm_time < '2024-01-20'"), changes.State(), **jobs)
    _, second = changes.incremental_run(ne, t, a, state, **jobs)
    rule_rows = s.read.parquet(f"{out}/rules").agg(F.count("*").alias("rules"))
    return rule_rows.select(F.lit(",".join(first)).alias("first"), F.lit(",".join(second)).alias("second"), "rules")


@query
def ml7_selective_retraining(s, d):
    """The rules in the store after two runs: one with the alarms of the first weeks, one with all of them."""
    ne, t, a = _elements(s, d), view(s, d, "topology_links"), cut(_labelled(s, d))
    kept = store.ModelStore(s, _folder(s))
    columns = ["GRAPH_DEGREE", "COMPONENT_SIZE", "TOPO_LAYER", "LINK_HEALTH_SCORE", "VENDOR_ENC", "TECHNOLOGY_ENC"]
    fit = lambda df: boosting.BoostedTrees(columns, rounds=2, depth=3).fit(df)
    job = retrain.Retraining(kept, columns, fit, lambda path: boosting.BoostedTrees.load(s, path), GAP, 100, SUPPORT, CONFIDENCE)
    job.run(ne, t, a.where("alarm_time < '2024-01-20'"))
    job.run(ne, t, a)
    delays = ("avg_delay_sec", "std_delay_sec", "min_delay_sec", "max_delay_sec")
    return _rounded(s.read.parquet(kept.current("rules")["path"]).withColumns({c: F.round(c, 3) for c in delays}))


# Streams


@query
def sm1_score_stream(s, d):
    """Every alarm with the features of its element, a cause by a model, and its expected consequents."""
    master, rows = _training(s, d)
    score = streams.scorer(master, models.RootCauseModel(features.FEATURES, trees=300, depth=8).fit(rows.where("train")), cut(_rules(s, d)))
    out, state = _folder(s), _folder(s)
    stream = streams.stream_alarms(s, _alarm_files(s, d), files=1)
    writer = streams.score_stream(stream, lambda: score, streams.batch_sink(out))
    writer.option("checkpointLocation", state).trigger(availableNow=True).start().awaitTermination()
    return s.read.parquet(out).select("alarm_id", "entity_id", "predicted_root_cause", F.round("confidence", 6).alias("confidence"), F.col("propagation_count").cast("long").alias("propagation_count"))


@query
def sm5_reload_rules(s, d):
    """A second version of the rules is published while the stream runs: from the second batch on only confident ones count."""
    found, kept = cut(_rules(s, d)), store.ModelStore(s, _folder(s))
    kept.publish("rules", lambda path: found.write.parquet(path))

    def load(version: str):
        entry = kept.current("rules")
        known = s.read.parquet(entry["path"])
        return lambda batch: rules.predict_propagation(batch, known, None).withColumn("version", F.lit(str(entry["version"])))

    out, state = _folder(s), _folder(s)
    sink = streams.batch_sink(out)

    def then_publish(df: DataFrame, number: int) -> None:
        sink(df, number)
        if number == 0:
            kept.publish("rules", lambda path: found.where("confidence >= 0.12").write.parquet(path))

    path = _folder(s)
    for half in ("alarm_time < '2024-01-15'", "alarm_time >= '2024-01-15'"):  # a batch each, in this order
        view(s, d, "alarms").where(half).coalesce(1).write.mode("append").parquet(path)
    stream = streams.stream_alarms(s, path, files=1)
    writer = streams.score_stream(stream, streams.Versioned(kept.version, load), then_publish).option("checkpointLocation", state)
    writer.trigger(availableNow=True).start().awaitTermination()
    return s.read.parquet(out).select("alarm_id", F.col("propagation_count").cast("long").alias("n"), "version")


@query
def sm2_sessionize_stream(s, d):
    return _run(s, streams.sessionize_stream(streams.stream_alarms(s, _alarm_files(s, d)), "12 hours"))


def _run_stateful(s: SparkSession, df: DataFrame) -> DataFrame:
    """`_run` with the state store that keyed state needs."""
    name = "spark.sql.streaming.stateStore.providerClass"
    before = s.conf.get(name)
    s.conf.set(name, seeded.ROCKSDB)
    try:
        return _run(s, df)
    finally:
        s.conf.set(name, before)


@query
def sm3_correlate_stream(s, d):
    """The seeded incidents of the alarms that the watermark has passed."""
    found = _run_stateful(s, seeded.correlate_stream(streams.stream_alarms(s, _alarm_files(s, d)), _neighbours(s, d)))
    return found.select("alarm_id", "entity_id", "alarm_time", "incident")


def _measurements(s: SparkSession, d: str) -> DataFrame:
    path = _folder(s)
    view(s, d, "kpi_history").write.parquet(path)
    return s.readStream.schema("ne_id long, ts timestamp, kpi_value double, is_anomaly int").parquet(path)


def _kpi_stream(s: SparkSession, d: str) -> DataFrame:
    return streams.kpi_stream(_measurements(s, d), "1 day", "12 hours")


@query
def sm4_kpi_features_stream(s, d):
    """The features of wn3 for the measurements that the watermark has passed."""
    return _rounded(_run_stateful(s, kpifeatures.kpi_feature_stream(_measurements(s, d), 80.0, 86_400, 7 * 86_400)))


@query
def sm4_kpi_stream(s, d):
    return _rounded(_run(s, _kpi_stream(s, d)))


@query
def sm4_score_kpi_stream(s, d):
    """The same windows with an anomaly flag, by a forest of the windows before a date."""
    past = cut(streams.kpi_windows(view(s, d, "kpi_history").where("ts < '2024-01-20'"), "1 day", "12 hours"))
    forest = models.IsolationForest(["kpi_mean", "kpi_std", "kpi_min", "kpi_max"], trees=200).fit(past, 0.1)
    return _run(s, streams.score_kpi_stream(_kpi_stream(s, d), forest)).select("ne_id", "start", "end", "anomaly_score", "anomaly")
