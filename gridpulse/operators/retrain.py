"""Selective retraining: what has changed since the last run decides what is computed, and a gate what is published.

All that a run leaves is in a model store, so a run that breaks off leaves the last one's: the hash trees of elements and
links, the graph features, the classifier (``cause``), the state of the rules and the rules. Changed elements and links
are named by the trees; graph features are recomputed for their components alone, the classifier is fitted again and
published unless it is worse on held-out alarms. More than ``threshold`` new alarms update the rules by the sessions that
they touch.

Edge cases: the first run computes all; a run without changes publishes nothing; alarms without a label aren't trained on;
without links, elements or labelled alarms there is no classifier; fewer new alarms than the threshold wait for the next
run.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import hashtree, rulestate
from .features import build_master_features, training_set
from .graph import graph_features
from .models import stratified_split
from .shared import cut
from .store import ModelStore, gated


@dataclass
class Report:
    """changed: rows of elements and links that differ (None: the first run). recomputed: elements whose graph features were
    computed. new_alarms: since the last update of the rules. published and refused: names."""

    changed: int | None = None
    recomputed: int = 0
    new_alarms: int = 0
    published: list[str] = field(default_factory=list)
    refused: list[str] = field(default_factory=list)


class Retraining:
    def __init__(self, store: ModelStore, columns: Sequence[str], fit: Callable[[DataFrame], object], load: Callable[[str], object], gap: int = 1800, threshold: int = 100, min_support: float = 0.01, min_confidence: float = 0.3):
        self.store, self.columns, self.fit, self.load = store, list(columns), fit, load
        self.gap, self.threshold, self.least = gap, threshold, (min_support, min_confidence)

    def _changes(self, name: str, df: DataFrame, key: str) -> DataFrame | None:
        known = self.store.current(name)
        return cut(hashtree.changes_since(self.store.spark, known["path"], df, key)) if known else None

    def _publish(self, report: Report, name: str, write: Callable[[str], None]) -> None:
        self.store.publish(name, write)
        report.published.append(name)

    def run(self, elements: DataFrame, links: DataFrame, alarms: DataFrame) -> Report:
        """elements: ID, NE_ID and what features are made of; links: src, dst and measurements; alarms: labelled."""
        report = Report()
        self._topology(report, elements, links, alarms)
        self._rules(report, alarms)
        return report

    def _topology(self, report: Report, elements: DataFrame, links: DataFrame, alarms: DataFrame) -> None:
        spark = self.store.spark
        named = links.withColumn("link", F.concat_ws("-", F.col("src").cast("long"), F.col("dst").cast("long")))
        changed = [self._changes("elements", elements, "ID"), self._changes("links", named, "link")]
        known = self.store.current("graph")
        if None in changed or not known:
            graph = graph_features(elements, links)
            report.recomputed = elements.count()
        else:
            report.changed = changed[0].count() + changed[1].count()
            if not report.changed:
                return
            ends = changed[1].select(F.explode(F.split("key", "-")).alias("key"))
            nodes = cut(changed[0].select("key").union(ends).select(F.col("key").try_cast("bigint").alias("node")).where("node IS NOT NULL").distinct())
            touched = hashtree.touched_elements(nodes, links)
            some = touched.withColumnRenamed("node", "ID")
            part = elements.join(some, "ID", "left_semi")
            report.recomputed = part.count()
            around = links.withColumn("ID", F.col("src").cast("long")).join(some, "ID", "left_semi").drop("ID")
            old = spark.read.parquet(known["path"]).join(some, "ID", "left_anti").join(elements.select("ID"), "ID", "left_semi")
            graph = old.unionByName(graph_features(part, around))
        graph = cut(graph)
        self._classifier(report, build_master_features(elements, links, graph=graph), alarms)
        self._publish(report, "graph", lambda path: graph.write.parquet(path))
        self._publish(report, "elements", lambda path: hashtree.save(hashtree.row_hashes(elements, "ID"), path))
        self._publish(report, "links", lambda path: hashtree.save(hashtree.row_hashes(named, "link"), path))

    def _classifier(self, report: Report, master: DataFrame, alarms: DataFrame) -> None:
        some = master.select("ID", "NE_ID", *[c for c in self.columns if c in master.columns and c not in ("ID", "NE_ID")])
        own = ["alarm_id", "entity_id", "root_cause"]
        rows = training_set(alarms.select(*own, *[c for c in self.columns if c in alarms.columns and c not in own]), some)
        kept = [c for c in self.columns if c in rows.columns and c not in ("alarm_id", "root_cause")]
        rows = cut(stratified_split(rows.select("alarm_id", "root_cause", *kept), "root_cause", "alarm_id"))
        train, held = rows.where("train"), rows.where("not train")
        if train.isEmpty() or held.isEmpty():
            return
        entry = gated(self.store, "cause", held, "root_cause", self.fit(train), self.load)
        (report.published if entry["accepted"] else report.refused).append("cause")

    def _rules(self, report: Report, alarms: DataFrame) -> None:
        known = self.store.current("rule_state")
        if known:
            state = rulestate.RuleState.load(self.store.spark, known["path"], self.gap)
            new = cut(alarms.join(state.sessions.select("alarm_id"), "alarm_id", "left_anti"))
            report.new_alarms = new.count()
            if report.new_alarms <= self.threshold:
                return
            state, _ = rulestate.update(state, new)
        else:
            state = rulestate.start(alarms, self.gap)
            report.new_alarms = state.sessions.count()
        self._publish(report, "rules", lambda path: rulestate.rules(state, *self.least).write.parquet(path))
        self._publish(report, "rule_state", state.save)
