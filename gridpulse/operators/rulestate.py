"""Propagation rules kept up to date: statistics of sessions that can be added and taken away.

The state of the rules is the alarms with the start of their session, how often each delay of each ordered pair of codes
occurs, and in how many sessions each code is. All of them are counts, so sessions can be taken out as well as put in, and the
extremes and deviations of delays follow from the counts. An update finds the sessions that new alarms touch (within the
gap of one of their alarms), takes these out, and puts the sessions of their old and new alarms in; it reads no alarm of
any other session.

Nulls and edge cases: alarms without an element, a time or an id take no part; an alarm whose id is known already is
ignored; new alarms may be of any time, and may join sessions that were apart; empty tables give an empty state and no
rules.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .rules import MAX_DELAY, propagation_pairs
from .sessions import session_codes, sessionize
from .shared import cut

ALARMS = ("alarm_id", "entity_id", "alarm_time", "alarm_code")


@dataclass
class RuleState:
    """sessions: ALARMS and start. delays: a, b, delay (microseconds; null beyond an hour or below 0), n. codes: code, n.
    total: the sessions of two alarms or more, in a table of one row (n)."""

    sessions: DataFrame
    delays: DataFrame
    codes: DataFrame
    total: DataFrame
    gap: int

    def save(self, path: str) -> None:
        self.sessions.withColumn("day", F.to_date("start")).write.mode("overwrite").partitionBy("day").parquet(f"{path}/sessions")
        for name in ("delays", "codes", "total"):
            getattr(self, name).write.mode("overwrite").parquet(f"{path}/{name}")

    @classmethod
    def load(cls, spark: SparkSession, path: str, gap: int) -> RuleState:
        return cls(*[spark.read.parquet(f"{path}/{name}").select(*columns) for name, columns in (("sessions", [*ALARMS, "start"]), ("delays", ["a", "b", "delay", "n"]), ("codes", ["code", "n"]), ("total", ["n"]))], gap)


def _alarms(alarms: DataFrame) -> DataFrame:
    return alarms.where("alarm_id IS NOT NULL AND entity_id IS NOT NULL AND alarm_time IS NOT NULL").select(*ALARMS).dropDuplicates(["alarm_id"])


def _with_start(alarms: DataFrame, gap: int) -> DataFrame:
    df = sessionize(alarms, gap, ["entity_id"])
    start = F.min("alarm_time").over(W.partitionBy("entity_id", "session_id"))
    return cut(df.withColumn("start", start).select(*ALARMS, "start"))


def _counts(sessions: DataFrame, sign: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    named = sessions.withColumn("session_id", F.concat_ws("#", "entity_id", F.unix_micros("start")))
    codes = cut(session_codes(named))
    us = F.round(F.col("delay") * 1e6).cast("long")
    delay = F.when(us.between(0, MAX_DELAY * 1_000_000), us)
    n = F.lit(sign).cast("long")
    delays = propagation_pairs(codes).groupBy("a", "b", delay.alias("delay")).agg((n * F.count("*")).alias("n"))
    return delays, codes.groupBy("code").agg((n * F.count("*")).alias("n")), codes.agg((n * F.count_distinct("session_id")).alias("n"))


def _added(tables: list[DataFrame], keys: list[str]) -> DataFrame:
    every = tables[0]
    for t in tables[1:]:
        every = every.unionByName(t)
    sums = every.groupBy(*keys).agg(F.sum("n").alias("n")) if keys else every.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"))
    return cut(sums.where("n <> 0") if keys else sums)


KEYS = (["a", "b", "delay"], ["code"], [])


def start(alarms: DataFrame, gap: int = 1800) -> RuleState:
    """The state of all alarms."""
    sessions = _with_start(_alarms(alarms), gap)
    return RuleState(sessions, *[_added([t], k) for t, k in zip(_counts(sessions, 1), KEYS)], gap)


def touched_sessions(state: RuleState, new: DataFrame) -> DataFrame:
    """entity_id, start of the sessions that have an alarm within the gap of a new one. Sessions and alarms of an element meet
    in pieces of the gap's length that each of them lies in or next to; a session has one row for each piece that it covers."""
    size = (state.gap + 1) * 1_000_000
    # The gap counts to each alarm of a session, and those are at most a gap apart: so to the session's span.
    ends = state.sessions.groupBy("entity_id", "start").agg(F.max("alarm_time").alias("end"))
    us, piece = F.unix_micros, lambda c: F.floor(F.unix_micros(c) / size)
    spans = ends.select("entity_id", "start", us("start").alias("from"), us("end").alias("to"), F.explode(F.sequence(piece("start"), piece("end"))).alias("piece"))
    asked = new.select("entity_id", us("alarm_time").alias("us"), F.explode(F.array(piece("alarm_time") - 1, piece("alarm_time"), piece("alarm_time") + 1)).alias("piece"))
    gap = state.gap * 1_000_000
    return spans.join(asked, ["entity_id", "piece"]).where((F.col("us") >= F.col("from") - gap) & (F.col("us") <= F.col("to") + gap)).select("entity_id", "start").distinct()


def update(state: RuleState, alarms: DataFrame) -> tuple[RuleState, DataFrame]:
    """The state with new alarms, and the alarms of the sessions that were taken out."""
    new = cut(_alarms(alarms).join(state.sessions.select("alarm_id"), "alarm_id", "left_anti").select(*ALARMS))
    touched = cut(touched_sessions(state, new))
    out = cut(state.sessions.join(touched, ["entity_id", "start"], "left_semi").select(*ALARMS, "start"))
    back = _with_start(out.select(*ALARMS).unionByName(new), state.gap)
    stay = state.sessions.join(touched, ["entity_id", "start"], "left_anti").select(*ALARMS, "start")
    parts = zip((state.delays, state.codes, state.total), _counts(out, -1), _counts(back, 1), KEYS)
    return RuleState(cut(stay.unionByName(back)), *[_added([a, b, c], k) for a, b, c, k in parts], state.gap), out


def rules(state: RuleState, min_support: float = 0.01, min_confidence: float = 0.3) -> DataFrame:
    """As `rules.propagation_rules` of all sessions."""
    one = W.partitionBy("a", "b")
    seconds, known = F.col("delay") / 1e6, F.when(F.col("delay").isNotNull(), F.col("n"))
    mean = F.sum(seconds * F.col("n")).over(one) / F.sum(known).over(one)
    stats = state.delays.withColumn("mean", mean).groupBy("a", "b").agg(
        F.sum("n").alias("count"), F.max("mean").alias("avg_delay_sec"),
        F.sqrt(F.sum((seconds - F.col("mean")) * (seconds - F.col("mean")) * F.col("n")) / F.sum(known)).alias("std_delay_sec"),
        F.min(seconds).alias("min_delay_sec"), F.max(seconds).alias("max_delay_sec"),
    )
    rated = stats.join(state.codes.select(F.col("code").alias("a"), F.col("n").alias("sessions")), "a")
    rated = rated.withColumn("support", F.col("count") / state.total.select("n").scalar()).withColumn("confidence", F.col("count") / F.col("sessions"))
    rated = rated.where((F.col("support") >= min_support) & (F.col("confidence") >= min_confidence))
    rank = F.row_number().over(W.partitionBy("a").orderBy(F.desc("confidence"), "b"))
    return rated.select(F.col("a").alias("antecedent"), F.col("b").alias("consequent"), "count", "support", "confidence", "avg_delay_sec", "std_delay_sec", "min_delay_sec", "max_delay_sec", rank.alias("rank"))
