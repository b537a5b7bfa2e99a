"""The report as JSON where a column is null in every row."""

from gridpulse.plans import queries


def test_a_report_without_rules_is_read_back(spark, monkeypatch):
    found = queries._rules
    monkeypatch.setattr(queries, "_rules", lambda s, d: found(s, d).where("false"))
    rows = queries.QUERIES["snk5_write_report"](spark, "/root/testdata/sf0.001").collect()
    assert rows and {r.propagation for r in rows} == {0} and all(r.alarms == r.alarm_count for r in rows)
