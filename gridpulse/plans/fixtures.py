"""Views of the test tables that stand in for network elements, links, alarms and KPI history.

Each statement runs in Spark and, with the braces filled by table names, in other SQL engines.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("customer", "nation", "region", "orders", "events", "part")

VIEWS = {
    "network_elements": """
SELECT c.c_custkey AS ID, concat('NE-', CAST(c.c_custkey AS STRING)) AS NE_ID, c.c_name AS NE_NAME, c.c_mktsegment AS NE_TYPE,
  CASE c.c_custkey % 6 WHEN 0 THEN 'LTE' WHEN 1 THEN 'T5G' WHEN 2 THEN 'GSM' WHEN 3 THEN 'UMTS' WHEN 4 THEN 'FIBER' ELSE NULL END AS TECHNOLOGY,
  n.n_name AS VENDOR, r.r_name AS DOMAIN,
  CASE WHEN c.c_acctbal < 0 THEN 'INACTIVE' ELSE 'ACTIVE' END AS NE_STATUS,
  CASE WHEN c.c_custkey % 7 = 0 THEN 1 ELSE 0 END AS IS_VIRTUAL,
  CASE WHEN c.c_custkey < 10 THEN NULL ELSE CAST(floor(c.c_custkey / 10.0) AS BIGINT) END AS PARENT_NE_ID_FK,
  CAST(r.r_regionkey AS BIGINT) AS GEOGRAPHY_L1_ID_FK, CAST(n.n_nationkey AS BIGINT) AS GEOGRAPHY_L2_ID_FK,
  CASE WHEN c.c_custkey % 3 = 0 THEN NULL ELSE c.c_custkey % 50 END AS GEOGRAPHY_L3_ID_FK,
  CASE WHEN c.c_custkey % 5 = 0 THEN NULL ELSE c.c_custkey % 200 END AS GEOGRAPHY_L4_ID_FK,
  CASE WHEN c.c_custkey % 97 = 0 THEN 1 ELSE 0 END AS IS_DELETED
FROM {customer} c JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey""",
    "hardware_details": """
SELECT o_custkey AS SOURCE_NE_ID, o_orderdate AS MANUFACTURE_DATE, o_orderdate + INTERVAL 1825 DAY AS WARRANTY_DATE,
  CASE WHEN o_orderkey % 10 = 0 THEN 1 ELSE 0 END AS IS_DELETED
FROM {orders} WHERE o_orderpriority = '5-LOW'""",
    "topology_links": """
SELECT o_custkey AS src, o_orderkey % (SELECT count(*) FROM {customer}) AS dst,
  CASE o_orderstatus WHEN 'F' THEN 'isis' WHEN 'O' THEN 'bgp' ELSE 'ospf' END AS link_type,
  CASE WHEN o_orderstatus = 'F' THEN o_totalprice / 5000.0 END AS SOURCE_UTILIZATION,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 50 AS DOUBLE) / 1000 END AS SOURCE_ERROR_RATE,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_orderkey % 20 AS DOUBLE) / 1000 END AS SOURCE_DROP_RATE,
  CASE WHEN o_orderstatus = 'F' THEN 100.0 - o_totalprice / 5000.0 END AS TARGET_UTILIZATION,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey % 50 AS DOUBLE) / 1000 END AS TARGET_ERROR_RATE,
  CASE WHEN o_orderstatus = 'F' THEN CAST(o_custkey % 20 AS DOUBLE) / 1000 END AS TARGET_DROP_RATE,
  CASE WHEN o_orderstatus <> 'F' THEN NULL WHEN o_totalprice > 400000 THEN 'CRITICAL' WHEN o_totalprice > 250000 THEN 'WARNING' ELSE 'HEALTHY' END AS SOURCE_UTILIZATION_SEVERITY
FROM {orders} WHERE o_orderpriority = '1-URGENT'""",
    "alarms": """
SELECT event_id AS alarm_id, CAST(ts AS TIMESTAMP) AS alarm_time, concat('NE-', CAST(user_id AS STRING)) AS entity_id,
  concat(event_type, '_', CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 5 AS STRING)) AS alarm_code,
  CASE WHEN value >= 100 THEN 'CRITICAL' WHEN value >= 50 THEN 'MAJOR' WHEN value >= 15 THEN 'MINOR' ELSE 'WARNING' END AS severity,
  CASE WHEN event_id % 11 = 0 THEN 'Power supply fault' WHEN event_id % 13 = 0 THEN 'bgp state change' WHEN event_id % 17 = 0 THEN '' END AS probable_cause
FROM {events}""",
    "alarm_library": """
SELECT DISTINCT concat(event_type, '_', CAST(CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 5 AS STRING)) AS alarm_code,
  CASE event_type WHEN 'error' THEN 'jnxFruPowerSupplyFail' WHEN 'click' THEN 'bgpRetransmitNeighbor' WHEN 'view' THEN 'opticalPowerLow' WHEN 'purchase' THEN 'ifState' ELSE 'utilizationOverflow' END AS alarm_identifier,
  CASE event_type WHEN 'error' THEN 'OUTAGE' WHEN 'view' THEN 'DETERIORATION' END AS classification
FROM {events} WHERE event_type <> 'signup' OR CAST(regexp_extract(props, '([0-9]+)', 1) AS INT) % 5 <> 4""",
    "kpi_history": """
SELECT user_id AS ne_id, CAST(ts AS TIMESTAMP) AS ts, value AS kpi_value, CASE WHEN value > 200 THEN 1 ELSE 0 END AS is_anomaly
FROM {events}""",
}


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    sql = VIEWS[name]
    used = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES if f"{{{t}}}" in sql}
    return spark.sql(sql, **used)


def ctes(*names: str) -> str:
    """The views as common table expressions over the tables of the same names."""
    tables = {t: t for t in TABLES}
    return ",\n".join(f"{n} AS ({VIEWS[n].format(**tables)})" for n in names)
