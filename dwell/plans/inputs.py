"""Stay records derived from the tables at hand, so that every operator has whole tables to run over."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dwell.functions.space import Grid

GRID = Grid("EPSG:32650", 0.0, 0.0, 10, 500.0, 10, (0.0, 0.0, 5000.0, 5000.0))
CODE = "4403"
RHYTHM = {
    "daytime": {"start_hour": 6, "end_hour": 18},
    "enter_periods": [{"name": "morning", "start_hour": 6, "end_hour": 11}, {"name": "night", "start_hour": 22, "end_hour": 4}, {"name": "meals", "hours": [7, 12, 12, 19]}],
    "leave_periods": [{"name": "late", "start_hour": 20, "end_hour": 24}],
    "weekday_groups": [{"name": "work", "days": [1, 2, 3, 4, 5]}, {"name": "rest", "days": [6, 7]}],
    "date_groups": [{"name": "start", "days_of_month": [1, 2, 3]}, {"name": "span", "ranges": [["2024-01-28", "2024-02-03"]]}],
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def folder(spark: SparkSession, what: str) -> str:
    """A new folder that driver and executors share: under spark.checkpoint.dir, or a temporary one on a local master."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that the whole cluster shares")
        base = f"file://{tempfile.mkdtemp(prefix='dwell-files-')}"
    return f"{base.rstrip('/')}/dwell-{what}-{uuid.uuid4().hex}"


def epoch_ms(c: Column) -> Column:
    """Of a time stamp without a zone, whatever the session's zone is."""
    return F.timestamp_diff("MILLISECOND", F.lit("1970-01-01 00:00:00").cast("timestamp_ntz"), c)


def stays(spark: SparkSession, sf_dir: str) -> DataFrame:
    e, i = table(spark, sf_dir, "events"), F.col("event_id")
    centi = F.round(F.col("value") * 100).cast("long")
    start = epoch_ms(F.col("ts"))
    return e.select(
        i, F.col("user_id").cast("string").alias("uuid"), (i % 12).alias("poi_id"), start.alias("start_ms"),
        (start + F.when(F.col("event_type").isin("click", "view"), F.lit(0)).otherwise(centi * 600)).alias("end_ms"),
        (centi / 100).alias("stay_minutes"),
        F.when(F.col("event_type") == "view", "Cell_Appearance").when(F.col("event_type") == "click", "wifi").otherwise("stay").alias("source"),
        ((i * 7919) % 6000 - 500).cast("double").alias("x"), ((i * 104729) % 6000 - 500).cast("double").alias("y"),
        (F.lit(617700169958293503) + (i % 40) * 262144).alias("h3_int"), (F.lit(440300) + i % 3).alias("c_code"),
    )


STAYS_SQL = """sp AS (
  SELECT event_id, CAST(user_id AS VARCHAR) AS uuid, event_id % 12 AS poi_id, epoch_us(ts) // 1000 AS start_ms,
    epoch_us(ts) // 1000 + CASE WHEN event_type IN ('click', 'view') THEN 0 ELSE CAST(round(value * 100) AS BIGINT) * 600 END AS end_ms,
    CAST(round(value * 100) AS BIGINT) / 100 AS stay_minutes,
    CASE WHEN event_type = 'view' THEN 'Cell_Appearance' WHEN event_type = 'click' THEN 'wifi' ELSE 'stay' END AS source,
    CAST((event_id * 7919) % 6000 - 500 AS DOUBLE) AS x, CAST((event_id * 104729) % 6000 - 500 AS DOUBLE) AS y,
    617700169958293503 + (event_id % 40) * 262144 AS h3_int, 440300 + event_id % 3 AS c_code
  FROM events)"""


def visit_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With hours that are unknown (negative or null), minutes and dates that are missing, and place 0."""
    s, i = stays(spark, sf_dir), F.col("event_id")
    hour = lambda c: F.expr(f"pmod({c}, 86400000L) div 3600000L")
    date = F.date_format(F.date_add(F.lit("1970-01-01").cast("date"), F.expr("start_ms div 86400000L").cast("int")), "yyyy-MM-dd")
    return s.select(
        i, "uuid", "poi_id", F.when(i % 13 == 0, F.lit(-1)).when(i % 19 == 0, F.lit(None)).otherwise(hour("start_ms")).cast("int").alias("start_hour"),
        hour("end_ms").cast("int").alias("end_hour"), F.when(i % 17 != 0, F.col("stay_minutes")).alias("stay_minutes"), F.when(i % 29 != 0, date).alias("date_str"),
        F.when(i % 7 != 0, F.concat(F.lit("["), F.col("x").cast("long").cast("string"), F.lit(", "), F.col("y").cast("long").cast("string"), F.lit("]"))).alias("location"),
    )


VISITS_SQL = (
    STAYS_SQL
    + """, rec AS (
  SELECT event_id, uuid, poi_id, CASE WHEN event_id % 13 = 0 THEN -1 WHEN event_id % 19 = 0 THEN NULL ELSE (start_ms % 86400000) // 3600000 END AS start_hour,
    (end_ms % 86400000) // 3600000 AS end_hour, CASE WHEN event_id % 17 <> 0 THEN stay_minutes END AS stay_minutes,
    CASE WHEN event_id % 29 <> 0 THEN DATE '1970-01-01' + CAST(start_ms // 86400000 AS INTEGER) END AS d,
    CASE WHEN event_id % 7 <> 0 THEN '[' || CAST(CAST(x AS BIGINT) AS VARCHAR) || ', ' || CAST(CAST(y AS BIGINT) AS VARCHAR) || ']' END AS location
  FROM sp WHERE poi_id <> 0)"""
)


def user_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("c_custkey")
    return table(spark, sf_dir, "customer").select(
        k.cast("string").alias("uuid"), F.round(F.col("c_acctbal") * 100).cast("long").alias("ses_bal"), F.col("c_mktsegment").alias("SES_segment"),
        ((k * 7919) % 6000 - 500).cast("double").alias("home_x"), ((k * 104729) % 6000 - 500).cast("double").alias("home_y"),
        ((k * 31) % 6000 - 500).cast("double").alias("work_x"), F.when(k % 5 != 0, ((k * 47) % 6000 - 500).cast("double")).alias("work_y"),
    )


def place_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(F.col("p_partkey").alias("poi_id"), F.col("p_type").alias("category"))
