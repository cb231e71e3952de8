"""The domain's relations over the given tables, as DataFrames and as SQL for the oracle.

Orders stand for ads, customers for their advertisers' pages, line items for collated variants,
and events for status observations. Dates are measured against a fixed day.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

AS_OF = "2002-01-01"
#: Event types as observed states; sign-ups say nothing.
STATUS = {"view": "active", "click": "active", "purchase": "explicitly_inactive", "error": "not_observed"}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ad_id, page_id, start_date, end_date, is_active, price, hook, days_active, collation_count."""
    lines = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.count("*").alias("n"))
    o = table(spark, sf_dir, "orders").join(lines, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    start = F.to_date("o_orderdate")
    return o.select(
        F.col("o_orderkey").alias("ad_id"),
        F.col("o_custkey").alias("page_id"),
        start.alias("start_date"),
        F.when(F.col("o_orderstatus") == "F", F.last_day(start)).alias("end_date"),
        (F.col("o_orderstatus") != "F").alias("is_active"),
        (F.col("o_totalprice") / 5000).alias("price"),
        F.col("o_orderpriority").alias("hook"),
        F.col("o_orderstatus").alias("segment"),
        F.greatest(F.lit(0), F.datediff(F.lit(AS_OF).cast("date"), start)).cast("long").alias("days_active"),
        F.coalesce("n", F.lit(0)).cast("long").alias("collation_count"),
    )


ADS = f"""lines AS (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY l_orderkey),
ads AS (SELECT o_orderkey AS ad_id, o_custkey AS page_id, CAST(o_orderdate AS DATE) AS start_date,
  CASE WHEN o_orderstatus = 'F' THEN last_day(CAST(o_orderdate AS DATE)) END AS end_date,
  o_orderstatus <> 'F' AS is_active, o_totalprice / 5000 AS price, o_orderpriority AS hook, o_orderstatus AS segment,
  CAST(greatest(0, date_diff('day', CAST(o_orderdate AS DATE), DATE '{AS_OF}')) AS BIGINT) AS days_active,
  CAST(coalesce(n, 0) AS BIGINT) AS collation_count
  FROM orders LEFT JOIN lines ON l_orderkey = o_orderkey)"""


def observations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """observation_id, ad_id, observed_at, observed_status, poll_complete, reported_stop_date."""
    e = table(spark, sf_dir, "events")
    status = F.create_map(*[F.lit(x) for pair in STATUS.items() for x in pair])[F.col("event_type")]
    return e.select(
        F.col("event_id").alias("observation_id"),
        F.col("user_id").alias("ad_id"),
        F.col("ts").alias("observed_at"),
        F.coalesce(status, F.lit("unknown")).alias("observed_status"),
        (F.get_json_object("props", "$.k").cast("int") % 10 != 0).alias("poll_complete"),
        F.when(F.col("event_type") == "purchase", F.to_date("ts")).alias("reported_stop_date"),
    )


OBS = """obs AS (SELECT event_id AS observation_id, user_id AS ad_id, ts AS observed_at,
  CASE event_type WHEN 'view' THEN 'active' WHEN 'click' THEN 'active' WHEN 'purchase' THEN 'explicitly_inactive'
    WHEN 'error' THEN 'not_observed' ELSE 'unknown' END AS observed_status,
  CAST(json_extract_string(props, '$.k') AS INT) % 10 <> 0 AS poll_complete,
  CASE WHEN event_type = 'purchase' THEN CAST(ts AS DATE) END AS reported_stop_date FROM events)"""
