"""Sinks: append-only logs with deterministic ids, immutable publications, exports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F


def canonical(rows: DataFrame) -> DataFrame:
    """One JSON column per row, columns in the order of their names."""
    return rows.select(F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"}).alias("row"))


def row_id(*parts: Column) -> Column:
    """SHA-256 of the parts as a JSON list."""
    return F.sha2(F.to_json(F.array(*[F.coalesce(p.cast("string"), F.lit("")) for p in parts])), 256)


def append_once(rows: DataFrame, path: str, key: str, day: str, cluster: str) -> None:
    """Appends rows whose id the log doesn't have yet, partitioned by day and sorted by the cluster column."""
    spark = rows.sparkSession
    fresh = rows.dropDuplicates([key])
    try:
        known = spark.read.parquet(path).select(key)
    except Exception as e:  # the log's first batch
        if "PATH_NOT_FOUND" not in str(e):
            raise
    else:
        fresh = fresh.join(known, key, "left_anti")
    fresh.withColumn("_day", F.to_date(day)).sortWithinPartitions(cluster).write.mode("append").partitionBy("_day").parquet(path)


def publish_immutable(rows: DataFrame, path: str) -> bool:
    """Writes rows where nothing is; the same content again is fine, other content is an error. True if written."""
    spark = rows.sparkSession
    try:
        there = spark.read.parquet(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        rows.write.mode("errorifexists").parquet(path)
        return True
    if sorted(there.columns) != sorted(rows.columns) or not canonical(there).exceptAll(canonical(rows)).isEmpty() or not canonical(rows).exceptAll(canonical(there)).isEmpty():
        raise ValueError(f"{path} holds other content")
    return False


def export_messages(rows: DataFrame, path: str) -> None:
    """(system, user, assistant) rows as chat JSON lines."""
    turns = F.array(*[F.struct(F.lit(r).alias("role"), F.col(r).alias("content")) for r in ("system", "user", "assistant")])
    rows.select(F.to_json(F.struct(turns.alias("messages"))).alias("value")).write.mode("overwrite").text(path)


def diagnostics(results: DataFrame, path: str) -> DataFrame:
    """Writes a row per URL as CSV and returns the histogram of status codes."""
    results.write.mode("overwrite").option("header", True).csv(path)
    return results.groupBy("status_code").agg(F.count("*").alias("n"))
