"""Status observations: building them, and resolving them into interval-censored lifecycles."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

MISSES = 2


def observation_id(run_id: Column, ad_id: Column) -> Column:
    return F.sha2(F.concat_ws(":", run_id, ad_id.cast("string")), 256)


def initial_observations(ads: DataFrame, run_id: str, observed_at: str) -> DataFrame:
    """The first observation of each ad with an id: inactive only where that is said outright."""
    at = F.coalesce(F.nullif(F.col("ingested_at"), F.lit("")), F.lit(observed_at))
    run = F.concat_ws(":", F.lit(run_id), at)
    return ads.filter(F.coalesce(F.col("ad_id").cast("string"), F.lit("")) != "").select(
        observation_id(run, F.col("ad_id")).alias("observation_id"),
        run.alias("run_id"),
        "ad_id",
        at.alias("observed_at"),
        F.when(F.col("is_active").eqNullSafe(False), "explicitly_inactive").otherwise("active").alias("observed_status"),
        F.lit("initial_corpus_snapshot").alias("evidence"),
        F.col("start_date").alias("reported_start_date"),
        F.col("end_date").alias("reported_stop_date"),
        F.lit(True).alias("poll_complete"),
    )


def poll_observations(known: DataFrame, returned: DataFrame, complete_pages: DataFrame, run_id: str, observed_at: Column) -> DataFrame:
    """An observation of each known ad (ad_id, page_id, start_date).

    returned: ad_id, r_active, r_stop, r_start, one row per ad. complete_pages: page_id of polls that
    gave results; only there does absence count as a miss.
    """
    seen = returned.select("ad_id", F.lit(True).alias("_seen"), "r_active", "r_stop", "r_start")
    done = complete_pages.select("page_id").distinct().withColumn("poll_complete", F.lit(True))
    rows = known.join(seen, "ad_id", "left").join(done, "page_id", "left").withColumn("poll_complete", F.coalesce("poll_complete", F.lit(False)))
    stopped = F.col("r_active").eqNullSafe(False) | F.col("r_stop").isNotNull()
    found = F.col("_seen").isNotNull()
    return rows.select(
        observation_id(F.lit(run_id), F.col("ad_id")).alias("observation_id"),
        "ad_id",
        "page_id",
        observed_at.alias("observed_at"),
        F.when(found & stopped, "explicitly_inactive").when(found, "active").when(F.col("poll_complete"), "not_observed").otherwise("unknown").alias("observed_status"),
        F.when(found & stopped, "reported_stop_or_inactive").when(found, "returned_active").when(F.col("poll_complete"), "missing_from_page_with_returned_results").otherwise("page_poll_without_positive_control").alias("evidence"),
        F.coalesce("r_start", "start_date").alias("reported_start_date"),
        F.when(found, F.col("r_stop")).alias("reported_stop_date"),
        "poll_complete",
    )


def resolve(observations: DataFrame, misses: int = MISSES) -> DataFrame:
    """The state of each ad after its observations in order of time, then id.

    An active observation starts a stretch. Within a stretch the first explicit stop settles the state,
    and complete misses before it infer one. Stretches are aggregated first, so no ad's history has
    to be held as a list.
    """
    order = Window.partitionBy("ad_id").orderBy("observed_at", "observation_id")
    active = F.col("observed_status") == "active"
    stop = F.col("observed_status") == "explicitly_inactive"
    rows = observations.withColumn("_stretch", F.count_if(active).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    inside = Window.partitionBy("ad_id", "_stretch").orderBy("observed_at", "observation_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_stops", F.count_if(stop).over(inside)).withColumn("_miss", (F.col("observed_status") == "not_observed") & F.coalesce("poll_complete", F.lit(False)))
    place = F.struct("observed_at", "observation_id")
    stretches = rows.groupBy("ad_id", "_stretch").agg(
        F.count("*").alias("n"),
        F.max(F.when(active, F.col("observed_at"))).alias("started"),
        F.min(F.when(F.col("_miss"), F.col("observed_at"))).alias("first_miss"),
        F.count_if(F.col("_miss") & (F.col("_stops") == 0)).alias("before"),
        F.max("_stops").alias("stops"),
        F.max(F.when(stop, F.col("observed_at"))).alias("stopped"),
        F.max_by(F.col("reported_stop_date"), F.when(stop, place)).alias("stop_date"),
        F.max(F.struct("_stops", F.col("observed_at"))).alias("_end"),
        F.count_if(F.col("_miss")).alias("misses"),
    )
    after = rows.join(stretches.select("ad_id", "_stretch", F.col("stops").alias("_last")), ["ad_id", "_stretch"])
    late = after.groupBy("ad_id", "_stretch").agg(F.count_if(F.col("_miss") & (F.col("_stops") == F.col("_last"))).alias("late"))
    inferred = (F.col("stops") == 0) & (F.col("before") >= misses)
    each = stretches.join(late, ["ad_id", "_stretch"]).select(
        "ad_id",
        "_stretch",
        "n",
        "started",
        "first_miss",
        "late",
        F.when(F.col("stops") > 0, "inactive_explicit").when(inferred, "inactive_inferred").when(F.col("started").isNotNull(), "active").otherwise("unknown").alias("state"),
        F.when(F.col("stops") > 0, F.col("stopped")).when(inferred, F.col("first_miss")).alias("event_at"),
        F.when(F.col("stops") > 0, F.col("_stretch")).alias("_stop_stretch"),
        "stop_date",
    )
    last = lambda c: F.max_by(c, "_stretch")
    return each.groupBy("ad_id").agg(
        last("state").alias("state"),
        F.max("started").alias("last_active_at"),
        last("first_miss").alias("first_missing_at"),
        F.max_by("event_at", F.when(F.col("event_at").isNotNull(), F.col("_stretch"))).alias("event_at"),
        F.max_by("stop_date", "_stop_stretch").alias("reported_stop_date"),
        last("late").cast("long").alias("consecutive_complete_misses"),
        F.sum("n").cast("long").alias("observation_count"),
    )


def event_duration(start: Column, stop_date: Column, event_at: Column) -> Column:
    """Days from start to the reported stop, else the event; null without a start or an event."""
    end = F.coalesce(stop_date.cast("date"), event_at.cast("date"))
    return F.when(start.isNotNull() & event_at.isNotNull(), F.greatest(F.lit(0), F.datediff(end, start)))
