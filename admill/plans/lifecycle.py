"""Queries of status observations and survival."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from admill.functions import dates
from admill.operators import lifecycle as lc, survival as sv
from admill.operators.storage import shared_dir
from admill.plans.registry import query
from admill.plans.views import ADS, AS_OF, OBS, ads, observations, table
from admill.streaming import lifecycle_stream as stream

#: The fold spelt out as a recursion over each ad's n-th observation.
_FOLD = f"""{OBS}, o AS (SELECT *, row_number() OVER (PARTITION BY ad_id ORDER BY observed_at, observation_id) AS rn FROM obs),
f AS (SELECT ad_id, CAST(0 AS BIGINT) AS rn, 'unknown' AS state, CAST(NULL AS TIMESTAMP) AS last_active_at, CAST(NULL AS TIMESTAMP) AS first_missing_at,
    CAST(NULL AS TIMESTAMP) AS event_at, CAST(NULL AS DATE) AS reported_stop_date, CAST(0 AS BIGINT) AS misses FROM (SELECT DISTINCT ad_id FROM obs)
  UNION ALL
  SELECT f.ad_id, o.rn,
    CASE WHEN o.observed_status = 'active' THEN 'active' WHEN o.observed_status = 'explicitly_inactive' THEN 'inactive_explicit'
      WHEN o.observed_status = 'not_observed' AND o.poll_complete AND f.state <> 'inactive_explicit' AND f.misses + 1 >= 2 THEN 'inactive_inferred' ELSE f.state END,
    CASE WHEN o.observed_status = 'active' THEN o.observed_at ELSE f.last_active_at END,
    CASE WHEN o.observed_status = 'active' THEN NULL WHEN o.observed_status = 'not_observed' AND o.poll_complete THEN coalesce(f.first_missing_at, o.observed_at) ELSE f.first_missing_at END,
    CASE WHEN o.observed_status = 'explicitly_inactive' THEN o.observed_at
      WHEN o.observed_status = 'not_observed' AND o.poll_complete AND f.state <> 'inactive_explicit' AND f.misses + 1 >= 2 THEN coalesce(f.first_missing_at, o.observed_at) ELSE f.event_at END,
    CASE WHEN o.observed_status = 'explicitly_inactive' THEN o.reported_stop_date ELSE f.reported_stop_date END,
    CASE WHEN o.observed_status IN ('active', 'explicitly_inactive') THEN 0 WHEN o.observed_status = 'not_observed' AND o.poll_complete THEN f.misses + 1 ELSE f.misses END
  FROM f JOIN o ON o.ad_id = f.ad_id AND o.rn = f.rn + 1),
resolved AS (SELECT f.* FROM f JOIN (SELECT ad_id, max(rn) AS rn FROM o GROUP BY ad_id) m ON m.ad_id = f.ad_id AND m.rn = f.rn)"""


_STATES = f"""WITH RECURSIVE {_FOLD} SELECT ad_id, state, last_active_at, first_missing_at, event_at, CAST(reported_stop_date AS VARCHAR) AS reported_stop_date, misses AS consecutive_complete_misses, rn AS observation_count FROM resolved"""


@query(_STATES)
def lifecycle_state(spark, sf):
    return lc.resolve(observations(spark, sf)).withColumn("reported_stop_date", F.col("reported_stop_date").cast("string"))


@query(_STATES)
def lifecycle_stream(spark, sf):
    """The same states from a stream whose later half comes first, with every tenth observation twice."""
    folder = f"{shared_dir(spark)}/admill-{spark.sparkContext.applicationId}/stream-{uuid.uuid4().hex}"
    rows = observations(spark, sf)
    middle = F.lit("2024-01-03").cast("timestamp")
    for part in (rows.filter(F.col("observed_at") >= middle), rows.filter((F.col("observed_at") < middle) | (F.col("observation_id") % 10 == 0))):
        part.write.mode("append").parquet(f"{folder}/in")
        stream.run(spark.readStream.schema(rows.schema).parquet(f"{folder}/in"), f"{folder}/log", f"{folder}/states", f"{folder}/checkpoint").awaitTermination()
    return stream.current_states(spark, f"{folder}/states").withColumn("reported_stop_date", F.col("reported_stop_date").cast("string"))


@query("""WITH k AS (SELECT o_orderkey AS ad_id, o_custkey AS page_id, o_orderstatus FROM orders),
r AS (SELECT l_orderkey AS ad_id, min(l_linestatus) <> 'F' AS r_active, CASE WHEN min(l_returnflag) = 'R' THEN CAST(max(l_shipdate) AS DATE) END AS r_stop FROM lineitem WHERE l_quantity >= 40 GROUP BY l_orderkey),
c AS (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
SELECT sha256('run-1:' || k.ad_id) AS observation_id, k.ad_id, CASE WHEN r.ad_id IS NOT NULL AND (r_active = false OR r_stop IS NOT NULL) THEN 'explicitly_inactive'
  WHEN r.ad_id IS NOT NULL THEN 'active' WHEN c_custkey IS NOT NULL THEN 'not_observed' ELSE 'unknown' END AS observed_status, c_custkey IS NOT NULL AS poll_complete, CAST(r_stop AS VARCHAR) AS reported_stop_date
FROM k LEFT JOIN r USING (ad_id) LEFT JOIN c ON c_custkey = page_id""")
def poll_observations(spark, sf):
    """A poll returns the ads that have a large line; the others weren't seen."""
    known = table(spark, sf, "orders").select(F.col("o_orderkey").alias("ad_id"), F.col("o_custkey").alias("page_id"), F.to_date("o_orderdate").alias("start_date"))
    lines = table(spark, sf, "lineitem").filter("l_quantity >= 40").groupBy(F.col("l_orderkey").alias("ad_id"))
    returned = lines.agg((F.min("l_linestatus") != "F").alias("r_active"), F.when(F.min("l_returnflag") == "R", F.to_date(F.max("l_shipdate"))).alias("r_stop"), F.lit(None).cast("date").alias("r_start"))
    pages = table(spark, sf, "customer").filter("c_mktsegment <> 'BUILDING'").select(F.col("c_custkey").alias("page_id"))
    out = lc.poll_observations(known, returned, pages, "run-1", F.lit(AS_OF).cast("timestamp"))
    return out.select("observation_id", "ad_id", "observed_status", "poll_complete", F.col("reported_stop_date").cast("string").alias("reported_stop_date"))


@query(f"""WITH {ADS} SELECT sha256('corpus:{AS_OF}:' || ad_id) AS observation_id, ad_id, CASE WHEN is_active = false THEN 'explicitly_inactive' ELSE 'active' END AS observed_status FROM ads""")
def initial_observations(spark, sf):
    rows = ads(spark, sf).withColumn("ingested_at", F.lit(None).cast("string"))
    return lc.initial_observations(rows, "corpus", AS_OF).select("observation_id", "ad_id", "observed_status")


def lifetimes(spark, sf):
    """Ads with duration and ended; running ads count to the fixed day."""
    rows = ads(spark, sf)
    long = F.datediff("end_date", "start_date") * 20 + F.pmod("ad_id", F.lit(50))
    return rows.withColumn("duration", F.when(F.col("end_date").isNotNull(), long).otherwise(F.col("days_active")).cast("long")).withColumn("ended", F.col("end_date").isNotNull())


_LIVES = f"""{ADS}, lives AS (SELECT *, CAST(CASE WHEN end_date IS NOT NULL THEN date_diff('day', start_date, end_date) * 20 + ad_id % 50 ELSE days_active END AS BIGINT) AS duration, end_date IS NOT NULL AS ended FROM ads)"""
_KM = """days AS (SELECT {by} duration AS t, count(*) AS n, count(*) FILTER (ended) AS d FROM lives GROUP BY ALL),
risk AS (SELECT *, sum(n) OVER (PARTITION BY {part} ORDER BY t ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS at_risk FROM days),
km AS (SELECT *, CASE WHEN max(CASE WHEN d = at_risk THEN 1 ELSE 0 END) OVER w = 1 THEN 0.0 ELSE exp(sum(CASE WHEN d < at_risk THEN ln(1 - d / at_risk) ELSE 0 END) OVER w) END AS survival
  FROM risk WINDOW w AS (PARTITION BY {part} ORDER BY t ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))"""


@query(f"WITH {_LIVES}, {_KM.format(by='', part='1')} SELECT t, CAST(at_risk AS BIGINT) AS at_risk, d AS ended, round(survival, 9) AS survival FROM km")
def km_survival(spark, sf):
    return sv.kaplan_meier(lifetimes(spark, sf), "duration", "ended").withColumn("survival", F.round("survival", 9))


_AT = "round(coalesce(min(CASE WHEN t <= {h} THEN survival END), 1.0), 9) AS s{h}"


@query(f"""WITH {_LIVES}, {_KM.format(by='hook,', part='hook')} SELECT hook, CAST(max(at_risk) AS BIGINT) AS n, CAST(sum(d) AS BIGINT) AS events_observed,
CASE WHEN min(CASE WHEN survival <= 0.75 THEN t END) IS NULL THEN 'threshold_not_estimable_due_to_censoring' ELSE 'ok' END AS status,
min(CASE WHEN survival <= 0.75 THEN t END) AS days_to_75pct, min(CASE WHEN survival <= 0.5 THEN t END) AS median_days, {', '.join(_AT.format(h=h) for h in sv.HORIZONS)} FROM km GROUP BY hook""")
def longevity_benchmarks(spark, sf):
    out = sv.benchmarks(lifetimes(spark, sf), "duration", "ended", ["hook"])
    return out.withColumns({f"s{h}": F.round(f"s{h}", 9) for h in sv.HORIZONS})


_S = "coalesce((SELECT min(survival) FROM km WHERE t <= {h}), 1.0)"
_HALF = "1.959963984540054 * sqrt(coalesce((SELECT sum(d / (at_risk * (at_risk - d))) FROM km WHERE t <= {h} AND d < at_risk), 0.0)) / abs(ln(" + _S + "))"
_BOUND = "CASE WHEN " + _S + " > 0 AND " + _S + " < 1 THEN exp(-exp(ln(-ln(" + _S + ")) {sign} " + _HALF + ")) ELSE " + _S + " END"
_H = "SELECT {h} AS horizon, round(" + _S + ", 9) AS survival, round(" + _BOUND.replace("{sign}", "+") + ", 7) AS lower_95, round(" + _BOUND.replace("{sign}", "-") + """, 7) AS upper_95, count(*) FILTER (duration >= {h}) AS observed_through,
count(*) FILTER ((ended AND duration <= {h}) OR duration >= {h}) AS eligible, count(*) FILTER (ended AND duration <= {h}) AS endings,
round(count(*) FILTER ((ended AND duration <= {h}) OR duration >= {h}) / count(*), 9) AS outcome_coverage,
CASE WHEN count(*) FILTER (ended AND duration <= {h}) >= 5 AND count(*) FILTER ((ended AND duration <= {h}) OR duration >= {h}) >= 20 THEN 'ok' ELSE 'insufficient_evidence' END AS status FROM lives"""


@query(f"WITH {_LIVES}, {_KM.format(by='', part='1')} " + " UNION ALL ".join(_H.format(h=h) for h in sv.HORIZONS))
def survival_horizons(spark, sf):
    out = sv.horizons(lifetimes(spark, sf), "duration", "ended")
    return out.withColumns({c: F.round(c, 9) for c in ("survival", "outcome_coverage")} | {c: F.round(c, 7) for c in ("lower_95", "upper_95")})


@query(f"""WITH {_LIVES}, k AS (SELECT duration AS t, ended AS e, collation_count AS r, count(*) AS n FROM lives GROUP BY ALL)
SELECT round(sum(a.n * b.n * CASE WHEN b.r < a.r THEN 1.0 WHEN b.r = a.r THEN 0.5 ELSE 0 END) / sum(a.n * b.n), 9) AS concordance, CAST(sum(a.n * b.n) AS BIGINT) AS pairs FROM k a JOIN k b ON b.t > a.t WHERE a.e""")
def concordance(spark, sf):
    return sv.concordance(lifetimes(spark, sf), "duration", "ended", "collation_count").withColumn("concordance", F.round("concordance", 9))


@query(f"""WITH {_LIVES}, k AS (SELECT duration AS t, ended AS e, price AS r, count(*) AS n FROM lives GROUP BY ALL)
SELECT round(sum(a.n * b.n * CASE WHEN b.r < a.r THEN 1.0 WHEN b.r = a.r THEN 0.5 ELSE 0 END) / sum(a.n * b.n), 9) AS concordance, CAST(sum(a.n * b.n) AS BIGINT) AS pairs FROM k a JOIN k b ON b.t > a.t WHERE a.e""")
def continuous_concordance(spark, sf):
    return sv.concordance(lifetimes(spark, sf), "duration", "ended", "price").withColumn("concordance", F.round("concordance", 9))


@query(f"""WITH RECURSIVE {_FOLD}, a AS (SELECT ad_id, DATE '2023-12-01' + CAST(ad_id % 20 AS INT) AS start_date FROM resolved)
SELECT ad_id, state, CASE WHEN event_at IS NOT NULL THEN greatest(0, date_diff('day', start_date, coalesce(reported_stop_date, CAST(event_at AS DATE)))) END AS duration FROM resolved JOIN a USING (ad_id)""")
def event_durations(spark, sf):
    start = F.date_add(F.lit("2023-12-01").cast("date"), F.pmod("ad_id", F.lit(20)).cast("int"))
    duration = lc.event_duration(start, F.col("reported_stop_date"), F.col("event_at"))
    return lc.resolve(observations(spark, sf)).select("ad_id", "state", duration.cast("long").alias("duration"))


@query(f"WITH {ADS}, c AS (SELECT end_date FROM ads WHERE end_date IS NOT NULL GROUP BY end_date HAVING count(*) > 0.01 * (SELECT count(end_date) FROM ads) AND count(*) >= 5) SELECT ad_id, CASE WHEN ad_id % 2 = 0 THEN is_active = false ELSE end_date IS NOT NULL AND end_date NOT IN (SELECT end_date FROM c) END AS observed FROM ads")
def event_observed(spark, sf):
    rows = ads(spark, sf)
    flagged = rows.withColumn("is_active", F.when(F.col("ad_id") % 2 == 0, F.col("is_active")))
    return sv.event_observed(flagged, sv.scrape_dates(rows)).select("ad_id", "observed")


@query("SELECT o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS from_epoch, CAST(year(o_orderdate) AS VARCHAR) || '-Q' || quarter(o_orderdate) AS cohort, strftime(o_orderdate, '%d.%m.%Y') AS kept FROM orders")
def date_coercion(spark, sf):
    """Epoch text becomes a date; text that isn't a date is cut to ten characters."""
    o = table(spark, sf, "orders")
    epoch = F.unix_timestamp("o_orderdate").cast("string")
    return o.select("o_orderkey", dates.iso_date(epoch).alias("from_epoch"), dates.cohort(F.col("o_orderdate")).alias("cohort"), dates.iso_date(F.date_format("o_orderdate", "dd.MM.yyyy")).alias("kept"))
