"""Queries of row selection, unions, gates and grouped patterns."""

from __future__ import annotations

from pyspark.sql import functions as F

from admill.operators import relational as rel, scoring, statistics as st, survival
from admill.plans.registry import query
from admill.plans.views import ADS, ads, table


@query("""SELECT l_orderkey, l_linenumber, l_partkey, l_shipdate, l_extendedprice FROM (SELECT *, row_number() OVER (
  PARTITION BY l_orderkey ORDER BY l_shipdate DESC, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1""")
def latest_snapshot(spark, sf):
    order = [F.desc("l_shipdate"), *map(F.asc, ("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"))]
    rows = rel.latest_per_key(table(spark, sf, "lineitem"), ["l_orderkey"], order)
    return rows.select("l_orderkey", "l_linenumber", "l_partkey", "l_shipdate", "l_extendedprice")


@query("""SELECT event_id, user_id, event_type, ts FROM (SELECT *, row_number() OVER (PARTITION BY event_id ORDER BY ts DESC, copy) AS rn FROM (
  SELECT *, 0 AS copy FROM events UNION ALL SELECT *, 1 AS copy FROM events WHERE event_type = 'click')) WHERE rn = 1""")
def dedup_events(spark, sf):
    """At-least-once delivery: clicks arrive twice, and one of each id is kept."""
    e = table(spark, sf, "events")
    sent = e.withColumn("copy", F.lit(0)).unionByName(e.filter("event_type = 'click'").withColumn("copy", F.lit(1)))
    return rel.latest_per_key(sent, ["event_id"], [F.desc("ts"), F.asc("copy")]).select("event_id", "user_id", "event_type", "ts")


@query(f"""WITH {ADS} SELECT 'own' AS data_source, 'roas' AS metric_type, ad_id, price AS metric, CAST(NULL AS BIGINT) AS days_active FROM ads WHERE segment = 'F'
UNION ALL SELECT 'competitor', 'longevity', ad_id, CAST(NULL AS DOUBLE), days_active FROM ads WHERE segment <> 'F' AND days_active >= 30""")
def master_view_union(spark, sf):
    rows = ads(spark, sf)
    own = rows.filter("segment = 'F'").select(F.lit("own").alias("data_source"), F.lit("roas").alias("metric_type"), "ad_id", F.col("price").alias("metric"))
    other = rows.filter("segment <> 'F' AND days_active >= 30").select(F.lit("competitor").alias("data_source"), F.lit("longevity").alias("metric_type"), "ad_id", "days_active")
    return own.unionByName(other, allowMissingColumns=True)


@query("""WITH a AS (SELECT DISTINCT user_id FROM events WHERE ts >= TIMESTAMP '2024-01-03'), b AS (SELECT DISTINCT user_id FROM events WHERE ts < TIMESTAMP '2024-01-03')
SELECT count(*) FILTER (b.user_id IS NULL) AS new, count(*) FILTER (a.user_id IS NOT NULL AND b.user_id IS NOT NULL) AS kept, count(*) FILTER (a.user_id IS NULL) AS gone
FROM a FULL JOIN b ON a.user_id = b.user_id""")
def window_novelty(spark, sf):
    e, day = table(spark, sf, "events"), F.lit("2024-01-03").cast("timestamp")
    return rel.novelty(e.filter(F.col("ts") >= day), e.filter(F.col("ts") < day), "user_id")


@query(f"""WITH {ADS}, l AS (SELECT 'end_date' AS field, CAST(end_date AS VARCHAR) AS v, page_id FROM ads UNION ALL SELECT 'price', CAST(price AS VARCHAR), page_id FROM ads
UNION ALL SELECT 'hook', hook, page_id FROM ads)
SELECT field, count(*) FILTER (v IS NOT NULL AND v <> '') AS rows, count(DISTINCT page_id) FILTER (v IS NOT NULL AND v <> '') AS advertisers,
  count(*) FILTER (v IS NOT NULL AND v <> '') / count(*) AS coverage,
  count(*) FILTER (v IS NOT NULL AND v <> '') >= 100 AND count(DISTINCT page_id) FILTER (v IS NOT NULL AND v <> '') >= 10 AS model_support FROM l GROUP BY field""")
def coverage_gate(spark, sf):
    return rel.coverage(ads(spark, sf), ["end_date", "price", "hook"], "page_id", 100, 10)


@query("SELECT event_type, count(*) AS n, count(DISTINCT user_id) AS users FROM events GROUP BY event_type")
def status_histogram(spark, sf):
    return table(spark, sf, "events").groupBy("event_type").agg(F.count("*").alias("n"), F.count_distinct("user_id").alias("users"))


@query("""SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN l.doc_id IS NULL THEN 'unlabeled' WHEN quality = 1 THEN 'accepted' ELSE 'rejected' END AS outcome
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id) GROUP BY outcome""")
def taxonomy_gate(spark, sf):
    labels = table(spark, sf, "labels").select("doc_id", (F.col("quality") == 1).alias("ok"))
    return rel.label_gate(table(spark, sf, "documents").select("doc_id"), labels, "doc_id", "ok").groupBy("outcome").agg(F.count("*").alias("n"))


@query("""WITH p AS (SELECT doc_id, length(text) > 1000 AS predicted, (doc_id % 100) / 100.0 AS confidence FROM documents WHERE lang <> 'es')
SELECT outcome, count(*) AS n FROM (SELECT CASE WHEN p.doc_id IS NULL THEN 'missing_prediction' WHEN l.doc_id IS NOT NULL AND l.quality = 1 THEN 'accepted_human'
  WHEN l.doc_id IS NOT NULL THEN 'rejected_human' WHEN confidence < 0.9 THEN 'queued_low_confidence' WHEN predicted THEN 'accepted_classifier' ELSE 'rejected_classifier' END AS outcome
FROM documents d LEFT JOIN p ON p.doc_id = d.doc_id LEFT JOIN labels l ON l.doc_id = d.doc_id) GROUP BY outcome""")
def classifier_admission(spark, sf):
    docs = table(spark, sf, "documents")
    predictions = docs.filter("lang <> 'es'").select("doc_id", (F.length("text") > 1000).alias("predicted"), (F.col("doc_id") % 100 / 100).alias("confidence"))
    gold = table(spark, sf, "labels").select("doc_id", (F.col("quality") == 1).alias("truth"))
    return rel.admit(docs.select("doc_id"), predictions, gold, "doc_id", 0.9).groupBy("outcome").agg(F.count("*").alias("n"))


@query("""WITH f AS (SELECT l_orderkey, max(l_extendedprice) AS fresh FROM lineitem WHERE l_shipdate >= TIMESTAMP '2000-01-01' GROUP BY l_orderkey)
SELECT o_orderkey, coalesce(fresh, o_totalprice) AS o_totalprice, fresh IS NOT NULL AS refreshed FROM orders LEFT JOIN f ON l_orderkey = o_orderkey""")
def refresh_override_join(spark, sf):
    fresh = table(spark, sf, "lineitem").filter(F.col("l_shipdate") >= F.lit("2000-01-01").cast("timestamp")).groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_extendedprice").alias("o_totalprice"))
    old = table(spark, sf, "orders").select("o_orderkey", "o_totalprice", F.lit(False).alias("refreshed"))
    out = rel.override(old, fresh, "o_orderkey", "o_totalprice")
    return out.drop("refreshed").join(fresh.select("o_orderkey", F.lit(True).alias("refreshed")), "o_orderkey", "left").withColumn("refreshed", F.coalesce("refreshed", F.lit(False)))


@query("SELECT d.doc_id, d.lang FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)")
def resume_pending(spark, sf):
    """What a resumed run has still to do."""
    return table(spark, sf, "documents").select("doc_id", "lang").join(table(spark, sf, "labels"), "doc_id", "left_anti")


@query("""SELECT l_partkey, arg_min(l_suppkey, l_orderkey * 100 + l_linenumber * 1.0) AS l_suppkey, min(l_orderkey) AS first_order,
  array_to_string(list_sort(list(DISTINCT l_returnflag)), ',') AS labels FROM (SELECT l_partkey, l_suppkey, l_orderkey, l_linenumber, l_returnflag,
  row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey) AS rn FROM lineitem) WHERE rn = 1 GROUP BY l_partkey""")
def provenance_merge(spark, sf):
    rows = rel.latest_per_key(table(spark, sf, "lineitem"), ["l_orderkey", "l_linenumber"], [F.asc("l_partkey"), F.asc("l_suppkey")])
    out = rel.merge_provenance(rows, "l_partkey", F.col("l_orderkey") * 100 + F.col("l_linenumber"), ["l_suppkey", F.col("l_orderkey").alias("first_order")], "l_returnflag")
    return out.withColumn("labels", F.array_join("labels", ","))


@query("""SELECT o_orderpriority AS hook, o_orderstatus AS segment, count(*) AS sample_size, round(avg(o_totalprice), 4) AS mean, round(stddev_samp(o_totalprice), 4) AS deviation,
  max(o_totalprice) AS best FROM orders GROUP BY 1, 2 HAVING count(*) >= 10""")
def pattern_discovery(spark, sf):
    rows = table(spark, sf, "orders").select(F.col("o_orderpriority").alias("hook"), F.col("o_orderstatus").alias("segment"), "o_totalprice")
    out = rel.pattern_metrics(rows, ["hook", "segment"], "o_totalprice", 10).drop("sharpe")
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "deviation")})


@query("""SELECT p_brand, p_type, count(*) AS sample_size, round(avg(l_quantity) / nullif(stddev_samp(l_quantity), 0), 6) AS sharpe FROM lineitem JOIN part ON l_partkey = p_partkey
GROUP BY 1, 2 HAVING count(*) >= 5 ORDER BY sharpe DESC, p_brand, p_type LIMIT 20""")
def combo_sharpe(spark, sf):
    rows = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey"))
    out = rel.pattern_metrics(rows, ["p_brand", "p_type"], "l_quantity", 5).withColumn("sharpe", F.round("sharpe", 6))
    return out.select("p_brand", "p_type", "sample_size", "sharpe").orderBy(F.desc("sharpe"), "p_brand", "p_type").limit(20)


@query(f"WITH {ADS} SELECT hook, count(*) AS sample_size, round(avg(days_active), 4) AS mean, round(stddev_samp(days_active), 4) AS deviation, max(days_active) AS best FROM ads GROUP BY hook HAVING count(*) >= 10")
def hook_performance(spark, sf):
    out = rel.pattern_metrics(ads(spark, sf), ["hook"], "days_active", 10).drop("sharpe")
    return out.withColumns({c: F.round(c, 4) for c in ("mean", "deviation")})


@query(f"WITH {ADS}, p AS (SELECT page_id, count(DISTINCT ad_id) AS n FROM ads GROUP BY page_id) SELECT ad_id, coalesce(n, 1) AS brand_scaling_count FROM ads LEFT JOIN p USING (page_id)")
def brand_scaling(spark, sf):
    return scoring.brand_scaling(ads(spark, sf)).select("ad_id", "brand_scaling_count")


@query(f"WITH {ADS}, c AS (SELECT end_date, count(*) AS n FROM ads WHERE end_date IS NOT NULL GROUP BY end_date) SELECT CAST(end_date AS VARCHAR) AS end_date, n FROM c WHERE n > 0.01 * (SELECT sum(n) FROM c) AND n >= 5")
def scrape_dates(spark, sf):
    return survival.scrape_dates(ads(spark, sf)).withColumn("end_date", F.col("end_date").cast("string"))


@query("SELECT c_nationkey AS value, count(*) AS count FROM customer WHERE c_nationkey IS NOT NULL GROUP BY 1 HAVING count(*) < 70")
def thin_categories(spark, sf):
    return st.thin_categories(table(spark, sf, "customer"), "c_nationkey", 70)


@query("""SELECT conv_id, '[' || string_agg('{"role":"' || role || '","chars":' || length(text) || '}', ',' ORDER BY turn) || ']' AS messages, count(*) AS turns FROM conversations GROUP BY conv_id HAVING count(*) >= 2""")
def sft_messages(spark, sf):
    """Chat rows for fine-tuning, texts by their length."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "role", F.length("text").alias("chars"))))
    rows = table(spark, sf, "conversations").groupBy("conv_id").agg(turns.alias("t"), F.count("*").alias("turns")).filter("turns >= 2")
    return rows.select("conv_id", F.to_json(F.transform("t", lambda x: F.struct(x["role"].alias("role"), x["chars"].alias("chars")))).alias("messages"), "turns")


@query("""WITH o AS (SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice / l_quantity AS unit, l_returnflag = 'R' AS best,
  row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS pos FROM lineitem)
SELECT l_orderkey, pos AS chosen, unit FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY CASE WHEN best THEN 0 WHEN l_quantity = 1 THEN 1 ELSE 2 END,
  CASE WHEN best OR l_quantity = 1 THEN 0 ELSE unit END, pos) AS rn FROM o) WHERE rn = 1""")
def best_offer(spark, sf):
    offers = F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity", "l_returnflag")))
    rows = table(spark, sf, "lineitem").groupBy("l_orderkey").agg(offers.alias("o"))
    shaped = F.transform("o", lambda x, i: F.struct((i + 1).alias("pos"), x["l_quantity"].alias("quantity"), (x["l_extendedprice"] / x["l_quantity"]).alias("price_per_unit"), (x["l_returnflag"] == "R").alias("is_best_value")))
    best = rel.best_offer(shaped)
    return rows.select("l_orderkey", best["pos"].cast("long").alias("chosen"), best["price_per_unit"].alias("unit"))
