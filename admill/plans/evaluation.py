"""Queries of reference labels, reviews, samples, windows and data-quality reports."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from admill.operators import evaluation as ev, modelling, relational as rel, scoring, statistics as st, windows
from admill.operators.storage import shared_dir, stored
from admill.plans.ordered import _SCORED
from admill.plans.registry import query
from admill.plans.statistics import halves, judged, rounded
from admill.plans.views import ADS, AS_OF, ads, table
from admill.sources import publishing

_JUDGED = "j AS (SELECT d.doc_id, NOT contains(text, '&&&') AS predicted, length(text) > 300 AS longer, quality = 1 AS actual, toxic = 1 AS toxic FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"


@query(f"WITH {_JUDGED} SELECT 'predicted' AS field, count(*) AS n, count(*) FILTER (predicted = actual) AS correct, round(count(*) FILTER (predicted = actual) / count(*), 6) AS accuracy FROM j UNION ALL SELECT 'judged', count(*), count(*) FILTER (actual), round(count(*) FILTER (actual) / count(*), 6) FROM j")
def boolean_accuracy(spark, sf):
    rows = judged(spark, sf)
    both = ev.boolean_accuracy(rows, "predicted", "actual").withColumn("field", F.lit("predicted")).unionByName(ev.judgment_rate(rows, "actual").withColumn("field", F.lit("judged")))
    return rounded(both)


@query("""WITH o AS (SELECT l_orderkey, CASE l_returnflag WHEN 'R' THEN 'real_offer' WHEN 'A' THEN 'cart_subtotal_widget' END AS context, CASE WHEN l_discount > 0.02 THEN l_extendedprice END AS price FROM lineitem),
g AS (SELECT o_orderkey, CASE o_orderpriority WHEN '1-URGENT' THEN 'real_offer' WHEN '2-HIGH' THEN 'cart_subtotal_widget' END AS e, o_orderstatus <> 'F' AS r FROM orders),
k AS (SELECT l_orderkey, count(*) FILTER (price IS NOT NULL AND coalesce(context, '') <> 'cart_subtotal_widget') > 0 AS rec FROM o GROUP BY 1),
c AS (SELECT l_orderkey, context, row_number() OVER (PARTITION BY l_orderkey ORDER BY count(*) DESC, context) AS rn FROM o WHERE context IS NOT NULL GROUP BY 1, 2)
SELECT count(*) AS n, count(e) AS n_with_context, round(count(*) FILTER (coalesce(rec, false) = r) / count(*), 6) AS recoverable_accuracy, round(count(*) FILTER (context = e) / count(e), 6) AS context_accuracy
FROM g LEFT JOIN k ON k.l_orderkey = o_orderkey LEFT JOIN c ON c.l_orderkey = o_orderkey AND rn = 1""")
def price_context_accuracy(spark, sf):
    context = F.when(F.col("l_returnflag") == "R", "real_offer").when(F.col("l_returnflag") == "A", "cart_subtotal_widget")
    offers = table(spark, sf, "lineitem").select(F.col("l_orderkey").alias("url"), context.alias("context"), F.when(F.col("l_discount") > 0.02, F.col("l_extendedprice")).alias("price"))
    expected = F.when(F.col("o_orderpriority") == "1-URGENT", "real_offer").when(F.col("o_orderpriority") == "2-HIGH", "cart_subtotal_widget")
    golden = table(spark, sf, "orders").select(F.col("o_orderkey").alias("url"), expected.alias("expected_context"), (F.col("o_orderstatus") != "F").alias("expected_recoverable"))
    return rounded(ev.price_context_accuracy(golden, offers))


@query("""WITH c AS (SELECT doc_id, length(text) > 300 AS predicted, (doc_id % 100) / 100.0 AS confidence FROM documents),
t AS (SELECT doc_id, quality = 1 AS truth FROM labels),
m AS (SELECT predicted, truth, confidence FROM c JOIN t USING (doc_id))
SELECT count(*) FILTER (predicted AND truth) AS tp, count(*) FILTER (predicted AND NOT truth) AS fp, count(*) FILTER (NOT predicted AND truth) AS fn, count(*) FILTER (NOT predicted AND NOT truth) AS tn, count(*) FILTER (confidence >= 0.6 AND confidence < 0.8) AS borderline FROM m""")
def truth_by_id_or_place(spark, sf):
    """Documents of odd ids carry no id in the truth table and are found by their place."""
    docs = table(spark, sf, "documents").select(F.col("doc_id").cast("string").alias("id"), F.col("doc_id").alias("place"), (F.length("text") > 300).alias("predicted"), (F.col("doc_id") % 100 / 100.0).alias("confidence"))
    truth = table(spark, sf, "labels").select(F.when(F.col("doc_id") % 2 == 0, F.col("doc_id").cast("string")).alias("id"), F.col("doc_id").alias("place"), (F.col("quality") == 1).alias("truth"))
    met = ev.with_truth(docs, truth, "id", "place")
    p, t = F.col("predicted"), F.col("truth")
    return met.agg(F.count_if(p & t).alias("tp"), F.count_if(p & ~t).alias("fp"), F.count_if(~p & t).alias("fn"), F.count_if(~p & ~t).alias("tn"), F.count_if(ev.borderline(F.col("confidence"))).alias("borderline"))


@query("""SELECT c_custkey AS custkey, 'missing' AS gap FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey IS NOT NULL)
UNION ALL SELECT DISTINCT o_custkey, 'extra' FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer)""")
def review_gaps(spark, sf):
    return ev.review_gaps(table(spark, sf, "customer").select(F.col("c_custkey").alias("custkey")), table(spark, sf, "orders").select(F.col("o_custkey").alias("custkey")), "custkey")


@query("""SELECT (SELECT count(*) FROM documents) AS n_left, (SELECT count(*) FROM labels) AS n_right, (SELECT count(*) FROM documents) = (SELECT count(*) FROM labels)
AND NOT EXISTS (SELECT 1 FROM documents d FULL JOIN labels l ON l.doc_id = d.doc_id WHERE d.doc_id IS NULL OR l.doc_id IS NULL) AS equal""")
def exact_set_gate(spark, sf):
    return ev.same_ids(table(spark, sf, "documents"), table(spark, sf, "labels"), "doc_id")


_REVIEWS = """r AS (SELECT l.doc_id, quality = 1 AS p, CASE WHEN length(text) % 2 = 0 THEN quality = 1 WHEN length(text) % 7 = 1 THEN toxic = 1 END AS s, CASE WHEN length(text) % 3 <> 0 THEN quality = 1 END AS a, lang FROM labels l JOIN documents d ON d.doc_id = l.doc_id),
o AS (SELECT *, CASE WHEN s IS NULL THEN 'primary' WHEN s = p AND (NOT p OR true) THEN 'agreed' WHEN a IS NULL THEN 'adjudication_missing' WHEN lang = 'es' THEN 'rationale_missing' ELSE 'adjudicated' END AS outcome FROM r)"""


def reviews(spark, sf):
    """Labels as reviews: some are seen twice, some disputes are decided, Spanish decisions lack a reason."""
    size = F.length("text")
    d = lambda who, label, why: F.struct(F.lit(who).alias("reviewer"), label.alias("label"), F.lit("x").alias("subcategory"), why.alias("rationale"))
    rows = table(spark, sf, "labels").join(table(spark, sf, "documents").select("doc_id", "text", "lang"), "doc_id")
    good, bad = F.col("quality") == 1, F.col("toxic") == 1
    why = F.when(F.col("lang") != "es", "seen").otherwise(" ")
    second = F.when(size % 2 == 0, d("b", good, why)).when(size % 7 == 1, d("b", bad, why))
    return rows.select(F.col("doc_id").alias("ad_id"), d("a", good, why).alias("primary"), second.alias("secondary"), F.when(size % 3 != 0, d("c", good, why)).alias("adjudication"))


@query(f"WITH {_REVIEWS} SELECT outcome, count(*) AS n, count(*) FILTER (outcome IN ('primary', 'agreed') AND p OR outcome = 'adjudicated' AND a) AS n_true FROM o GROUP BY outcome")
def adjudication_outcomes(spark, sf):
    return ev.adjudicated(reviews(spark, sf)).groupBy("outcome").agg(F.count("*").alias("n"), F.count_if("final_label").alias("n_true"))


@query(f"""WITH {_REVIEWS}, k AS (SELECT count(*) AS n, avg(CASE WHEN p = s THEN 1.0 ELSE 0 END) AS o, avg(CASE WHEN p THEN 1.0 ELSE 0 END) AS x, avg(CASE WHEN s THEN 1.0 ELSE 0 END) AS y FROM o WHERE s IS NOT NULL)
SELECT count(*) AS n_reviews, count(*) FILTER (outcome IN ('primary', 'agreed', 'adjudicated')) AS n_final_labels, count(*) FILTER (outcome IN ('adjudication_missing', 'rationale_missing')) AS n_invalid,
count(*) FILTER (outcome IN ('adjudicated', 'adjudication_missing', 'rationale_missing')) AS n_disagreements, count(*) FILTER (outcome = 'adjudicated') AS n_adjudicated,
max(k.n) AS n_double_reviewed, round(max((o - (x * y + (1 - x) * (1 - y))) / (1 - (x * y + (1 - x) * (1 - y)))), 6) AS kappa, 'failed' AS status, CAST(0 AS BIGINT) AS n_approved FROM o, k""")
def adjudication_report(spark, sf):
    r = reviews(spark, sf)
    out = ev.adjudication_report(r.select("ad_id"), r)
    return rounded(out.select("n_reviews", "n_final_labels", "n_invalid", "n_disagreements", "n_adjudicated", "n_double_reviewed", "kappa", "status", "n_approved"))


@query("""SELECT 'count_differs' AS reason, abs(count(*) - 10) AS n FROM labels UNION ALL SELECT 'label_not_true', count(*) FILTER (quality <> 1) FROM labels HAVING count(*) FILTER (quality <> 1) > 0
UNION ALL SELECT 'sample_differs', count(*) FILTER (toxic = 1) FROM labels HAVING count(*) FILTER (toxic = 1) > 0""")
def approved_label_check(spark, sf):
    labels = table(spark, sf, "labels").select((F.col("quality") == 1).alias("label"), F.when(F.col("toxic") == 1, "other").otherwise("h").alias("sample_hash"))
    return ev.unapproved(labels, "passed", "h", 10)


@query("SELECT o_orderkey FROM orders ORDER BY sha256('42:' || o_orderkey), o_orderkey LIMIT 100")
def random_sample(spark, sf):
    return ev.random_sample(table(spark, sf, "orders").select("o_orderkey"), "o_orderkey", 100)


@query("""WITH have AS (SELECT p_brand, count(*) AS h FROM part WHERE p_size = 1 GROUP BY 1), n AS (SELECT part.p_brand, p_partkey, row_number() OVER (PARTITION BY part.p_brand ORDER BY CASE WHEN p_size > 40 THEN 0 ELSE 1 END, sha256('42:' || p_partkey), p_partkey) AS place, coalesce(h, 0) AS h
FROM part LEFT JOIN have ON have.p_brand = part.p_brand WHERE p_size <> 1) SELECT p_brand, p_partkey, CAST(place AS BIGINT) AS place FROM n WHERE place <= 6 - h""")
def shortfall_sample(spark, sf):
    part = table(spark, sf, "part").select("p_brand", "p_partkey", "p_size")
    out = ev.shortfall_sample(part, part.filter("p_size = 1"), "p_brand", "p_partkey", F.col("p_size") > 40)
    return out.select("p_brand", "p_partkey", F.col("place").cast("long").alias("place"))


_DAY = "TIMESTAMP '2024-01-03'"


def window_ads(rows):
    return rows.groupBy(F.col("user_id").alias("ad_id")).agg((F.min("user_id") % 50).alias("page_id"), F.min("ts").alias("observed_at"))


def parts(spark, sf):
    e, day = table(spark, sf, "events"), F.lit("2024-01-03").cast("timestamp")
    return window_ads(e.filter(F.col("ts") >= day)), window_ads(e.filter(F.col("ts") < day)), e.select(F.col("user_id").alias("ad_id"), (F.col("value") > 10).alias("poll_complete"))


@query(f"""WITH a AS (SELECT user_id AS ad_id, min(user_id) % 50 AS page_id, min(ts) AS seen FROM events WHERE ts >= {_DAY} GROUP BY 1), b AS (SELECT user_id AS ad_id, min(user_id) % 50 AS page_id, min(ts) AS seen FROM events WHERE ts < {_DAY} GROUP BY 1),
o AS (SELECT count(*) AS n, count(*) FILTER (value > 10) AS c FROM events WHERE user_id IN (SELECT ad_id FROM a))
SELECT count(*) AS n_ads, count(DISTINCT page_id) AS n_advertisers, min(seen) AS observed_at_min, max(seen) AS observed_at_max, max(o.n) AS n_observations, max(o.c) AS complete_observations, count(*) FILTER (ad_id NOT IN (SELECT ad_id FROM b)) AS n_new_ads, count(*) FILTER (ad_id IN (SELECT ad_id FROM b)) AS n_existing_ads,
count(DISTINCT page_id) FILTER (page_id NOT IN (SELECT page_id FROM b)) AS n_new_advertisers, CASE WHEN min(seen) > (SELECT max(seen) FROM b) THEN 'after_previous_window' ELSE 'not_proven_after_previous_window' END AS temporal_order,
min(seen) > (SELECT max(seen) FROM b) AND count(*) FILTER (ad_id NOT IN (SELECT ad_id FROM b)) > 0 AS eligible FROM a, o""")
def window_summary(spark, sf):
    now, before, polls = parts(spark, sf)
    return windows.window_summary(now, polls, before)


def chained(spark, sf):
    """The ads and polls of two windows, with times as whole microseconds."""
    now, before, polls = parts(spark, sf)
    timed = lambda rows: rows.withColumn("observed_at", F.unix_micros(F.col("observed_at").cast("timestamp")))
    return timed(now), timed(before), polls.withColumn("poll_complete", F.col("poll_complete").cast("string"))


_CHAIN = f"""WITH a AS (SELECT user_id AS ad_id, min(user_id) % 50 AS page_id, epoch_us(min(ts)) AS observed_at FROM events WHERE ts >= {_DAY} GROUP BY 1), b AS (SELECT user_id AS ad_id, min(user_id) % 50 AS page_id, epoch_us(min(ts)) AS observed_at FROM events WHERE ts < {_DAY} GROUP BY 1),
o AS (SELECT user_id AS ad_id, value > 10 AS poll_complete FROM events),
m AS (SELECT {windows.content_hash_sql("b", ["ad_id"])} AS ad_ids_sha256, {windows.content_hash_sql("b", ["ad_id", "page_id", "observed_at"])} AS ads_sha256, NULL::VARCHAR AS observations_sha256, NULL::VARCHAR AS previous_window_id, 'baseline' AS role),
n AS (SELECT *, sha256('{{"ad_ids_sha256":"' || ad_ids_sha256 || '","ads_sha256":"' || ads_sha256 || '","observations_sha256":null,"previous_window_id":null,"role":"' || role || '"}}') AS window_id FROM m),
p AS (SELECT {windows.content_hash_sql("a", ["ad_id"])} AS ad_ids_sha256, {windows.content_hash_sql("a", ["ad_id", "page_id", "observed_at"])} AS ads_sha256, {windows.content_hash_sql("o", ["ad_id", "poll_complete"])} AS observations_sha256, window_id AS previous_window_id, 'future_holdout' AS role FROM n)
SELECT *, sha256('{{"ad_ids_sha256":"' || ad_ids_sha256 || '","ads_sha256":"' || ads_sha256 || '","observations_sha256":"' || observations_sha256 || '","previous_window_id":"' || previous_window_id || '","role":"' || role || '"}}') AS window_id FROM p UNION ALL SELECT * FROM n"""


@query(_CHAIN)
def window_chain(spark, sf):
    """Two frozen windows, the second bound to the first."""
    now, before, polls = chained(spark, sf)
    first = stored(windows.window_manifest(before), "window")
    fields = [*windows.SOURCE, "window_id"]
    return first.select(*fields).unionByName(windows.window_manifest(now, polls, first, before).select(*fields))


@query("""SELECT CAST(o_orderkey AS BIGINT) AS o_orderkey, CASE WHEN o_orderstatus = 'O' THEN 'CHANGED' ELSE o_orderpriority END AS o_orderpriority FROM orders UNION ALL SELECT -o_orderkey, 'ADDED' FROM orders WHERE o_orderstatus = 'F' AND o_orderkey > 0""")
def bucketed_upsert(spark, sf):
    """Orders in buckets, with open ones changed and closed ones added again under new keys."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").cast("long").alias("o_orderkey"), "o_orderpriority", "o_orderstatus")
    path = f"{shared_dir(spark)}/admill-{spark.sparkContext.applicationId}/upserted-{uuid.uuid4().hex}"
    changed = orders.filter("o_orderstatus = 'O'").withColumn("o_orderpriority", F.lit("CHANGED"))
    added = orders.filter("o_orderstatus = 'F' AND o_orderkey > 0").withColumn("o_orderkey", -F.col("o_orderkey")).withColumn("o_orderpriority", F.lit("ADDED"))
    publishing.upsert_buckets(orders, path, "o_orderkey")
    publishing.upsert_buckets(changed.unionByName(added), path, "o_orderkey")
    return spark.read.parquet(path).select("o_orderkey", "o_orderpriority")


@query("SELECT 'observations' AS role, count(*) AS n, 0 AS problems FROM events UNION ALL SELECT 'orders', count(*), 0 FROM orders")
def handoff_bundle(spark, sf):
    """Two tables published as one bundle, verified and read back."""
    path = f"{shared_dir(spark)}/admill-{spark.sparkContext.applicationId}/bundle-{uuid.uuid4().hex}"
    tables = {"orders": table(spark, sf, "orders"), "observations": table(spark, sf, "events")}
    publishing.publish_bundle(tables, path, "v1")
    problems = publishing.verify_bundle(spark, path, list(tables)).agg(F.count("*").cast("int").alias("problems"))
    read = [spark.read.parquet(f"{path}/{r}").agg(F.lit(r).alias("role"), F.count("*").alias("n")) for r in tables]
    return read[0].unionByName(read[1]).join(F.broadcast(problems))


@query(f"""WITH a AS (SELECT count(DISTINCT user_id) AS n FROM events WHERE ts >= {_DAY}), b AS (SELECT count(DISTINCT user_id) AS n FROM events) SELECT 'n_ids' AS field, CAST(a.n AS VARCHAR) AS recorded, CAST(b.n AS VARCHAR) AS rebuilt FROM a, b WHERE a.n <> b.n""")
def window_verification(spark, sf):
    """A summary recorded of a part doesn't hold for the whole."""
    e = table(spark, sf, "events")
    part = e.filter(F.col("ts") >= F.lit("2024-01-03").cast("timestamp"))
    return windows.mismatches(windows.identity(part, "user_id").select("n_ids"), windows.identity(e, "user_id").select("n_ids"))


@query("""WITH t AS (SELECT * FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'), u AS (SELECT * FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01')
SELECT 'o_custkey' AS key, count(*) AS shared, count(*) = 0 AS apart FROM (SELECT DISTINCT o_custkey FROM t INTERSECT SELECT o_custkey FROM u) UNION ALL SELECT 'o_orderkey', count(*), count(*) = 0 FROM (SELECT DISTINCT o_orderkey FROM t INTERSECT SELECT o_orderkey FROM u)""")
def leakage(spark, sf):
    return windows.leakage(*halves(spark, sf), ["o_custkey", "o_orderkey"])


@query(f"""WITH {ADS} SELECT count(*) AS n_test, count(DISTINCT page_id) AS n_test_groups, round(avg(abs(price - (20 + collation_count * 5.0))), 6) AS test_mae, round(avg(abs(price - 30)), 6) AS baseline_mae, round(avg(20 + collation_count * 5.0) - avg(price), 6) AS calibration_gap FROM ads WHERE start_date >= DATE '2000-01-01'""")
def future_window_score(spark, sf):
    rows = ads(spark, sf).filter("start_date >= DATE '2000-01-01'").select(F.col("price").alias("actual"), (20 + F.col("collation_count") * 5.0).alias("prediction"), F.col("page_id").alias("group"), F.col("hook").alias("segment"))
    return rounded(windows.future_score(rows, 30.0)[0])


@query(f"WITH {ADS} SELECT ad_id, coalesce(abs(date_diff('day', start_date, coalesce(end_date, DATE '{AS_OF}')) - 30) <= 1 OR (end_date IS NOT NULL AND date_diff('day', start_date, end_date) < 30), false) AS followed FROM ads")
def follow_up(spark, sf):
    return ads(spark, sf).select("ad_id", windows.follow_up(F.col("start_date"), F.col("end_date"), F.lit(AS_OF).cast("date"), 30).alias("followed"))


_COLUMNS = ("user_id", "event_type", "value", "late")


@query("""WITH e AS (SELECT user_id, event_type, CASE WHEN value > 60 THEN NULL ELSE value END AS value, ts >= TIMESTAMP '2024-01-03' AS late FROM events), n AS (SELECT count(*) AS n FROM e),
v AS (SELECT 'event_type' AS c, CAST(event_type AS VARCHAR) AS v FROM e UNION ALL SELECT 'value', CAST(value AS VARCHAR) FROM e UNION ALL SELECT 'late', CAST(late AS VARCHAR) FROM e),
k AS (SELECT c, v, count(*) AS k FROM v WHERE v IS NOT NULL GROUP BY 1, 2), s AS (SELECT c, count(*) AS distinct_, sum(k) AS known, max(k) AS most FROM k GROUP BY 1),
f AS (SELECT c, CASE c WHEN 'value' THEN 'numeric' WHEN 'late' THEN 'boolean' ELSE 'categorical' END AS kind, n, 1 - known / n AS null_rate, distinct_,
  array_to_string(list_filter([CASE WHEN 1 - known / n >= 0.3 THEN 'high_null_rate' END, CASE WHEN c IN ('value', 'late') AND distinct_ = 1 AND known > 1 THEN 'zero_variance' END,
  CASE WHEN (c = 'value' AND distinct_ > 1 OR c = 'event_type') AND most / known >= 0.4 THEN 'high_point_mass' END, CASE WHEN c = 'event_type' AND distinct_ / known >= 0.5 AND distinct_ > 20 THEN 'high_cardinality' END], lambda x: x IS NOT NULL), ',') AS flags FROM s, n),
u AS (SELECT c, kind, n, null_rate, distinct_, flags FROM f UNION ALL SELECT 'user_id', 'id', n, 0, NULL, '' FROM n)
SELECT c AS "column", kind, n, round(null_rate, 6) AS null_rate, distinct_ AS "distinct", flags, CASE WHEN flags <> '' THEN CAST(row_number() OVER (PARTITION BY flags <> '' ORDER BY null_rate DESC, c) AS INT) END AS flag_rank FROM u""")
def data_quality_report(spark, sf):
    e = table(spark, sf, "events")
    rows = e.select("user_id", "event_type", F.when(F.col("value") <= 60, F.col("value")).alias("value"), (F.col("ts") >= F.lit("2024-01-03").cast("timestamp")).alias("late"))
    return rounded(st.quality_report(rows, ["user_id"], []))


@query("SELECT v AS variant, f AS n_features, round(n / f, 2) AS rows_per_feature, CASE WHEN f >= n THEN 'features_exceed_rows' WHEN n / f < 10 THEN 'thin_ratio' END AS flag FROM (SELECT count(*) AS n FROM labels), (VALUES ('plain', CAST(4 AS BIGINT)), ('wide', 60), ('embedded', 3207)) x(v, f)")
def rows_per_feature(spark, sf):
    return st.dimensionality(table(spark, sf, "labels").count(), {"plain": 4, "wide": 60, "embedded": 3207}, spark)


@query()
def target_tests(spark, sf):
    """Probabilities of r, F and t; no SQL function has them, so tests hold them against published tables."""
    rows = ads(spark, sf)
    r = st.pearson_test(rows, "price", "days_active").select(F.lit("pearson").alias("test"), F.col("r").alias("statistic"), "p")
    f = st.anova_test(rows, "hook", "price").select(F.lit("anova").alias("test"), F.col("f").alias("statistic"), "p")
    t = st.welch_test(rows, "end_date", "price").select(F.lit("welch").alias("test"), F.col("t").alias("statistic"), "p")
    return r.unionByName(f).unionByName(t)


@query(f"""WITH {_SCORED}, f AS (SELECT ad_id, {", ".join(f"round({w[0]!r} * pd + {w[1]!r} * pd * ps + {w[2]!r} * pc, 9) AS s{i}" for i, w in enumerate(scoring.SCENARIOS.values()))} FROM p),
r AS (SELECT ad_id, {", ".join(f"rank() OVER (ORDER BY s{i}) + (count(*) OVER (PARTITION BY s{i}) - 1) / 2.0 AS r{i}, row_number() OVER (ORDER BY s{i} DESC, ad_id) <= ceil(0.2 * count(*) OVER ()) AS t{i}" for i in range(len(scoring.SCENARIOS)))} FROM f)
{" UNION ALL ".join(f"SELECT '{k}' AS scenario, round(corr(r0, r{i}), 5) AS spearman, round(count(*) FILTER (t0 AND t{i}) / count(*) FILTER (t0 OR t{i}), 5) AS top_jaccard FROM r" for i, k in enumerate(scoring.SCENARIOS))}""")
def sensitivity_scenarios(spark, sf):
    return rounded(scoring.sensitivity(scoring.with_percentiles(scoring.brand_scaling(ads(spark, sf)))), 5)


@query("SELECT vec_id, label, " + ", ".join(f"CASE WHEN label % 5 <> 0 THEN CAST(embedding[{i + 1}] AS DOUBLE) END AS embedding_{i}" for i in range(8)) + " FROM embeddings")
def expanded_embeddings(spark, sf):
    rows = table(spark, sf, "embeddings").withColumn("embedding", F.when(F.col("label") % 5 != 0, F.col("embedding")).otherwise(F.array().cast("array<float>")))
    return modelling.expanded_vectors(rows, "embedding", 8)


@query(f"WITH {ADS} SELECT price, hook, segment, collation_count, CAST(days_active AS DOUBLE) AS y FROM ads")
def model_inputs(spark, sf):
    rows = ads(spark, sf)
    return modelling.inputs_and_target(rows, "days_active", ["ad_id", "page_id"], ["days_active"], ["is_active", "start_date", "end_date"])


@query("""WITH c AS (SELECT p_brand AS feature, round(corr(p_size, p_retailprice), 9) AS coefficient FROM part GROUP BY 1) SELECT feature, coefficient FROM c ORDER BY abs(coefficient) DESC, feature LIMIT 20""")
def top_coefficients(spark, sf):
    fitted = table(spark, sf, "part").groupBy(F.col("p_brand").alias("feature")).agg(F.round(F.corr("p_size", "p_retailprice"), 9).alias("coefficient"))
    return modelling.top_coefficients(fitted)


_META = [("price", "numeric", "Price of the product"), ("hook", "categorical", "Framing of the message"), ("collation_count", "numeric", "Variants shown together")]


@query(f"""WITH {ADS}, p AS (SELECT * FROM (VALUES ('price', (SELECT 1 - count(price) / count(*) FROM ads)), ('hook', (SELECT 1 - count(hook) / count(*) FROM ads)), ('end_date', (SELECT 1 - count(end_date) / count(*) FROM ads))) v(feature, null_rate)),
m AS (SELECT * FROM (VALUES {", ".join(f"('{a}', '{b}', '{c}')" for a, b, c in _META)}) v(feature, kind, meaning)),
i AS (SELECT * FROM (VALUES ('price', (SELECT corr(price, days_active) FROM ads)), ('collation_count', (SELECT corr(collation_count, days_active) FROM ads))) v(feature, importance))
SELECT feature, coalesce(kind, 'numeric') AS kind, coalesce(meaning, 'not documented') AS meaning, round(null_rate, 6) AS null_rate, round(importance, 6) AS importance FROM p LEFT JOIN m USING (feature) LEFT JOIN i USING (feature)""")
def validation_report(spark, sf):
    """Profiles, what the registry knows of each feature, and how a model ranks it."""
    rows = ads(spark, sf)
    one = rows.agg(*[(1 - F.count(c) / F.count("*")).alias(c) for c in ("price", "hook", "end_date")])
    profile = one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("null_rate")) for c in ("price", "hook", "end_date")])).alias("x")).select("x.*")
    known = spark.createDataFrame(_META, "feature string, kind string, meaning string")
    gains = rows.agg(F.corr("price", "days_active").alias("price"), F.corr("collation_count", "days_active").alias("collation_count"))
    gains = gains.select(F.explode(F.array(*[F.struct(F.lit(c).alias("feature"), F.col(c).alias("importance")) for c in ("price", "collation_count")])).alias("x")).select("x.*")
    return rounded(rel.described(profile, known, gains))


@query("""SELECT count(*) FILTER (ts >= TIMESTAMP '2024-01-03') AS n_new, max(ts) AS newest, count(*) FILTER (ts >= TIMESTAMP '2024-01-03') >= 50 AS retrain, date_diff('day', CAST(max(ts) AS DATE), DATE '2024-03-01') > 7 AS stale FROM events""")
def freshness(spark, sf):
    return rel.freshness(table(spark, sf, "events"), "ts", F.lit("2024-01-03").cast("timestamp"), F.lit("2024-03-01").cast("date"))


@query(f"""WITH {ADS} SELECT count(*) AS total, count(f.l_orderkey) AS matched, count(*) FILTER (f.l_orderkey IS NOT NULL AND big > 0) AS with_flag FROM ads LEFT JOIN (SELECT l_orderkey, count(*) FILTER (l_quantity > 45) AS big FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) f ON f.l_orderkey = ad_id""")
def feature_merge(spark, sf):
    """Ads keep their row whether or not features were extracted."""
    f = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").groupBy(F.col("l_orderkey").alias("ad_id")).agg(F.count_if(F.col("l_quantity") > 45).alias("big"))
    return rel.attached(ads(spark, sf), f, "ad_id", "creative_features").agg(F.count("*").alias("total"), F.count("creative_features").alias("matched"), F.count_if(F.col("creative_features.big") > 0).alias("with_flag"))


@query(f"WITH {ADS} SELECT upper(trim(hook)) AS hook, count(*) AS n, round(avg(price), 6) AS mean_price FROM ads JOIN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1) f ON f.l_orderkey = ad_id GROUP BY 1")
def extraction_join(spark, sf):
    from admill.functions.text import standardised

    f = table(spark, sf, "lineitem").filter("l_returnflag = 'R'").select(F.col("l_orderkey").alias("ad_id")).distinct()
    return rounded(ads(spark, sf).join(f, "ad_id").groupBy(standardised(F.col("hook")).alias("hook")).agg(F.count("*").alias("n"), F.avg("price").alias("mean_price")))


@query("""SELECT o_orderkey AS ad_id FROM orders WHERE o_orderkey IS NOT NULL AND o_orderstatus <> 'F'""")
def active_tracked(spark, sf):
    rows = ads(spark, sf)
    return rows.filter(rel.tracked(F.col("ad_id"), F.col("end_date"))).select("ad_id")
