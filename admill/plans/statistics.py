"""Queries of data quality, drift, agreement and evidence."""

from __future__ import annotations

from pyspark.sql import functions as F

from admill.operators import statistics as st
from admill.plans.registry import query
from admill.plans.views import ADS, ads, table


def rounded(df, places: int = 6):
    return df.withColumns({c: F.round(c, places) for c, kind in df.dtypes if kind == "double"})


@query("""WITH v AS (SELECT 'l_quantity' AS "column", l_quantity AS x FROM lineitem UNION ALL SELECT 'l_discount', CASE WHEN l_linenumber % 3 <> 0 THEN l_discount END FROM lineitem UNION ALL SELECT 'l_linenumber', l_linenumber FROM lineitem),
m AS (SELECT "column", arg_max(x, k * 1e6 - x) AS point_mass_value, max(k) / sum(k) AS point_mass_fraction FROM (SELECT "column", x, count(*) AS k FROM v WHERE x IS NOT NULL GROUP BY ALL) GROUP BY 1),
s AS (SELECT "column", count(*) AS n, 1 - count(x) / count(*) AS null_rate, avg(x) AS mean, median(x) AS median, min(x) AS min, max(x) AS max, stddev_pop(x) AS stdev FROM v GROUP BY 1)
SELECT "column", n, round(null_rate, 6) AS null_rate, round(mean, 6) AS mean, round(median, 6) AS median, round(min, 6) AS min, round(max, 6) AS max, round(stdev, 6) AS stdev,
round(point_mass_value, 6) AS point_mass_value, round(point_mass_fraction, 6) AS point_mass_fraction, array_to_string(list_filter([CASE WHEN null_rate >= 0.3 THEN 'high_null_rate' END,
CASE WHEN round(stdev, 4) = 0 AND n > 1 THEN 'zero_variance' END, CASE WHEN round(stdev, 4) <> 0 AND point_mass_fraction >= 0.4 THEN 'high_point_mass' END], lambda f: f IS NOT NULL), ',') AS flags FROM s JOIN m USING ("column")""")
def column_profile(spark, sf):
    rows = table(spark, sf, "lineitem").withColumn("l_discount", F.when(F.col("l_linenumber") % 3 != 0, F.col("l_discount")))
    return rounded(st.profile(rows, ["l_quantity", "l_discount", "l_linenumber"]))


@query("""WITH r AS (SELECT value AS x, row_number() OVER (ORDER BY value) - 1 AS i, count(*) OVER () AS n FROM events WHERE value IS NOT NULL), q AS (SELECT max(n) AS n, max(CASE WHEN i = n // 4 THEN x END) AS q1, max(CASE WHEN i = 3 * n // 4 THEN x END) AS q3 FROM r)
SELECT q.n, q1, q3, round(count(*) FILTER (x < q1 - 1.5 * (q3 - q1) OR x > q3 + 1.5 * (q3 - q1)) / count(*), 6) AS outlier_rate FROM r, q GROUP BY q.n, q1, q3""")
def iqr_outliers(spark, sf):
    return st.iqr_outlier_rate(table(spark, sf, "events"), "value").withColumn("outlier_rate", F.round("outlier_rate", 6))


@query("SELECT arg_max(p_size, n * 1000 - p_size) AS value, round(max(n) / sum(n), 6) AS share FROM (SELECT p_size, count(*) AS n FROM part GROUP BY p_size)")
def point_mass(spark, sf):
    return rounded(st.point_mass(table(spark, sf, "part"), "p_size"))


@query(f"WITH {ADS} SELECT round(corr(days_active, price), 6) AS r_price, round(corr(days_active, collation_count), 6) AS r_collation, count(*) AS n FROM ads")
def target_correlation(spark, sf):
    return rounded(ads(spark, sf).agg(F.corr("days_active", "price").alias("r_price"), F.corr("days_active", "collation_count").alias("r_collation"), F.count("*").alias("n")))


@query("""WITH g AS (SELECT o_orderpriority, count(*) AS n, avg(o_totalprice) AS m, var_pop(o_totalprice) AS v FROM orders GROUP BY 1 HAVING count(*) >= 2), t AS (SELECT sum(n) AS n, count(*) AS k, sum(n * m) / sum(n) AS gm, sum(n * v) AS w FROM g)
SELECT CAST(max(t.n) AS BIGINT) AS n, max(k) AS n_groups, round((sum(g.n * (m - gm) * (m - gm)) / (max(k) - 1)) / (max(w) / (max(t.n) - max(k))), 5) AS f FROM g, t""")
def anova_f(spark, sf):
    return rounded(st.anova(table(spark, sf, "orders"), "o_orderpriority", "o_totalprice"), 5)


@query("""WITH r AS (SELECT o_orderkey % 7 = 0 AS gone, o_totalprice AS y FROM orders), s AS (SELECT count(*) FILTER (gone) AS n_null, count(*) FILTER (NOT gone) AS n_non_null, avg(y) FILTER (gone) AS mean_null, avg(y) FILTER (NOT gone) AS mean_non_null,
var_samp(y) FILTER (gone) AS a, var_samp(y) FILTER (NOT gone) AS b FROM r) SELECT n_null, n_non_null, round(mean_null, 4) AS mean_null, round(mean_non_null, 4) AS mean_non_null, round((mean_null - mean_non_null) / sqrt(a / n_null + b / n_non_null), 4) AS t FROM s""")
def missingness_bias(spark, sf):
    rows = table(spark, sf, "orders").select(F.when(F.col("o_orderkey") % 7 != 0, F.lit(1)).alias("x"), "o_totalprice")
    return rounded(st.welch(rows, "x", "o_totalprice"), 4)


_PSI = """a AS (SELECT o_totalprice AS x FROM orders WHERE o_orderdate < TIMESTAMP '2000-01-01'), b AS (SELECT o_totalprice * 1.05 AS x FROM orders WHERE o_orderdate >= TIMESTAMP '2000-01-01'),
e AS (SELECT list_sort(list_distinct(quantile_cont(x, [0.0,0.1,0.2,0.3,0.4,0.5,0.6,0.7,0.8,0.9,1.0]))) AS e FROM a), i AS (SELECT e[2:len(e) - 1] AS e FROM e),
ca AS (SELECT len(list_filter(i.e, lambda q: q <= x)) AS bin, count(*) AS n FROM a, i GROUP BY 1), cb AS (SELECT len(list_filter(i.e, lambda q: q <= x)) AS bin, count(*) AS n FROM b, i GROUP BY 1),
g AS (SELECT bin, greatest(coalesce(ca.n / (SELECT sum(n) FROM ca), 0), 1e-6) AS p, greatest(coalesce(cb.n / (SELECT sum(n) FROM cb), 0), 1e-6) AS q FROM ca FULL JOIN cb USING (bin))"""


def halves(spark, sf):
    o, day = table(spark, sf, "orders"), F.lit("2000-01-01").cast("timestamp")
    return o.filter(F.col("o_orderdate") < day), o.filter(F.col("o_orderdate") >= day).withColumn("o_totalprice", F.col("o_totalprice") * 1.05)


@query(f"WITH {_PSI} SELECT round(sum((q - p) * ln(q / p)), 6) AS psi FROM g")
def psi(spark, sf):
    return rounded(st.psi(*halves(spark, sf), "o_totalprice"))


_TVD = """x AS (SELECT coalesce({c}, '__missing__') AS level, count(*) FILTER (o_orderdate < TIMESTAMP '2000-01-01') AS a, count(*) FILTER (o_orderdate >= TIMESTAMP '2000-01-01') AS b FROM orders GROUP BY 1)"""


@query("WITH " + _TVD.format(c="o_orderpriority") + " SELECT round(sum(abs(a / (SELECT sum(a) FROM x) - b / (SELECT sum(b) FROM x))) / 2, 6) AS tvd FROM x")
def tvd(spark, sf):
    return rounded(st.total_variation(*halves(spark, sf), "o_orderpriority"))


@query(f"""WITH {_PSI}, {_TVD.format(c='o_orderpriority')} SELECT 'o_totalprice' AS feature, 'population_stability_index' AS metric, round(sum((q - p) * ln(q / p)), 6) AS score, CAST(0 AS DOUBLE) AS train_missing_rate, CAST(0 AS DOUBLE) AS test_missing_rate FROM g
UNION ALL SELECT 'o_orderpriority', 'total_variation_distance', round(sum(abs(a / (SELECT sum(a) FROM x) - b / (SELECT sum(b) FROM x))) / 2, 6), CAST(0 AS DOUBLE), CAST(0 AS DOUBLE) FROM x""")
def drift_report(spark, sf):
    return rounded(st.drift(*halves(spark, sf), ["o_totalprice"], ["o_orderpriority"]))


def judged(spark, sf):
    docs = table(spark, sf, "documents").select("doc_id", (~F.contains(F.col("text"), F.lit("&&&"))).alias("predicted"), (F.length("text") > 300).alias("longer"))
    return docs.join(table(spark, sf, "labels"), "doc_id").withColumn("actual", F.col("quality") == 1)


_JUDGED = "j AS (SELECT NOT contains(text, '&&&') AS predicted, length(text) > 300 AS longer, quality = 1 AS actual, quality, toxic, lang, source FROM documents JOIN labels USING (doc_id))"
_W = "CASE WHEN {n} = 0 THEN 0.0 ELSE ({k}/{n} + 3.8414588206941236/(2*{n}) - 1.959963984540054*sqrt({k}/{n}*(1-{k}/{n})/{n} + 3.8414588206941236/(4*{n}*{n}))) / (1 + 3.8414588206941236/{n}) END"


@query(f"""WITH {_JUDGED}, c AS (SELECT count(*) FILTER (predicted AND actual) AS tp, count(*) FILTER (predicted AND NOT actual) AS fp, count(*) FILTER (NOT predicted AND actual) AS fn, count(*) FILTER (NOT predicted AND NOT actual) AS tn FROM j)
SELECT tp, fp, fn, tn, round(coalesce(tp / (tp + fp), 0), 6) AS precision, round(coalesce(tp / (tp + fn), 0), 6) AS recall, round({_W.format(k='tp', n='(tp+fp)')}, 6) AS precision_lower, round({_W.format(k='tp', n='(tp+fn)')}, 6) AS recall_lower FROM c""")
def confusion_wilson(spark, sf):
    return rounded(st.confusion(judged(spark, sf), "predicted", "actual"))


@query(f"""WITH {_JUDGED}, s AS (SELECT count(*) AS n, avg(CASE WHEN predicted = longer THEN 1.0 ELSE 0 END) AS o, avg(CASE WHEN predicted THEN 1.0 ELSE 0 END) AS a, avg(CASE WHEN longer THEN 1.0 ELSE 0 END) AS b FROM j)
SELECT n, round(o, 6) AS agreement, round((o - (a * b + (1 - a) * (1 - b))) / (1 - (a * b + (1 - a) * (1 - b))), 6) AS kappa FROM s""")
def cohen_kappa(spark, sf):
    return rounded(st.cohen_kappa(judged(spark, sf), "predicted", "longer"))


@query("""SELECT lang AS class, count(*) AS n, count(*) FILTER (g = lang) AS correct, round(count(*) FILTER (g = lang) / count(*), 6) AS recall FROM (SELECT lang,
CASE WHEN contains(text, ' der ') THEN 'de' WHEN contains(text, ' les ') THEN 'fr' WHEN contains(text, ' los ') THEN 'es' ELSE 'en' END AS g FROM documents) GROUP BY lang""")
def categorical_accuracy(spark, sf):
    has = lambda w: F.contains(F.col("text"), F.lit(w))
    guess = F.when(has(" der "), "de").when(has(" les "), "fr").when(has(" los "), "es").otherwise("en")
    rows = table(spark, sf, "documents").select("lang", guess.alias("guess"))
    return rounded(st.class_recall(rows, "guess", "lang"))


@query("""SELECT count(*) AS n, count(*) FILTER (coalesce(abs(p - e) <= 1, false)) AS correct, round(count(*) FILTER (coalesce(abs(p - e) <= 1, false)) / count(*), 6) AS accuracy
FROM (SELECT CASE WHEN l_orderkey % 10 <> 0 THEN l_linenumber END AS p, CAST(l_quantity AS INT) % 7 AS e FROM lineitem)""")
def count_accuracy(spark, sf):
    rows = table(spark, sf, "lineitem").select(F.when(F.col("l_orderkey") % 10 != 0, F.col("l_linenumber")).alias("p"), (F.col("l_quantity").cast("int") % 7).alias("e"))
    return rounded(st.count_accuracy(rows, "p", "e"))


@query(f"""WITH {ADS}, r AS (SELECT CAST(year(start_date) AS VARCHAR) || '-Q' || quarter(start_date) AS segment, page_id, price AS a, 20 + collation_count * 5.0 AS p FROM ads),
m AS (SELECT segment, median(a) AS md FROM r GROUP BY segment)
SELECT segment, count(*) AS n, count(DISTINCT page_id) AS n_advertisers, round(avg(abs(a - p)), 5) AS mae, round(avg(abs(a - md)), 5) AS median_mae, round(avg(a), 5) AS actual_mean, round(avg(p), 5) AS predicted_mean,
round(avg(p) - avg(a), 5) AS calibration_gap, count(*) >= 100 AND count(DISTINCT page_id) >= 10 AS promotion_supported, 'ok' AS status FROM r JOIN m USING (segment) GROUP BY segment HAVING count(*) >= 10
UNION ALL SELECT segment, count(*), NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'insufficient_sample' FROM r GROUP BY segment HAVING count(*) < 10""")
def segment_metrics(spark, sf):
    rows = ads(spark, sf).select(F.concat(F.year("start_date").cast("string"), F.lit("-Q"), F.quarter("start_date").cast("string")).alias("segment"), "page_id", "price", (20 + F.col("collation_count") * 5.0).alias("p"))
    return rounded(st.segment_metrics(rows, "segment", "price", "p", F.col("page_id")), 5)


def _evidence(spark, sf):
    rows = ads(spark, sf).select("ad_id", "page_id", "price", (20 + F.col("collation_count") * 5.0).alias("p"))
    return st.cluster_bootstrap(rows, "page_id", "price", "p", 50.0, resamples=500, key="ad_id")


@query()
def bootstrap_ci(spark, sf):
    """Resampling weights come from our own generator: tests hold the intervals against a plain resampler, bootstrap_points has the figures that SQL can give."""
    return _evidence(spark, sf)


@query(f"""WITH {ADS}, r AS (SELECT page_id, ad_id, price AS a, 20 + collation_count * 5.0 AS p FROM ads),
k AS (SELECT *, row_number() OVER (ORDER BY p DESC, ad_id) AS np, row_number() OVER (ORDER BY a DESC, ad_id) AS na, CAST(ceil(count(*) OVER () * 0.2) AS BIGINT) AS k FROM r)
SELECT count(DISTINCT page_id) AS clusters, round(avg(abs(a - p) - abs(a - 50)), 7) AS difference, round(avg(p - a), 7) AS calibration_gap,
count(DISTINCT page_id) FILTER (np <= k) AS top_clusters, round(count(*) FILTER (np <= k AND na <= k) / count(*) FILTER (np <= k), 7) AS precision FROM k""")
def bootstrap_points(spark, sf):
    return rounded(_evidence(spark, sf).select("clusters", "difference", "calibration_gap", "top_clusters", "precision"), 7)


@query(f"""WITH {ADS}, e AS (SELECT hook, count(*) AS n_test, count(DISTINCT page_id) AS n_adv, avg(abs(price - 50)) AS mae, avg(abs(price - 40)) AS base FROM ads GROUP BY hook)
SELECT hook, array_to_string(list_filter([CASE WHEN NOT n_test >= 100 THEN 'holdout_rows_at_least_100' END, CASE WHEN NOT n_adv >= 10 THEN 'holdout_advertisers_at_least_10' END,
CASE WHEN NOT mae < base THEN 'mae_point_better_than_baseline' END, 'mae_bootstrap_interval_below_zero'], lambda x: x IS NOT NULL), ',') AS failed_checks, 'blocked' AS status FROM e""")
def promotion_decision(spark, sf):
    a = F.abs(F.col("price") - 50)
    e = ads(spark, sf).groupBy("hook").agg(F.count("*").alias("n_test"), F.count_distinct("page_id").alias("n_test_advertisers"), F.avg(a).alias("test_mae"), F.avg(F.abs(F.col("price") - 40)).alias("baseline_mae"))
    e = e.withColumns({"taxonomy_status": F.lit("passed"), "enrichment_status": F.lit("passed"), "worktree_dirty": F.lit(False), "advertiser_overlap": F.lit(0), "n_clusters": F.col("n_test_advertisers"), "mae_upper_95": F.lit(None).cast("double"), "precision_lower_95": F.lit(0.3)})
    return st.promotion(e).select("hook", "failed_checks", "status")
