"""Queries of scores, ranks, splits and selections."""

from __future__ import annotations

from pyspark.sql import Window, functions as F

from admill.operators import scoring, splits
from admill.operators.storage import stored
from admill.plans.registry import query
from admill.plans.views import ADS, ads, table

_SCORED = f"""{ADS}, b AS (SELECT a.*, n_page AS brand_scaling_count FROM ads a JOIN (SELECT page_id, count(DISTINCT ad_id) AS n_page FROM ads GROUP BY page_id) USING (page_id)),
p AS (SELECT *, cume_dist() OVER (ORDER BY days_active) AS pd, cume_dist() OVER (ORDER BY brand_scaling_count) AS ps, cume_dist() OVER (ORDER BY collation_count) AS pc FROM b),
s AS (SELECT *, 0.7 * pd + 0.2 * pd * ps + 0.1 * pc AS composite_success_score, 0.5 * pd + 0.3 * pd * ps + 0.2 * pc AS challenger FROM p)"""


def scored(spark, sf):
    rows = scoring.success_score(scoring.brand_scaling(ads(spark, sf)))
    other = scoring.score({"longevity": 0.5, "longevity_scaling_interaction": 0.3, "variant_boost": 0.2})
    return rows.withColumn("challenger", other)


@query(f"WITH {_SCORED} SELECT ad_id, page_id, round(composite_success_score, 9) AS composite_success_score FROM s")
def success_score(spark, sf):
    return scored(spark, sf).select("ad_id", "page_id", F.round("composite_success_score", 9).alias("composite_success_score"))


@query(f"""WITH {ADS}, r AS (SELECT days_active FROM ads WHERE start_date < DATE '2000-01-01'), n AS (SELECT count(*) AS n FROM r),
c AS (SELECT days_active, sum(k) OVER (ORDER BY days_active) AS below FROM (SELECT days_active, count(*) FILTER (start_date < DATE '2000-01-01') AS k FROM ads GROUP BY days_active))
SELECT ad_id, round(below / n, 9) AS percentile FROM ads JOIN c USING (days_active), n WHERE start_date >= DATE '2000-01-01'""")
def heldout_percentile(spark, sf):
    rows = ads(spark, sf)
    reference = F.col("start_date") < F.lit("2000-01-01").cast("date")
    shares = scoring.value_shares(rows, "days_active", "percentile", reference)
    return rows.filter(~reference).join(shares, "days_active").select("ad_id", F.round("percentile", 9).alias("percentile"))


@query(f"""WITH {_SCORED}, r AS (SELECT rank() OVER (ORDER BY round(composite_success_score, 9)) + (count(*) OVER (PARTITION BY round(composite_success_score, 9)) - 1) / 2.0 AS a,
  rank() OVER (ORDER BY round(challenger, 9)) + (count(*) OVER (PARTITION BY round(challenger, 9)) - 1) / 2.0 AS b FROM s) SELECT round(corr(a, b), 6) AS spearman FROM r""")
def spearman(spark, sf):
    rows = stored(scored(spark, sf).select(F.round("composite_success_score", 9).alias("x"), F.round("challenger", 9).alias("y")), "scores")
    return scoring.spearman(rows, "x", "y").select(F.round("spearman", 6).alias("spearman"))


_TOP = f"""WITH {_SCORED}, t AS (SELECT row_number() OVER (ORDER BY round(composite_success_score, 9) DESC, ad_id) <= ceil(0.2 * count(*) OVER ()) AS a,
  row_number() OVER (ORDER BY round(challenger, 9) DESC, ad_id) <= ceil(0.2 * count(*) OVER ()) AS b FROM s)
SELECT count(*) FILTER (a AND b) / count(*) FILTER (b) AS precision, count(*) FILTER (a AND b) / count(*) FILTER (a OR b) AS jaccard FROM t"""


@query(_TOP)
def top20_agreement(spark, sf):
    rows = stored(scored(spark, sf).select("ad_id", F.round("composite_success_score", 9).alias("x"), F.round("challenger", 9).alias("y")), "scores")
    return scoring.top_agreement(rows, "x", "y")


@query(f"""WITH {ADS}, r AS (SELECT ad_id, row_number() OVER (ORDER BY start_date, ad_id) AS rn, count(*) OVER () AS n FROM ads) SELECT ad_id, rn <= CAST(floor(0.8 * n) AS BIGINT) AS is_train FROM r""")
def temporal_split(spark, sf):
    return splits.temporal_split(ads(spark, sf), "start_date", "ad_id").select("ad_id", "is_train")


@query(f"""WITH {ADS}, f AS (SELECT page_id, min(start_date) AS first FROM ads GROUP BY page_id),
g AS (SELECT page_id, row_number() OVER (ORDER BY first, CAST(page_id AS VARCHAR)) AS rn, count(*) OVER () AS n FROM f)
SELECT ad_id, rn > n - greatest(1, ceil(n * 0.2)) AS is_test FROM ads JOIN g USING (page_id)""")
def advertiser_holdout(spark, sf):
    group = splits.advertiser(F.col("page_id"), F.col("ad_id"))
    return splits.advertiser_holdout(ads(spark, sf), "start_date", group).select("ad_id", "is_test")


@query(f"""WITH {_SCORED}, e AS (SELECT *, round(composite_success_score, 9) AS score FROM s WHERE days_active >= 30 AND segment <> 'F'),
r AS (SELECT *, row_number() OVER (PARTITION BY page_id ORDER BY score DESC, ad_id) = 1 AS first_of_group FROM e)
SELECT ad_id, page_id, score, first_of_group FROM r ORDER BY first_of_group DESC, score DESC, ad_id LIMIT 24""")
def benchmark_queue(spark, sf):
    rows = scored(spark, sf).filter("days_active >= 30 AND segment <> 'F'").withColumn("score", F.round("composite_success_score", 9))
    group = splits.advertiser(F.col("page_id"), F.col("ad_id"))
    return splits.diversified_top(rows, "score", group, "ad_id", 24).select("ad_id", "page_id", "score", "first_of_group")


@query("""SELECT p_brand, n, rank() OVER (ORDER BY n DESC) AS importance_rank FROM (SELECT p_brand, count(*) AS n FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY p_brand)""")
def importance_rank(spark, sf):
    gains = table(spark, sf, "lineitem").join(table(spark, sf, "part"), F.col("l_partkey") == F.col("p_partkey")).groupBy("p_brand").agg(F.count("*").alias("n"))
    return gains.withColumn("importance_rank", F.rank().over(Window.orderBy(F.desc("n"))))  # a row per brand


@query()
def stratified_sample(spark, sf):
    """Strata by hook and segment; the order is our own seeded hash, so there is no SQL twin."""
    rows = ads(spark, sf)
    strata = F.array(F.concat(F.lit("hook:"), F.col("hook")), F.concat(F.lit("segment:"), F.col("segment")))
    return splits.stratified_sample(rows, strata, "ad_id", 120).select("ad_id", "stratum")
