"""Observation windows: what a collection holds, how it follows the one before, and whether a model may be judged on it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from admill.operators.statistics import segment_metrics


def identity(rows: DataFrame, key: str) -> DataFrame:
    """One row: n, distinct ids, and a hash of the set of ids that doesn't depend on their order or place."""
    ids = rows.select(F.col(key).cast("string").alias("id")).distinct()
    low = F.conv(F.substring(F.sha2("id", 256), 1, 12), 16, 10).cast("decimal(38,0)")
    return ids.agg(F.count("*").alias("n_ids"), F.coalesce(F.sum(low), F.lit(0)).cast("string").alias("ids_hash")).join(F.broadcast(rows.agg(F.count("*").alias("n_rows"))))


def window_summary(ads: DataFrame, observations: DataFrame, previous: DataFrame | None = None) -> DataFrame:
    """One row: sizes, time range, novelty against the previous window's ads, complete polls, and whether it may judge an older model.

    ads: ad_id, page_id, observed_at; observations: ad_id, poll_complete; only those of the window's ads count.
    """
    now = ads.agg(F.count("*").alias("n_ads"), F.count_distinct("page_id").alias("n_advertisers"), F.min("observed_at").alias("observed_at_min"), F.max("observed_at").alias("observed_at_max"))
    polls = observations.join(ads.select("ad_id").distinct(), "ad_id", "left_semi").agg(F.count("*").alias("n_observations"), F.count_if("poll_complete").alias("complete_observations"))
    out = now.join(F.broadcast(polls))
    if previous is None:
        return out.withColumns({"n_new_ads": F.col("n_ads"), "n_existing_ads": F.lit(0).cast("long"), "n_new_advertisers": F.col("n_advertisers"), "temporal_order": F.lit("baseline"), "eligible": F.lit(False)})
    new = ads.select("ad_id").distinct().join(previous.select("ad_id").distinct().withColumn("_old", F.lit(True)), "ad_id", "left")
    pages = ads.select("page_id").distinct().filter("page_id IS NOT NULL").join(previous.select("page_id").distinct(), "page_id", "left_anti")
    novel = new.agg(F.count_if(F.col("_old").isNull()).alias("n_new_ads"), F.count("_old").alias("n_existing_ads"))
    end = previous.agg(F.max("observed_at").alias("_end"))
    out = out.join(F.broadcast(novel)).join(F.broadcast(pages.agg(F.count("*").alias("n_new_advertisers")))).join(F.broadcast(end))
    after = F.coalesce(F.col("observed_at_min") > F.col("_end"), F.lit(False))
    out = out.withColumn("temporal_order", F.when(after, "after_previous_window").otherwise("not_proven_after_previous_window"))
    return out.withColumn("eligible", after & (F.col("n_new_ads") > 0)).drop("_end")


def mismatches(recorded: DataFrame, rebuilt: DataFrame) -> DataFrame:
    """(field, recorded, rebuilt) of the fields in which one-row summaries differ; empty if the record holds."""
    fields = [c for c in recorded.columns if c in rebuilt.columns]
    left, right = (df.select(F.struct(*[F.col(c).cast("string").alias(c) for c in fields]).alias(n)) for df, n in ((recorded, "a"), (rebuilt, "b")))
    rows = F.array(*[F.struct(F.lit(c).alias("field"), F.col(f"a.{c}").alias("recorded"), F.col(f"b.{c}").alias("rebuilt")) for c in fields])
    return left.join(F.broadcast(right)).select(F.explode(rows).alias("r")).select("r.*").filter(~F.col("recorded").eqNullSafe(F.col("rebuilt")))


def leakage(train: DataFrame, test: DataFrame, keys: list[str]) -> DataFrame:
    """A row per key: distinct values on both sides of a split, and whether the sides are apart."""
    out = None
    for key in keys:
        both = train.select(key).distinct().join(test.select(key).distinct(), key, "left_semi").filter(F.col(key).isNotNull())
        row = both.agg(F.lit(key).alias("key"), F.count("*").alias("shared"), (F.count("*") == 0).alias("apart"))
        out = row if out is None else out.unionByName(row)
    return out


def future_score(scored: DataFrame, baseline: float, group: str = "group", segment: str = "segment") -> tuple[DataFrame, DataFrame]:
    """One row of a frozen model's errors on a later window (actual, prediction, group) beside a constant's, and a row per segment."""
    a, p = F.col("actual"), F.col("prediction")
    one = scored.agg(F.count("*").alias("n_test"), F.count_distinct(group).alias("n_test_groups"), F.avg(F.abs(a - p)).alias("test_mae"), F.avg(F.abs(a - baseline)).alias("baseline_mae"), (F.avg(p) - F.avg(a)).alias("calibration_gap"))
    return one, segment_metrics(scored, segment, "actual", "prediction", F.col(group))


def follow_up(start, stop, as_of, least_days: int, tolerance: int = 1):
    """Whether a target's age lies within a day of the follow-up asked for, or the ad ended before."""
    age = F.datediff(F.coalesce(stop, as_of), start)
    return F.coalesce((F.abs(age - least_days) <= tolerance) | (stop.isNotNull() & (age < least_days)), F.lit(False))


def content_hash(rows: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """One row, hash: SHA-256 of a multiset of rows, whatever their order and place.

    A row is the JSON of its columns as strings in the order of their names. Rows' hashes are counted, sorted and hashed within
    the buckets that their first four digits name, then within the first two, then all together, so no task holds all of them.
    """
    names = sorted(columns or rows.columns)
    leaf = F.sha2(F.to_json(F.struct(*[F.col(c).cast("string").alias(c) for c in names]), {"ignoreNullFields": "false"}), 256)
    level = rows.groupBy(leaf.alias("_h")).agg(F.count("*").alias("_n")).select(F.substring("_h", 1, 4).alias("_b"), F.concat_ws(":", "_h", F.col("_n").cast("string")).alias("_x"))
    for width in (2, 0):
        level = level.groupBy("_b").agg(F.sha2(F.array_join(F.sort_array(F.collect_list("_x")), ","), 256).alias("_h"))
        level = level.select(F.substring("_b", 1, width).alias("_b"), F.concat_ws(":", "_b", "_h").alias("_x"))
    return level.agg(F.sha2(F.array_join(F.sort_array(F.collect_list("_x")), ","), 256).alias("hash"))


def content_hash_sql(relation: str, columns: list[str]) -> str:
    """content_hash as SQL, for columns that read alike as strings."""
    parts = " || ',' || ".join(f"""'"{c}":' || coalesce('"' || CAST({c} AS VARCHAR) || '"', 'null')""" for c in sorted(columns))
    return f"""(WITH h0 AS (SELECT sha256('{{' || {parts} || '}}') AS h FROM {relation}), h1 AS (SELECT substr(h, 1, 4) AS b, h || ':' || count(*) AS x FROM h0 GROUP BY h),
h2 AS (SELECT b, sha256(string_agg(x, ',' ORDER BY x)) AS h FROM h1 GROUP BY b), h3 AS (SELECT substr(b, 1, 2) AS b, b || ':' || h AS x FROM h2),
h4 AS (SELECT b, sha256(string_agg(x, ',' ORDER BY x)) AS h FROM h3 GROUP BY b) SELECT sha256(coalesce(string_agg(b || ':' || h, ',' ORDER BY b || ':' || h), '')) FROM h4)"""


#: Fields that a window's id is made of, in the order of their names.
SOURCE = ["ad_ids_sha256", "ads_sha256", "observations_sha256", "previous_window_id", "role"]


def window_id() -> Column:
    """SHA-256 of the canonical JSON of a manifest's source fields."""
    return F.sha2(F.to_json(F.struct(*SOURCE), {"ignoreNullFields": "false"}), 256)


def window_manifest(ads: DataFrame, observations: DataFrame | None = None, previous: DataFrame | None = None, previous_ads: DataFrame | None = None) -> DataFrame:
    """One row that freezes a window: hashes of its ads, observations and set of ids, the id of the window before, an id over all of these, and its summary.

    ads: ad_id, page_id, observed_at and any others; observations: ad_id, poll_complete and any others; previous: the manifest before, with
    the ads it was made of. Ads without an id, repeated ids and a window without ads are errors.
    """
    blank = F.coalesce(F.trim(F.col("ad_id").cast("string")), F.lit("")) == ""
    n, n_blank, n_ids = ads.agg(F.count("*"), F.count_if(blank), F.count_distinct("ad_id")).first()
    if n == 0 or n_blank:
        raise ValueError("every ad of a window needs an ad_id, and a window needs ads")
    if n_ids != n:
        raise ValueError("a window can't hold an ad_id twice")
    if (previous is None) != (previous_ads is None):
        raise ValueError("a previous window needs its manifest and its ads")
    none = F.lit(None).cast("string")
    out = content_hash(ads).withColumnRenamed("hash", "ads_sha256").join(F.broadcast(content_hash(ads, ["ad_id"]).withColumnRenamed("hash", "ad_ids_sha256")))
    out = out.withColumn("observations_sha256", none) if observations is None else out.join(F.broadcast(content_hash(observations).withColumnRenamed("hash", "observations_sha256")))
    out = out.withColumn("role", F.lit("baseline" if previous is None else "future_holdout"))
    out = out.withColumn("previous_window_id", none) if previous is None else out.join(F.broadcast(previous.select(F.col("window_id").alias("previous_window_id"))))
    polls = ads.select("ad_id", F.lit(None).cast("boolean").alias("poll_complete")).limit(0) if observations is None else observations
    return out.withColumn("window_id", window_id()).join(F.broadcast(window_summary(ads, polls, previous_ads)))


def verify_window(manifest: DataFrame, ads: DataFrame, observations: DataFrame | None = None, previous: DataFrame | None = None, previous_ads: DataFrame | None = None) -> DataFrame:
    """(field, recorded, rebuilt) of all that a stored manifest gets wrong about these sources, its own id among them; empty if it holds."""
    own = manifest.select(F.lit("window_id of its own fields").alias("field"), F.col("window_id").alias("recorded"), window_id().alias("rebuilt")).filter("NOT recorded <=> rebuilt")
    return mismatches(manifest, window_manifest(ads, observations, previous, previous_ads)).unionByName(own)
