"""Direction of features from model reports, and how far an ad follows them."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

RELIABLE = 0.10
MISSING = ["unknown", "none", "", "nan", "missing"]


def parse_features(entries: DataFrame, dimensions: list[str], name: str = "feature") -> DataFrame:
    """entries with kind, dimension and value. Levels may hold underscores, so the longest known dimension counts."""
    kind = F.regexp_extract(name, "^(numeric|categorical)__", 1)
    rest = F.regexp_replace(F.regexp_replace(name, "^(numeric|categorical)__", ""), "^creative_", "")
    known = [F.when(F.startswith(rest, F.lit(f"{d}_")), F.lit(d)) for d in sorted(dimensions, key=len, reverse=True)]
    dimension = F.when(kind == "numeric", rest).otherwise(F.coalesce(*known))
    value = F.when(kind == "categorical", F.substring(rest, F.length(dimension) + 2, F.length(rest)))
    return entries.withColumns({"kind": F.nullif(kind, F.lit("")), "dimension": dimension, "value": value}).filter(F.col("kind").isNotNull() & F.col("dimension").isNotNull())


def directives(parsed: DataFrame, buckets: DataFrame) -> DataFrame:
    """(bucket, dimension, value, direction, magnitude, source): direction is unknown where signed and absolute effects disagree too much.

    parsed: dimension, value, signed, absolute, source; buckets: dimension, bucket. Missing-data levels are left out.
    """
    real = parsed.filter(F.col("value").isNull() | ~F.lower("value").isin(MISSING))
    reliable = F.try_divide(F.abs("signed"), "absolute") >= RELIABLE
    direction = F.when(~F.coalesce(reliable, F.lit(False)), "unknown").when(F.col("signed") > 0, "higher_is_better").otherwise("lower_is_better")
    return real.join(F.broadcast(buckets), "dimension").select("bucket", "dimension", "value", direction.alias("direction"), F.col("absolute").alias("magnitude"), "source")


def alignment(rows: DataFrame, key: str, guide: DataFrame, dimensions: list[str]) -> DataFrame:
    """(key, alignment): one up for each wanted level that a row has, one down for each unwanted; missing data counts neither way."""
    sign = F.when(F.col("direction") == "higher_is_better", 1).when(F.col("direction") == "lower_is_better", -1).otherwise(0)
    rules = guide.filter(F.col("value").isNotNull()).groupBy("dimension", "value").agg(F.sum(sign).alias("_sign"))
    pairs = F.array(*[F.struct(F.lit(d).alias("dimension"), F.col(d).cast("string").alias("value")) for d in dimensions])
    flat = rows.select(key, F.explode(pairs).alias("p")).select(key, "p.*")
    return flat.join(F.broadcast(rules), ["dimension", "value"], "left").groupBy(key).agg(F.coalesce(F.sum("_sign"), F.lit(0)).cast("long").alias("alignment"))


def reference_rows(rows: DataFrame, n: int, key: str = "ad_id", score: str = "composite_success_score", least: int = 1) -> DataFrame:
    """The n best rows by alignment, then score; if too few are aligned at all, all rows compete."""
    aligned = rows.filter(F.col("alignment") >= least)
    pool = aligned if aligned.limit(n).count() >= n else rows
    return pool.orderBy(F.desc("alignment"), F.desc(score), key).limit(n)

