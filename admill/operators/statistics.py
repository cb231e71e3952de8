"""Data quality, drift, agreement and evidence, as aggregates."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from admill.functions.distributions import f_probability, t_probability
from admill.operators.ordering import grouped_quantiles, quantiles, with_row_number
from admill.operators.storage import stored

NULLS, POINT_MASS, OUTLIERS, CARDINALITY = 0.30, 0.40, 0.05, 0.5
Z95 = 1.959963984540054


def point_mass(rows: DataFrame, column: str) -> DataFrame:
    """One row: the most frequent non-null value (ties: the least) and its share."""
    counts = rows.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.agg(F.max_by(column, F.struct("n", -F.col(column))).alias("value"), F.try_divide(F.max("n").cast("double"), F.sum("n")).alias("share"))


def iqr_outlier_rate(rows: DataFrame, column: str) -> DataFrame:
    """One row: share beyond 1.5 ranges of the quartiles, which are the values at places n/4 and 3n/4 from 0."""
    x = rows.filter(F.col(column).isNotNull()).select(F.col(column).cast("double").alias("x"))
    n = x.count()
    placed = with_row_number(x, "x", [], "_i")
    quartiles = placed.agg(F.max(F.when(F.col("_i") == n // 4 + 1, F.col("x"))).alias("q1"), F.max(F.when(F.col("_i") == 3 * n // 4 + 1, F.col("x"))).alias("q3"))
    iqr = F.col("q3") - F.col("q1")
    beyond = (F.col("x") < F.col("q1") - 1.5 * iqr) | (F.col("x") > F.col("q3") + 1.5 * iqr)
    rate = F.try_divide(F.count_if(beyond & (iqr != 0)).cast("double"), F.count("*"))
    return x.join(F.broadcast(quartiles)).agg(F.lit(n).cast("long").alias("n"), F.first("q1").alias("q1"), F.first("q3").alias("q3"), F.when(F.lit(n < 4), 0.0).otherwise(rate).alias("outlier_rate"))


def profile(rows: DataFrame, numeric: list[str]) -> DataFrame:
    """A row per numeric column: counts, moments, point mass, and flags. One pass for the moments, one for the values."""
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("double").alias("x")) for c in numeric])).alias("v")).select("v.*")
    stats = long.groupBy("column").agg(
        F.count("*").alias("n"), (1 - F.count("x") / F.count("*")).alias("null_rate"), F.avg("x").alias("mean"),
        F.min("x").alias("min"), F.max("x").alias("max"), F.stddev_pop("x").alias("stdev"),
    )
    counts = long.filter(F.col("x").isNotNull()).groupBy("column", "x").agg(F.count("*").alias("k"))
    modes = counts.groupBy("column").agg(F.max_by("x", F.struct("k", -F.col("x"))).alias("point_mass_value"), (F.max("k") / F.sum("k")).alias("point_mass_fraction"))
    flat = F.round("stdev", 4) == 0
    flags = F.filter(F.array(F.when(F.col("null_rate") >= NULLS, "high_null_rate"), F.when(flat & (F.col("n") > 1), "zero_variance"), F.when(~flat & (F.col("point_mass_fraction") >= POINT_MASS), "high_point_mass")), lambda f: f.isNotNull())
    medians = grouped_quantiles(long, "column", "x", [0.5]).select("column", F.get("quantiles", F.lit(0)).alias("median"))
    return stats.join(modes, "column", "left").join(medians, "column", "left").withColumn("flags", F.array_join(flags, ","))


def thin_categories(rows: DataFrame, column: str, least: int = 30) -> DataFrame:
    counts = rows.filter(F.col(column).isNotNull()).groupBy(F.col(column).alias("value")).agg(F.count("*").alias("count"))
    return counts.filter(F.col("count") < least)


def anova(rows: DataFrame, group: str, value: str) -> DataFrame:
    """One row: F statistic of a one-way analysis over groups of at least two, from sums of squares."""
    g = rows.filter(F.col(group).isNotNull() & F.col(value).isNotNull()).groupBy(group).agg(F.count("*").alias("n"), F.avg(value).alias("m"), F.var_pop(value).alias("v")).filter("n >= 2")
    total, mean = F.sum("n"), F.sum(F.col("n") * F.col("m")) / F.sum("n")
    between = F.sum(F.col("n") * F.col("m") * F.col("m")) - total * mean * mean
    within = F.sum(F.col("n") * F.col("v"))
    k = F.count("*")
    return g.agg(total.cast("long").alias("n"), k.alias("n_groups"), F.try_divide(F.try_divide(between, k - 1), F.try_divide(within, total - k)).alias("f"))


def welch(rows: DataFrame, missing: str, value: str, least: int = 10) -> DataFrame:
    """One row: Welch's t between rows that lack a column and rows that have it; null with fewer than `least` on a side."""
    gone, v = F.col(missing).isNull(), F.col(value)
    part = lambda where, fn: fn(F.when(where, v))
    out = rows.filter(v.isNotNull()).agg(
        F.count_if(gone).alias("n_null"), F.count_if(~gone).alias("n_non_null"), part(gone, F.avg).alias("mean_null"), part(~gone, F.avg).alias("mean_non_null"),
        part(gone, F.var_samp).alias("_a"), part(~gone, F.var_samp).alias("_b"),
    )
    t = (F.col("mean_null") - F.col("mean_non_null")) / F.sqrt(F.col("_a") / F.col("n_null") + F.col("_b") / F.col("n_non_null"))
    return out.withColumn("t", F.when((F.col("n_null") >= least) & (F.col("n_non_null") >= least), t)).drop("_a", "_b")


def psi(train: DataFrame, test: DataFrame, column: str) -> DataFrame:
    """One row: population stability index over the training deciles."""
    deciles = sorted(set(quantiles(train, column, [i / 10 for i in range(11)])))
    if len(deciles) < 2:
        return train.sparkSession.range(1).select(F.lit(0.0).alias("psi"))
    inner = deciles[1:-1]
    place = F.size(F.filter(F.array(*map(F.lit, inner)), lambda b: b <= F.col(column))) if inner else F.lit(0)

    def shares(rows: DataFrame, name: str) -> DataFrame:
        counts = rows.filter(F.col(column).isNotNull()).groupBy(place.alias("bin")).agg(F.count("*").alias("n"))
        return counts.select("bin", (F.col("n") / F.sum("n").over(Window.partitionBy(F.lit(0)))).alias(name))  # eleven rows at most

    both = train.sparkSession.range(len(inner) + 1).select(F.col("id").cast("int").alias("bin")).join(shares(train, "a"), "bin", "left").join(shares(test, "b"), "bin", "left")
    a, b = (F.greatest(F.coalesce(c, F.lit(0.0)), F.lit(1e-6)) for c in ("a", "b"))
    return both.agg(F.sum((b - a) * F.log(b / a)).alias("psi"))


def total_variation(train: DataFrame, test: DataFrame, column: str) -> DataFrame:
    """One row: half the sum of differences of the levels' shares; missing is a level."""
    rows = train.select(F.lit(1).alias("w"), column).unionByName(test.select(F.lit(0).alias("w"), column))
    level = F.coalesce(F.col(column).cast("string"), F.lit("__missing__"))
    counts = rows.groupBy(level.alias("level")).agg(F.sum("w").alias("a"), F.count_if(F.col("w") == 0).alias("b"))
    totals = counts.agg(F.sum("a").alias("_a"), F.sum("b").alias("_b"))
    gap = F.abs(F.try_divide("a", "_a") - F.try_divide("b", "_b"))
    return counts.join(F.broadcast(totals)).agg((F.sum(gap) / 2).alias("tvd"))


def drift(train: DataFrame, test: DataFrame, numeric: list[str], categorical: list[str], most: int = 30) -> DataFrame:
    """The most shifted features with their metric, score and missing rates."""
    parts = []
    for c in [*numeric, *categorical]:
        metric = psi(train, test, c) if c in numeric else total_variation(train, test, c)
        name = "population_stability_index" if c in numeric else "total_variation_distance"
        rate = lambda rows, as_: rows.agg(F.avg(F.col(c).isNull().cast("double")).alias(as_))
        one = metric.toDF("score").join(F.broadcast(rate(train, "train_missing_rate"))).join(F.broadcast(rate(test, "test_missing_rate")))
        parts.append(one.select(F.lit(c).alias("feature"), F.lit(name).alias("metric"), "score", "train_missing_rate", "test_missing_rate"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.orderBy(F.desc("score"), "feature").limit(most)


def wilson_lower(successes: Column, total: Column, z: float = Z95) -> Column:
    p = F.try_divide(successes.cast("double"), total)
    margin = z * F.sqrt(p * (1 - p) / total + z * z / (4 * total * total))
    return F.when(total == 0, F.lit(0.0)).otherwise((p + z * z / (2 * total) - margin) / (1 + z * z / total))


def confusion(rows: DataFrame, predicted: str, actual: str) -> DataFrame:
    """One row: the four counts, precision and recall with Wilson lower bounds. Null predictions or labels are left out."""
    p, a = F.col(predicted), F.col(actual)
    one = rows.filter(p.isNotNull() & a.isNotNull()).agg(F.count_if(p & a).alias("tp"), F.count_if(p & ~a).alias("fp"), F.count_if(~p & a).alias("fn"), F.count_if(~p & ~a).alias("tn"))
    share = lambda x, y: F.coalesce(F.try_divide(F.col(x).cast("double"), F.col(x) + F.col(y)), F.lit(0.0))
    return one.withColumns({
        "precision": share("tp", "fp"), "recall": share("tp", "fn"),
        "precision_lower": wilson_lower(F.col("tp"), F.col("tp") + F.col("fp")), "recall_lower": wilson_lower(F.col("tp"), F.col("tp") + F.col("fn")),
    })


def cohen_kappa(rows: DataFrame, a: str, b: str) -> DataFrame:
    """One row: observed agreement and kappa; null where chance alone agrees always."""
    cells = rows.filter(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).alias("a"), F.col(b).alias("b")).agg(F.count("*").alias("n"))
    by_a = cells.groupBy(F.col("a").alias("level")).agg(F.sum("n").alias("x"))
    by_b = cells.groupBy(F.col("b").alias("level")).agg(F.sum("n").alias("y"))
    chance = by_a.join(by_b, "level").agg(F.coalesce(F.sum(F.col("x") * F.col("y")), F.lit(0)).alias("_e"))
    agree = cells.agg(F.sum("n").alias("n"), F.coalesce(F.sum(F.when(F.col("a") == F.col("b"), F.col("n"))), F.lit(0)).alias("_o"))
    observed, expected = F.col("_o") / F.col("n"), F.col("_e") / (F.col("n") * F.col("n"))
    return agree.join(F.broadcast(chance)).select("n", observed.alias("agreement"), F.when(expected != 1, (observed - expected) / (1 - expected)).alias("kappa"))


def class_recall(rows: DataFrame, predicted: str, expected: str) -> DataFrame:
    """A row per expected class: how many, and how many were predicted; null expectations are left out."""
    known = rows.filter(F.col(expected).isNotNull())
    hit = F.count_if(F.col(predicted).eqNullSafe(F.col(expected)))
    return known.groupBy(F.col(expected).alias("class")).agg(F.count("*").alias("n"), hit.alias("correct"), (hit / F.count("*")).alias("recall"))


def count_accuracy(rows: DataFrame, predicted: str, expected: str, tolerance: int = 1) -> DataFrame:
    """One row: share within the tolerance; a missing prediction counts as wrong."""
    known = rows.filter(F.col(expected).isNotNull())
    right = F.count_if(F.coalesce(F.abs(F.col(predicted) - F.col(expected)) <= tolerance, F.lit(False)))
    return known.agg(F.count("*").alias("n"), right.alias("correct"), F.coalesce(F.try_divide(right.cast("double"), F.count("*")), F.lit(0.0)).alias("accuracy"))


def segment_metrics(rows: DataFrame, segment: str, actual: str, predicted: str, advertiser: Column, least: int = 10, promote_rows: int = 100, promote_advertisers: int = 10) -> DataFrame:
    """A row per segment: error, error of the segment's own median, means, gap, and whether the segment may be promoted."""
    a, p = F.col(actual), F.col(predicted)
    kept = rows.filter(F.col(segment).isNotNull())
    medians = grouped_quantiles(kept, segment, actual, [0.5]).select(segment, F.get("quantiles", F.lit(0)).alias("_median"))
    out = kept.join(medians, segment, "left").groupBy(F.col(segment).alias("segment")).agg(
        F.count("*").alias("n"), F.count_distinct(advertiser).alias("n_advertisers"), F.avg(F.abs(a - p)).alias("mae"), F.avg(F.abs(a - F.col("_median"))).alias("median_mae"),
        F.avg(a).alias("actual_mean"), F.avg(p).alias("predicted_mean"),
    )
    ok = F.col("n") >= least
    values = {c: F.when(ok, F.col(c)) for c in ("n_advertisers", "mae", "median_mae", "actual_mean", "predicted_mean")}
    out = out.withColumns(values).withColumn("calibration_gap", F.col("predicted_mean") - F.col("actual_mean"))
    promoted = F.when(ok, (F.col("n") >= promote_rows) & (F.col("n_advertisers") >= promote_advertisers))
    return out.withColumn("promotion_supported", promoted).withColumn("status", F.when(ok, "ok").otherwise("insufficient_sample"))


def poisson_weights(seed: int, group: str, resamples: int) -> np.ndarray:
    """How often a group is drawn in each resample: Poisson(1) counts that depend on the seed and the group alone."""
    key = int.from_bytes(hashlib.blake2b(f"{seed}:{group}".encode(), digest_size=16).digest())
    return np.random.Generator(np.random.Philox(key=key)).poisson(1.0, resamples)


def resampled_sums(groups: DataFrame, group: str, sums: list[str], resamples: int, seed: int) -> DataFrame:
    """(r, sums...): the sums of each resample of rows of groups. A task adds its groups into one array per sum and sends those; nothing grows with groups times resamples."""

    def add(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((len(sums), resamples))
        for batch in batches:
            for key, *values in batch[[group, *sums]].itertuples(index=False):
                total += np.outer(values, poisson_weights(seed, key, resamples))
        yield pd.DataFrame({"r": range(resamples), **dict(zip(sums, total))})

    flat = groups.select(F.col(group).cast("string").alias(group), *[F.col(c).cast("double").alias(c) for c in sums])
    parts = flat.mapInPandas(add, "r int, " + ", ".join(f"{c} double" for c in sums))
    return parts.groupBy("r").agg(*[F.sum(c).alias(c) for c in sums])


def top_set_hits(rows: DataFrame, key: str, actual: str, predicted: str, share: float = 0.2) -> DataFrame:
    """The rows of the predicted top share, with hit: whether they are in the actual top share too. Ties go by key."""
    n = rows.count()
    k = max(1, math.ceil(n * share))
    ranked = with_row_number(with_row_number(rows, predicted, [F.asc(key)], "_p", descending=True), actual, [F.asc(key)], "_a", descending=True)
    return ranked.filter(F.col("_p") <= k).withColumn("hit", (F.col("_a") <= k).cast("int")).drop("_p", "_a")


def cluster_bootstrap(rows: DataFrame, group: str, actual: str, predicted: str, baseline: float, resamples: int = 2000, seed: int = 7, key: str | None = None) -> DataFrame:
    """One row of paired evidence over resampled groups, each figure with its 95 % interval: the error's difference to a constant baseline's,
    the calibration gap and, where a key column orders ties, the precision of the predicted top fifth within that fixed set.

    Groups are reduced to sums first. Each resample weighs each group by a Poisson(1) count, which stands for sampling groups with replacement
    and needs no order of rows. Rows without a group are an error; resamples that draw no group don't count.
    """
    if not rows.filter(F.col(group).isNull() | (F.trim(F.col(group).cast("string")) == "")).isEmpty():
        raise ValueError(f"rows without {group}")
    a, p = F.col(actual), F.col(predicted)
    sums = stored(rows.groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("n"), F.sum(F.abs(a - p)).alias("e"), F.sum(F.abs(a - baseline)).alias("b"), F.sum(p - a).alias("g")), "group-sums")
    interval = lambda v, name: [F.percentile(v, q).alias(f"{name}_{side}_95") for q, side in ((0.025, "lower"), (0.975, "upper"))]
    ratio = lambda top, bottom: F.try_divide(F.col(top), F.col(bottom))
    spread = resampled_sums(sums, "_group", ["n", "e", "b", "g"], resamples, seed).agg(*interval(F.try_divide(F.col("e") - F.col("b"), F.col("n")), "difference"), *interval(ratio("g", "n"), "calibration"))
    out = sums.agg(F.count("*").alias("clusters"), (F.sum(F.col("e") - F.col("b")) / F.sum("n")).alias("difference"), (F.sum("g") / F.sum("n")).alias("calibration_gap")).join(F.broadcast(spread))
    if key is None:
        return out
    hits = stored(top_set_hits(rows, key, actual, predicted).groupBy(F.col(group).alias("_group")).agg(F.count("*").alias("n"), F.sum("hit").alias("h")), "top-set")
    within = resampled_sums(hits, "_group", ["n", "h"], resamples, seed + 1).agg(*interval(ratio("h", "n"), "precision"))
    return out.join(F.broadcast(hits.agg(F.count("*").alias("top_clusters"), (F.sum("h") / F.sum("n")).alias("precision")))).join(F.broadcast(within))


def promotion(evidence: DataFrame) -> DataFrame:
    """evidence with failed checks and the decision. Missing evidence fails its check."""
    e = F.col
    checks = {
        "taxonomy_adjudication_passed": e("taxonomy_status") == "passed",
        "product_enrichment_passed": e("enrichment_status") == "passed",
        "git_worktree_clean": ~e("worktree_dirty"),
        "advertiser_overlap_zero": e("advertiser_overlap") == 0,
        "holdout_rows_at_least_100": e("n_test") >= 100,
        "holdout_advertisers_at_least_10": e("n_test_advertisers") >= 10,
        "uncertainty_is_advertiser_clustered": e("n_clusters") == e("n_test_advertisers"),
        "mae_point_better_than_baseline": e("test_mae") < e("baseline_mae"),
        "mae_bootstrap_interval_below_zero": e("mae_upper_95") < 0,
        "top_20pct_precision_lower_bound_above_prevalence": e("precision_lower_95") > 0.2,
    }
    failed = F.filter(F.array(*[F.when(~F.coalesce(c, F.lit(False)), name) for name, c in checks.items()]), lambda x: x.isNotNull())
    return evidence.withColumn("failed_checks", F.array_join(failed, ",")).withColumn("status", F.when(F.col("failed_checks") == "", "promoted").otherwise("blocked"))


def pearson_test(rows: DataFrame, x: str, y: str, least: int = 10) -> DataFrame:
    """One row: n, r and its two-sided p; null with fewer than `least` pairs or a constant side."""
    known = rows.filter(F.col(x).isNotNull() & F.col(y).isNotNull())
    out = known.agg(F.count("*").alias("n"), F.when(F.count("*") >= least, F.corr(F.col(x).cast("double"), F.col(y).cast("double"))).alias("r"))
    df = F.col("n") - 2
    t = F.when(F.abs("r") < 1, F.col("r") * F.sqrt(df / (1 - F.col("r") * F.col("r"))))
    return out.withColumn("p", F.when(F.abs("r") >= 1, F.lit(0.0)).otherwise(t_probability(t, df)))


def anova_test(rows: DataFrame, group: str, value: str) -> DataFrame:
    """anova with the upper probability of F."""
    return anova(rows, group, value).withColumn("p", f_probability(F.col("f"), F.col("n_groups") - 1, F.col("n") - F.col("n_groups")))


def welch_test(rows: DataFrame, missing: str, value: str, least: int = 10) -> DataFrame:
    """welch with the Welch-Satterthwaite degrees of freedom, the two-sided p, and whether values look missing not at random."""
    gone, v = F.col(missing).isNull(), F.col(value)
    spread = rows.filter(v.isNotNull()).agg((F.var_samp(F.when(gone, v)) / F.count_if(gone)).alias("_a"), (F.var_samp(F.when(~gone, v)) / F.count_if(~gone)).alias("_b"))
    out = welch(rows, missing, value, least).join(F.broadcast(spread))
    a, b = F.col("_a"), F.col("_b")
    df = F.pow(a + b, F.lit(2)) / (a * a / (F.col("n_null") - 1) + b * b / (F.col("n_non_null") - 1))
    tested = out.withColumn("df", F.when(F.col("t").isNotNull(), df)).withColumn("p", t_probability(F.col("t"), F.col("df")))
    return tested.withColumn("likely_mnar", F.col("p") < 0.05).drop("_a", "_b")


def column_kinds(rows: DataFrame, ids: list[str], embeddings: list[str]) -> dict[str, str]:
    """Kind of each column: by name for ids and embeddings, else by its type."""
    kinds = {}
    for name, kind in rows.dtypes:
        number = kind in ("tinyint", "smallint", "int", "bigint", "float", "double") or kind.startswith("decimal")
        kinds[name] = "id" if name in ids else "embedding" if name in embeddings else "boolean" if kind == "boolean" else "numeric" if number else "categorical"
    return kinds


def quality_report(rows: DataFrame, ids: list[str], embeddings: list[str]) -> DataFrame:
    """A row per column: kind, n, null_rate and flags, those with flags and most nulls first (rank 1 on; null without flags).

    Values of all columns go through one aggregation by column and value; vectors only through counts.
    """
    kinds = column_kinds(rows, ids, embeddings)
    plain = [c for c, k in kinds.items() if k in ("numeric", "boolean", "categorical")]
    whole = rows.agg(F.count("*").alias("n"), *[F.count(c).alias(f"k_{c}") for c in kinds], *[F.count_if(F.size(c) > 0).alias(f"e_{c}") for c, k in kinds.items() if k == "embedding"], *[F.count_distinct(F.size(c)).alias(f"d_{c}") for c, k in kinds.items() if k == "embedding"])
    facts = [F.struct(F.lit(c).alias("column"), F.lit(k).alias("kind"), F.col("n"), (1 - F.try_divide(f"k_{c}", "n")).alias("null_rate"), (1 - F.try_divide(f"e_{c}", "n") if k == "embedding" else F.lit(None).cast("double")).alias("empty_rate"), (F.col(f"d_{c}") if k == "embedding" else F.lit(0).cast("long")).alias("dims")) for c, k in kinds.items()]
    base = whole.select(F.explode(F.array(*facts)).alias("x")).select("x.*")
    long = rows.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("v")) for c in plain])).alias("x")).select("x.*").filter(F.col("v").isNotNull())
    counts = long.groupBy("column", "v").agg(F.count("*").alias("k"))
    values = counts.groupBy("column").agg(F.count("*").alias("distinct"), F.sum("k").alias("known"), F.max("k").alias("most"))
    out = base.join(values, "column", "left")
    share, kind = F.try_divide("most", "known"), F.col("kind")
    same = (F.col("distinct") == 1) & (F.col("known") > 1)
    pointed = F.coalesce(share >= POINT_MASS, F.lit(False))
    flags = F.array(
        F.when(F.col("null_rate") >= NULLS, "high_null_rate"),
        F.when(F.col("empty_rate") >= NULLS, "high_empty_rate"),
        F.when(F.col("dims") > 1, "inconsistent_dims"),
        F.when(kind.isin("numeric", "boolean") & same, "zero_variance"),
        F.when(((kind == "numeric") & ~same | (kind == "categorical")) & pointed, "high_point_mass"),
        F.when((kind == "categorical") & (F.col("distinct") / F.col("known") >= CARDINALITY) & (F.col("distinct") > 20), "high_cardinality"),
    )
    flagged = out.withColumn("flags", F.array_join(F.filter(flags, lambda f: f.isNotNull()), ",")).select("column", "kind", "n", "null_rate", "distinct", "flags")
    order = Window.partitionBy(F.col("flags") != "").orderBy(F.desc("null_rate"), "column")  # a row per column
    return flagged.withColumn("flag_rank", F.when(F.col("flags") != "", F.row_number().over(order)))


def dimensionality(n_rows: int, features: dict[str, int], spark) -> DataFrame:
    """A row per variant: its features, rows a feature, and a flag where there are too few."""
    rows = spark.createDataFrame([(k, v) for k, v in features.items()], "variant string, n_features long")
    ratio = F.try_divide(F.lit(float(n_rows)), F.col("n_features"))
    flag = F.when(F.col("n_features") >= n_rows, "features_exceed_rows").when(ratio < 10, "thin_ratio")
    return rows.withColumn("rows_per_feature", F.round(ratio, 2)).withColumn("flag", flag)
