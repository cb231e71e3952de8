"""Reference labels beside predictions, reviews and their adjudication, and samples to label."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from admill.operators.statistics import cohen_kappa

DOUBLE_REVIEWED, KAPPA = 0.20, 0.80
# Price contexts whose offers don't count as recovered prices.
DISCARDED = ["shipping_or_promo_banner", "rhetorical_or_competitor_price", "cart_subtotal_widget"]


def boolean_accuracy(rows: DataFrame, predicted: str, expected: str) -> DataFrame:
    """One row over the labelled rows: n, correct, accuracy (0 without any). A missing prediction is wrong."""
    right = F.count_if(F.coalesce(F.col(predicted) == F.col(expected), F.lit(False)))
    return rows.filter(F.col(expected).isNotNull()).agg(F.count("*").alias("n"), right.alias("correct"), F.coalesce(F.try_divide(right.cast("double"), F.count("*")), F.lit(0.0)).alias("accuracy"))


def judgment_rate(rows: DataFrame, expected: str) -> DataFrame:
    """One row over the judged rows: n, how many were judged true, and their share (0 without any)."""
    return boolean_accuracy(rows.withColumn("_true", F.lit(True)), "_true", expected)


def price_context_accuracy(golden: DataFrame, offers: DataFrame, key: str = "url") -> DataFrame:
    """One row: share of pages whose price was recovered as expected, and of those with an expected context, the share predicted right.

    golden: key, expected_context (null: nothing to classify), expected_recoverable. offers: key, context, price.
    A page's context is its offers' most frequent one, the first in the alphabet of equal ones.
    """
    kept = F.col("price").isNotNull() & ~F.coalesce(F.col("context").isin(DISCARDED), F.lit(False))
    recovered = offers.groupBy(key).agg((F.count_if(kept) > 0).alias("_recovered"))
    counts = offers.filter(F.col("context").isNotNull()).groupBy(key, "context").agg(F.count("*").alias("_n"))
    first = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("_n"), "context"))
    modes = counts.withColumn("_rn", first).filter("_rn = 1").select(key, F.col("context").alias("_context"))
    met = golden.join(recovered, key, "left").join(modes, key, "left")
    right = F.count_if(F.coalesce("_recovered", F.lit(False)) == F.col("expected_recoverable"))
    known = F.count("expected_context")
    return met.agg(
        F.count("*").alias("n"), known.alias("n_with_context"), F.coalesce(F.try_divide(right.cast("double"), F.count("*")), F.lit(0.0)).alias("recoverable_accuracy"),
        F.coalesce(F.try_divide(F.count_if(F.col("_context") == F.col("expected_context")).cast("double"), known), F.lit(0.0)).alias("context_accuracy"),
    )


def with_truth(rows: DataFrame, truth: DataFrame, key: str, position: str) -> DataFrame:
    """rows with a known truth: by id where the truth row has one, else by position. truth: key, position, truth; one row each."""
    known = truth.filter(F.col("truth").isNotNull())
    by_id = known.filter(F.col(key).isNotNull()).select(key, F.col("truth").alias("_by_id"))
    by_place = known.filter(F.col(key).isNull()).select(position, F.col("truth").alias("_by_place"))
    met = rows.join(by_id, key, "left").join(by_place, position, "left")
    return met.withColumn("truth", F.coalesce("_by_id", "_by_place")).drop("_by_id", "_by_place").filter(F.col("truth").isNotNull())


def borderline(confidence: Column) -> Column:
    return (confidence >= 0.6) & (confidence < 0.8)


def review_gaps(sample: DataFrame, reviews: DataFrame, key: str) -> DataFrame:
    """(key, gap) of sampled rows without a review ('missing') and of reviews of other rows ('extra')."""
    missing = sample.select(key).distinct().join(reviews.select(key), key, "left_anti").withColumn("gap", F.lit("missing"))
    return missing.unionByName(reviews.select(key).distinct().join(sample.select(key), key, "left_anti").withColumn("gap", F.lit("extra")))


def same_ids(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """One row: whether both sides have as many rows and exactly the same ids."""
    gaps = review_gaps(a, b, key).agg(F.count("*").alias("_gaps"))
    sizes = a.agg(F.count("*").alias("_a")).join(F.broadcast(b.agg(F.count("*").alias("_b")))).join(F.broadcast(gaps))
    return sizes.select(F.col("_a").alias("n_left"), F.col("_b").alias("n_right"), ((F.col("_a") == F.col("_b")) & (F.col("_gaps") == 0)).alias("equal"))


def adjudicated(reviews: DataFrame) -> DataFrame:
    """reviews with outcome and final label.

    reviews: ad_id and, for each of primary, secondary and adjudication, a struct (reviewer, label, subcategory, rationale) or
    null. The outcome is 'primary', 'agreed' or 'adjudicated', or names what is wrong; wrong rows have no final label.
    """
    p, s, a = F.col("primary"), F.col("secondary"), F.col("adjudication")
    bad = lambda d: d["label"].isNull() | (F.coalesce(F.trim(d["reviewer"]), F.lit("")) == "")
    agree = (p["label"] == s["label"]) & (~p["label"] | p["subcategory"].eqNullSafe(s["subcategory"]))
    outcome = (
        F.when(p.isNull() | bad(p), "primary_incomplete")
        .when(s.isNull(), "primary")
        .when(bad(s), "secondary_incomplete")
        .when(s["reviewer"] == p["reviewer"], "same_reviewer")
        .when(agree, "agreed")
        .when(a.isNull(), "adjudication_missing")
        .when(bad(a), "adjudication_incomplete")
        .when(a["reviewer"].isin(p["reviewer"], s["reviewer"]), "adjudicator_not_independent")
        .when(F.coalesce(F.trim(a["rationale"]), F.lit("")) == "", "rationale_missing")
        .otherwise("adjudicated")
    )
    final = F.when(F.col("outcome") == "adjudicated", a["label"]).when(F.col("outcome").isin("primary", "agreed"), p["label"])
    return reviews.withColumn("outcome", outcome).withColumn("final_label", final)


def adjudication_report(sample: DataFrame, reviews: DataFrame) -> DataFrame:
    """One row: counts, agreement, what failed, and how many labels are approved: all true ones if nothing failed, else none."""
    rows = adjudicated(reviews)
    double = rows.filter(F.col("secondary").isNotNull() & ~F.col("outcome").isin("primary_incomplete", "secondary_incomplete", "same_reviewer"))
    pairs = double.select(F.col("primary.label").alias("x"), F.col("secondary.label").alias("y"))
    kappa = cohen_kappa(pairs, "x", "y").select(F.col("n").alias("n_double_reviewed"), "agreement", "kappa")
    fine = F.col("outcome").isin("primary", "agreed", "adjudicated")
    disputed = F.col("outcome").isin("adjudicated", "adjudication_missing", "adjudication_incomplete", "adjudicator_not_independent", "rationale_missing")
    counts = rows.agg(
        F.count("*").alias("n_reviews"), F.count_distinct("ad_id").alias("_ids"), F.count_if(fine).alias("n_final_labels"), F.count_if(~fine).alias("n_invalid"), F.count_if(disputed).alias("n_disagreements"),
        F.count_if(F.col("outcome") == "adjudicated").alias("n_adjudicated"), F.count_if(F.col("final_label")).alias("_true"),
    )
    gaps = review_gaps(sample, reviews, "ad_id").agg(F.count_if(F.col("gap") == "missing").alias("n_missing"), F.count_if(F.col("gap") == "extra").alias("n_extra"))
    size = sample.agg(F.count("*").alias("n_sampled"))
    out = counts.join(F.broadcast(kappa)).join(F.broadcast(gaps)).join(F.broadcast(size)).withColumn("double_fraction", F.coalesce(F.try_divide("n_double_reviewed", "n_sampled"), F.lit(0.0)))
    checks = {
        "duplicate_reviews": F.col("_ids") < F.col("n_reviews"), "missing_reviews": F.col("n_missing") > 0, "extra_reviews": F.col("n_extra") > 0, "invalid_reviews": F.col("n_invalid") > 0,
        "double_review_too_rare": F.col("double_fraction") < DOUBLE_REVIEWED, "kappa_not_estimable": F.col("kappa").isNull(), "kappa_too_low": F.col("kappa") < KAPPA,
        "disagreement_not_adjudicated": F.col("n_disagreements") != F.col("n_adjudicated"), "labels_missing": F.col("n_final_labels") != F.col("n_sampled"),
    }
    failed = F.filter(F.array(*[F.when(F.coalesce(c, F.lit(False)), k) for k, c in checks.items()]), lambda x: x.isNotNull())
    out = out.withColumn("failures", F.array_join(failed, ",")).withColumn("status", F.when(F.col("failures") == "", "passed").otherwise("failed"))
    return out.withColumn("n_approved", F.when(F.col("status") == "passed", F.col("_true")).otherwise(0).cast("long")).drop("_ids", "_true")


def unapproved(labels: DataFrame, status: str, sample_hash: str, n_approved: int) -> DataFrame:
    """(reason, n) of what forbids using approved labels (label, sample_hash) under a report; empty if nothing does."""
    every = labels.agg(F.count("*").alias("n"), F.count_if(~F.coalesce("label", F.lit(False))).alias("other"), F.count_if(~F.col("sample_hash").eqNullSafe(F.lit(sample_hash))).alias("unbound"))
    reasons = F.array(
        F.struct(F.lit("report_not_passed").alias("reason"), F.lit(int(status != "passed")).cast("long").alias("n")),
        F.struct(F.lit("count_differs").alias("reason"), F.abs(F.col("n") - n_approved).alias("n")),
        F.struct(F.lit("label_not_true").alias("reason"), F.col("other").alias("n")),
        F.struct(F.lit("sample_differs").alias("reason"), F.col("unbound").alias("n")),
    )
    return every.select(F.explode(reasons).alias("r")).select("r.*").filter("n > 0")


def seeded_order(key: Column, seed: int) -> Column:
    """A text that orders rows by chance but alike everywhere."""
    return F.sha2(F.concat_ws(":", F.lit(str(seed)), key.cast("string")), 256)


def random_sample(rows: DataFrame, key: str, n: int, seed: int = 42) -> DataFrame:
    """n rows without replacement, the same for a seed wherever it runs."""
    return rows.orderBy(seeded_order(F.col(key), seed), key).limit(n)


def shortfall_sample(candidates: DataFrame, present: DataFrame, category: str, key: str, first: Column, per_category: int = 6, seed: int = 42) -> DataFrame:
    """candidates that top each category up to `per_category`: present ones (category, key) count and aren't taken again; `first` ones go first."""
    have = present.groupBy(category).agg(F.count_distinct(key).alias("_have"))
    new = candidates.join(present.select(key).distinct(), key, "left_anti").join(F.broadcast(have), category, "left")
    place = F.row_number().over(Window.partitionBy(category).orderBy(F.when(first, 0).otherwise(1), seeded_order(F.col(key), seed), key))
    return new.withColumn("place", place).filter(F.col("place") <= per_category - F.coalesce("_have", F.lit(0))).drop("_have")
