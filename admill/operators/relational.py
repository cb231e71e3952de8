"""Row selection, unions and gates over keyed relations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F


def latest_per_key(rows: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by the order; the order should end in a unique column."""
    best = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return rows.withColumn("_rn", best).filter("_rn = 1").drop("_rn")


def merge_provenance(rows: DataFrame, key: str, arrival: Column, fields: list[str], label: str) -> DataFrame:
    """One row per key: the first arrival's fields, and all its labels, sorted and distinct."""
    first = F.min_by(F.struct(*fields), arrival).alias("_first")
    return rows.groupBy(key).agg(first, F.array_sort(F.collect_set(label)).alias("labels")).select(key, "_first.*", "labels")


def novelty(current: DataFrame, previous: DataFrame, key: str) -> DataFrame:
    """One row: how many distinct keys are new, kept and gone."""
    a = current.select(key).distinct().withColumn("_now", F.lit(True))
    b = previous.select(key).distinct().withColumn("_then", F.lit(True))
    both = a.join(b, key, "full_outer")
    return both.agg(
        F.count_if(F.col("_then").isNull()).alias("new"),
        F.count_if(F.col("_now") & F.col("_then")).alias("kept"),
        F.count_if(F.col("_now").isNull()).alias("gone"),
    )


def coverage(rows: DataFrame, fields: list[str], advertiser: str, least_rows: int, least_advertisers: int) -> DataFrame:
    """A row per field: rows and advertisers that have it (zero and false count as present), and whether a model may use it."""
    present = {f: F.col(f).isNotNull() & (F.col(f).cast("string") != "") for f in fields}
    one = rows.agg(F.count("*").alias("_n"), *[F.count_if(p).alias(f"r_{f}") for f, p in present.items()], *[F.count_distinct(F.when(p, F.col(advertiser))).alias(f"a_{f}") for f, p in present.items()])
    parts = [F.struct(F.lit(f).alias("field"), F.col(f"r_{f}").alias("rows"), F.col(f"a_{f}").alias("advertisers")) for f in fields]
    out = one.select("_n", F.explode(F.array(*parts)).alias("p")).select("p.*", F.try_divide("p.rows", "_n").alias("coverage"))
    return out.withColumn("model_support", (F.col("rows") >= least_rows) & (F.col("advertisers") >= least_advertisers))


def override(rows: DataFrame, fresh: DataFrame, key: str, column: str) -> DataFrame:
    """rows with the fresh value of a column where there is one. fresh has a row per key at most."""
    new = fresh.select(key, F.col(column).alias("_new"))
    return rows.join(new, key, "left").withColumn(column, F.coalesce("_new", column)).drop("_new")


def label_gate(ads: DataFrame, labels: DataFrame, key: str, accept: str) -> DataFrame:
    """ads with outcome accepted, rejected or unlabeled; what isn't labelled isn't accepted."""
    known = labels.select(key, F.col(accept).alias("_accept"))
    outcome = F.when(F.col("_accept").isNull(), "unlabeled").when(F.col("_accept"), "accepted").otherwise("rejected")
    return ads.join(known, key, "left").withColumn("outcome", outcome).drop("_accept")


def admit(ads: DataFrame, predictions: DataFrame, gold: DataFrame, key: str, confidence: float) -> DataFrame:
    """ads with one of seven outcomes: human labels first, then sure predictions; the rest is queued.

    predictions: key, predicted, confidence; gold: key, truth.
    """
    p = predictions.select(key, F.lit(True).alias("_has"), F.col("predicted").alias("_p"), F.col("confidence").alias("_c"))
    g = gold.select(key, F.col("truth").alias("_t"), F.lit(True).alias("_human"))
    outcome = (
        F.when(F.col("_has").isNull(), "missing_prediction")
        .when(F.col("_human") & F.coalesce("_t", F.lit(False)), "accepted_human")
        .when(F.col("_human"), "rejected_human")
        .when(F.col("_p").isNull() | F.col("_c").isNull(), "invalid_prediction")
        .when(F.col("_c") < confidence, "queued_low_confidence")
        .when(F.col("_p"), "accepted_classifier")
        .otherwise("rejected_classifier")
    )
    return ads.join(p, key, "left").join(g, key, "left").withColumn("outcome", outcome).drop("_has", "_p", "_c", "_t", "_human")


def pattern_metrics(rows: DataFrame, keys: list[str], value: str, least: int) -> DataFrame:
    """Groups of at least `least` rows: size, mean, deviation, maximum and mean over deviation."""
    out = rows.groupBy(*keys).agg(F.count("*").alias("sample_size"), F.avg(value).alias("mean"), F.stddev_samp(value).alias("deviation"), F.max(value).alias("best"))
    return out.filter(F.col("sample_size") >= least).withColumn("sharpe", F.try_divide("mean", F.nullif(F.col("deviation"), F.lit(0.0))))


def best_offer(offers: Column) -> Column:
    """Of an array of offers: one flagged best, else of quantity one, else the least price per unit, else the first."""
    flagged = F.get(F.filter(offers, lambda o: F.coalesce(o["is_best_value"], F.lit(False))), F.lit(0))
    single = F.get(F.filter(offers, lambda o: o["quantity"] == 1), F.lit(0))
    priced = F.filter(offers, lambda o: o["price_per_unit"].isNotNull())
    least = F.array_min(F.transform(priced, lambda o: o["price_per_unit"]))
    cheapest = F.get(F.filter(priced, lambda o: o["price_per_unit"] == least), F.lit(0))
    return F.coalesce(flagged, single, cheapest, F.get(offers, F.lit(0)))


def tracked(key: Column, end: Column) -> Column:
    """Whether an ad is known and hasn't ended."""
    return (F.coalesce(key.cast("string"), F.lit("")) != "") & (F.coalesce(end.cast("string"), F.lit("")) == "")


def attached(rows: DataFrame, features: DataFrame, key: str, into: str) -> DataFrame:
    """rows with the features of their key as a struct; null where there are none. features has a row per key at most."""
    packed = features.select(key, F.struct(*[c for c in features.columns if c != key]).alias(into))
    return rows.join(packed, key, "left")


def described(profile: DataFrame, known: DataFrame, importance: DataFrame) -> DataFrame:
    """A row per profiled feature with its kind and meaning (a plain entry for an unknown one) and its importance, if any."""
    out = profile.join(F.broadcast(known), "feature", "left").join(F.broadcast(importance), "feature", "left")  # a row per feature
    return out.withColumns({"kind": F.coalesce("kind", F.lit("numeric")), "meaning": F.coalesce("meaning", F.lit("not documented"))})


def freshness(rows: DataFrame, at: str, since: Column, today: Column, enough: int = 50, most_days: int = 7) -> DataFrame:
    """One row: rows since the last training, the newest row, whether there are enough to retrain, and whether the newest is too old."""
    new = F.count_if(F.col(at) >= since)
    return rows.agg(new.alias("n_new"), F.max(at).alias("newest"), (new >= enough).alias("retrain"), (F.datediff(F.any_value(today), F.max(at)) > most_days).alias("stale"))


def merged_semantics(partial: Column, told: Column) -> Column:
    """What a language model told wins where it says anything."""
    return F.coalesce(F.when(told.cast("string") != "", told), partial)


def direct_response(merged: dict[str, Column], offers: Column, told: dict[str, Column]) -> dict[str, Column]:
    """merged fields with the gaps filled: price from the best offer (a unit's, else the whole), variants from its labels, the rest as told."""
    best = best_offer(offers)
    labels = F.filter(F.transform(offers, lambda o: o["tier_label"]), lambda x: F.coalesce(x, F.lit("")) != "")
    fill = told | {"price": F.coalesce(best["price_per_unit"], best["total_price"]), "variants": F.when(F.size(labels) > 0, labels)}
    return {k: F.coalesce(merged[k], fill[k]) if k in merged and k in fill else merged.get(k, fill.get(k)) for k in {**merged, **fill}}
