"""Train and test splits, seeded samples, and diversified selections."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from admill.operators.ordering import with_row_number


def advertiser(page: Column, ad: Column) -> Column:
    """The page, or a group of its own for an ad without one."""
    return F.coalesce(F.nullif(page.cast("string"), F.lit("")), F.concat(F.lit("__ad__"), ad.cast("string")))


def temporal_split(rows: DataFrame, day: str, key: str, train_share: float = 0.8) -> DataFrame:
    """Dated rows with is_train: the first part by day, ties by key."""
    dated = rows.filter(F.col(day).isNotNull())
    cut = int(train_share * dated.count())
    numbered = with_row_number(dated.withColumn("_day", F.unix_date(day).cast("double")), "_day", [F.col(key)], "_rn")
    return numbered.withColumn("is_train", F.col("_rn") <= cut).drop("_day", "_rn")


def advertiser_holdout(rows: DataFrame, day: str, group: Column, test_share: float = 0.2) -> DataFrame:
    """Dated rows with is_test: the advertisers first seen last, each wholly on one side."""
    dated = rows.filter(F.col(day).isNotNull()).withColumn("_group", group)
    first = dated.groupBy("_group").agg(F.min(F.unix_date(day)).cast("double").alias("_first"))
    n = first.count()
    test = max(1, math.ceil(n * test_share)) if n else 0
    ranked = with_row_number(first, "_first", [F.col("_group")], "_rn").select("_group", (F.col("_rn") > n - test).alias("is_test"))
    return dated.join(ranked, "_group").drop("_group")


def stratified_sample(rows: DataFrame, strata: Column, key: str, size: int, seed: int = 42) -> DataFrame:
    """At most `size` rows, dealt round-robin over strata in a seeded hash order; a row in several strata is taken once."""
    spread = rows.withColumn("_stratum", F.explode(strata))
    order = Window.partitionBy("_stratum").orderBy(F.xxhash64(F.lit(seed), F.col(key)), key)
    turns = spread.withColumn("_turn", F.row_number().over(order)).filter(F.col("_turn") <= size)
    first = turns.groupBy(key).agg(F.min(F.struct("_turn", "_stratum")).alias("_at"))
    chosen = first.orderBy("_at", key).limit(size)
    return rows.join(chosen.select(key, F.col("_at._stratum").alias("stratum")), key)


def diversified_top(rows: DataFrame, score: str, group: Column, key: str, n: int) -> DataFrame:
    """n rows by score: first the best of each group, then the rest."""
    best = F.row_number().over(Window.partitionBy("_group").orderBy(F.desc(score), key))
    ranked = rows.withColumn("_group", group).withColumn("_best", best)
    return ranked.orderBy((F.col("_best") == 1).desc(), F.desc(score), key).limit(n).withColumn("first_of_group", F.col("_best") == 1).drop("_group", "_best")


def batches(rows: DataFrame, key: str, most_rows: int = 500) -> DataFrame:
    """rows with batch: groups of at most `most_rows` in the key's order, for sinks with request limits."""
    numbered = with_row_number(rows.withColumn("_k", F.col(key).cast("double")), "_k", [F.col(key)], "_rn")
    return numbered.withColumn("batch", F.floor((F.col("_rn") - 1) / most_rows)).drop("_k", "_rn")
