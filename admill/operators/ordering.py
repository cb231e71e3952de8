"""Global order without one global task: rows are dealt into value ranges, ranked there, and offset."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

RANGES = 64
#: Distinct values that one task may order; more are dealt into ranges.
MOST_VALUES = 50_000


def in_ranges(df: DataFrame, by: str, ranges: int = RANGES) -> DataFrame:
    """df with _range: equal values of the numeric column share one, and ranges follow the values' order; nulls come last."""
    bounds = sorted(set(df.approxQuantile(by, [i / ranges for i in range(1, ranges)], 0.005)))
    if not bounds:
        return df.withColumn("_range", F.lit(0))
    place = F.size(F.filter(F.array(*map(F.lit, bounds)), lambda b: b < F.col(by)))
    return df.withColumn("_range", F.when(F.col(by).isNull(), len(bounds) + 1).otherwise(place))


def with_row_number(df: DataFrame, by: str, ties: list[Column], into: str, descending: bool = False, ranges: int = RANGES) -> DataFrame:
    """df with a global row number from 1 by a numeric column, then ties."""
    dealt = in_ranges(df, by, ranges)
    sizes = dealt.groupBy("_range").agg(F.count("*").alias("_n"))
    step = F.desc("_range") if descending else F.asc("_range")
    before = F.coalesce(F.sum("_n").over(Window.orderBy(step).rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sizes.select("_range", before.alias("_before")))  # a row per range
    order = F.desc_nulls_last(by) if descending else F.asc_nulls_last(by)
    own = F.row_number().over(Window.partitionBy("_range").orderBy(order, *ties))
    return dealt.join(offsets, "_range").withColumn(into, (F.col("_before") + own).cast("long")).drop("_range", "_before")


def value_shares(df: DataFrame, by: str, into: str, where: Column | None = None) -> DataFrame:
    """(by, into): for each distinct value, the share of reference rows at or below it. where picks the reference rows."""
    weight = F.count("*") if where is None else F.sum(F.when(where, 1).otherwise(0))
    counts = df.groupBy(by).agg(weight.alias("_n"))
    if counts.limit(MOST_VALUES + 1).count() <= MOST_VALUES:
        below = F.sum("_n").over(Window.orderBy(by).rowsBetween(Window.unboundedPreceding, 0))
        return counts.select(by, (below / F.greatest(F.sum("_n").over(Window.partitionBy()), F.lit(1))).alias(into))
    dealt = in_ranges(counts, by)
    sums = dealt.groupBy("_range").agg(F.sum("_n").alias("_s"))
    before = F.coalesce(F.sum("_s").over(Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = F.broadcast(sums.select("_range", before.alias("_before"), F.sum("_s").over(Window.partitionBy()).alias("_all")))
    own = F.sum("_n").over(Window.partitionBy("_range").orderBy(by).rowsBetween(Window.unboundedPreceding, 0))
    return dealt.join(offsets, "_range").select(by, ((F.col("_before") + own) / F.greatest(F.col("_all"), F.lit(1))).alias(into))


def quantiles(df: DataFrame, by: str, points: list[float]) -> list[float]:
    """Exact quantiles with linear interpolation of a numeric column, nulls left out; empty without values. Only the rows at their places reach the driver."""
    known = df.filter(F.col(by).isNotNull()).select(F.col(by).cast("double").alias("x"))
    n = known.count()
    if not n:
        return []
    places = [q * (n - 1) for q in points]
    wanted = sorted({int(p) + 1 for p in places} | {min(n, int(p) + 2) for p in places})
    found = {r["_i"]: r["x"] for r in with_row_number(known, "x", [], "_i").filter(F.col("_i").isin(wanted)).collect()}
    return [found[int(p) + 1] + (p - int(p)) * (found[min(n, int(p) + 2)] - found[int(p) + 1]) for p in places]


def grouped_quantiles(df: DataFrame, group: str, by: str, points: list[float], into: str = "quantiles") -> DataFrame:
    """(group, into): exact quantiles of a numeric column within each group, with linear interpolation, nulls left out; groups without values don't come.

    Each group's values are dealt into ranges of about equal size by a mergeable sketch, and counted. A quantile's two places lie in ranges that these
    counts tell, and only the rows of such ranges are ordered, so neither a group's values nor an order of all of them meets in one task.
    """
    known = df.filter(F.col(by).isNotNull()).select(F.col(group).alias("_g"), F.col(by).cast("double").alias("_x"))
    counted = known.groupBy("_g", "_x").agg(F.count("*").alias("_n"))  # equal values are one row from here on
    bounds = counted.groupBy(F.col("_g").alias("_h")).agg(F.percentile_approx("_x", [i / RANGES for i in range(1, RANGES)], 1000).alias("_bounds"))
    dealt = counted.join(bounds, F.col("_g").eqNullSafe(F.col("_h"))).select("_g", "_x", "_n", F.size(F.filter(F.array_distinct("_bounds"), lambda b: b < F.col("_x"))).alias("_range"))
    before, whole = Window.partitionBy("_g").orderBy("_range").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy("_g")
    sizes = dealt.groupBy("_g", "_range").agg(F.sum("_n").alias("_n")).select("_g", "_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("_all"), F.col("_n").alias("_here"))
    place = lambda q: (F.col("_all") - 1) * q
    low = lambda q: F.floor(place(q)) + 1
    wanted = F.array(*[p for q in points for p in (low(q), F.least(low(q) + 1, F.col("_all")))])
    held = sizes.filter(F.exists(wanted, lambda p: (p > F.col("_before")) & (p <= F.col("_before") + F.col("_here")))).drop("_here").withColumnsRenamed({"_g": "_h", "_range": "_r"})
    upto = F.sum("_n").over(Window.partitionBy("_g", "_range").orderBy("_x").rowsBetween(Window.unboundedPreceding, 0))
    rows = dealt.join(held, F.col("_g").eqNullSafe(F.col("_h")) & (F.col("_range") == F.col("_r"))).withColumn("_last", F.col("_before") + upto)
    at = lambda p: F.max(F.when((p <= F.col("_last")) & (p > F.col("_last") - F.col("_n")), F.col("_x")))
    found = rows.groupBy(F.col("_g").alias(group)).agg(F.first("_all").alias("_all"), *[at(p).alias(f"{side}{i}") for i, q in enumerate(points) for side, p in (("_low", low(q)), ("_high", F.least(low(q) + 1, F.col("_all"))))])
    between = [F.col(f"_low{i}") + (place(q) - F.floor(place(q))) * (F.col(f"_high{i}") - F.col(f"_low{i}")) for i, q in enumerate(points)]
    return found.select(group, F.array(*between).alias(into))
