"""Censored survival: scrape stamps, Kaplan-Meier curves, horizons and concordance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from admill.operators.ordering import MOST_VALUES, RANGES, in_ranges, with_row_number
from admill.operators.storage import stored

HORIZONS = (30, 60, 90, 180)
#: About how many rows of a concordance's blocks one task holds, and how many kinds one range of risk.
TASK_ROWS, RANGE_ROWS = 250_000, 500_000


def scrape_dates(ads: DataFrame, share: float = 0.01, least: int = 5) -> DataFrame:
    """end_dates that too many ads share to be endings: (end_date, n)."""
    counts = ads.filter(F.col("end_date").isNotNull()).groupBy("end_date").agg(F.count("*").alias("n"))
    total = counts.agg(F.sum("n").alias("_total"))
    return counts.join(F.broadcast(total)).filter((F.col("n") > share * F.col("_total")) & (F.col("n") >= least)).drop("_total")


def event_observed(ads: DataFrame, stamps: DataFrame) -> DataFrame:
    """ads with observed: the activity flag where there is one, else an end date that is no scrape stamp."""
    marked = ads.join(stamps.select("end_date", F.lit(True).alias("_stamp")), "end_date", "left")
    dated = F.col("end_date").isNotNull() & F.col("_stamp").isNull()
    return marked.withColumn("observed", F.when(F.col("is_active").isNotNull(), ~F.col("is_active")).otherwise(dated)).drop("_stamp")


def kaplan_meier(rows: DataFrame, duration: str, observed: str, by: list[str] | None = None) -> DataFrame:
    """(by..., t, at_risk, ended, survival) at each whole day that occurs; windows run over days, not rows."""
    by = by or []
    days = rows.groupBy(*by, F.col(duration).alias("t")).agg(F.count("*").alias("n"), F.count_if(observed).alias("ended"))
    # days differ within a lifetime's span, so a group's window holds thousands of rows at most
    order = Window.partitionBy(*(by or [F.lit(0)])).orderBy("t")
    at_risk = F.sum("n").over(order.rowsBetween(0, Window.unboundedFollowing))
    steps = days.withColumn("at_risk", at_risk)
    logs = F.sum(F.when(F.col("ended") < F.col("at_risk"), F.log(1 - F.col("ended") / F.col("at_risk"))).otherwise(0.0)).over(order.rowsBetween(Window.unboundedPreceding, 0))
    dead = F.max(F.col("ended") == F.col("at_risk")).over(order.rowsBetween(Window.unboundedPreceding, 0))
    return steps.select(*by, "t", "at_risk", "ended", F.when(dead, F.lit(0.0)).otherwise(F.exp(logs)).alias("survival"))


def benchmarks(rows: DataFrame, duration: str, observed: str, by: list[str], least: int = 20) -> DataFrame:
    """A row per group: days until survival falls to 75 % and 50 %, and survival at the horizons; null where unknown."""
    curve = kaplan_meier(rows, duration, observed, by)
    crossed = lambda s: F.min(F.when(F.col("survival") <= s, F.col("t")))
    at = lambda h: F.coalesce(F.min(F.when(F.col("t") <= h, F.col("survival"))), F.lit(1.0))
    sizes = curve.groupBy(*by).agg(F.max("at_risk").alias("n"), F.sum("ended").cast("long").alias("events_observed"), crossed(0.75).alias("_75"), crossed(0.5).alias("_50"), *[at(h).alias(f"_s{h}") for h in HORIZONS])
    ok = F.col("n") >= least
    status = F.when(~ok, "insufficient_sample").when(F.col("_75").isNull(), "threshold_not_estimable_due_to_censoring").otherwise("ok")
    return sizes.select(*by, "n", "events_observed", status.alias("status"), F.when(ok, F.col("_75")).alias("days_to_75pct"), F.when(ok, F.col("_50")).alias("median_days"), *[F.when(ok, F.col(f"_s{h}")).alias(f"s{h}") for h in HORIZONS])


def horizons(rows: DataFrame, duration: str, observed: str, at: tuple[int, ...] = HORIZONS, endings: int = 5, known: int = 20) -> DataFrame:
    """A row per horizon: survival, ads whose outcome is known by then, endings, and whether that is evidence enough.

    The interval is the log-log one by Greenwood's variance.
    """
    curve = kaplan_meier(rows, duration, observed)
    spread = F.when(F.col("ended") < F.col("at_risk"), F.col("ended") / (F.col("at_risk") * (F.col("at_risk") - F.col("ended")))).otherwise(0.0)
    d, e = F.col(duration), F.col(observed)
    counts = rows.agg(
        F.count("*").alias("n"),
        *[F.count_if(d >= h).alias(f"through{h}") for h in at],
        *[F.count_if((e & (d <= h)) | (d >= h)).alias(f"eligible{h}") for h in at],
        *[F.count_if(e & (d <= h)).alias(f"ended{h}") for h in at],
    )
    upto = curve.agg(*[F.coalesce(F.min(F.when(F.col("t") <= h, F.col("survival"))), F.lit(1.0)).alias(f"s{h}") for h in at], *[F.coalesce(F.sum(F.when(F.col("t") <= h, spread)), F.lit(0.0)).alias(f"v{h}") for h in at])
    pick = lambda h: F.struct(F.lit(h).alias("horizon"), *[F.col(f"{c}{h}").alias(c) for c in ("s", "v", "through", "eligible", "ended")])
    out = counts.join(F.broadcast(upto)).select("n", F.explode(F.array(*map(pick, at))).alias("h")).select("n", "h.*")
    s = F.col("s")
    half = 1.959963984540054 * F.sqrt("v") / F.abs(F.log(s))
    bound = lambda sign: F.when((s > 0) & (s < 1), F.exp(-F.exp(F.log(-F.log(s)) + sign * half))).otherwise(s)
    enough = (F.col("ended") >= endings) & (F.col("eligible") >= known)
    return out.select(
        F.col("horizon").cast("int").alias("horizon"), s.alias("survival"), bound(1).alias("lower_95"), bound(-1).alias("upper_95"), F.col("through").alias("observed_through"), "eligible",
        F.col("ended").alias("endings"), (F.col("eligible") / F.col("n")).alias("outcome_coverage"), F.when(enough, "ok").otherwise("insufficient_evidence").alias("status"),
    )


def block_points(numbered: DataFrame, digits: int, rows: int) -> DataFrame:
    """(digit, block, _range, r, sooner, later): events and later rows of each risk in a block, dealt by block and range into as many tasks as the rows need."""
    level = numbered.withColumn("digit", F.explode(F.sequence(F.lit(0), F.lit(digits - 1))))
    side = F.expr("shiftright(day, digit) % 2")
    block = level.select("digit", F.expr("shiftright(day, digit + 1)").alias("block"), "_range", "r", F.when(side == 0, F.when(F.col("e"), F.col("n"))).alias("sooner"), F.when(side == 1, F.col("n")).alias("later"))
    told = block.filter("sooner IS NOT NULL OR later IS NOT NULL")  # a censored row on the lower side meets nobody
    dealt = told.repartition(max(1, -(-rows * digits // TASK_ROWS)), "digit", "block", "_range")
    return dealt.groupBy("digit", "block", "_range", "r").agg(F.coalesce(F.sum("sooner"), F.lit(0)).alias("sooner"), F.coalesce(F.sum("later"), F.lit(0)).alias("later"))


def concordance(rows: DataFrame, duration: str, observed: str, risk: str) -> DataFrame:
    """One row: the share of comparable pairs in which the higher risk ends sooner, ties of risk counting a half, and the number of pairs.

    Pairs are never formed. Days are numbered in order; two different days part at exactly one binary
    digit of their numbers, so for each digit the events on the lower side of a block meet the rows on its higher
    side, as running sums along the risk. Blocks are summed by ranges of risk, so none has to fit one task; ranges and tasks grow with the kinds of rows.
    """
    kinds = stored(rows.groupBy(F.col(duration).cast("double").alias("t"), F.col(observed).alias("e"), F.col(risk).cast("double").alias("r")).agg(F.count("*").alias("n")), "risks")
    days = stored(with_row_number(kinds.select("t").distinct(), "t", [], "day"), "days")
    n_days, n_kinds = days.count(), kinds.count()
    digits = max(1, n_days.bit_length())
    ranged = in_ranges(kinds.filter("t IS NOT NULL AND r IS NOT NULL"), "r", max(RANGES, -(-n_kinds // RANGE_ROWS)))
    numbered = ranged.join(F.broadcast(days) if n_days <= MOST_VALUES else days, "t")
    keys = ["digit", "block"]
    points = block_points(numbered, digits, n_kinds)
    sums = points.groupBy(*keys, "_range").agg(F.sum("later").alias("_s"))
    whole = Window.partitionBy(*keys)
    lower = sums.select(*keys, "_range", F.coalesce(F.sum("_s").over(whole.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("_lower"), F.sum("_s").over(whole).alias("_all"))
    inside = F.coalesce(F.sum("later").over(Window.partitionBy(*keys, "_range").orderBy("r").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    met = points.withColumn("_inside", inside).filter("sooner > 0").join(lower, [*keys, "_range"])
    good = F.sum(F.col("sooner") * (F.col("_lower") + F.col("_inside") + 0.5 * F.col("later")))
    pairs = F.sum(F.col("sooner") * F.col("_all"))
    return met.agg(F.try_divide(good, pairs.cast("double")).alias("concordance"), F.coalesce(pairs, F.lit(0)).cast("long").alias("pairs"))

