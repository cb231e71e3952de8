"""Sequence packing as a cutting-stock problem.

Documents become token ids with an end id, cut into full sequences and a remainder. The remainders'
lengths fall into classes of `capacity / CLASSES` tokens, and the histogram of classes (at most
`CLASSES` numbers, whatever the corpus) is the demand of a linear program whose columns are
patterns: multisets of classes that fit one sequence. Columns are generated: the program's duals
price classes, a knapsack dynamic program finds the best pattern, and the loop ends when Farley's
bound proves the solution within `GAP` of the optimum. Patterns are rounded down, and first-fit-decreasing
packs what that leaves over. What then remains, because only patterns of under `MIN_FILL` would hold it, is laid end to end and cut where
a sequence ends: only there is a piece shorter than a sequence cut.

The plan assigns ranks: the k-th piece of a class goes to the k-th place that the patterns have for
it, or to a position among those laid end to end; both are arithmetic. Ranks are taken in salted
buckets of a length, their number set by its own count, so a length that a third of all documents
share is spread over many tasks. Offsets are running sums within a sequence.

Cases: a null or empty text is one piece with the end id only; null and repeated doc_ids are
packed row by row; ties of length are broken by row; an empty table gives an empty result; texts are
encoded whole. Of the columns of docs only those named in `keep` go on, so others may have any name;
a kept column with the name of a result is an error.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from admill.llm.common import join_checked, materialise, require
from admill.llm.tokens import default_ranks, encode

CAPACITY, END, GAP, CLASSES, MIN_FILL = 1024, 0, 0.002, 128, 0.95
#: Rows of one length that are ranked together, and most such buckets of a length.
BUCKET_ROWS, MAX_BUCKETS = 500, 10_000
_RESULTS = {"start", "length", "ids", "doc_tokens", "sequence_id", "offset"}

Pattern = tuple[tuple[int, int], ...]


def pieces(docs: DataFrame, capacity: int = CAPACITY, path: str | None = None, end: int = END, keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """The kept columns of docs, a row per piece: start, length, ids (little-endian unsigned 32-bit), doc_tokens."""
    ranks = path or default_ranks()
    if clash := _RESULTS & set(keep):
        raise ValueError(f"kept columns have names of results: {sorted(clash)}")

    def ids(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in texts:
            yield pd.Series([encode(x, ranks, end).tobytes() for x in batch], dtype=object)

    coded = require(docs, "text", *keep).select(*keep, F.pandas_udf(ids, "binary")(F.col("text")).alias("ids"))
    coded = coded.withColumn("doc_tokens", (F.octet_length("ids") / 4).cast("long"))
    starts = F.sequence(F.lit(0).cast("long"), F.col("doc_tokens") - 1, F.lit(capacity).cast("long"))
    cut = coded.select(*keep, "ids", "doc_tokens", F.explode(starts).alias("start"))
    length = F.least(F.col("doc_tokens") - F.col("start"), F.lit(capacity)).cast("long")
    return cut.select(*keep, "start", length.alias("length"), _part("ids", F.col("start"), length).alias("ids"), "doc_tokens")


def _part(ids: str, start: Column, length: Column) -> Column:
    return F.substring(F.col(ids), (start * 4 + 1).cast("int"), (length * 4).cast("int"))


def best_pattern(values: np.ndarray, capacity: int) -> tuple[float, Counter]:
    """Knapsack without limits on copies: the lengths of greatest total value that fit; values[i] belongs to length i."""
    best = np.zeros(capacity + 1)
    taken = np.zeros(capacity + 1, dtype=np.int64)
    gains = np.maximum(values[: capacity + 1], 0.0)
    for room in range(1, capacity + 1):
        totals = best[room - 1 :: -1][:room] + gains[1 : room + 1]
        i = int(totals.argmax())
        best[room], taken[room] = (totals[i], i + 1) if totals[i] > best[room - 1] else (best[room - 1], 0)
    pattern: Counter = Counter()
    room = capacity
    while room > 0:
        if taken[room]:
            pattern[int(taken[room])] += 1
            room -= int(taken[room])
        else:
            room -= 1
    return float(best[capacity]), pattern


def first_fit(demand: Counter, capacity: int) -> Iterator[tuple[Pattern, int]]:
    """First-fit-decreasing, a pattern at a time: longest lengths first, as many as still fit."""
    left = Counter({k: v for k, v in demand.items() if 0 < k <= capacity and v > 0})
    while left:
        room, pattern = capacity, Counter()
        for length in sorted(left, reverse=True):
            if take := min(left[length], room // length):
                pattern[length] = take
                room -= take * length
        times = min(left[k] // n for k, n in pattern.items())
        left -= Counter({k: n * times for k, n in pattern.items()})
        yield tuple(sorted(pattern.items(), reverse=True)), times


def solve(demand: dict[int, int], capacity: int, gap: float = GAP, min_fill: float = MIN_FILL) -> tuple[list[tuple[Pattern, int]], Counter]:
    """Patterns of at least that fill with the times each is used, and the demand that they leave over."""
    left = Counter({k: v for k, v in demand.items() if v > 0})
    lengths = sorted(k for k in left if k <= capacity)
    if not lengths:
        return [], left
    at = {k: i for i, k in enumerate(lengths)}
    m = len(lengths)
    columns: list[Pattern] = [((k, capacity // k),) for k in lengths]
    inverse = np.diag([1.0 / (capacity // k) for k in lengths])
    level = inverse @ np.array([demand[k] for k in lengths], dtype=float)
    values = np.zeros(capacity + 1)
    duals = inverse.sum(axis=0)
    for step in range(30 * m + 100):
        if step % 200 == 199:
            duals = inverse.sum(axis=0)
        values[lengths] = duals
        worth, pattern = best_pattern(values, capacity)
        if worth <= 1 + gap:  # Farley: the optimum is at least level.sum() / worth
            break
        column = np.zeros(m)
        for k, n in pattern.items():
            column[at[k]] = n
        change = inverse @ column
        with np.errstate(divide="ignore", invalid="ignore"):
            ratios = np.where(change > 1e-9, level / change, np.inf)
        out = int(ratios.argmin())
        pivot = inverse[out] / change[out]
        amount = level[out] / change[out]
        level = np.maximum(level - change * amount, 0.0)
        level[out] = amount
        inverse -= np.outer(change, pivot)
        inverse[out] = pivot
        duals = duals - (change.sum() - 1.0) * pivot
        columns[out] = tuple(sorted(pattern.items(), reverse=True))
    used: Counter = Counter()
    for i in np.argsort(-level):
        pattern = columns[int(i)]
        times = min(int(level[i] + 1e-9), *(left[k] // n for k, n in pattern))
        if times > 0 and sum(k * n for k, n in pattern) >= min_fill * capacity:
            used[pattern] += times
            for k, n in pattern:
                left[k] -= n * times
    for pattern, times in first_fit(left, capacity):
        if sum(k * n for k, n in pattern) >= min_fill * capacity:
            used[pattern] += times
            for k, n in pattern:
                left[k] -= n * times
    return sorted(used.items(), reverse=True), +left


PLAN = "plan_class long, first long, last long, copies long, sequence long, place long"
LENGTHS = "length long, class long, class_first long, buckets int"


def plan_rows(used: list[tuple[Pattern, int]]) -> list[tuple[int, int, int, int, int, int]]:
    """For each class of each pattern: the ranks it takes, its copies a sequence, its first sequence and place."""
    rows, sequence, given = [], 0, Counter()
    for pattern, times in used:
        place = 0
        for size, copies in pattern:
            first = given[size]
            given[size] += copies * times
            rows.append((size, first, given[size] - 1, copies, sequence, place))
            place += copies
        sequence += times
    return rows


def laid_out(demand: dict[int, int], capacity: int, gap: float = GAP) -> tuple[list[tuple], list[tuple]]:
    """Rows of PLAN and of LENGTHS for counts by exact length.

    Within a class, longer pieces have the lower ranks, so the ranks left over belong to known
    lengths. Those rows have copies 0, and their place is a token position from their first sequence on.
    """
    unit = max(1, capacity // CLASSES)
    classes: Counter = Counter()
    lengths = []
    for length in sorted(demand, reverse=True):
        size = -(-length // unit)
        lengths.append((length, size, classes[size], min(MAX_BUCKETS, -(-demand[length] // BUCKET_ROWS))))
        classes[size] += demand[length]
    used, left = solve(classes, capacity // unit, gap)
    rows = plan_rows(used)
    sequence, position = sum(n for _, n in used), 0
    for length, size, first, _ in lengths:
        stop = first + demand[length]
        first = max(first, classes[size] - left[size])
        if first < stop:
            rows.append((size, first, stop - 1, 0, sequence, position))
            position += (stop - first) * length
    return rows, lengths


def ranks(rows: DataFrame) -> DataFrame:
    """rows (with _row unique, and buckets by length) with rank: their number from 0 among rows of the same length."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64("_row"), F.col("buckets")).cast("int"))
    sizes = salted.groupBy("length", "_salt").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("length").orderBy("_salt").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("length", "_salt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    own = F.row_number().over(Window.partitionBy("length", "_salt").orderBy("_row")) - 1
    return salted.withColumn("_own", own).join(offsets, ["length", "_salt"]).withColumn("rank", F.col("_before") + F.col("_own")).drop("_salt", "_own", "_before")


def place(rows: DataFrame, capacity: int = CAPACITY, gap: float = GAP) -> DataFrame:
    """rows (_row unique, length at most capacity, any others), one or two rows each: with _skip and _take (the part of the row), sequence_id and offset."""
    spark = rows.sparkSession
    demand = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}  # at most `capacity` rows
    plan, lengths = laid_out(demand, capacity, gap)
    # a row for each length, and for each class of each pattern: thousands at most
    known = rows.join(F.broadcast(spark.createDataFrame(lengths, LENGTHS)), "length")
    ranked = ranks(known).withColumn("rank", F.col("rank") + F.col("class_first"))
    on = (F.col("class") == F.col("plan_class")) & F.col("rank").between(F.col("first"), F.col("last"))
    k = F.col("rank") - F.col("first")
    position = F.col("place") + k * F.col("length")
    inside = F.col("copies") > 0
    placed = ranked.join(F.broadcast(spark.createDataFrame(plan, PLAN)), on).select(
        *rows.columns,
        "copies",
        (F.col("sequence") + F.when(inside, F.floor(k / F.col("copies"))).otherwise(F.floor(position / capacity))).cast("long").alias("sequence_id"),
        F.when(inside, F.col("place") + F.pmod(k, F.col("copies"))).otherwise(F.pmod(position, F.lit(capacity))).alias("_at"),
    )
    before = F.sum("length").over(Window.partitionBy("sequence_id").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1))
    offset = F.when(inside, F.coalesce(before, F.lit(0))).otherwise(F.col("_at")).cast("long")
    room = F.lit(capacity) - F.col("_offset")
    part = lambda skip, take, sequence, at: F.struct(skip.cast("long").alias("_skip"), take.cast("long").alias("_take"), sequence.alias("sequence_id"), at.cast("long").alias("offset"))
    whole = F.array(part(F.lit(0), F.least(F.col("length"), room), F.col("sequence_id"), F.col("_offset")))
    rest = F.array(part(room, F.col("length") - room, F.col("sequence_id") + 1, F.lit(0)))
    parts = F.when(F.col("length") > room, F.concat(whole, rest)).otherwise(whole)
    return placed.withColumn("_offset", offset).select(*rows.columns, F.explode(parts).alias("_p")).select(*rows.columns, "_p.*")


def _numbered(parts: DataFrame) -> DataFrame:
    return materialise(parts.withColumn("_row", F.monotonically_increasing_id()), "pieces")


def pack(parts: DataFrame, capacity: int = CAPACITY, gap: float = GAP) -> DataFrame:
    """parts of pieces() with sequence_id and offset; those that a sequence's end cuts become two rows."""
    out = place(_numbered(parts), capacity, gap)
    cut = {"start": F.col("start") + F.col("_skip"), "length": F.col("_take"), "ids": _part("ids", F.col("_skip"), F.col("_take"))}
    return out.select(*[cut[c].alias(c) if c in cut else F.col(c) for c in parts.columns], "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, length, ids) of packed pieces that carry ids; a sequence holds at most `CAPACITY` of them."""
    inside = F.array_sort(F.collect_list(F.struct("offset", "ids")))
    joined = F.aggregate("_in", F.lit(b""), lambda acc, x: F.concat(acc, x["ids"]))
    return packed.groupBy("sequence_id").agg(F.sum("length").alias("length"), inside.alias("_in")).select("sequence_id", "length", joined.alias("ids"))


def packed_pieces(docs: DataFrame) -> DataFrame:
    """The digest of a packed corpus: a row per piece. Ids stay where they were written, but for the few pieces that are cut."""
    rows = _numbered(pieces(docs).withColumn("ids_crc32", F.crc32("ids")))
    placed = materialise(place(rows.drop("ids")), "placed")
    whole = F.col("_take") == F.col("length")
    cut = join_checked(rows.select("_row", "ids"), placed.filter(~whole), "_row").withColumn("ids_crc32", F.crc32(_part("ids", F.col("_skip"), F.col("_take"))))
    both = placed.filter(whole).unionByName(cut.select(*placed.columns))
    return both.select("doc_id", (F.col("start") + F.col("_skip")).alias("start"), F.col("_take").alias("length"), "ids_crc32", "doc_tokens", "sequence_id", "offset")
