"""Target-distribution importance resampling: hashed n-gram weights, Gumbel scores, distributed LSD radix sort.

Texts are lower-cased (A-Z only) and split into runs of digits, letters a-z and characters beyond ASCII. Features are single
words and pairs of neighbours; a feature's bucket is its CRC-32 modulo `BUCKETS`. What all documents and all target
texts hold in each bucket gives the bucket's gain, a document's weight is the floored mean gain of its features, and a
Gumbel number drawn from the document's id turns the weight into a score: the highest scores are a sample without
replacement by weight.

Tasks count into one array of buckets each, so what is shuffled for the counts doesn't depend on text lengths, and score with one
array of gains. Ranks come from a least-significant-digit radix sort of the key (score down, doc_id up): each pass deals rows
by their present position into blocks of `BLOCK_ROWS`, counts every digit in each block, adds the counts
up over digits and blocks, and sends each row to its digit's offset plus its place among the block's rows of that digit. A
pass is a stable counting sort, no task sees more than a block of a digit, and after the last one positions are ranks.

Cases: null texts have no words; a document without features weighs 0; documents of under `LEAST_WORDS` words get no rank; a null
doc_id draws as an empty id and comes last at ties; rows with equal keys (repeated rows) are ranked in stored order; with no
target text all gains come from the corpus alone; an empty table gives an empty result; texts are read whole; extra columns are ignored.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from admill.llm.common import materialise, require

BUCKETS, LEAST_WORDS, SHARE, SEED = 10_000, 20, 25, 7
#: Bits of one digit of the sort, and rows of one block, a power of two.
DIGIT_BITS, BLOCK_BITS = 11, 16
#: A-Z become a-z, and every ASCII byte that is neither digit nor letter becomes a space.
_LETTERS = bytes(b if b > 127 or chr(b).isalnum() else 32 for b in range(256)).lower()


def words(text: str | None) -> list[bytes]:
    return (text or "").encode(errors="replace").translate(_LETTERS).split()


def feature_buckets(text: str | None, buckets: int = BUCKETS) -> np.ndarray:
    """Buckets of a text's words and pairs of words, repeats included."""
    parts = words(text)
    single = [crc32(w) for w in parts]
    pairs = [crc32(b" " + w, c) for w, c in zip(parts[1:], single)]  # the checksum of "a b" goes on from that of "a"
    return np.array(single + pairs, dtype=np.int64) % buckets


def bucket_counts(texts: DataFrame, into: str, buckets: int = BUCKETS) -> DataFrame:
    """(bucket, into): how many features of all texts fall into each bucket that has any."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, dtype=np.int64)
        for batch in batches:
            for text in batch.column("text").to_pylist():
                total += np.bincount(feature_buckets(text, buckets), minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held, pa.int32()), pa.array(total[held])], ["bucket", "n"])

    parts = require(texts, "text").select(F.col("text").cast("string").alias("text")).mapInArrow(count, "bucket int, n long")
    return parts.groupBy("bucket").agg(F.sum("n").alias(into))


def gains(corpus: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """floor(1000 ln(target share / corpus share)) of every bucket, with one feature added to each; as many numbers as buckets reach the driver."""
    source, wanted = np.zeros(buckets, dtype=np.int64), np.zeros(buckets, dtype=np.int64)
    for held, into in ((bucket_counts(corpus, "n", buckets), source), (bucket_counts(target, "n", buckets), wanted)):
        for r in held.collect():
            into[r["bucket"]] = r["n"]
    s, t = int(source.sum()), int(wanted.sum())
    ratio = lambda a, b: (b + 1.0) * (s + float(buckets)) / ((a + 1.0) * (t + float(buckets)))
    return np.array([math.floor(1000 * math.log(ratio(float(a), float(b)))) for a, b in zip(source, wanted)], dtype=np.int64)


def gumbel(doc_id: int | None, seed: int = SEED) -> int:
    """floor(-1000 ln(-ln u)) with u in (0, 1) from the id's SHA-256."""
    h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
    return math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))


def scored(docs: DataFrame, gain: np.ndarray, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score) of every row."""
    shared, buckets = docs.sparkSession.sparkContext.broadcast(gain), len(gain)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, n, weight = batch.column("doc_id").to_pylist(), [], []
            for text in batch.column("text").to_pylist():
                found = feature_buckets(text, buckets)
                n.append(len(found))
                weight.append(int(shared.value[found].sum()) // len(found) if len(found) else 0)
            total = [w + gumbel(i, seed) for i, w in zip(ids, weight)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(v, pa.int64()) for v in (n, weight, total))], ["doc_id", "n_features", "weight", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(score, "doc_id long, n_features long, weight long, score long")


def counting_pass(rows: DataFrame, digit: Column, position: str = "_at") -> DataFrame:
    """rows with positions sorted by a digit, stably: position order decides among equal digits."""
    dealt = rows.withColumns({"_d": digit, "_b": F.shiftright(position, BLOCK_BITS)})
    counts = materialise(dealt.groupBy("_d", "_b").agg(F.count("*").alias("_n")), "digit-counts")
    before = Window.orderBy("_d").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.groupBy("_d").agg(F.sum("_n").alias("_n")).select("_d", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))  # a row per value of a digit
    within = Window.partitionBy("_d").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.withColumn("_before", F.coalesce(F.sum("_n").over(within), F.lit(0))).join(F.broadcast(starts), "_d").select("_d", "_b", (F.col("_start") + F.col("_before")).alias("_offset"))
    own = F.row_number().over(Window.partitionBy("_d", "_b").orderBy(position)) - 1
    moved = dealt.withColumn("_own", own).join(offsets, ["_d", "_b"]).withColumn(position, F.col("_offset") + F.col("_own"))
    return materialise(moved.select(*rows.columns), "sort-pass")


def digits(number: Column, bits: int) -> list[Column]:
    """The digits of an unsigned number of so many bits, least significant first, about equally wide."""
    passes = -(-bits // DIGIT_BITS)
    width = -(-bits // passes) if passes else 0
    return [F.shiftrightunsigned(number, i * width).bitwiseAND(F.lit((1 << width) - 1)).cast("int") for i in range(passes)]


def ascending(name: str, low: int, high: int) -> tuple[Column, int]:
    """An unsigned number that is ordered like a whole-number column between low and high, and its bits."""
    if high - low < 1 << 63:
        return F.col(name) - F.lit(low), (high - low).bit_length()
    return F.col(name).bitwiseXOR(F.lit(-(1 << 63))), 64


def radix_ranked(rows: DataFrame, into: str = "rank") -> DataFrame:
    """Stored rows (doc_id, score, _at) with their rank from 1: higher scores first, then smaller doc_ids, null last, then _at.

    _at may have gaps at first, as row numbers from one file to the next do; each pass makes it dense."""
    low, high, least, most, nulls = rows.agg(F.min("doc_id"), F.max("doc_id"), F.min("score"), F.max("score"), F.count_if(F.col("doc_id").isNull())).first()
    if least is None:
        return rows.withColumn(into, F.lit(None).cast("long")).drop("_at")
    ids, id_bits = ascending("doc_id", low, high) if low is not None else (F.lit(0), 0)
    steps = digits(F.coalesce(ids, F.lit(0)), id_bits) + ([F.col("doc_id").isNull().cast("int")] if nulls else [])
    steps += digits(F.lit(most) - F.col("score"), (most - least).bit_length())
    for step in steps or [F.lit(0)]:
        rows = counting_pass(rows, step)
    return rows.withColumn(into, F.col("_at") + 1).drop("_at")


def resampled(docs: DataFrame, target: DataFrame, share: int = SHARE, least_words: int = LEAST_WORDS, seed: int = SEED) -> DataFrame:
    """(doc_id, n_features, weight, score, rank) of every row of docs; share percent of the rows with enough words are drawn, the others' rank is null."""
    require(docs, "doc_id", "text")
    rows = scored(docs, gains(docs, target), seed).withColumn("_at", F.monotonically_increasing_id())
    rows = materialise(rows, "scored")
    long_enough = F.col("n_features") >= 2 * least_words - 1  # n words have n - 1 pairs
    ranked = radix_ranked(rows.filter(long_enough))
    n = rows.filter(long_enough).count()
    drawn = ranked.withColumn("rank", F.when(F.col("rank") <= share * n // 100, F.col("rank")))
    return drawn.unionByName(rows.filter(~long_enough).drop("_at").withColumn("rank", F.lit(None).cast("long"))).select("doc_id", "n_features", "weight", "score", "rank")
