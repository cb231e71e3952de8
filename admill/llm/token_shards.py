"""Training-order materialisation: token sequences at permuted slots in fixed-stride binary shards.

Each input partition is one token stream (its documents, an end id after each) cut into sequences
of `LENGTH` ids; only a stream's last sequence is padded. A sequence's number, partition and place
in it, enters a keyed Feistel permutation that walks its cycles until it falls into the domain of
all possible numbers: as many partitions as there are, times the most sequences that one of them can hold. That bound comes from
one count of text bytes, of which an id has at least one, so the place in the order is known while the stream is still being read, and texts
are encoded once. Storing the sequences first, so as to number them without
gaps before they are permuted, would take 3.3 times the input on disk of 3. Shards are equal ranges of the permuted domain, as many as keep
one near `SHARD_BYTES`; a shard's task sorts its sequences and writes them as 16-bit ids with the same stride. The counts of the
shards then turn into each shard's first slot, which makes slots dense: a slot is the rank of a permuted number. Sequence s is at
stride * (s - first slot) of its shard, so a reader can stop and resume at any slot.

The order depends on how docs are partitioned, which has to be the same when texts are counted and when they are read: so it is for files and
stored tables. Where a partition turns out to hold more than was counted, writing stops with an error.

Cases: null and empty texts contribute their end id; null and repeated doc_ids are carried along, as are ties; extra
columns of docs are left out whatever their names; an empty table writes no shard; texts are encoded whole. The end id also
pads a stream's last sequence, whose n_tokens tells where it ends. A vocabulary of more than 2**16 ids is an error, since
ids are stored in 16 bits.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator
from contextlib import ExitStack

import numpy as np
import pandas as pd
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F

from admill.llm.common import materialise, require, scratch
from admill.llm.files import opened, written
from admill.llm.tokens import default_ranks, encode

LENGTH, END, PAD, KEY, ROUNDS = 1024, 50256, 50256, 2024, 6
#: About how many bytes of ids one shard holds where the input is large; a byte of text makes a quarter of an id, two bytes each.
SHARD_BYTES, _BYTES_PER_BYTE = 256_000_000, 0.5
SPANS = "array<struct<doc_id: string, start: bigint, length: bigint, offset: bigint>>"
SHARDED = f"shard long, place long, n_tokens long, ids_crc32 long, docs {SPANS}, file string"


def round_keys(key: int, rounds: int = ROUNDS) -> np.ndarray:
    return np.array([int.from_bytes(hashlib.blake2b(f"{key}:{i}".encode(), digest_size=8).digest(), "little") for i in range(rounds)], dtype=np.uint64)


def _mixed(x: np.ndarray, key: np.uint64) -> np.ndarray:
    x = (x ^ key) * np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(32))


def permute(numbers: np.ndarray, domain: int, key: int = KEY) -> np.ndarray:
    """A bijection of [0, domain) by a balanced Feistel network over the next power of four, walked until within the domain."""
    half = np.uint64(max(1, ((domain - 1).bit_length() + 1) // 2))
    mask = (np.uint64(1) << half) - np.uint64(1)
    keys = round_keys(key)
    out = np.asarray(numbers, dtype=np.uint64).copy()
    walking = np.ones(len(out), dtype=bool)
    while walking.any():
        x = out[walking]
        left, right = x >> half, x & mask
        for k in keys:
            left, right = right, left ^ (_mixed(right, k) & mask)
        out[walking] = (left << half) | right
        walking = out >= np.uint64(domain)
    return out


def bounds(docs: DataFrame, length: int = LENGTH) -> tuple[int, int, int]:
    """Number of partitions of docs, the most sequences that one of them can hold, and bytes of all texts."""
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("long")
    each = docs.groupBy(F.spark_partition_id().alias("p")).agg(F.sum(size).alias("bytes"), F.count("*").alias("n"))
    last, most, total = each.agg(F.max("p"), F.max(F.col("bytes") + F.col("n")), F.sum("bytes")).first()
    return (0, 0, 0) if last is None else (last + 1, most // length + 1, total)


def streams(docs: DataFrame, places: int, length: int = LENGTH, path: str | None = None) -> DataFrame:
    """(number, n_tokens, ids, docs) of each sequence; ids are little-endian and 16 bits wide. places: the most sequences of a partition."""
    ranks = path or default_ranks()

    def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        number = TaskContext.get().partitionId() * places
        end = number + places
        held, size, spans = [], 0, []

        def sequence(ids: np.ndarray, spans: list, real: int) -> tuple:
            nonlocal number
            number += 1
            if number > end:
                raise ValueError("docs came in other partitions than they were counted in; store them first")
            if ids.max() >> 16:
                raise ValueError(f"id {ids.max()} needs more than 16 bits")
            return number - 1, real, ids.astype("<u2").tobytes(), spans

        for batch in batches:
            rows = []
            for doc_id, text in batch.itertuples(index=False):
                ids = encode(text, ranks, END)
                start = 0
                while start < len(ids):
                    take = min(length - size, len(ids) - start)
                    held.append(ids[start : start + take])
                    spans.append((doc_id, start, take, size))
                    start, size = start + take, size + take
                    if size == length:
                        rows.append(sequence(np.concatenate(held), spans, length))
                        held, size, spans = [], 0, []
            yield pd.DataFrame(rows, columns=["number", "n_tokens", "ids", "docs"])
        if size:
            ids = np.concatenate([*held, np.full(length - size, PAD, dtype=np.uint32)])
            yield pd.DataFrame([sequence(ids, spans, size)], columns=["number", "n_tokens", "ids", "docs"])

    rows = docs.select(F.col("doc_id").cast("string").alias("doc_id"), "text")
    return rows.mapInPandas(cut, f"number long, n_tokens long, ids binary, docs {SPANS}")


def slots(number: Column, domain: int, key: int = KEY) -> Column:
    def place(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for batch in batches:
            yield pd.Series(permute(batch.to_numpy(), domain, key).astype(np.int64))

    return F.pandas_udf(place, "long")(number)


def write_shards(docs: DataFrame, folder: str | None = None, length: int = LENGTH, shards: int | None = None, key: int = KEY) -> DataFrame:
    """Writes the shards and returns a row per sequence: slot, shard, byte_offset, n_tokens, ids_crc32, docs, file."""
    spark = docs.sparkSession
    folder = folder or scratch(spark, "shards")
    docs = require(docs, "doc_id", "text").select("doc_id", "text")
    partitions, places, total = bounds(docs, length)
    domain = max(1, partitions * places)
    shards = min(domain, shards or max(int(spark.conf.get("spark.sql.shuffle.partitions")), round(total * _BYTES_PER_BYTE / SHARD_BYTES)))
    width = -(-domain // shards)

    def write(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        attempt = TaskContext.get().taskAttemptId()
        now, place, out = -1, 0, None
        with ExitStack() as stack:
            for batch in batches:
                rows = []
                for shard, n_tokens, ids, spans in batch.itertuples(index=False):
                    if shard != now:
                        stack.pop_all().close()
                        now, place, uri = shard, 0, f"{folder}/shard-{shard:06d}.bin"
                        out = stack.enter_context(written(uri, attempt))
                    out.write(ids)
                    rows.append((shard, place, n_tokens, zlib.crc32(ids), spans, uri))
                    place += 1
                yield pd.DataFrame(rows, columns=["shard", "place", "n_tokens", "ids_crc32", "docs", "file"])

    placed = streams(docs, places, length).withColumn("_slot", slots(F.col("number"), domain, key)).withColumn("shard", F.floor(F.col("_slot") / width).cast("int"))
    dealt = placed.repartitionById(shards, F.col("shard")).sortWithinPartitions("shard", "_slot").select("shard", "n_tokens", "ids", "docs")
    stored = materialise(dealt.mapInPandas(write, SHARDED), "shard-rows")
    counts = stored.groupBy("shard", "file").agg(F.count("*").alias("sequences"))
    before = F.sum("sequences").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1))
    manifest = counts.withColumn("first_slot", F.coalesce(before, F.lit(0)))
    materialise_manifest(manifest, folder, length)
    first = manifest.select("shard", "first_slot")  # a row per shard
    return stored.join(F.broadcast(first), "shard").select(
        (F.col("first_slot") + F.col("place")).alias("slot"), "shard", (F.col("place") * (2 * length)).alias("byte_offset"), "n_tokens", "ids_crc32", "docs", "file"
    )


def materialise_manifest(manifest: DataFrame, folder: str, length: int) -> None:
    manifest.withColumn("stride", F.lit(2 * length)).coalesce(1).sortWithinPartitions("first_slot").write.mode("overwrite").parquet(f"{folder}/manifest")


def read_from(spark: SparkSession, folder: str, slot: int, most: int) -> Iterator[np.ndarray]:
    """Sequences from a slot on, in order: at most `most` of them. Seeks once a shard, then reads on."""
    shards = spark.read.parquet(f"{folder}/manifest").filter(F.col("first_slot") + F.col("sequences") > slot).orderBy("first_slot")
    for m in shards.toLocalIterator():
        with opened(m["file"]) as f:
            f.seek(max(0, slot - m["first_slot"]) * m["stride"])
            while most and (data := f.read(m["stride"])):
                most -= 1
                yield np.frombuffer(data, dtype="<u2")
        if not most:
            return


def sharded_documents(docs: DataFrame) -> DataFrame:
    """Where each document's tokens went: a row per document and sequence."""
    rows = write_shards(docs).withColumn("_d", F.explode("docs"))
    doc_id = F.expr("try_cast(_d.doc_id AS long)").alias("doc_id")
    return rows.select(doc_id, "_d.start", "_d.length", "slot", "_d.offset", "shard", "byte_offset", "n_tokens", "ids_crc32")
