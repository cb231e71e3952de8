"""Language identification by compression: the language whose dictionary makes a text smallest.

Each learned language has a raw-content zstandard dictionary of whole labelled texts. Texts are lower-cased and all
but their letters becomes single spaces. A text is cut into pieces of `PIECE` bytes, all of them are compressed with every
dictionary, and the sizes are added up: the language with the smallest sum is the prediction. Short pieces keep a text from
being its own dictionary, so a long text is judged by the language throughout. A text whose two smallest sums lie within `MARGIN` of each other is marked as rejected: it keeps its
best language, with the score its narrow margin gives, for the caller to set aside.

The dictionaries are fitted on a bounded sample: the `LANGUAGES` most frequent values of lang, of each at most `ROWS` different
texts chosen by hash, whole texts until they hold `DICTIONARY` bytes. Rows whose CRC-32 of the decimal doc_id is divisible by
`FOLDS` are held out and never learned from. Tasks get the dictionaries by broadcast, whose size these bounds fix.

Cases: null texts and texts without a letter are `und` with score 0, as is everything where no language was learned; null labels
and null doc_ids are never learned from and a null doc_id isn't held out; repeated rows count once in the sample and get
equal results; equal sums go to the language learned from most rows, then the first by name; one learned language takes
every text with letters; an empty table gives an empty result; very long texts are read whole, piece by piece; extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import lru_cache

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, Window, functions as F

from admill.llm.common import require

FOLDS = 5
#: The bounds of the labelled sample: languages, different texts of each, and bytes of each dictionary.
LANGUAGES, ROWS, DICTIONARY = 200, 1_000, 200_000
#: Bytes compressed at once, compression level, and the relative margin below which a prediction is rejected.
PIECE, LEVEL, MARGIN = 1_000, 6, 0.01
UNKNOWN = "und"


def held_out(doc_id: Column, folds: int = FOLDS) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % folds == 0, F.lit(False))


def letters_only(text: Column) -> Column:
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}]+", " ")


def training_texts(docs: DataFrame, languages: int = LANGUAGES, rows: int = ROWS) -> DataFrame:
    """(lang, n, text, place): the bounded sample of labelled rows that aren't held out, letters only; shorter texts than a dictionary first, then by hash. n counts a language's rows."""
    known = docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")) & F.col("text").rlike(r"\p{L}"))
    counts = known.groupBy("lang").agg(F.count("*").alias("n"), F.approx_count_distinct(F.xxhash64("text")).alias("_texts"))
    common = F.broadcast(counts.orderBy(F.desc("n"), "lang").limit(languages))
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    near = known.withColumn("_p", place).join(common, "lang").filter(F.col("_p") * F.col("_texts") < F.lit(8.0 * rows * (1 << 40)))  # some 8 * rows texts
    some = near.select("lang", "n", letters_only(F.col("text")).alias("text"), "_p").dropDuplicates(["lang", "text"])
    order = Window.partitionBy("lang").orderBy(F.octet_length("text") > DICTIONARY, "_p", "text")
    chosen = some.withColumn("place", F.row_number().over(order)).filter(F.col("place") <= rows)
    before = F.coalesce(F.sum(F.octet_length("text")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    return chosen.withColumn("_before", before).filter(F.col("_before") < DICTIONARY).select("lang", "n", "text", "place")


def dictionaries(docs: DataFrame) -> dict[str, bytes]:
    """The raw content of each learned language's dictionary, most frequent language first. Only the bounded sample reaches the driver."""
    held: dict[str, list[bytes]] = {}
    for r in training_texts(docs).orderBy(F.desc("n"), "lang", "place").toLocalIterator():
        held.setdefault(r["lang"], []).append(r["text"].encode(errors="replace"))
    return {lang: b"\n".join(texts)[-2 * DICTIONARY :] for lang, texts in held.items()}


def pieces(text: str) -> list[bytes]:
    data = text.encode(errors="replace")
    return [data[i : i + PIECE] for i in range(0, len(data), PIECE)]


def compressors(contents: dict[str, bytes]) -> dict[str, zstandard.ZstdCompressor]:
    out = {}
    for lang, content in contents.items():
        raw = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        raw.precompute_compress(level=LEVEL)
        out[lang] = zstandard.ZstdCompressor(dict_data=raw, write_content_size=False, write_checksum=False, write_dict_id=False)
    return out


def judged(sizes: list[int]) -> tuple[int, float, float]:
    """Place of the smallest sum, its score and its relative margin. The score weighs languages by 2^-(bits saved), evened out over a text's length."""
    best = min(range(len(sizes)), key=sizes.__getitem__)
    others = [s for i, s in enumerate(sizes) if i != best]
    margin = (min(others) - sizes[best]) / max(min(others), 1) if others else 1.0
    spare = [100 * (s - sizes[best]) / max(sizes[best], 1) for s in sizes]
    return best, 1 / sum(math.exp(-x) for x in spare), margin


def identified(docs: DataFrame, contents: dict[str, bytes] | None = None, margin: float = MARGIN) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, margin, rejected) of every row. contents: dictionaries, fitted on docs unless given."""
    require(docs, "doc_id", "text", "lang")
    shared = docs.sparkSession.sparkContext.broadcast(dictionaries(docs) if contents is None else contents)

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = compressors(shared.value)
        names = list(known)

        @lru_cache(maxsize=256)
        def sizes(text: str) -> tuple[int, ...]:
            parts = pieces(text)
            return tuple(sum(len(c.compress(p)) for p in parts) for c in known.values())

        for batch in batches:
            rows = []
            for text, letters in zip(batch.column("text").to_pylist(), batch.column("letters").to_pylist()):
                if not letters or not names:
                    rows.append((UNKNOWN, 0.0, 0.0))
                    continue
                best, score, apart = judged(list(sizes(text)))
                rows.append((names[best], score, apart))
            lang, score, apart = zip(*rows) if rows else ((), (), ())
            done = [batch.column("doc_id"), batch.column("held_out"), pa.array(lang, pa.string()), pa.array(score, pa.float64()), pa.array(apart, pa.float64())]
            yield pa.RecordBatch.from_arrays([*done, pa.array([a < margin for a in apart], pa.bool_())], ["doc_id", "held_out", "lang_pred", "score", "margin", "rejected"])

    letters = F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), letters_only(F.col("text").cast("string")).alias("text"), held_out(F.col("doc_id")).alias("held_out"), letters.alias("letters"))
    return rows.mapInArrow(predict, "doc_id long, held_out boolean, lang_pred string, score double, margin double, rejected boolean")
