"""Benchmark decontamination: rare n-gram seeds, then Smith-Waterman alignment.

A copy is looked for where a document holds `MIN_HITS` places of an item's n-grams. Of an item with p places, the
p - MIN_HITS + 1 whose n-grams are in the fewest documents are its seeds: whoever holds MIN_HITS places holds one of
them, so the commonest n-grams bring no candidates and nothing is lost. Frequencies are counted over all documents.
A document that holds a seed has the item's other places counted too; their positions bound the stretches of the
document that are aligned. A stretch that shares too few words with the item to score enough in
any order is left out, which loses nothing; a local alignment (match 2, mismatch -1, gap -1 on
words) scores the rest. The score is the share of the item's words that the best alignment
matches; `MIN_SCORE` of them mark a copy, edited or not.

Items with the same text are searched once. The distinct items are broadcast while their words are counted to
be within `BROADCAST_SEEDS`; beyond that, documents send the n-grams that a bitmap of the items' n-grams lets pass
through a join, split for n-grams of more than `HOT` documents. Beyond some 10^8 n-grams of items the bitmap lets
more pass, which the join then drops.

Cases: null and empty texts match nothing, nor do items shorter than an n-gram; items with the
same text are reported each; of stretches with equal scores the first in the document is reported; extra
columns of docs come back from the filter whatever their names, and stay out of the report; null doc_id or item_id is carried along; repeated rows are reported
each; empty tables give an empty result; texts are read whole, and each far-apart occurrence in a
document counts toward its best score.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame, Window, functions as F

from admill.llm.common import is_small, join_checked, materialise, require, shielded

N, MIN_HITS, MIN_SCORE, MIN_MATCHES = 3, 3, 0.5, 8
MATCH, MISMATCH, GAP = 2, -1, -1
#: Most words of items that are broadcast, and pairs aligned at once.
BROADCAST_SEEDS, _PAIRS = 200_000, 512
#: Documents of an n-gram that one task joins, and the most bits of the bitmap (16 MB).
HOT, MOST_BITS = 100_000, 1 << 27
_WORD = re.compile(r"\w+")


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def grams(words: list[str], n: int = N) -> list[int]:
    """Signed 64-bit hashes of all n-grams, in order."""
    h = xxhash.xxh64_intdigest
    return [x - (1 << 64) if (x := h("\x1f".join(g))) >> 63 else x for g in zip(*(words[i:] for i in range(n)))]


class GramIndex:
    """The n-grams of given word lists, found in a text by word numbers: most words of a text are in no list at all."""

    def __init__(self, lists: list[list[str]], n: int = N):
        self.n = n
        self.numbers = {w: i for i, w in enumerate(sorted({w for words in lists for w in words}))}
        hashes = {g: h for words in lists for g, h in zip(zip(*(words[i:] for i in range(n))), grams(words, n))}
        keys = np.array([self._key(np.array([[self.numbers[w]] for w in g]))[0] for g in hashes] or [], dtype=np.int64)
        order = np.argsort(keys)
        self.keys, self.grams = keys[order], np.array(list(hashes.values()), dtype=np.int64)[order]

    def _key(self, columns: np.ndarray) -> np.ndarray:
        """One number for n word numbers; with a few hundred thousand words it fits 64 bits."""
        key = columns[0].astype(np.int64)
        for column in columns[1:]:
            key = key * (len(self.numbers) + 1) + column
        return key

    def find(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Positions of the indexed n-grams among the words, and their hashes."""
        none = np.zeros(0, dtype=np.int64)
        if len(words) < self.n or not len(self.keys):
            return none, none
        get = self.numbers.get
        ids = np.array([get(w, -1) for w in words])
        columns = np.stack([ids[i : len(ids) - self.n + 1 + i] for i in range(self.n)])
        at = np.flatnonzero((columns >= 0).all(axis=0))
        key = self._key(columns[:, at])
        i = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        hit = self.keys[i] == key
        return at[hit], self.grams[i[hit]]


def benchmark_items(benchmark: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Distinct texts as (item, words), and (item, item_id) for each row; copies of a text are searched once."""
    rows = require(benchmark, "item_id", "text").filter(F.col("text").isNotNull()).withColumn("item", F.xxhash64("text"))
    one = rows.groupBy("item", "text").count().groupBy("item").agg(F.count("*").alias("texts")).filter("texts > 1")
    if not one.isEmpty():
        raise ValueError("two texts of the benchmark have the same hash")

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"item": batch["item"], "words": [words_of(x) for x in batch["text"]]})

    items = rows.groupBy("item").agg(F.first("text").alias("text")).mapInPandas(split, "item long, words array<string>")
    return materialise(items.filter(F.size("words") >= N), "benchmark-words"), materialise(rows.select("item", F.col("item_id").cast("string").alias("item_id")), "benchmark-ids")


def item_seeds(items: DataFrame, n: int = N) -> DataFrame:
    """(gram, item, at) for each n-gram of each item."""

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            rows = [(g, item, at) for item, words in zip(batch["item"], batch["words"]) for at, g in enumerate(grams(list(words), n))]
            yield pd.DataFrame(rows, columns=["gram", "item", "at"], dtype="int64")

    return items.mapInPandas(split, "gram long, item long, at long")


def local_alignment(items: list[np.ndarray], windows: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Smith-Waterman of many pairs of word-number arrays at once.

    Returns each pair's matched words on its best local alignment, and the alignment's last
    window word. Rows of the item run in step; gaps along the window come from a running maximum.
    """
    pairs, wide, tall = len(items), max(map(len, windows)), max(map(len, items))
    a = np.full((pairs, tall), -1, dtype=np.int64)
    b = np.full((pairs, wide), -2, dtype=np.int64)
    for i, (x, y) in enumerate(zip(items, windows)):
        a[i, : len(x)], b[i, : len(y)] = x, y
    # a cell is score * BIG + matches, so that the matches of the best path travel with its score
    big = 1 << 20
    step = np.arange(wide, dtype=np.int64) * (GAP * big)
    row = np.zeros((pairs, wide + 1), dtype=np.int64)
    best, end = np.zeros(pairs, dtype=np.int64), np.zeros(pairs, dtype=np.int64)
    for i in range(tall):
        same = b == a[:, i : i + 1]
        cell = np.maximum(row[:, :-1] + np.where(same, MATCH * big + 1, MISMATCH * big), row[:, 1:] + GAP * big)
        np.maximum(cell, 0, out=cell)
        cell = np.maximum.accumulate(cell - step, axis=1) + step
        np.maximum(cell, 0, out=cell)
        row[:, 1:] = np.where(cell >= big, cell, 0)
        top = row[:, 1:].argmax(axis=1)
        value = row[np.arange(pairs), top + 1]
        better = value > best
        best[better], end[better] = value[better], top[better]
    return best % big, end


def stretches(hits: list[tuple[int, int]], size: int, total: int) -> list[tuple[int, int]]:
    """Stretches of a document around seed hits (document position, item position), merged where they overlap."""
    slack = size // 2 + N
    spans = sorted((max(0, d - at - slack), min(total, d - at + size + slack)) for d, at in hits)
    out: list[tuple[int, int]] = []
    for low, high in spans:
        if out and low <= out[-1][1] and high - out[-1][0] <= 4 * (size + 2 * slack):
            out[-1] = (out[-1][0], max(high, out[-1][1]))
        else:
            out.append((low, high))
    return out


def needed(size: int, min_score: float = MIN_SCORE) -> float:
    """Matched words that a copy of an item of that many words must have."""
    return max(min_score * size, min(MIN_MATCHES, size))


def worth_aligning(item: list[str], stretch: list[str], min_score: float = MIN_SCORE) -> bool:
    """Whether the stretch has enough of the item's words in any order; an alignment never matches more."""
    wanted, shared = Counter(item), 0
    for word in stretch:
        if wanted.get(word):
            wanted[word] -= 1
            shared += 1
    return shared >= needed(len(item), min_score)


def align(tasks: list[tuple[tuple, list[str], list[str], int]], min_score: float = MIN_SCORE) -> list[tuple]:
    """tasks: (key, item words, stretch words, stretch start). The best stretch of each key, if it scores enough."""
    tasks.sort(key=lambda t: (len(t[2]), len(t[1])))
    found: dict[tuple, tuple] = {}
    for i in range(0, len(tasks), _PAIRS):
        part = tasks[i : i + _PAIRS]
        number: dict[str, int] = defaultdict(lambda: len(number))
        items = [np.array([number[w] for w in t[1]]) for t in part]
        windows = [np.array([number[w] for w in t[2]]) for t in part]
        for (key, item, _, start), matches, end in zip(part, *local_alignment(items, windows)):
            score = float(matches) / len(item)
            if matches >= needed(len(item), min_score) and score > found.get(key, (0.0,))[0]:
                found[key] = (score, int(matches), int(start + end))
    return [(*key, *value) for key, value in found.items()]


FOUND = "_row long, doc_id string, item long, score double, matches long, last_word long"


def contaminated(docs: DataFrame, benchmark: DataFrame, min_score: float = MIN_SCORE, min_hits: int = MIN_HITS) -> DataFrame:
    """docs carry a number for each row in _row. (_row, doc_id, item_id, score, matches, last_word) of each copy of an item in a document."""
    items, ids = benchmark_items(benchmark)
    few = (items.agg(F.sum(F.size("words"))).first()[0] or 0) <= BROADCAST_SEEDS and is_small(items)
    found = _search_broadcast(docs, items, min_score, min_hits) if few else _search_joined(stored(docs), items, min_score, min_hits)
    return join_checked(found, ids, "item").drop("item")


def rarest(seeds: list[int], frequency: dict[int, int], min_hits: int) -> set[int]:
    """n-grams of which a text must hold one to hold min_hits of an item's places: all places but the commonest."""
    kept = len(seeds) - min(min_hits, len(seeds)) + 1
    return set(sorted(seeds, key=lambda g: (frequency.get(g, 0), g))[:kept])


def _frequencies(docs: DataFrame, known) -> dict[int, int]:
    """Documents that hold each of a broadcast index's n-grams; at most BROADCAST_SEEDS of them."""

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen: Counter = Counter()
        for batch in batches:
            for text in batch["text"]:
                seen.update(set(known.value.find(words_of(text))[1].tolist()))
        yield pd.DataFrame({"gram": list(seen), "n": list(seen.values())}, dtype="int64")

    counted = docs.select("text").mapInPandas(count, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))
    return {r["gram"]: r["n"] for r in counted.collect()}


def _search_broadcast(docs: DataFrame, few_items: DataFrame, min_score: float, min_hits: int) -> DataFrame:
    """Two passes over the documents with the items in every task; their words were counted to be within BROADCAST_SEEDS."""
    items = {r["item"]: list(r["words"]) for r in few_items.collect()}
    context = docs.sparkSession.sparkContext
    index = context.broadcast(GramIndex(list(items.values())))
    frequency = _frequencies(docs, index)
    at: dict[int, list[tuple[int, int]]] = defaultdict(list)
    rare: dict[int, list[int]] = defaultdict(list)
    for item, words in items.items():
        seeds = grams(words)
        for i, gram in enumerate(seeds):
            at[gram].append((item, i))
        for gram in rarest(seeds, frequency, min_hits):
            rare[gram].append(item)
    shared = context.broadcast((dict(at), dict(rare), items))

    def search(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known, (places, seeds, texts) = index.value, shared.value
        tasks = []
        for batch in batches:
            for row, doc_id, text in zip(batch["_row"], batch["doc_id"], batch["text"]):
                words = words_of(text)
                where, found = (x.tolist() for x in known.find(words))
                near = {item for gram in set(found) for item in seeds.get(gram, ())}
                if not near:
                    continue
                hits: dict[int, list[tuple[int, int]]] = defaultdict(list)
                for d, gram in zip(where, found):
                    for item, position in places[gram]:
                        if item in near:
                            hits[item].append((d, position))
                for item, held in hits.items():
                    tasks += _tasks((row, doc_id, item), texts[item], words, held, min_score, min_hits)
            if len(tasks) >= 4 * _PAIRS:
                yield _frame(align(tasks, min_score))
                tasks = []
        if tasks:
            yield _frame(align(tasks, min_score))

    return materialise(_named(docs).mapInPandas(search, FOUND), "leaks")


def _tasks(key: tuple, item: list[str], words: list[str], hits: list[tuple[int, int]], min_score: float, min_hits: int) -> Iterator[tuple]:
    """Stretches of a document to be aligned with an item, from its hits (document position, item position)."""
    if len({p for _, p in hits}) >= min(min_hits, len(item) - N + 1):
        for low, high in stretches(hits, len(item), len(words)):
            if worth_aligning(item, words[low:high], min_score):
                yield key, item, words[low:high], low


def _named(docs: DataFrame) -> DataFrame:
    return docs.select("_row", F.col("doc_id").cast("string").alias("doc_id"), "text")


def _frame(rows: list[tuple]) -> pd.DataFrame:
    return pd.DataFrame(rows, columns=[x.split()[0] for x in FOUND.split(", ")])


def _bitmap(seeds: DataFrame) -> np.ndarray:
    """One bit for each of the seeds' n-grams, at its remainder; some sixteen bits a seed, within MOST_BITS."""
    size = min(MOST_BITS, 1 << max(15, (16 * seeds.count()).bit_length()))
    place = F.pmod("gram", F.lit(size)) + 1
    parts = seeds.groupBy(F.bitmap_bucket_number(place).alias("part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position(place)).alias("bits"))
    out = np.zeros(size // 8, dtype=np.uint8)
    for r in parts.collect():  # at most MOST_BITS in all
        held = np.frombuffer(bytes(r["bits"]), dtype=np.uint8)
        out[(r["part"] - 1) * 4096 : r["part"] * 4096] = held
    return out


def _rare(seeds: DataFrame, placed: DataFrame, min_hits: int) -> DataFrame:
    """(gram, item, parts): each item's places but the commonest, with the parts that the n-gram's documents are joined in."""
    counted = placed.groupBy("gram").agg(F.count("*").alias("n"))
    known = seeds.join(counted, "gram", "left").withColumn("n", F.coalesce("n", F.lit(0)))
    of_item = Window.partitionBy("item")
    places = F.count("*").over(of_item)
    ranked = known.select("*", places.alias("p"), F.row_number().over(of_item.orderBy("n", "gram", "at")).alias("rank"))
    kept = ranked.filter((F.col("rank") <= F.col("p") - F.least(F.lit(min_hits), "p") + 1) & (F.col("n") > 0))
    return kept.select("gram", "item", F.ceil(F.col("n") / HOT).cast("int").alias("parts")).distinct()


def _search_joined(docs: DataFrame, items: DataFrame, min_score: float, min_hits: int) -> DataFrame:
    """For items beyond the bound: n-grams of stored docs meet the rare seeds in a join, candidates meet their texts again."""
    seeds = materialise(item_seeds(items), "benchmark-seeds")
    bits = docs.sparkSession.sparkContext.broadcast(_bitmap(seeds))

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        known = bits.value
        for batch in batches:
            for row, text in zip(batch["_row"], batch["text"]):
                found = np.unique(np.array(grams(words_of(text)), dtype=np.int64))
                place = found % (8 * len(known))
                found = found[(known[place >> 3] >> (place & 7)) & 1 == 1]
                if len(found):
                    yield pd.DataFrame({"_row": row, "gram": found})

    placed = docs.select("_row", "text").mapInPandas(split, "_row long, gram long")
    rare = materialise(_rare(seeds, placed, min_hits), "benchmark-rare")
    hot = rare.filter("parts > 1").select("gram", "parts").distinct()
    part = F.coalesce(F.pmod(F.xxhash64("_row"), F.col("parts")), F.lit(0)).cast("int")
    left = join_checked(placed, hot, "gram", "left").select("_row", "gram", part.alias("part"))
    right = rare.select("gram", "item", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    pairs = left.join(right, ["gram", "part"]).select("_row", "item").distinct()
    candidates = join_checked(pairs, items, "item").join(_named(docs), "_row")

    def score(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        last, words, held = None, [], {}
        for batch in batches:
            tasks = []
            for row, doc_id, item, item_words, text in batch[["_row", "doc_id", "item", "words", "text"]].itertuples(index=False):
                if row != last:  # a row's candidates mostly come one after another
                    last, words, held = row, words_of(text), defaultdict(list)
                    for d, gram in enumerate(zip(*(words[i:] for i in range(N)))):
                        held[gram].append(d)
                item_words = list(item_words)
                hits = [(d, p) for p, gram in enumerate(zip(*(item_words[i:] for i in range(N)))) for d in held.get(gram, ())]
                tasks += _tasks((row, doc_id, item), item_words, words, hits, min_score, min_hits)
            if tasks:
                yield _frame(align(tasks, min_score))

    return materialise(candidates.mapInPandas(score, FOUND), "leaks")


def stored(docs: DataFrame) -> DataFrame:
    """docs written once, so that the numbers of its rows stay as they are."""
    return materialise(docs, "decontam")


def leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(doc_id, item_id, score, matches, last_word) for each copy of a benchmark item in a document."""
    rows = require(docs, "doc_id", "text").select("doc_id", "text").withColumn("_row", F.monotonically_increasing_id())
    ids = [F.expr(f"try_cast({c} AS long)").alias(c) for c in ("doc_id", "item_id")]
    return contaminated(rows, benchmark).select(*ids, "score", "matches", "last_word")


def decontaminate(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of docs that hold no copy of a benchmark item, with their own columns."""
    hidden, restore = shielded(require(docs, "doc_id", "text"), "doc_id", "text")
    rows = stored(hidden.withColumn("_row", F.monotonically_increasing_id()))
    gone = materialise(contaminated(rows, benchmark).select("_row").distinct(), "leaked")
    return restore(join_checked(rows, gone, "_row", "left_anti"))
