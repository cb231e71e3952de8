"""Near copies: Jaccard similarity of word shingles of at least `LEAST`, linked into connected components.

A text is the set of its shingles of `WORDS` words, as 64-bit hashes; texts with equal sets collapse first. Links come
in two passes, and each is checked on the whole sets before it counts:

1. SimHash: fingerprints of the sets, linked within `RADIUS` bits by BK-trees (see simhash), find the almost exact copies.
2. MinHash: sets meet where one of `BANDS` bands of `ROWS` minhashes is equal. Fingerprints at a similarity of `LEAST`
   differ in some 10 of 64 bits, up to 17, where no tree prunes; bands miss a pair of exactly that similarity once in
   ten thousand times, and rarer the more similar it is.

The sets of a band's group are compared with its smallest first. Where the group still holds several components, the sets
outside of its largest component are compared with all others of the group in tasks of their own, in chunks of bounded size, and a
task sends on only the links that join components: no list of pairs exists, and a large group of copies costs about one
comparison a text. Groups of the same sets, which similar sets have in many bands, are compared once.

Cases: null and empty texts are copies of each other; fewer than `WORDS` words make one shingle; null
doc_ids are kept only where no other row of the component has one; repeated rows are copies; an empty
table gives an empty result; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from admill.llm import simhash
from admill.llm.common import join_checked, materialise, require, shielded
from admill.operators.graph import components

WORDS, SEED, LEAST = 5, 42, 0.8
#: Bits that fingerprints of the first pass may differ in; bands and minhashes of a band of the second.
RADIUS, BANDS, ROWS = 2, 24, 5
#: About how many sets, and shingles of these, one chunk of a group holds; columns of a matrix block.
CHUNK, CHUNK_SHINGLES, COLUMNS = 1_000, 1_500_000, 4_096
_rng = np.random.default_rng(SEED)
_TIMES, _MIX = _rng.integers(1 << 62, size=BANDS * ROWS, dtype=np.uint64) * 2 + 1, _rng.integers(1 << 63, size=BANDS * ROWS, dtype=np.uint64)


def shingles(text: str | None, size: int = WORDS, seed: int = SEED) -> np.ndarray:
    """Sorted unsigned 64-bit hashes of a whole text's distinct shingles."""
    words = (text or "").encode().lower().split()
    parts = zip(*(words[i:] for i in range(size))) if len(words) > size else (words,)
    h, join = xxhash.xxh64_intdigest, b" ".join
    return np.unique(np.fromiter((h(join(s), seed) for s in parts), dtype="<u8"))


def band_keys(hashes: np.ndarray) -> list[int]:
    """A 64-bit key of each band of minhashes."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(hashes), 2048):
        least = np.minimum(least, ((hashes[i : i + 2048, None] ^ _MIX) * _TIMES).min(axis=0))
    keys = [xxhash.xxh64_intdigest(band.tobytes(), b) for b, band in enumerate(least.reshape(BANDS, ROWS))]
    return np.array(keys, dtype="<u8").view("<i8").tolist()


def add_signatures(docs: DataFrame, size: int = WORDS) -> DataFrame:
    """docs with _s: number of shingles, two hashes of their set, its fingerprint and its band keys."""

    def sign(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in texts:
            rows = []
            for text in batch:
                s = shingles(text, size)
                key = np.frombuffer(xxhash.xxh3_128_digest(s.tobytes()), dtype="<i8")
                fp = int(np.array([simhash.majority(s)], dtype="<u8").view("<i8")[0])
                rows.append((len(s), int(key[0]), int(key[1]), fp, band_keys(s)))
            yield pd.DataFrame(rows, columns=["n", "k1", "k2", "fp", "bands"])

    return docs.withColumn("_s", F.pandas_udf(sign, "n int, k1 long, k2 long, fp long, bands array<long>")(F.col("text")))


def similar_size(a: Column, b: Column, least: float) -> Column:
    return F.least(a, b) >= least * F.greatest(a, b) - 1e-9


def verified(pairs: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame:
    """Those of the stored pairs (a, b) whose sets are similar enough, stored. Texts move and are split again; they take less room than their sets."""

    def similar(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        split = lru_cache(maxsize=64)(lambda text: shingles(text, size))
        for xs, ys in batches:
            out = []
            for x, y in zip(map(split, xs), map(split, ys)):
                common = len(np.intersect1d(x, y, assume_unique=True))
                out.append(common >= least * (len(x) + len(y) - common) - 1e-9)
            yield pd.Series(out, dtype=bool)

    ends = materialise(pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct(), "pair-ends")
    some = join_checked(texts, ends, "id", "left_semi")
    left, right = (some.select(F.col("id").alias(c), F.col("text").alias(t)) for c, t in (("a", "x"), ("b", "y")))
    met = join_checked(left, pairs, "a").join(right, "b")
    return materialise(met.filter(F.pandas_udf(similar, "boolean")("x", "y")).select("a", "b"), "verified")


def fingerprint_pairs(kinds: DataFrame, least: float) -> DataFrame:
    """Candidate pairs (a, b) of kinds whose fingerprints are equal or linked by BK-trees, each with the smallest id of a fingerprint."""
    firsts = materialise(kinds.groupBy("fp").agg(F.min(F.struct("id", "n")).alias("first")), "fingerprints")
    alike = kinds.join(firsts, "fp").filter(F.col("id") != F.col("first.id")).select(F.col("first.id").alias("a"), F.col("id").alias("b"), F.col("first.n").alias("na"), F.col("n").alias("nb"))
    links = simhash.fingerprint_links(firsts.select("fp"), RADIUS)
    ends = [firsts.select(F.col("fp").alias(c), F.col("first.id").alias(f"i{c}"), F.col("first.n").alias(f"n{c}")) for c in ("a", "b")]
    across = links.join(ends[0], "a").join(ends[1], "b").select(F.least("ia", "ib").alias("a"), F.greatest("ia", "ib").alias("b"), "na", "nb")
    pairs = alike.unionByName(across).filter(similar_size(F.col("na"), F.col("nb"), least)).select("a", "b").distinct()
    return materialise(pairs, "fingerprint-pairs")


def common_counts(sets: list[np.ndarray], chosen: np.ndarray) -> np.ndarray:
    """How many shingles each chosen set shares with every set."""
    rows = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, columns, df = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = df[columns] > 1
    rows, columns = rows[shared], (np.cumsum(df > 1) - 1)[columns[shared]]
    order = np.argsort(columns, kind="stable")
    rows, columns = rows[order], columns[order]
    out = np.zeros((len(chosen), len(sets)), dtype=np.float32)
    for first in range(0, int(columns[-1]) + 1 if len(columns) else 0, COLUMNS):
        part = slice(*np.searchsorted(columns, [first, first + COLUMNS]))
        block = np.zeros((len(sets), COLUMNS), dtype=np.float32)
        block[rows[part], columns[part] - first] = 1
        out += block[chosen] @ block.T
    return out


def joining_links(ids: np.ndarray, roots: np.ndarray, sets: list[np.ndarray], asks: np.ndarray, answers: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Links between similar sets that join components: of those that ask with those that answer."""
    root = {r: r for r in roots.tolist()}

    def find(r: int) -> int:
        while root[r] != r:
            root[r] = root[root[r]]
            r = root[r]
        return r

    sizes, found = np.array([len(s) for s in sets]), []
    common = common_counts(sets, asks)
    for i, a in enumerate(asks):
        near = np.flatnonzero((common[i] >= least * (sizes[a] + sizes - common[i]) - 1e-6) & answers & (roots != roots[a]))
        for b in near:
            x, y = find(int(roots[a])), find(int(roots[b]))
            if x != y:
                root[max(x, y)] = min(x, y)
                found.append((int(ids[a]), int(ids[b])))
    return found


TASK = ["h", "kind", "low", "high"]


def _compared(size: int, least: float):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by task. Main sets (chunk kind 0) only answer."""
        held: list[pd.DataFrame] = []

        def links() -> pd.DataFrame:
            rows = pd.concat(held, ignore_index=True)
            main = rows["main"].to_numpy()
            sets = [shingles(t, size) for t in rows["text"]]
            answers = main if rows["kind"].iloc[0] == 0 else np.ones(len(rows), dtype=bool)
            return pd.DataFrame(joining_links(rows["id"].to_numpy(), rows["root"].to_numpy(), sets, np.flatnonzero(~main), answers, least), columns=["a", "b"])

        for batch in batches:
            keys = batch[TASK].to_numpy()
            cuts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1), True])
            for start, stop in zip(cuts, cuts[1:]):
                if held and (held[0][TASK].iloc[0].to_numpy() != keys[start]).any():
                    yield links()
                    held = []
                held.append(batch[start:stop])
        if held:
            yield links()

    return compare


def group_links(members: DataFrame, links: DataFrame, texts: DataFrame, size: int, least: float) -> DataFrame:
    """Links (a, b) that join the components of links within the groups of stored members (h, id, n)."""
    roots = components(links)
    rooted = members.join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id"))
    parts = rooted.groupBy("h", "root").agg(F.count("*").alias("c"), F.sum("n").alias("s"), F.sum(F.xxhash64("id").cast("decimal(38,0)")).alias("x"))
    whole = parts.groupBy("h").agg(F.max(F.struct("c", "root", "s")).alias("m"), F.sum("c").alias("c"), F.sum("s").alias("s"), F.sum("x").alias("x"), F.count("*").alias("p")).filter("p > 1")
    chunks = lambda c, s: F.greatest(F.ceil(c / CHUNK), F.ceil(s / CHUNK_SHINGLES), F.lit(1)).cast("int")
    once = whole.groupBy("c", "x").agg(F.min(F.struct("h", F.col("m.root").alias("main_root"), chunks(F.col("m.c"), F.col("m.s")).alias("mains"), chunks(F.col("c") - F.col("m.c"), F.col("s") - F.col("m.s")).alias("others"), chunks(F.col("c"), F.col("s")).alias("all"))).alias("g"))
    mixed = materialise(once.select("g.*"), "mixed-groups")
    rows = members.join(mixed, "h").join(roots.withColumnRenamed("node", "id"), "id", "left").withColumn("root", F.coalesce("root", "id")).withColumn("main", F.col("root") == F.col("main_root"))
    own = F.pmod(F.xxhash64("id"), F.when(F.col("main"), F.col("mains")).otherwise(F.col("others"))).cast("int")
    rows = rows.withColumn("own", own)
    task = lambda kind, low, high: F.struct(F.lit(kind).alias("kind"), low.alias("low"), high.alias("high"))
    upto = lambda n: F.sequence(F.lit(0), F.col(n) - 1)
    against = F.transform(upto("mains"), lambda v: task(0, F.col("own"), v))  # an outside chunk with every main chunk
    among = F.transform(upto("others"), lambda v: task(1, F.least("own", v), F.greatest("own", v)))
    answer = F.transform(upto("others"), lambda u: task(0, u, F.col("own")))
    tasks = F.when(F.col("all") == 1, F.array(task(2, F.lit(0), F.lit(0)))).when(F.col("main"), answer).otherwise(F.concat(against, among))
    dealt = materialise(rows.select("h", "id", "root", "main", F.explode(tasks).alias("t")).select("h", "t.*", "id", "root", "main"), "group-tasks")
    needed = materialise(dealt.select("id").distinct(), "group-ids")
    placed = join_checked(texts, needed, "id", "left_semi").join(dealt, "id").select(*TASK, "id", "root", "main", "text")
    found = placed.repartition(*TASK).sortWithinPartitions(*TASK).mapInPandas(_compared(size, least), "a long, b long")
    return materialise(found.distinct(), "group-links")


def similar_links(kinds: DataFrame, texts: DataFrame, size: int = WORDS, least: float = LEAST) -> DataFrame:
    """Links (a, b) that connect similar kinds. kinds: (id, n, fp, bands), one row per set; texts: (id, text) of at least these ids."""
    links = verified(fingerprint_pairs(kinds, least), texts, size, least)
    placed = kinds.select("id", "n", F.explode("bands").alias("h"))
    firsts = placed.groupBy("h").agg(F.count("*").alias("_c"), F.min(F.struct("id", "n")).alias("first")).filter("_c > 1").drop("_c")
    members = materialise(placed.join(firsts, "h"), "bands")
    near = (F.col("id") != F.col("first.id")) & similar_size(F.col("n"), F.col("first.n"), least)
    stars = members.filter(near).select(F.col("first.id").alias("a"), F.col("id").alias("b")).distinct()
    links = materialise(links.unionByName(verified(materialise(stars, "stars"), texts, size, least)), "star-links")
    return links.unionByName(group_links(members.select("h", "id", "n"), links, texts, size, least))


def one_of_near_copies(docs: DataFrame, size: int = WORDS, least: float = LEAST) -> DataFrame:
    """docs with one row of every component of near copies: the smallest doc_id, and of repeated rows the first stored."""
    hidden, restore = shielded(require(docs, "doc_id", "text"), "doc_id", "text")
    rows = materialise(add_signatures(hidden.withColumn("_row", F.monotonically_increasing_id()), size), "signed")
    keys = rows.select("_row", "doc_id", "_s.k1", "_s.k2")
    firsts = materialise(keys.groupBy("k1", "k2").agg(F.min("_row").alias("id")), "shingle-sets")
    kinds = rows.join(firsts.select(F.col("id").alias("_row")), "_row", "left_semi").select(F.col("_row").alias("id"), "_s.n", "_s.fp", "_s.bands")
    roots = components(similar_links(kinds, rows.select(F.col("_row").alias("id"), "text"), size, least))
    rooted = firsts.join(roots.withColumnRenamed("node", "id"), "id", "left").select("k1", "k2", F.coalesce("root", "id").alias("root"))
    keyed = materialise(keys.join(rooted, ["k1", "k2"]).select("_row", "doc_id", "root"), "near-copies")
    best = F.min(F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))).alias("_best")
    kept = keyed.groupBy("root").agg(best).select(F.col("_best._row").alias("_row"))
    gone = materialise(keyed.select("_row").join(kept, "_row", "left_anti"), "near-copies-gone")
    return restore(join_checked(rows, gone, "_row", "left_anti"))
