"""SimHash near-duplicates: BK-trees per shard, linked fingerprints, connected components.

A text's fingerprint is the majority vote of the XXH64 hashes of its 3-word shingles. Equal
fingerprints collapse into one row first, so groups of copies cost one tree node. Fingerprints
that differ in at most `RADIUS` bits agree in all but `RADIUS` of any bit blocks, so each choice
of the other blocks is a shard key: every link lies in some shard. A shard's fingerprints form a
BK-tree, children keyed by Hamming distance to their parent, and a search follows only edges
within the radius. Trees reach their tasks with the shuffle that groups a shard, which is never
larger than `MOST_NODES`: a larger shard is dealt into chunks, and every pair of chunks meets in a
task of its own. Tasks send on a spanning forest of what they link, and components come from
alternating star operations, so no group's pairs are ever listed.

Cases: null and empty texts have fingerprint zero and link as any other; fewer than three words
make one shingle; a null doc_id never becomes a component's id unless all are null; repeated rows
get equal results; an empty table gives an empty result; texts are read whole.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from admill.llm.common import join_checked, materialise, require, shielded
from admill.operators.graph import components

WORDS, SEED, RADIUS = 3, 42, 2
#: Most fingerprints of one tree.
MOST_NODES = 20_000
#: Rows that a task links at once, and search steps taken at once.
_ROWS, _STEPS = 200_000, 500_000
_BITS = np.unpackbits(np.arange(256, dtype=np.uint8)[:, None], axis=1, bitorder="little").astype(np.int64)
_BYTE = np.arange(8, dtype=np.int64) * 256


def fingerprint(text: str | None, size: int = WORDS, seed: int = SEED) -> int:
    """Unsigned 64-bit SimHash of a whole text."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = zip(*(words[i:] for i in range(size))) if len(words) > size else (words,)
    h, join = xxhash.xxh64_intdigest, b" ".join
    return majority(np.fromiter((h(join(s), seed) for s in shingles), dtype="<u8"))


def majority(hashes: np.ndarray) -> int:
    """The number whose bits are set in over half of unsigned 64-bit hashes."""
    if len(hashes) == 1:
        return int(hashes[0])
    counts = np.zeros((8, 8), dtype=np.int64)
    for i in range(0, len(hashes), 1 << 18):
        cells = (hashes[i : i + (1 << 18)].view(np.uint8).reshape(-1, 8) + _BYTE).ravel()
        counts += np.bincount(cells, minlength=2048).reshape(8, 256) @ _BITS
    set_bits = (counts * 2 > len(hashes)).ravel()
    return int(np.packbits(set_bits, bitorder="little").view("<u8")[0])


def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series(np.array([fingerprint(x) for x in batch], dtype="<u8").view("<i8"))


def add_fingerprint(docs: DataFrame, into: str = "fingerprint") -> DataFrame:
    """docs with the fingerprint as a signed 64-bit number."""
    return require(docs, "text").withColumn(into, F.pandas_udf(_fingerprints, "long")(F.col("text")))


def shard_keys(fp: Column, n: int, radius: int = RADIUS) -> Column:
    """Array of shard keys: values of all but `radius` bit blocks, enough blocks to keep random shards small."""
    blocks = next((k for k in range(radius + 1, radius + 4) if n <= 64 << (64 * (k - radius) // k)), radius + 4)
    edges = [64 * i // blocks for i in range(blocks + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(edges, edges[1:])]
    keys = []
    for which, chosen in enumerate(combinations(masks, blocks - radius)):
        mask = reduce(int.__or__, chosen)
        keys.append(F.struct(F.lit(which).alias("which"), fp.bitwiseAND(F.lit(mask - (1 << 64) if mask >> 63 else mask).cast("long")).alias("bits")))
    return F.array(*keys)


def distance(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.bitwise_count(a ^ b).astype(np.int64)


def _roots(labels: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """labels with a and b of each pair in one class: hooks the larger root to the smaller until none is left."""
    while True:
        x, y = labels[a], labels[b]
        if not (apart := x != y).any():
            return labels
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(labels, np.maximum(x, y), np.minimum(x, y))
        while (jump := labels[labels] != labels).any():
            labels = np.where(jump, labels[labels], labels)


def bk_forest(first: np.ndarray, fps: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """BK-trees of all shards at once: first is each row's root. Sorted edge keys (node * 65 + distance), and their children.

    Rows that reach a node with the same distance do so in the same round; the first becomes the
    child and the others go on from it.
    """
    keys, children = [], []
    rest = np.flatnonzero(first != np.arange(len(fps)))
    at = first[rest]
    while len(rest):
        edge = at * 65 + distance(fps[rest], fps[at])
        new, where, which = np.unique(edge, return_index=True, return_inverse=True)
        child = rest[where]
        keys.append(new)
        children.append(child)
        at = child[which]
        on = at != rest
        rest, at = rest[on], at[on]
    if not keys:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    key, child = np.concatenate(keys), np.concatenate(children)
    order = np.argsort(key)
    return key[order], child[order]


def link(first: np.ndarray, fps: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each row, the smallest row that links within its shard lead to."""
    keys, children = bk_forest(first, fps)
    labels = np.arange(len(fps))
    if not len(keys):
        return labels
    stack = [(np.arange(len(fps))[i : i + _STEPS], first[i : i + _STEPS]) for i in range(0, len(fps), _STEPS)]
    while stack:
        query, node = stack.pop()
        d = distance(fps[query], fps[node])
        hit = (d <= radius) & (query != node)
        if hit.any():
            labels = _roots(labels, query[hit], node[hit])
        for step in range(-radius, radius + 1):
            edge = node * 65 + d + step
            i = np.searchsorted(keys, edge)
            i[i == len(keys)] = 0
            found = (keys[i] == edge) & (d + step > 0) & (d + step <= 64)
            q, c = query[found], children[i[found]]
            stack += [(q[j : j + _STEPS], c[j : j + _STEPS]) for j in range(0, len(q), _STEPS)]
    return labels


def _spanning(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Rows come sorted by shard; whole shards are linked together, some `_ROWS` rows at a time."""

    def links(rows: pd.DataFrame) -> pd.DataFrame:
        shard = rows[["which", "bits", "low", "high"]].to_numpy()
        starts = np.r_[True, (shard[1:] != shard[:-1]).any(axis=1)]
        first = np.flatnonzero(starts)[np.cumsum(starts) - 1]
        fps = rows["fp"].to_numpy()
        labels = link(first, fps.view("<u8"))
        linked = np.flatnonzero(labels != np.arange(len(fps)))
        return pd.DataFrame({"a": fps[linked], "b": fps[labels[linked]]})

    held: list[pd.DataFrame] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += len(batch)
        if size >= _ROWS:
            rows = pd.concat(held, ignore_index=True)
            last = rows[["which", "bits", "low", "high"]].to_numpy()
            whole = np.flatnonzero((last != last[-1]).any(axis=1))
            cut = whole[-1] + 1 if len(whole) else 0
            if cut:
                yield links(rows[:cut].reset_index(drop=True))
            held = [rows[cut:].reset_index(drop=True)]
            size = len(held[0])
    if size:
        yield links(pd.concat(held, ignore_index=True))


def fingerprint_links(fps: DataFrame, radius: int = RADIUS, most: int = MOST_NODES) -> DataFrame:
    """Spanning links (a, b) of distinct fingerprints (column fp) within the radius."""
    n = fps.count()
    rows = fps.select("fp", F.explode(shard_keys(F.col("fp"), n, radius)).alias("_k")).select("fp", "_k.which", "_k.bits")
    large = rows.groupBy("which", "bits").agg(F.ceil(F.count("*") / most).cast("int").alias("chunks")).filter("chunks > 1")
    if large.isEmpty():
        rows = rows.withColumns({"low": F.lit(0), "high": F.lit(0)})
    else:
        rows = rows.join(large, ["which", "bits"], "left").withColumn("chunks", F.coalesce("chunks", F.lit(1)))
        own = F.pmod(F.xxhash64("fp"), F.col("chunks")).cast("int")
        rows = rows.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        rows = rows.withColumns({"low": F.least("_own", "_other"), "high": F.greatest("_own", "_other")})
    keys = ["which", "bits", "low", "high"]
    return rows.select("fp", *keys).repartition(*keys).sortWithinPartitions(*keys, "fp").mapInPandas(_spanning, "a long, b long")


def fingerprint_components(fps: DataFrame) -> DataFrame:
    """(fp, component_id) for rows (doc_id, fp): component_id is the smallest doc_id of all linked rows."""
    distinct = materialise(fps.groupBy("fp").agg(F.min("doc_id").alias("least")), "fingerprints")
    roots = components(fingerprint_links(distinct.select("fp")))
    rooted = distinct.join(roots, distinct["fp"] == roots["node"], "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return materialise(rooted.join(least, "root").select("fp", "component_id"), "components")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """(doc_id, fingerprint as 16 hex digits, component_id) for every row."""
    fps = materialise(add_fingerprint(require(docs, "doc_id", "text"), "fp").select("doc_id", "fp"), "simhash")
    found = join_checked(fps, fingerprint_components(fps), "fp")
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame) -> DataFrame:
    """docs with one row of every component: the smallest doc_id, and of repeated rows the first stored."""
    hidden, restore = shielded(require(docs, "doc_id", "text"), "doc_id", "text")
    rows = materialise(add_fingerprint(hidden, "_fp").withColumn("_row", F.monotonically_increasing_id()), "simhash")
    keys = rows.select("doc_id", F.col("_fp").alias("fp"), "_row")
    keyed = materialise(join_checked(keys, fingerprint_components(keys), "fp"), "simhash-keys")
    first = F.struct(F.col("doc_id").isNull(), F.col("doc_id"), F.col("_row"))
    best = F.min(first).alias("_best")
    kept = keyed.groupBy(F.coalesce("component_id", F.lit(-1)).alias("_c"), F.when(F.col("component_id").isNull(), F.col("fp")).alias("_f")).agg(best)
    gone = keyed.select("_row").join(kept.select(F.col("_best._row").alias("_row")), "_row", "left_anti")
    return restore(join_checked(rows, materialise(gone, "simhash-gone"), "_row", "left_anti"))
