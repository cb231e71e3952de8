"""Hard-negative mining: exact windowed inner-product search over cover trees.

A component x becomes floor(256 * x), so scores are whole numbers. Every vector gets one more
component that lifts it to the length of the longest, M; a query gets a zero there. The squared distance of
query q and candidate c is then |q|^2 + M^2 - 2 q.c, so near neighbours are high scores and the covering radius of
a tree node bounds the scores of all below it, from above and from below.

Equal vectors of one label answer alike: their anchors become one query, and of their candidates only those with the
smallest ids can be among the first. The tree's top level is a set of pivots, chosen far apart from a sample of
at most `SAMPLE` rows: each candidate goes to its nearest pivot, each pivot's rows of a label to one or more
blocks of some `BLOCK` rows. A query goes only to the pivots whose bounds meet one of its score windows, given
what the sample's own rows already guarantee. A block's task builds the tree of its rows (each level halves the covering
radius) and descends best first: nodes outside of the window or below the k-th score found are
skipped, leaves are verified exactly. Queries stream past the tree, so a task holds one block and one batch of queries.

Cases: rows with a null label, a null vector or a null or non-finite component take no part; vectors of
different lengths don't meet; a null vec_id comes after all others at ties and is neither anchor nor relabelled; rows repeated
with id, label and vector count once, and "other" rows are those of another vec_id; ties go to the smaller vec_id;
an empty table gives an empty result; extra columns are ignored. Scores are exact while squared lengths stay
below 2^53; beyond that they are computed with whole numbers and saturate at 63 bits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window, functions as F

from admill.llm.common import join_checked, materialise, require

POSITIVES, NEGATIVES = 5, 10
#: Rows that pivots are chosen from, rows of one block, rows of a leaf, most children of a node, score windows searched at once.
SAMPLE, BLOCK, LEAF, FAN, BATCH = 1024, 32_768, 96, 24, 1024
_LONG = np.iinfo(np.int64)
#: Squared lengths below this keep products exact in doubles.
EXACT = 2.0**53


def quantised(vectors: DataFrame) -> DataFrame:
    """(id, label, x, norm2) of the rows that take part; a null id becomes the largest number."""
    require(vectors, "vec_id", "embedding", "label")
    finite = F.forall("embedding", lambda v: F.coalesce(F.abs(v.cast("double")) < F.lit(float("inf")), F.lit(False)))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")).cast("long")
    part = vectors.filter(F.col("label").isNotNull() & F.col("embedding").isNotNull() & finite)
    rows = part.select(F.coalesce(F.col("vec_id").cast("long"), F.lit(int(_LONG.max))).alias("id"), label.alias("label"), F.transform("embedding", lambda v: F.floor(v.cast("double") * 256)).alias("x"))
    return rows.withColumn("norm2", F.aggregate("x", F.lit(0.0), lambda a, v: a + v.cast("double") * v.cast("double")))


def _matrix(column: pa.Array, start: int, stop: int, dim: int) -> np.ndarray:
    offsets = column.offsets
    return column.values.to_numpy()[offsets[start].as_py() : offsets[stop].as_py()].reshape(stop - start, dim)


def products(a: np.ndarray, b: np.ndarray, exact: bool) -> np.ndarray:
    """Inner products of all rows of a and b: doubles that hold whole numbers, or saturated whole numbers."""
    if exact:
        return a.astype(np.float64) @ b.astype(np.float64).T
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    return np.clip(a.astype(object) @ b.astype(object).T, _LONG.min, _LONG.max).astype(np.int64)


class CoverTree:
    """Cover tree of rows (x, norm2 <= m2): flat arrays of nodes, whose rows are order[first:last]."""

    def __init__(self, x: np.ndarray, norm2: np.ndarray, m2: float):
        y = np.column_stack([x.astype(np.float64), np.sqrt(np.maximum(m2 - norm2, 0))])
        centre, radius, children, spans, order = [], [], [], [], []

        def far(rows: np.ndarray, c: int) -> np.ndarray:
            return np.sqrt(np.maximum(((y[rows] - y[c]) ** 2).sum(axis=1), 0))

        def add(c: int, r: float) -> int:
            centre.append(c), radius.append(r), children.append(()), spans.append((0, 0))
            return len(centre) - 1

        everything = np.arange(len(x))
        away = far(everything, 0)
        stack = [(add(0, float(away.max())), everything, away)]
        while stack:
            node, rows, away = stack.pop()
            if len(rows) <= LEAF or radius[node] == 0:
                spans[node] = (len(order), len(order) + len(rows))
                order.extend(rows.tolist())
                continue
            centres, nearest, scale = [centre[node]], np.zeros(len(rows), dtype=np.int64), radius[node] / 2
            while len(centres) < FAN and away.max() > scale:  # the next level's scale covers all, or the fan is full
                new = int(rows[away.argmax()])
                d = far(rows, new)
                nearest[d < away] = len(centres)
                away = np.minimum(away, d)
                centres.append(new)
            for i, c in enumerate(centres):
                mine = nearest == i
                if mine.any():
                    child = add(c, float(away[mine].max()))
                    children[node] += (child,)
                    stack.append((child, rows[mine], away[mine]))
        self.m2, self.centre, self.radius, self.children, self.spans, self.order = m2, np.array(centre), np.array(radius), children, spans, np.array(order)


def bounds(scores: np.ndarray, q2: np.ndarray, m2: float, radius: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Least and highest score within the radius of a centre with these scores, a little widened for rounding."""
    both = q2 + m2
    d = np.sqrt(np.maximum(both - 2 * scores.astype(np.float64), 0))
    return (both - (d + radius) ** 2) / 2 - 1e-6 * both - 1, (both - np.maximum(d - radius, 0) ** 2) / 2 + 1e-6 * both + 1


def best(window: np.ndarray, score: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of each window's first k: higher scores first, then smaller ids."""
    order = np.lexsort((ids, -score.astype(np.float64) if score.dtype != np.int64 else np.invert(score), window))
    w = window[order]
    starts = np.flatnonzero(np.r_[True, w[1:] != w[:-1]]) if len(w) else np.zeros(0, np.int64)
    rank = np.arange(len(w)) - np.repeat(starts, np.diff(np.r_[starts, len(w)]))
    return order[rank < k]


def descend(tree: CoverTree, x: np.ndarray, ids: np.ndarray, q: np.ndarray, qi: np.ndarray, lo: np.ndarray, hi: np.ndarray, least: np.ndarray, k: int, exact: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(window, id, score) of the first k rows of each window: lo <= score <= hi for query q[qi], scores of `least` or more only.

    The frontier holds (window, node, highest possible score). Each round takes every window's best nodes, twice as many as the
    round before: inner nodes give way to their children, leaves are verified, and the k-th score found cuts the frontier.
    """
    q2 = (q.astype(np.float64) ** 2).sum(axis=1)
    least = np.maximum(least, lo)
    found_w, found_id, found_s = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def reached(w: np.ndarray, nodes: np.ndarray) -> list[np.ndarray]:
        s = products(q[qi[w]], x[tree.centre[nodes]], exact)
        low, high = bounds(s, q2[qi[w]][:, None], tree.m2, tree.radius[nodes][None, :])
        a, b = np.nonzero((high >= least[w][:, None]) & (low <= hi[w][:, None]))
        return [w[a], nodes[b], np.minimum(high[a, b], hi[w[a]])]

    w, node, high = reached(np.arange(len(qi)), np.zeros(1, np.int64))
    take = 2
    while len(w):
        order = np.lexsort((-high, w))
        w, node, high = w[order], node[order], high[order]
        starts = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
        rank = np.arange(len(w)) - np.repeat(starts, np.diff(np.r_[starts, len(w)]))
        now = rank < take
        rest, news, hits = [w[~now], node[~now], high[~now]], [], []
        by_node = np.argsort(node[now], kind="stable")
        nodes, ws = node[now][by_node], w[now][by_node]
        cuts = np.flatnonzero(np.r_[True, nodes[1:] != nodes[:-1], True])
        for a, b in zip(cuts, cuts[1:]):
            n, some = nodes[a], ws[a:b]
            if tree.children[n]:
                news.append(reached(some, np.array(tree.children[n])))
                continue
            rows = tree.order[slice(*tree.spans[n])]
            s = products(q[qi[some]], x[rows], exact)
            i, j = np.nonzero((s >= least[some][:, None]) & (s <= hi[some][:, None]))
            hits.append((some[i], ids[rows[j]], s[i, j].astype(np.int64)))
        if hits:
            found_w, found_id, found_s = (np.concatenate([old, *new]) for old, new in zip((found_w, found_id, found_s), zip(*hits)))
            first = best(found_w, found_s, found_id, k)
            found_w, found_id, found_s = found_w[first], found_id[first], found_s[first]
            last = np.flatnonzero(np.r_[found_w[k - 1 :] == found_w[: len(found_w) - k + 1], False][: len(found_w)]) if len(found_w) >= k else []
            for i in last:
                least[found_w[i + k - 1]] = max(least[found_w[i + k - 1]], found_s[i + k - 1])
        w, node, high = (np.concatenate(parts) for parts in zip(rest, *news))
        on = high >= least[w]
        w, node, high = w[on], node[on], high[on]
        take *= 2
    return found_w, found_id, found_s


class Pivots:
    """The trees' common top level: sampled rows, and those of them, far apart, that candidates are dealt to."""

    def __init__(self, sample: list, n: int, m2: float, exact: bool):
        self.m2, self.exact, self.radius, self.sample, self.at, pivots = m2, exact, np.zeros(0), {}, {}, 0
        for dim in sorted({len(r["x"]) for r in sample}):
            rows = [r for r in sample if len(r["x"]) == dim]
            x = np.array([r["x"] for r in rows], dtype=np.int64).reshape(len(rows), dim)
            norm2 = (x.astype(np.float64) ** 2).sum(axis=1)
            self.sample[dim] = (x, np.array([r["label"] for r in rows]))
            y = np.column_stack([x, np.sqrt(np.maximum(m2 - norm2, 0))])
            chosen, away = [0], ((y - y[0]) ** 2).sum(axis=1)
            while len(chosen) < min(len(rows), -(-n // BLOCK)) and away.max() > 0:
                chosen.append(int(away.argmax()))
                away = np.minimum(away, ((y - y[chosen[-1]]) ** 2).sum(axis=1))
            self.at[dim] = (pivots + np.arange(len(chosen)), x[chosen], y[chosen])
            pivots += len(chosen)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Number and distance of each row's nearest pivot; -1 where no pivot has as many components."""
        if x.shape[1] not in self.at:
            return np.full(len(x), -1), np.zeros(len(x))
        numbers, _, y = self.at[x.shape[1]]
        lifted = np.column_stack([x, np.sqrt(np.maximum(self.m2 - (x.astype(np.float64) ** 2).sum(axis=1), 0))])
        which, away = np.zeros(len(x), np.int64), np.full(len(x), np.inf)
        for number, pivot in enumerate(y):
            d = np.sqrt(((lifted - pivot) ** 2).sum(axis=1))
            which, away = np.where(d < away, number, which), np.minimum(d, away)
        return numbers[which], away

    def routes(self, q: np.ndarray, label: np.ndarray, windows: list[tuple[np.ndarray, np.ndarray]], k: int, same: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
        """For each query, the pivots that may hold rows for one of its windows, and for each of these windows a score that k rows of the sample reach."""
        if q.shape[1] not in self.at:
            return [np.array([-1])] * len(q), [lo for lo, _ in windows]
        numbers, pivots, _ = self.at[q.shape[1]]
        x, labels = self.sample[q.shape[1]]
        q2 = (q.astype(np.float64) ** 2).sum(axis=1)[:, None]
        low, high = bounds(products(q, pivots, self.exact), q2, self.m2, self.radius[numbers][None, :])
        own = products(q, x, self.exact)
        chosen, least = [], []
        for i, (lo, hi) in enumerate(windows):
            scores = own[i][(labels == label[i]) == same]
            reach = np.array(lo, dtype=np.int64)
            for j in range(len(lo)):
                inside = scores[(scores >= lo[j]) & (scores <= hi[j])]
                if len(inside) >= k:
                    reach[j] = int(np.partition(inside, len(inside) - k)[len(inside) - k])
            met = ((high[i][:, None] >= reach[None, :]) & (low[i][:, None] <= np.array(hi)[None, :])).any(axis=1)
            chosen.append(numbers[met])
            least.append(reach)
        return chosen, least


def _runs(batch: pa.RecordBatch, names: list[str]) -> Iterator[tuple[int, int]]:
    keys = np.column_stack([batch.column(n).to_numpy() for n in names])
    cuts = np.flatnonzero(np.r_[True, (keys[1:] != keys[:-1]).any(axis=1), True])
    yield from zip(cuts[:-1], cuts[1:])


def dealt(rows: DataFrame, pivots: Pivots) -> DataFrame:
    """rows with dim, pivot and the distance from it."""
    shared = rows.sparkSession.sparkContext.broadcast(pivots)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            pivot, away, dims = np.full(batch.num_rows, -1), np.zeros(batch.num_rows), batch.column("dim").to_numpy()
            for a, b in _runs(batch, ["dim"]):
                pivot[a:b], away[a:b] = shared.value.nearest(_matrix(batch.column("x"), a, b, int(dims[a])))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(pivot, pa.int32()), pa.array(away)], [*batch.schema.names, "pivot", "away"])

    kinds = ", ".join(f"{n} {t}" for n, t in rows.dtypes)
    return rows.mapInArrow(deal, f"{kinds}, pivot int, away double")


def routed(queries: DataFrame, pivots: Pivots, k: int, same: bool) -> DataFrame:
    """queries (qid, label, dim, x, lo, hi) once per pivot they may find rows at, with the scores that are reached already."""
    shared = queries.sparkSession.sparkContext.broadcast(pivots)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims, labels = batch.column("dim").to_numpy(), batch.column("label").to_numpy()
            windows = list(zip(*([np.array(v, dtype=np.int64) for v in batch.column(c).to_pylist()] for c in ("lo", "hi"))))
            to, least = [], []
            for a, b in _runs(batch, ["dim"]):
                found = shared.value.routes(_matrix(batch.column("x"), a, b, int(dims[a])), labels[a:b], windows[a:b], k, same)
                to += found[0]
                least += found[1]
            again = np.repeat(np.arange(batch.num_rows), [len(t) for t in to])
            out = batch.take(pa.array(again))
            reach = pa.array([least[i].tolist() for i in again], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([*out.columns, reach, pa.array(np.concatenate([*to, np.zeros(0, np.int64)]), pa.int32())], [*out.schema.names, "least", "pivot"])

    kinds = ", ".join(f"{n} {t}" for n, t in queries.dtypes)
    return queries.mapInArrow(route, f"{kinds}, least array<long>, pivot int")


KEYS = ["dim", "block", "pivot", "chunk"]


def _searched(m2: float, k: int, exact: bool):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows come sorted by block, candidates before queries."""
        key, held, tree = None, [], None
        for batch in batches:
            columns = {n: batch.column(n).to_numpy() for n in (*KEYS, "kind", "id")}
            for a, b in _runs(batch, [*KEYS, "kind"]):
                here = tuple(int(columns[n][a]) for n in KEYS)
                if here != key:
                    key, held, tree = here, [], None
                x = _matrix(batch.column("x"), a, b, key[0])
                if columns["kind"][a] == 0:
                    held.append((x, columns["id"][a:b]))
                    continue
                if not held:
                    continue
                if tree is None:
                    rows, ids = (np.concatenate(p) for p in zip(*held))
                    tree = CoverTree(rows, (rows.astype(np.float64) ** 2).sum(axis=1), m2)
                lo, hi, least = ([np.array(v, dtype=np.int64) for v in batch.column(c).slice(a, b - a).to_pylist()] for c in ("lo", "hi", "least"))
                sizes = np.array([len(v) for v in lo])
                qi, at = np.repeat(np.arange(b - a), sizes), np.concatenate([np.arange(n) for n in sizes])
                lo, hi, least = (np.concatenate(v) for v in (lo, hi, least))
                for i in range(0, len(qi), BATCH):
                    part = slice(i, i + BATCH)
                    w, found, score = descend(tree, rows, ids, x, qi[part], lo[part], hi[part], least[part], k, exact)
                    yield pa.RecordBatch.from_arrays([pa.array(columns["id"][a:b][qi[part][w]]), pa.array(at[part][w], pa.int32()), pa.array(found), pa.array(score)], ["qid", "w", "id", "score"])

    return search


class Index:
    """Candidates dealt to blocks, with what queries need to find them."""

    def __init__(self, rows: DataFrame, k: int):
        # of equal vectors of one label, only the k smallest ids can be among anyone's first k
        alike = Window.partitionBy("x", "label").orderBy("id")
        few = rows.withColumn("_r", F.dense_rank().over(alike)).filter(F.col("_r") <= k).dropDuplicates(["x", "label", "id"]).drop("_r")
        few = materialise(few.withColumn("dim", F.size("x")), "candidates")
        n, m2, widest = few.agg(F.count("*"), F.coalesce(F.max("norm2"), F.lit(0.0)), F.coalesce(F.max(F.array_max(F.transform("x", F.abs))), F.lit(0))).first()
        sample = few.orderBy(F.xxhash64("id", "x"), "id", "label").select("id", "label", "x").limit(SAMPLE).collect()
        self.m2, self.exact = m2, m2 < EXACT
        #: the narrowest type that holds all components
        self.kind = "array<int>" if widest < 2**31 else "array<long>"
        self.pivots = Pivots(sample, n, m2, self.exact)
        placed = dealt(few.select("id", F.col("label").alias("block"), "dim", F.col("x").cast(self.kind).alias("x")), self.pivots)
        self.placed = materialise(placed, "dealt")
        self.blocks = materialise(self.placed.groupBy("dim", "block", "pivot").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("chunks"), F.max("away").alias("radius")), "blocks")
        radius = {r["pivot"]: r["radius"] for r in self.blocks.groupBy("pivot").agg(F.max("radius").alias("radius")).collect()}  # at most SAMPLE + 1 rows
        self.pivots.radius = np.array([radius.get(i, 0.0) for i in range(sum(len(a) for a, _, _ in self.pivots.at.values()))])

    def search(self, queries: DataFrame, k: int, same: bool) -> DataFrame:
        """(qid, w, id, score, rank): for window w of each query (qid, label, dim, x, lo, hi), its first k rows of the same label, or of other labels."""
        asked = routed(queries.withColumn("x", F.col("x").cast(self.kind)), self.pivots, k, same)
        label = F.col("block") == F.col("label") if same else F.col("block") != F.col("label")
        met = join_checked(asked, self.blocks.drop("radius"), ["dim", "pivot"]).filter(label).withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)))
        sizes = join_checked(self.placed, self.blocks.select("dim", "block", "pivot", "chunks"), ["dim", "block", "pivot"])
        none = F.lit(None).cast("array<long>")
        candidates = sizes.select(*KEYS[:3], F.pmod(F.xxhash64("id"), F.col("chunks")).cast("int").alias("chunk"), F.lit(0).alias("kind"), "id", "x", none.alias("lo"), none.alias("hi"), none.alias("least"))
        rows = candidates.unionByName(met.select(*KEYS, F.lit(1).alias("kind"), F.col("qid").alias("id"), "x", "lo", "hi", "least"))
        found = rows.repartition(*KEYS).sortWithinPartitions(*KEYS, "kind").mapInArrow(_searched(self.m2, k, self.exact), "qid long, w int, id long, score long")
        rank = F.row_number().over(Window.partitionBy("qid", "w").orderBy(F.desc("score"), "id"))
        return found.withColumn("rank", rank).filter(F.col("rank") <= k)


def hard_negatives(vectors: DataFrame, every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = 30, high: int = 90) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): see the module.

    Anchors are the rows whose vec_id `every` divides. A pair's negatives have another label and low * positive_score <= 100 * score <= high * positive_score.
    """
    rows = quantised(vectors)
    index = Index(rows, max(positives + 1, negatives))
    anchors = rows.filter((F.col("id") % every == 0) & (F.col("id") != int(_LONG.max)))
    asked = materialise(anchors.select("x", "label").distinct().withColumns({"dim": F.size("x"), "qid": F.monotonically_increasing_id()}), "queries")
    own = anchors.select("id", "x", "label").distinct().join(asked, ["x", "label"]).select("qid", F.col("id").alias("anchor_id"))
    every_score = {"lo": F.array(F.lit(int(_LONG.min))), "hi": F.array(F.lit(int(_LONG.max)))}
    near = index.search(asked.withColumns(every_score), positives + 1, True).select("qid", F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    first = F.row_number().over(Window.partitionBy("qid", "anchor_id").orderBy(F.desc("positive_score"), "positive_id"))
    pairs = own.join(near, "qid").filter("anchor_id <> positive_id").withColumn("_r", first).filter(F.col("_r") <= positives).filter("positive_score >= 0").drop("_r")
    pairs = materialise(pairs, "positives")
    tenth = lambda times, up: F.expr(f"cast((cast(positive_score as decimal(38, 0)) * {times} + {up}) div 100 as long)")
    spans = pairs.select("qid", tenth(low, 99).alias("lo"), tenth(high, 0).alias("hi")).distinct()
    grouped = spans.groupBy("qid").agg(F.array_sort(F.collect_list(F.struct("lo", "hi"))).alias("_s"))
    windows = materialise(grouped.select("qid", "_s.lo", "_s.hi").join(asked, "qid"), "windows")
    numbered = windows.select("qid", F.posexplode(F.arrays_zip("lo", "hi")).alias("w", "_s")).select("qid", "w", "_s.lo", "_s.hi")
    found = index.search(windows, negatives, False).join(numbered, ["qid", "w"])
    met = pairs.withColumns({"lo": tenth(low, 99), "hi": tenth(high, 0)}).join(found, ["qid", "lo", "hi"])
    named = lambda c: F.when(F.col(c) != int(_LONG.max), F.col(c))
    return met.select("anchor_id", named("positive_id").alias("positive_id"), F.col("rank").cast("int").alias("rank"), named("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


def report_sql(every: int = 100, positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = 30, high: int = 90) -> str:
    """The same by all pairs, as SQL."""
    return f"""
WITH r AS (SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda v: CAST(floor(256 * CAST(v AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda v: v IS NULL OR NOT isfinite(v))) = 0),
s AS (SELECT a.vec_id AS anchor_id, a.label AS anchor_label, b.vec_id, b.label,
    CAST(coalesce(list_sum(list_transform(list_zip(a.x, b.x), lambda p: p[1] * p[2])), 0) AS BIGINT) AS score
  FROM r a JOIN r b ON a.vec_id % {every} = 0 AND a.vec_id <> b.vec_id AND len(a.x) = len(b.x)),
p AS (SELECT anchor_id, anchor_label, vec_id AS positive_id, score AS positive_score FROM s WHERE label = anchor_label
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {positives})
SELECT p.anchor_id, p.positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS INT) AS rank,
  s.vec_id AS negative_id, p.positive_score, s.score AS negative_score
FROM p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> p.anchor_label
  AND {low} * p.positive_score <= 100 * s.score AND 100 * s.score <= {high} * p.positive_score
QUALIFY rank <= {negatives}
"""
