"""Duplicates and neighbours: token overlap, MinHash, cosine, clusters."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import Column, DataFrame, Window, functions as F

from admill.operators.graph import components
from admill.operators.storage import stored

PERMUTATIONS = 128


def token_set(text: Column) -> Column:
    return F.array_distinct(F.filter(F.split(F.coalesce(text, F.lit("")), r"[\x20\x09-\x0D]+"), lambda w: w != ""))


def jaccard_pairs(rows: DataFrame, key: str, tokens: Column, least: float) -> DataFrame:
    """(a, b, jaccard) of pairs at or above the threshold: candidates share a token of their rarest prefix.

    Tokens are ordered by frequency, and a pair that similar must share one of the first
    n - ceil(least * n) + 1, so only rare tokens meet in the join.
    """
    sets = rows.select(F.col(key).alias("id"), tokens.alias("tokens")).withColumn("n", F.size("tokens")).filter("n > 0")
    flat = sets.select("id", "n", F.explode("tokens").alias("token"))
    df = flat.groupBy("token").agg(F.count("*").alias("df"))
    ranked = flat.join(df, "token").withColumn("place", F.row_number().over(Window.partitionBy("id").orderBy("df", "token")))
    prefix = ranked.filter(F.col("place") <= F.col("n") - F.ceil(least * F.col("n") - 1e-9) + 1).select("id", "n", "token")
    other = prefix.select(F.col("id").alias("b"), F.col("n").alias("nb"), "token")
    close = (F.col("id") < F.col("b")) & (F.least("n", "nb") >= least * F.greatest("n", "nb"))
    pairs = prefix.join(other, "token").filter(close).select(F.col("id").alias("a"), "b").distinct()
    left, right = sets.select(F.col("id").alias("a"), F.col("tokens").alias("x")), sets.select(F.col("id").alias("b"), F.col("tokens").alias("y"))
    both = pairs.join(left, "a").join(right, "b")
    score = F.size(F.array_intersect("x", "y")) / F.size(F.array_union("x", "y"))
    return both.select("a", "b", score.alias("jaccard")).filter(F.col("jaccard") >= least)


def minhash(text: Column, permutations: int = PERMUTATIONS) -> Column:
    """Signature array: for each permutation the least hash over the distinct tokens; empty texts have none."""

    def sign(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        rng = np.random.default_rng(1)
        a, b = rng.integers(1, 1 << 61, size=(2, permutations, 1), dtype=np.uint64)
        for batch in batches:
            out = []
            for tokens in batch:
                if tokens is None or not len(tokens):
                    out.append(None)
                    continue
                h = pd.util.hash_array(np.asarray(tokens, dtype=object)).astype(np.uint64)
                out.append(((a | np.uint64(1)) * h + b >> np.uint64(32)).min(axis=1).astype(np.int64).tolist())
            yield pd.Series(out)

    return F.pandas_udf(sign, "array<long>")(token_set(text))


def bands_for(least: float, permutations: int = PERMUTATIONS) -> int:
    """The fewest bands such that signatures which agree in that share of slots have a whole band in common: one more than slots may differ."""
    differ = int((1 - least) * permutations + 1e-9)
    return next(b for b in range(differ + 1, permutations + 1) if permutations % b == 0)


#: The most members of a band that meet in one task; a larger band is dealt into chunks, and each pair of chunks gets a task.
CHUNK = 4096
TASK = ["band", "h", "low", "high"]


def joining_links(ids: np.ndarray, roots: np.ndarray, chunks: np.ndarray, signatures: np.ndarray, least: float) -> list[tuple[int, int]]:
    """Links between signatures of different classes (and chunks, where there are two) that join classes not yet joined."""
    root = {r: r for r in roots.tolist()}

    def find(r: int) -> int:
        while root[r] != r:
            root[r] = root[root[r]]
            r = root[r]
        return r

    found, two = [], chunks.min() != chunks.max()
    slots = np.ascontiguousarray(signatures.T)
    step = max(1, (1 << 22) // len(ids))
    for at in range(0, len(ids), step):
        part = slice(at, at + step)
        agree = np.zeros((len(ids[part]), len(ids) - at), dtype=np.int16)
        for slot in slots:
            agree += slot[part, None] == slot[None, at:]
        near = (agree >= least) & (roots[part, None] != roots[None, at:])
        if two:
            near &= chunks[part, None] != chunks[None, at:]
        for i, j in zip(*np.nonzero(near)):
            x, y = find(int(roots[at + i])), find(int(roots[at + j]))
            if x != y:
                root[max(x, y)] = min(x, y)
                found.append((int(min(ids[at + i], ids[at + j])), int(max(ids[at + i], ids[at + j]))))
    return found


def _compared(least: float):
    def compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        """Rows come sorted by task."""
        held: list[pd.DataFrame] = []
        found: list[tuple[int, int]] = []

        def meet() -> None:
            ids, roots, chunks = (np.concatenate([p[c].to_numpy() for p in held]) for c in ("first", "root", "chunk"))
            if len(ids) > 1:
                found.extend(joining_links(ids, roots, chunks, np.vstack([np.vstack(p["s"].to_numpy()) for p in held]), least))

        for batch in batches:
            keys = batch[TASK].to_numpy()
            cuts = np.flatnonzero(np.r_[len(keys) > 0, (keys[1:] != keys[:-1]).any(axis=1), True]) if len(keys) else []
            for start, stop in zip(cuts, cuts[1:]):
                if held and (held[0][TASK].iloc[0].to_numpy() != keys[start]).any():
                    meet()
                    held = []
                held.append(batch[start:stop])
            yield pd.DataFrame(found, columns=["a", "b"])
            found.clear()
        if held:
            meet()
        yield pd.DataFrame(found, columns=["a", "b"])

    return compare


def band_links(rooted: DataFrame, kinds: DataFrame, least: float) -> DataFrame:
    """Links (a, b) that join classes within bands. rooted: (band, h, first, root), stored; kinds: (first, s).

    Members and their signatures go to their band's tasks, pairs stay there: what is shuffled and sent on grows with the members.
    """
    spread = rooted.groupBy("band", "h").agg(F.min("root").alias("_l"), F.max("root").alias("_m"), F.count("*").alias("_n")).filter("_l <> _m")
    mixed = spread.select("band", "h", F.ceil(F.col("_n") / CHUNK).cast("int").alias("_k"))
    short = F.transform("s", lambda x: (x - (1 << 31)).cast("int"))
    rows = rooted.join(mixed, ["band", "h"]).withColumn("chunk", F.pmod(F.xxhash64("first"), F.col("_k")).cast("int"))
    others = F.explode(F.sequence(F.lit(0), F.col("_k") - 1)).alias("_o")
    dealt = rows.select("band", "h", "first", "root", "chunk", others).select("band", "h", "first", "root", "chunk", F.least("chunk", "_o").alias("low"), F.greatest("chunk", "_o").alias("high"))
    placed = dealt.join(kinds.select("first", short.alias("s")), "first").select(*TASK, "first", "root", "chunk", "s")
    return placed.repartition(*TASK).sortWithinPartitions(*TASK).mapInPandas(_compared(least), "a long, b long").distinct()


def near_duplicates(rows: DataFrame, key: str, text: str, least: float = 0.95) -> DataFrame:
    """(key, first) of each row that is linked to an earlier one, directly or by way of others: the least key (a whole number) of its class.

    Two rows are linked if their signatures agree in at least that share of slots; every such pair shares a
    band. Equal signatures collapse first, by their SHA-256. A band's members are compared with its least member, then those of
    different classes with each other, so a large group of copies costs one comparison a member.
    """
    bands = bands_for(least)
    digest = F.unhex(F.sha2(F.array_join(F.col("s").cast("array<string>"), ","), 256))
    signed = stored(rows.select(F.col(key).alias("id"), minhash(F.col(text)).alias("s")).filter(F.col("s").isNotNull()).withColumn("d", digest), "signatures")
    firsts = stored(signed.groupBy("d").agg(F.min("id").alias("first")), "signature-kinds")
    kinds = stored(signed.join(firsts.select(F.col("first").alias("id"), "d"), ["id", "d"]).dropDuplicates(["id", "d"]).select(F.col("id").alias("first"), "s"), "signature-firsts")
    width = PERMUTATIONS // bands
    keys = F.array(*[F.struct(F.lit(i).alias("band"), F.xxhash64(F.slice("s", i * width + 1, width)).alias("h")) for i in range(bands)])
    banded = kinds.select("first", F.explode(keys).alias("k")).select("first", "k.*")
    groups = banded.groupBy("band", "h").agg(F.count("*").alias("n"), F.min("first").alias("a")).filter("n > 1").drop("n")
    members = stored(banded.join(groups, ["band", "h"]), "bands")
    agree = F.aggregate(F.zip_with("s", "s2", lambda x, y: (x == y).cast("int")), F.lit(0), lambda acc, x: acc + x)
    left, right = kinds.select(F.col("first").alias("a"), "s"), kinds.select(F.col("first").alias("b"), F.col("s").alias("s2"))
    pairs = members.filter(F.col("first") != F.col("a")).select("a", F.col("first").alias("b")).distinct()
    stars = stored(pairs.join(left, "a").join(right, "b").filter(agree >= least * PERMUTATIONS - 1e-9).select("a", "b"), "signature-links")
    roots = components(stars).withColumnRenamed("node", "first")
    rooted = stored(members.select("band", "h", "first").join(roots, "first", "left").withColumn("root", F.coalesce("root", "first")), "rooted-bands")
    joined = stored(band_links(rooted, kinds, least * PERMUTATIONS - 1e-9), "signature-links")
    roots = components(stars.unionByName(joined)).withColumnRenamed("node", "first")
    out = signed.select("id", "d").join(firsts, "d").join(roots, "first", "left").withColumn("first", F.coalesce("root", "first"))
    return out.select(F.col("id").alias(key), "first").filter(F.col(key) > F.col("first"))


def cosine(a: Column, b: Column) -> Column:
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda acc, v: acc + v)
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def _units(vectors: pd.Series, width: int) -> np.ndarray:
    """Vectors as rows of length 1. Rows of NaN: not finite. Rows of inf: no direction, or null, or of another length."""
    out = np.full((len(vectors), width), np.inf)
    for i, v in enumerate(vectors):
        if v is not None and len(v) == width:
            out[i] = v if np.isfinite(v := np.asarray(v, dtype=float)).all() else np.nan
    with np.errstate(invalid="ignore", divide="ignore"):
        norms = np.sqrt((out * out).sum(axis=1, keepdims=True))
        return np.where(np.isinf(norms) | (norms == 0), np.inf, out / norms)


def nearest(queries: DataFrame, items: DataFrame, key: str, vector: str, k: int, most_queries: int = 20_000, digits: int = 7) -> DataFrame:
    """(query, item, cosine, rank) of the k most similar items of each query, itself left out, by cosine to that many digits, then key (a whole number).

    Queries are a stated set, taken in blocks of about `most_queries` at most, which are broadcast; a task multiplies its items with a block as matrices and
    sends each query's k best. Vectors without direction have no cosine and come last.
    """
    whole = F.when(F.forall(vector, lambda x: x.isNotNull()), F.col(vector).cast("array<double>"))
    numbered = queries.select(F.col(key).cast("long").alias("query"), whole.alias("q"))
    all_items = items.select(F.col(key).cast("long").alias("item"), whole.alias("v"))
    n, width = numbered.agg(F.count("*"), F.max(F.size("q"))).first()
    blocks, scale = max(1, -(-n // most_queries)), 10.0**digits

    def scan(held, rows: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        ids, units = held.value
        best, who = np.full((len(ids), k), -3.0), np.full((len(ids), k), np.iinfo(np.int64).max)
        for batch in rows:
            found, names = _units(batch["v"], units.shape[1]), batch["item"].to_numpy()
            odd, lost = np.isnan(found[:, 0]), np.isinf(found[:, 0])
            plain = np.where(np.isfinite(found), found, 0.0).T
            for at in range(0, len(ids), 500):
                part, own = units[at : at + 500], slice(at, at + 500)
                score = np.where(np.isfinite(part), part, 0.0) @ plain
                score[:, lost], score[np.isinf(part[:, 0])] = -2.0, -2.0  # no cosine: last
                score[:, odd], score[np.isnan(part[:, 0])] = 2.0, 2.0  # not a number: first
                near = score >= best[own, -1:] - 1.0 / scale
                if near.sum() > 8 * k * len(part) and len(names) > k:  # of a batch's own, only the first k (and the query itself) can matter
                    near &= score >= np.partition(score, -k - 1, axis=1)[:, -k - 1 : -k] - 1.0 / scale
                i, j = np.nonzero(near)
                keep = ids[own][i] != names[j]
                i, j = i[keep], j[keep]
                rounded = np.floor(score[i, j] * scale + 0.5) / scale
                who_i, score_i = np.concatenate([np.repeat(np.arange(len(part)), k), i]), np.concatenate([best[own].ravel(), rounded])
                who_j = np.concatenate([who[own].ravel(), names[j]])
                order = np.lexsort((who_j, -score_i, who_i))
                starts = np.searchsorted(who_i[order], np.arange(len(part)))
                top = order[starts[:, None] + np.arange(k)]
                best[own], who[own] = score_i[top], who_j[top]
        i, j = np.nonzero(best > -3.0)
        told = best[i, j]
        yield pd.DataFrame({"query": ids[i], "item": who[i, j], "score": told})

    top = Window.partitionBy("query").orderBy(F.desc("score"), "item")
    cosine_of = F.when(F.col("score") > 1.5, F.lit(float("nan"))).when(F.col("score") >= -1.5, F.col("score"))
    out = None
    for block in range(blocks):
        part = numbered.filter(F.pmod(F.xxhash64("query"), F.lit(blocks)) == block).toPandas()  # of bounded size
        held = items.sparkSession.sparkContext.broadcast((part["query"].to_numpy(dtype=np.int64), _units(part["q"], max(1, width or 1))))
        best = all_items.mapInPandas(partial(scan, held), "query long, item long, score double")
        best = best.withColumn("rank", F.row_number().over(top)).filter(F.col("rank") <= k).select("query", "item", cosine_of.alias("cosine"), "rank")
        out = best if out is None else out.unionByName(best)
    return out


def cluster_trends(rows: DataFrame, vector: str, value: str, k: int = 15, seed: int = 42) -> DataFrame:
    """A row per embedding cluster: size and mean value; with fewer rows than clusters, one row over all."""
    with_vector = rows.filter(F.size(vector) > 0)
    if with_vector.count() < k:
        return with_vector.agg(F.lit(-1).alias("cluster"), F.count("*").alias("n"), F.avg(value).alias("mean"))
    points = with_vector.select(value, array_to_vector(F.transform(vector, lambda x: x.cast("double"))).alias("features"))
    model = KMeans(k=k, seed=seed, maxIter=20).fit(points)
    return model.transform(points).groupBy(F.col("prediction").alias("cluster")).agg(F.count("*").alias("n"), F.avg(value).alias("mean"))
