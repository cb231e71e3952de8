"""Language identification, hard negatives and resampling against plain versions."""

import hashlib
import math
import re
import zlib
from collections import Counter

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from admill.llm import hard_negatives, language, resampling, token_shards

LONG = 2**63 - 1


def plain_negatives(rows):
    """All pairs, one anchor at a time."""
    part = set()
    for vec_id, x, label in rows:
        if label is None or x is None or any(v is None or not math.isfinite(v) for v in x):
            continue
        part.add((LONG if vec_id is None else vec_id, tuple(math.floor(256 * v) for v in x), (label + 1) % 10 if vec_id is not None and vec_id % 7 == 0 else label))
    out = []
    for i, x, label in part:
        if i % 100 or i == LONG:
            continue
        scored = sorted((-sum(a * b for a, b in zip(x, y)), j, k) for j, y, k in part if len(y) == len(x))
        for s, j, _ in [p for p in scored if p[2] == label and p[1] != i][:5]:
            fit = [(-t, k) for t, k, m in scored if m != label and 30 * -s <= 100 * -t <= 90 * -s]
            out += [(i, j if j < LONG else None, r, k if k < LONG else None, -s, t) for r, (t, k) in enumerate(fit[:10], 1)]
    return Counter(out)


def mined(spark, rows):
    return Counter(tuple(r) for r in hard_negatives.hard_negatives(spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")).collect())


def test_hard_negatives_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=6)], int(rng.integers(0, 4))) for i in range(700)]
    rows += [(700 + i, rows[5][1], 1) for i in range(60)] + [(800 + i, rows[5][1], 2) for i in range(30)]  # a hot vector
    rows += [(900, None, 1), (1000, [1.0] * 6, None), (1100, [None] + [0.0] * 5, 1), (1101, [math.nan] * 6, 1), (1200, [math.inf] * 6, 1), (1300, [0.0] * 6, 1)]
    rows += [(1400, [1.0, 2.0], 1), (1401, [2.0, 1.0], 1), (1402, [1.0, 1.0], 2), (1500, [], 1), (1501, [], 1), (1502, [], 2), (None, rows[3][1], 3), rows[100], rows[100]]
    assert mined(spark, rows) == plain_negatives(rows)


def test_hard_negatives_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "BLOCK", 50)
    monkeypatch.setattr(hard_negatives, "SAMPLE", 100)
    monkeypatch.setattr(hard_negatives, "BATCH", 7)
    rng = np.random.default_rng(4)
    centres = rng.normal(size=(12, 5))
    rows = [(i, [float(v) for v in centres[i % 12] + rng.normal(size=5) / 6], int(rng.integers(0, 3))) for i in range(1200)]
    assert mined(spark, rows) == plain_negatives(rows)


def test_hard_negatives_huge_components(spark):
    rows = [(i, [float((i % 13) * 10**5), float(i)], i % 3) for i in range(0, 300)]
    assert mined(spark, rows) == plain_negatives(rows)
    assert not mined(spark, [])


def test_cover_tree_bounds_and_prunes():
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(20, 8)) * 4
    x = np.floor(256 * (centres[rng.integers(0, 20, 4000)] + rng.normal(size=(4000, 8)) / 20)).astype(np.int64)
    norm2 = (x.astype(float) ** 2).sum(axis=1)
    tree = hard_negatives.CoverTree(x, norm2, norm2.max())
    assert sorted(tree.order.tolist()) == list(range(4000))

    def below(n):
        return tree.order[slice(*tree.spans[n])].tolist() if not tree.children[n] else [r for c in tree.children[n] for r in below(c)]

    q = np.floor(256 * centres[3]).astype(np.int64)
    seen = 0
    for n in range(len(tree.centre)):
        s = x[below(n)] @ q
        low, high = hard_negatives.bounds(np.array([float(x[tree.centre[n]] @ q)]), np.array([float(q @ q)]), tree.m2, np.array([tree.radius[n]]))
        assert low[0] <= s.min() and s.max() <= high[0]
        seen += not tree.children[n] and high[0] >= np.sort(x @ q)[-10]
    assert seen < 0.25 * sum(not c for c in tree.children)  # most leaves lie outside


def test_hard_negatives_sql(spark, tiny):
    vectors = spark.read.parquet(f"{tiny}/embeddings.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM '{tiny}/embeddings.parquet'")
    want = con.execute(hard_negatives.report_sql()).fetchall()
    assert want and Counter(want) == Counter(tuple(r) for r in hard_negatives.hard_negatives(vectors).collect())


def plain_resampling(docs, target, share=25):
    def features(text):
        w = re.findall("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
        return len(w), [zlib.crc32(f.encode()) % 10000 for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]

    s, t = (Counter(b for text in texts for b in features(text)[1]) for texts in ([d[1] for d in docs], target))
    total_s, total_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (total_s + 10000) / ((s[b] + 1) * (total_t + 10000)))) for b in range(10000)]
    rows = []
    for doc_id, text in docs:
        n, f = features(text)
        h = int(hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        weight = math.floor(sum(gain[b] for b in f) / len(f)) if f else 0
        rows.append([doc_id, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None, n])
    order = sorted((r for r in rows if r[5] >= 20), key=lambda r: (-r[3], r[0] is None, r[0]))
    for rank, r in enumerate(order[: share * len(order) // 100], 1):
        r[4] = rank
    return Counter(tuple(r[:5]) for r in rows)


def test_resampling(spark, tiny):
    docs = [tuple(r) for r in spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text").collect()]
    bench = [r["text"] for r in spark.read.parquet(f"{tiny}/benchmark.parquet").collect()]
    got = resampling.resampled(spark.read.parquet(f"{tiny}/documents.parquet"), spark.read.parquet(f"{tiny}/benchmark.parquet"))
    assert got.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert Counter(map(tuple, got.collect())) == plain_resampling(docs, bench)


@pytest.mark.parametrize("bits", [2, 11])
def test_resampling_odd_rows(spark, monkeypatch, bits):
    monkeypatch.setattr(resampling, "DIGIT_BITS", bits)
    monkeypatch.setattr(resampling, "BLOCK_BITS", 2)
    texts = [None, "", "!!", "Éa b1 B1 ﬀ", "one " * 19, "one " * 20, "w" * 30000, "the cat 9 " * 900] + [f"word{i} and " * 12 for i in range(12)]
    rows = [(i * 10**17 - 10**18, t) for i, t in enumerate(texts)] + [(7, texts[9])] * 3 + [(None, texts[8]), (LONG, texts[8]), (-LONG - 1, texts[8])]
    docs = spark.createDataFrame([(*r, "x", 1) for r in rows], "doc_id long, text string, rank string, _at int")
    target = ["word3 and word4", None]
    got = resampling.resampled(docs, spark.createDataFrame([(1, t) for t in target], "item_id long, text string"), share=80)
    assert Counter(map(tuple, got.collect())) == plain_resampling(rows, target, 80)


def test_resampling_empty(spark):
    docs, bench = spark.createDataFrame([], "doc_id long, text string"), spark.createDataFrame([], "item_id long, text string")
    assert resampling.resampled(docs, bench).count() == 0
    one = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    assert [r["rank"] for r in resampling.resampled(one, bench).collect()] == [None]


def test_language_held_out_accuracy(spark, tiny):
    docs = spark.read.parquet(f"{tiny.rsplit('sf', 1)[0]}sf0.01/documents.parquet")
    out = language.identified(docs).join(docs.select("doc_id", "lang"), "doc_id").collect()
    held = [r for r in out if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0) for r in out) and len(out) == docs.count()
    assert sum(r["lang"] == r["lang_pred"] for r in held) >= 0.96 * len(held)
    assert all(0 <= r["score"] <= 1 and r["rejected"] == (r["margin"] < language.MARGIN) for r in out)
    sure = [r for r in held if not r["rejected"]]
    assert sum(r["lang"] == r["lang_pred"] for r in sure) >= 0.98 * len(sure)


def test_language_learns_from_training_rows_only(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    wrong = docs.withColumn("lang", F.when(language.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang")))
    assert language.dictionaries(wrong) == language.dictionaries(docs)
    for lang, content in language.dictionaries(docs).items():
        assert len(content) <= 2 * language.DICTIONARY and lang != "xx"


def test_language_odd_rows(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet").select("doc_id", "text", "lang", F.lit(1).alias("score"))
    odd = [(None, "the and of", None, 1), (-5, None, "en", 1), (-6, "", None, 1), (-7, "12 + 3 !", "en", 1), (-8, "der und die ist " * 20000, None, 1), (-8, "der und die ist " * 20000, None, 1), (-9, "é", None, 1)]
    out = {}
    for r in language.identified(docs.unionByName(spark.createDataFrame(odd, docs.schema))).collect():
        assert out.setdefault(r["doc_id"], r) == r
    assert all(out[i]["lang_pred"] == "und" and out[i]["score"] == 0 for i in (-5, -6, -7))
    assert out[-8]["lang_pred"] == "de" and out[-9]["lang_pred"] != "und" and not out[None]["held_out"]
    none = docs.limit(0)
    assert language.identified(none).count() == 0
    unlabelled = language.identified(docs.withColumn("lang", F.lit(None).cast("string"))).collect()
    assert all(r["lang_pred"] == "und" for r in unlabelled)


def plain_sizes(contents, text):
    clean = re.sub(r"(?:[^\w]|[\d_])+", " ", text.lower()).encode()
    parts = [clean[i : i + language.PIECE] for i in range(0, len(clean), language.PIECE)]
    return {lang: sum(len(c.compress(p)) for p in parts) for lang, c in language.compressors(contents).items()}


def test_language_takes_the_smallest(spark, tiny):
    docs = spark.read.parquet(f"{tiny}/documents.parquet")
    contents = language.dictionaries(docs)
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    for r in language.identified(docs, contents).collect():
        sizes = plain_sizes(contents, texts[r["doc_id"]])
        assert r["lang_pred"] == min(sizes, key=sizes.get)


def test_token_shards_walk_cycles(spark, tmp_path):
    """The slots are the ranks of the permuted numbers, in a domain that no power of four fills."""
    texts = [f"word{i} " * (i % 40) for i in range(90)]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3, "doc_id")
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    partitions, places, _ = token_shards.bounds(docs, 16)
    domain = partitions * places
    assert domain & (domain - 1) and places * 16 >= 40 * 4
    numbers = {}
    for r in token_shards.streams(docs, places, 16).collect():
        numbers[r["docs"][0]["doc_id"], r["docs"][0]["start"]] = r["number"]
    assert max(numbers.values()) < domain
    image = dict(zip(numbers.values(), token_shards.permute(np.array(list(numbers.values())), domain).tolist()))
    assert len(set(image.values())) == len(numbers) and max(image.values()) < domain
    rows = token_shards.write_shards(docs, f"file://{tmp_path}/shards", length=16, shards=4).collect()
    by_slot = [numbers[r["docs"][0]["doc_id"], r["docs"][0]["start"]] for r in sorted(rows, key=lambda r: r["slot"])]
    assert by_slot == sorted(numbers.values(), key=image.get) and [r["slot"] for r in sorted(rows, key=lambda r: r["slot"])] == list(range(len(rows)))
    again = token_shards.write_shards(docs.repartition(5, "doc_id"), f"file://{tmp_path}/other", length=16, shards=4).collect()
    pieces = lambda rows: sorted((d["doc_id"], sum(x["length"] for r in rows for x in r["docs"] if x["doc_id"] == d["doc_id"])) for d in {d["doc_id"]: d for r in rows for d in r["docs"]}.values())
    assert pieces(again) == pieces(rows)  # another partitioning, another order, the same ids
    with pytest.raises(Exception, match="store them first"):
        token_shards.streams(docs, 1, 16).collect()
