"""Near copies against all-pairs Jaccard, with groups compared whole and in chunks."""

import random

import numpy as np
import pytest
from admill.llm import near_copies


def sets(text):
    words = (text or "").lower().split()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)} if len(words) > 5 else {tuple(words)}


def brute(rows):
    root = {i: i for i, _ in rows}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    split = {i: sets(t) for i, t in rows}
    for i in split:
        for j in split:
            x, y = split[i], split[j]
            if i < j and len(x & y) >= 0.8 * len(x | y) - 1e-9 and find(i) != find(j):
                root[max(find(i), find(j))] = min(find(i), find(j))
    return {i for i in root if root[i] == i}


def corpus():
    rng = random.Random(5)
    word = lambda: f"w{rng.randrange(4000)}"
    texts = [None, "", "one two", "One  two"]
    shared = [word() for _ in range(40)]
    for _ in range(25):
        base = [word() for _ in range(rng.randrange(60, 120))]
        for _ in range(6):  # a chain of edits: its ends may be less alike than its neighbours
            base = list(base)
            base[rng.randrange(len(base))] = word()
            texts.append(" ".join(base))
    texts += [" ".join([word() for _ in range(90)] + shared) for _ in range(20)]
    hub = [word() for _ in range(100)]
    for _ in range(60):  # one group of copies with independent edits, about as alike as the bound
        copy = list(hub)
        for i in rng.sample(range(100), rng.randrange(1, 4)):
            copy[i] = word()
        texts.append(" ".join(copy))
    rng.shuffle(texts)
    return list(enumerate(texts))


@pytest.mark.parametrize("chunk", [1_000, 7])
def test_against_all_pairs(spark, monkeypatch, chunk):
    monkeypatch.setattr(near_copies, "CHUNK", chunk)
    monkeypatch.setattr(near_copies, "COLUMNS", 64)
    rows = corpus()
    kept = near_copies.one_of_near_copies(spark.createDataFrame(rows, "doc_id long, text string"))
    found = [r["doc_id"] for r in kept.collect()]
    assert sorted(found) == sorted(brute(rows)) and len(found) < len(rows) - 100


def test_against_all_pairs_of_documents(spark, tiny):
    docs = spark.read.parquet(f"{tiny.replace('sf0.001', 'sf0.01')}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    found = {r["doc_id"] for r in near_copies.one_of_near_copies(docs).collect()}
    want = brute(rows)
    assert found == want and len(want) < len(rows)


def test_bands_find_pairs_at_the_bound():
    rng = random.Random(6)
    met = 0
    for _ in range(300):
        common, a, b = ([rng.randrange(1 << 64) for _ in range(n)] for n in (80, 10, 10))
        x, y = (near_copies.band_keys(np.unique(np.array(common + own, dtype=np.uint64))) for own in (a, b))
        met += any(p == q for p, q in zip(x, y))
    assert met >= 299
