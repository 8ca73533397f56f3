"""Near-duplicate classes by shingles against brute force."""

from itertools import combinations

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from chromaloom.llm import near_copies, simhash
from test_operators import ODD, empty, frame


def brute_firsts(rows):
    sets = [frozenset(simhash.shingle_hashes(t or "", 5).tolist()) for _, t in rows]
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i
    holders = {}
    for i, s in enumerate(sets):
        for h in s or {None}:
            holders.setdefault(h, []).append(i)
    for i, j in {p for at in holders.values() for p in combinations(at, 2)}:
        if sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j]):
            parent[top(i)] = top(j)
    best = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            best[top(i)] = min(best.get(top(i), d), d)
    return sorted(best.values())


def kept_ids(kept):
    return sorted(r.doc_id for r in kept.collect() if r.doc_id is not None)


def test_near_copies_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    words = [f"w{k}" for k in range(300)]
    rows = list(ODD)
    for k in range(300):  # copies of a few texts, edited so that likeness lies around 0.8, in a few large buckets
        text = [words[(7 * i + k % 3 * 11 + i * i) % 300] for i in range(150)]
        for at in rng.integers(0, 150, rng.integers(0, 6)):
            text[at] = words[rng.integers(300)]
        rows.append((100 + k, " ".join(text)))
    want = brute_firsts(rows)
    assert 10 < len(want) < len(rows) - 100
    kept = near_copies.one_of_each(frame(spark, rows))
    assert kept.columns == frame(spark).columns
    assert kept_ids(kept) == want
    assert near_copies.one_of_each(empty(spark)).count() == 0


def test_stage_drops_all_near_copies_of_a_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    assert kept_ids(corpus_pipeline.near_duplicates(spark, docs, "")) == brute_firsts(rows)


def test_band_keys_miss_few_pairs():
    rng = np.random.default_rng(1)
    missed = 0
    for _ in range(400):  # 160 of 200 shared: likeness 0.8
        both = rng.integers(0, 1 << 63, 200, np.uint64)
        a, b = near_copies.band_keys([both[:180], both[20:]])
        missed += not (a == b).any()
    assert missed == 0
