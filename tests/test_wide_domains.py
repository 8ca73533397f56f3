"""Domains of every size against a dense search, and clustering in few rounds."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from chromaloom.operators import domains, features, greedy, matrix
from test_matrix import dense_matrix, planted


def brute_scores(m, least):
    """Score of every domain from the definition of its two triangles."""
    n = len(m)
    far = np.zeros((3 * n, 3 * n))
    far[n:2 * n, n:2 * n] = np.maximum(m, m.T)
    out = {}
    for a in range(n):
        for b in range(a + least, n):
            upper, lower, mid = [], [], (a + b) // 2
            for r in range(a, b + 1):
                for j in (range(2 * r - a + 1, b + 1) if r <= mid else range(b + 1, 2 * r - a + 1)):
                    up, down = far[n + r, n + 2 * r - j], far[n + r, n + j]
                    p = (up - down) / (up + down) if up + down else 0.0
                    (upper if r <= mid else lower).append(p + np.sign(p))
            out[a, b] = round((sum(lower) / len(lower) - sum(upper) / len(upper)) / 4, 6)
    return out


def valued(spark, m, res=10_000):
    return matrix.intra(dense_matrix(spark, m, res)).withColumn("value", F.col("n").cast("double"))


@pytest.mark.parametrize("tile", [2, 6, 512])
def test_scores_equal_the_definition(spark, tile):
    rng = np.random.default_rng(tile)
    m = np.triu(rng.integers(0, 4, (21, 21)))
    m[20, 20] = 1
    got = {(r.b1, r.b2): round(r.score, 6) for r in domains.scored(valued(spark, m), None, 3, -9.0, tile).collect()}
    want = brute_scores(m, 3)
    assert set(got) == set(want) and all(abs(got[k] - want[k]) < 2e-6 for k in want)
    some = {(r.b1, r.b2) for r in domains.scored(valued(spark, m), 7, 3, -9.0, tile).collect()}
    assert some == {k for k in want if k[1] - k[0] <= 7}


def test_wide_domain_is_found_by_default(spark):
    found = domains.domains(valued(spark, planted(130, domains=[(25, 101)])), 10_000, min_bins=8, min_score=0.5, tile=32).collect()
    assert (250_000, 1_020_000) in {(r.start, r.end) for r in found}


def test_tiles_find_the_same(spark):
    values = valued(spark, planted(40, domains=[(3, 9), (14, 36)]))
    whole, parts = (sorted(map(tuple, domains.domains(values, 10_000, min_score=0.3, tile=t).collect())) for t in (512, 8))
    assert whole == parts and any(end - start > 120_000 for _, start, end, _ in parts)


def test_empty_map_has_no_domains(spark):
    assert domains.domains(valued(spark, np.eye(3)).where("false"), 10_000).count() == 0


def test_a_ramp_of_pixels_settles_in_few_rounds(spark, monkeypatch):
    rounds = []
    monkeypatch.setattr(greedy, "cut_measuring", lambda df, m, real=greedy.cut_measuring: rounds.append(1) or real(df, m))
    ramp = spark.range(10_000).select(F.lit("chr1").alias("chrom"), F.col("id").alias("b1"), (F.col("id") + 50).alias("b2"), F.col("id").alias("n"))
    tops = features.strongest_first(ramp, 1)
    assert tops.agg(F.count("*"), F.sum("members"), F.min(F.col("b1") % 2)).first() == (5000, 10_000, 1)
    assert len(rounds) <= 10


def test_members_belong_to_their_strongest_top(spark):
    rows = [("c", 0, 9, 9), ("c", 2, 9, 5), ("c", 1, 9, 1), ("c", 5, 9, 5), ("c", 4, 9, 2)]
    got = features.strongest_first(spark.createDataFrame(rows, "chrom string, b1 long, b2 long, n long"), 1).collect()
    assert {(r.b1, r.members) for r in got} == {(0, 2), (2, 1), (5, 2)}


def test_poisson_tail():
    counts = np.array([7, 0, 3, 3, 40, 1])
    want = [1 - sum(math.exp(-2.5) * 2.5 ** k / math.factorial(k) for k in range(c)) for c in counts]
    assert np.allclose(features._poisson_tail(2.5, counts), want, atol=1e-12)
