import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from chromaloom.operators import domains, features, matrix, support
from chromaloom.sources import contacts as files

PIXELS = "res long, c1 string, c2 string, b1 long, b2 long, n long"


def dense_matrix(spark, m, res=1000):
    rows = [(res, "chr1", "chr1", i, j, int(m[i, j])) for i in range(len(m)) for j in range(i, len(m)) if m[i, j]]
    return spark.createDataFrame(rows, PIXELS)


@pytest.fixture(scope="module")
def symmetric():
    rng = np.random.default_rng(5)
    m = rng.integers(1, 30, (12, 12))
    return np.triu(m) + np.triu(m, 1).T


def test_levels_add_up(spark):
    rng = random.Random(1)
    rows = [(rng.choice(["chr1", "chr2"]), rng.randint(0, 9999), "chr2", rng.randint(0, 9999)) for _ in range(500)]
    df = spark.createDataFrame(rows, "c1 string, p1 long, c2 string, p2 long")
    together = matrix.contact_matrix(df, (2500, 1000, 500, 100))
    for res in (2500, 1000, 500, 100):
        alone = matrix.contact_matrix(df, (res,))
        mine = together.where(F.col("res") == res)
        assert mine.exceptAll(alone).isEmpty() and alone.exceptAll(mine).isEmpty()


def test_balancing_makes_equal_rows(spark, symmetric):
    m = dense_matrix(spark, symmetric)
    norm = matrix.norm_vectors(m, "BALANCE", iters=12, cut_every=4)
    values = matrix.apply_norm(m, norm, rescale=False).collect()
    rows = np.zeros(12)
    for r in values:
        rows[r.b1] += r.value
        if r.b1 != r.b2:
            rows[r.b2] += r.value
    assert np.allclose(rows, 1, atol=1e-3)


def test_correlation_and_component(spark, symmetric):
    cells = dense_matrix(spark, symmetric).withColumnRenamed("c1", "chrom").withColumn("oe", F.col("n").cast("double"))
    corr = matrix.pearsons(cells, block=5)
    got = np.full((12, 12), np.nan)
    for r in corr.collect():
        got[r.i, r.j] = got[r.j, r.i] = r.r
    want = np.corrcoef(symmetric)
    assert np.allclose(got, want)
    vector = np.array([r.v for r in matrix.eigenvector(cells, iters=24, cut_every=6).orderBy("bin").collect()])
    some = {(r.i, r.j): r.r for r in matrix.pearsons(cells, block=5, rows=(4, 6)).collect()}
    assert set(some) == {(i, j) for i in range(12) for j in range(i, 12) if 4 <= i < 6 or 4 <= j < 6}
    assert all(abs(r - want[k]) < 1e-9 for k, r in some.items())
    values, vectors = np.linalg.eigh(want)
    top = vectors[:, np.argmax(np.abs(values))]
    assert abs(abs(vector @ top) - 1) < 0.05
    assert vector[np.argmax(np.abs(vector))] > 0


def test_too_fine_correlation_is_refused(spark, symmetric):
    cells = dense_matrix(spark, symmetric).withColumnRenamed("c1", "chrom").withColumn("oe", F.col("n").cast("double"))
    with pytest.raises(Exception, match="too fine"):
        matrix.pearsons(cells, max_bins=8).collect()


def test_matrix_store(spark, symmetric, tmp_path):
    m = dense_matrix(spark, symmetric).unionByName(dense_matrix(spark, symmetric, 5000))
    files.write_matrix(m, str(tmp_path / "m"))
    back = files.read_matrix(spark, str(tmp_path / "m"), 5000)
    assert back.exceptAll(m.where("res = 5000")).isEmpty() and back.count() == 78
    plan = back._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(res" in plan


def test_clusters_match_greedy(spark):
    rng = random.Random(2)
    points = {(rng.randint(0, 40), rng.randint(0, 40)): rng.randint(1, 9) for _ in range(200)}
    todo, tops = dict(points), {}
    while todo:
        top = max(todo, key=lambda p: (todo[p], -p[0], -p[1]))
        near = [p for p in todo if abs(p[0] - top[0]) <= 3 and abs(p[1] - top[1]) <= 3]
        tops[top] = points[top]
        for p in near:
            del todo[p]
    df = spark.createDataFrame([("chr1", a, b, n) for (a, b), n in points.items()], "chrom string, b1 long, b2 long, n long")
    found = features.strongest_first(df, 3)
    assert {(r.b1, r.b2): r.n for r in found.collect()} == tops
    assert found.agg(F.sum("members")).first()[0] == len(points)


def planted(size, domains=(), loops=()):
    m = np.zeros((size, size))
    for i in range(size):
        for j in range(i, size):
            m[i, j] = round(400 / (1 + j - i))
            m[i, j] *= 3 if any(a <= i and j <= b for a, b in domains) else 1
    for i, j in loops:
        m[i, j] += 300
    return m


def test_planted_loop_is_found(spark):
    m = dense_matrix(spark, planted(80, loops=[(20, 50)]), 25_000)
    sizes = spark.createDataFrame([("chr1", 80 * 25_000 - 1)], "chrom string, length long")
    values = matrix.intra(m).withColumn("value", F.col("n").cast("double"))
    exp = matrix.expected(values, sizes, (25_000,), "value")
    found = features.loops(values, exp, sizes, 25_000).collect()
    assert (20 * 25_000, 50 * 25_000) in {(r.x1, r.y1) for r in found}
    assert len(found) <= 3


def test_planted_domain_is_found(spark):
    m = dense_matrix(spark, planted(100, domains=[(30, 50)]), 10_000)
    values = matrix.intra(m).withColumn("value", F.col("n").cast("double"))
    found = domains.domains(values, 10_000, span=40, min_bins=8, min_score=0.5).orderBy(F.desc("score")).collect()
    assert abs(found[0].start - 300_000) <= 20_000 and abs(found[0].end - 510_000) <= 20_000


def test_motif_must_be_alone(spark):
    loops = spark.createDataFrame([("chr1", 0, 10000, "chr1", 50000, 60000)], "c1 string, x1 long, x2 long, c2 string, y1 long, y2 long")
    peaks = spark.createDataFrame([("chr1", 900, 1200), ("chr1", 51000, 53000)], "chrom string, start long, end long")
    motifs = spark.createDataFrame([("chr1", 1000, 1020, "+"), ("chr1", 5000, 5020, "+"), ("chr1", 51100, 51120, "-"), ("chr1", 52100, 52120, "-")],
                                   "chrom string, start long, end long, strand string")
    got = features.anchor_motifs(loops, peaks, motifs).collect()
    assert [(r.side, r.motif_start, r.convergent) for r in got] == [(1, 1000, True)]


def test_loops_ask_for_their_shape(spark):
    values = spark.createDataFrame([("chr1", 0, 1, 1, 1.0)], "chrom string, b1 long, b2 long, n long, value double")
    with pytest.raises(ValueError, match="give peak and window"):
        features.loops(values, values, values, 7000)


def test_stage_tables_can_be_dropped(spark):
    support.drop_stages(spark)
    kept = support.cut(spark.range(3))
    assert kept.count() == 3
    assert support.drop_stages(spark) == 1 and support.drop_stages(spark) == 0


def test_balancing_ends_when_it_has_converged(spark):
    """A map that is close to two sides in contact only with each other: plain rounds hardly move."""
    rng = np.random.default_rng(3)
    rng.uniform(size=49)
    b = np.round(10 ** rng.uniform(0.5, 2.5, (7, 7)))
    m = np.block([[np.eye(7), b], [b.T, np.eye(7)]])
    plain = 1 / np.sqrt(m.sum(axis=1))
    for _ in range(50):
        plain = plain / np.sqrt(plain * (m @ plain))
    assert np.abs(plain * (m @ plain) - 1).max() > 1e-4
    # a last row with too few contacts is left out
    rows = dense_matrix(spark, m).unionByName(spark.createDataFrame([(1000, "chr1", "chr1", 0, 14, 1)], PIXELS))
    found = sorted(matrix.balanced(rows).collect(), key=lambda r: r.bin)
    assert [r.bin for r in found] == list(range(14)) and all(r.residual < 1e-6 and 0 < r.steps < 8 for r in found)
    x = 1 / np.array([r.v for r in found])
    assert np.allclose(x * (m @ x), 1, atol=1e-6)
    assert max(r.residual for r in matrix.balanced(rows, steps=1, rounds=1).collect()) > 1e-6
