import random

import pytest
from pyspark.sql import functions as F

from chromaloom.operators import collisions, duplicates, greedy

KEY = ["c1", "c2", "f1", "f2", "s1", "s2"]


def frame(spark, rows):
    """Rows of (name, p1, p2[, c2]) in one block."""
    full = [(r[0], "chr1", r[3] if len(r) > 3 else "chr1", 0, 1, 0, 16, r[1], r[2]) for r in rows]
    return spark.createDataFrame(full, "qname string, c1 string, c2 string, f1 long, f2 long, s1 int, s2 int, p1 long, p2 long")


def brute(rows, w):
    kept = []
    for name, a, b in sorted(rows, key=lambda r: (r[1], r[2], r[0])):
        if not any(abs(a - x) <= w and abs(b - y) <= w for _, x, y in kept):
            kept.append((name, a, b))
    return {k[0] for k in kept}


def names(df):
    return {r.qname for r in df.select("qname").collect()}


@pytest.mark.parametrize("extent,count,wobble", [(60, 400, 4), (330, 500, 4), (200, 500, 1)])
def test_matches_brute_force(spark, extent, count, wobble):
    rng = random.Random(extent + wobble)
    rows = [(f"r{i:04d}", rng.randint(0, extent), rng.randint(0, extent)) for i in range(count)]
    assert names(duplicates.unique_pairs(frame(spark, rows), wobble)) == brute(rows, wobble)


def test_result_does_not_depend_on_tile_size(spark):
    rng = random.Random(3)
    rows = [(f"r{i:04d}", rng.randint(0, 150), rng.randint(0, 150)) for i in range(500)]
    points = duplicates._folded(frame(spark, rows), KEY, ())
    for side, dims in ((40, 2), (70, None)):
        kept = duplicates.greedy_unique(points, KEY, 4, side, dims)
        assert {r.q for r in kept.select(F.col("rep.qname").alias("q")).collect()} == brute(rows, 4)


def test_chain_across_many_tiles(spark):
    # every point is near the one before: 0 stays, 3 goes, 6 stays ...
    rows = [(f"r{i:04d}", 3 * i, 7) for i in range(200)]
    assert names(duplicates.unique_pairs(frame(spark, rows))) == {f"r{i:04d}" for i in range(0, 200, 2)}


def test_duplicates_do_not_mark_others(spark):
    verdict = {r.qname: r.dup_class for r in duplicates.dedup(frame(spark, [("a", 10, 10), ("b", 14, 10), ("c", 18, 10)])).collect()}
    assert verdict == {"a": "unique", "b": "pcr", "c": "unique"}


def test_hot_position_keeps_every_row(spark):
    hot = [(f"h{i:05d}", 500, 900) for i in range(3000)]
    df = frame(spark, hot + [("x", 503, 903), ("y", 506, 900), ("z", 500, 900, "chr2")])
    counts = {r.dup_class: r["count"] for r in duplicates.dedup(df).groupBy("dup_class").count().collect()}
    assert counts == {"unique": 3, "pcr": 3000}


def test_exact_mode(spark):
    rows = [("a", 1, 1), ("b", 1, 1), ("c", 1, 2)]
    assert names(duplicates.unique_pairs(frame(spark, rows), exact=True)) == {"a", "c"}


def test_optical_classes(spark):
    rows = [("M:1:FC:1:7:100:100", 10, 10), ("M:1:FC:1:7:120:140/1", 11, 10), ("M:1:FC:1:8:100:100", 12, 10),
            ("M:1:FC:1:7:150:100", 13, 10), ("plain", 14, 11)]
    verdict = {r.qname: r.dup_class for r in duplicates.dedup(frame(spark, rows), optical=True).collect()}
    assert list(verdict[r[0]] for r in rows) == ["unique", "optical", "pcr", "pcr", "pcr"]


def test_pcr_wins_when_marked_by_both(spark):
    rows = [("M:1:FC:1:7:100:100", 10, 10), ("M:1:FC:1:9:100:100", 15, 14), ("M:1:FC:1:7:110:110", 14, 13)]
    # the third is next to both; the second is kept because it is 5 away from the first
    verdict = {r.qname: r.dup_class for r in duplicates.dedup(frame(spark, rows), optical=True).collect()}
    assert verdict["M:1:FC:1:7:110:110"] == "optical"
    assert verdict["M:1:FC:1:9:100:100"] == "unique"


def test_group_duplicates_need_all_positions(spark):
    def group(name, *positions, strand=0):
        return (name, len(positions), 0, [("chr1", p, strand, i, 60, "50M") for i, p in enumerate(positions)])

    rows = [group("a", 100, 5000, 90000), group("b", 103, 5004, 89997), group("c", 100, 5005, 90000),
            group("d", 100, 5000, 90000, strand=16), group("e", 100, 5000)]
    df = spark.createDataFrame(rows, "qname string, k long, part long, recs array<struct<chrom:string,pos:long,strand:int,rec_no:int,mapq:int,cigar:string>>")
    dup = {r.qname for r in collisions.dedup_groups(df).where("is_dup").collect()}
    assert dup == {"b"}


def test_points_of_many_ways_go_to_four_tiles_at_most(spark):
    side = duplicates._tile_side(4)
    df = spark.createDataFrame([("k", [side * i for i in range(1, 41)], "x")], "key string, pos array<long>, rep string")
    assert greedy.spread(df, ["key", "pos", "rep"], 4, side).count() == 4
    rows = [(f"r{i}", [100 * k + d * (k + 1 == i) for k in range(12)]) for i, d in enumerate([0, 3, 4, 5, 9])]
    points = spark.createDataFrame([("k", p, r) for r, p in rows], "key string, pos array<long>, rep string")
    kept = {r.rep for r in duplicates.greedy_unique(points.dropDuplicates(["pos"]), ["key"], 4, side=9).collect()}
    assert kept == {"r0", "r3", "r4"}


@pytest.mark.parametrize("growth", [16, 2])
def test_long_chains_in_widening_tiles(spark, growth, monkeypatch):
    for module in (duplicates, greedy):
        monkeypatch.setattr(module, "GROWTH", growth)
    rng = random.Random(3)
    places = [(2 * i, 100) for i in range(120)] + [(rng.randint(0, 60), rng.randint(500, 540)) for _ in range(150)] + [(3 * i, 900 + 3 * i) for i in range(40)]
    places = sorted(set(places))
    df = spark.createDataFrame([("k", list(p), f"r{i}") for i, p in enumerate(places)], "key string, pos array<long>, rep string")
    want = []
    for a, b in places:
        if not any(abs(a - x) <= 4 and abs(b - y) <= 4 for x, y in want):
            want.append((a, b))
    got = duplicates.greedy_unique(df, ["key"], 4, side=40, dims=2, rounds=1).collect()
    assert sorted(tuple(r.pos) for r in got) == want


def test_a_million_chained_points_take_ten_rounds_at_most(spark, monkeypatch):
    rounds = []
    for module in (duplicates, greedy):
        monkeypatch.setattr(module, "cut_measuring", lambda df, m, real=module.cut_measuring: rounds.append(1) or real(df, m))
    df = spark.range(1_000_000).select(F.lit("k").alias("key"), F.array(2 * F.col("id"), F.lit(100).cast("long")).alias("pos"), F.col("id").cast("string").alias("rep"))
    kept = duplicates.greedy_unique(df, ["key"], 4, dims=2)
    assert tuple(kept.agg(F.count("*"), F.count_if(F.col("pos")[0] % 6 > 0)).first()) == (333_334, 0)
    assert len(rounds) <= 10


def test_selection_by_strength(spark):
    """Any order, in tiles that are smaller than the chains of pixels that wait for each other."""
    rng = random.Random(8)
    pixels = {(rng.randint(0, 80), rng.randint(0, 80)): rng.randint(1, 30) for _ in range(500)} | {(200 + k, 300 + k): k for k in range(90)}
    df = spark.createDataFrame([("k", list(p), n) for p, n in pixels.items()], "key string, pos array<long>, rep long")
    want = []
    for p in sorted(pixels, key=lambda p: (-pixels[p], p)):
        if not any(abs(p[0] - x) <= 2 and abs(p[1] - y) <= 2 for x, y in want):
            want.append(p)
    got = greedy.select(df, ["key"], 2, 8, [F.col("rep").desc(), F.col("pos")]).collect()
    assert sorted(tuple(r.pos) for r in got) == sorted(want)


def test_groups_of_several_rows_have_the_same_verdicts(spark, monkeypatch):
    """Names with more records than a row holds: all their records in order, and verdicts as for short ones."""
    rng = random.Random(5)
    rows = []
    for base in range(6):
        spots = sorted(rng.sample(range(1000, 90_000, 50), 7))
        for copy in range(5):
            shift = [copy * 2 + (copy == 3) * rng.randint(0, 1) if copy < 4 else 9 for _ in spots]
            rows += [(f"g{base}{copy}", i + 1, 16 * (base % 2), "chr1", p + d, 60, "50M") for i, (p, d) in enumerate(zip(spots, shift))]
    rows += [("few", i, 0, "chr2", 100 * i, 60, "50M") for i in (1, 2)] + [("low", i, 0, "chr2", 100 * i, 1 + i, "50M") for i in range(1, 9)]
    df = spark.createDataFrame(rows, "qname string, rec_no int, flag int, rname string, pos long, mapq int, cigar string")
    whole = collisions.abnormal_groups(df)
    want = {r.qname: r.is_dup for r in collisions.dedup_groups(whole).collect()}
    recs = {r.qname: r.recs for r in whole.collect()}
    assert any(want.values()) and not all(want.values())
    for most in (3, 6):
        monkeypatch.setattr(collisions, "MAX_WAYS", most)
        groups = collisions.abnormal_groups(df)
        got = {}
        for r in sorted(groups.collect(), key=lambda r: r.part):
            got.setdefault(r.qname, []).extend(r.recs)
            assert len(r.recs) <= most and r.k == len(recs[r.qname])
        assert got == recs
        assert {r.qname: r.is_dup for r in collisions.dedup_groups(groups).collect()} == want


def test_verdicts_are_the_same_however_the_kept_rows_are_joined(spark, monkeypatch):
    rng = random.Random(5)
    rows = [(f"A:1:F:1:1:{rng.randrange(90)}:{rng.randrange(90)}" if i % 3 else f"q{i}", "chr1" if i % 17 else None, rng.randrange(25), rng.randrange(25)) for i in range(300)]
    df = spark.createDataFrame([*rows, *rows[:20], (None, "chr1", 3, 3)], "qname string, c string, p1 long, p2 long")
    for kwargs in ({"exact": True}, {}, {"optical": True}):
        found = []
        for limit in (10**6, 0):  # sent to the pairs, then shuffled, markers of cells with many duplicates apart
            monkeypatch.setattr(duplicates, "KEPT_ROWS", limit)
            monkeypatch.setattr(duplicates, "MARKER_ROWS", limit)
            monkeypatch.setattr(duplicates, "HOT_CELL", 5)
            got = duplicates.dedup(df, key=["c"], **kwargs)
            if kwargs.get("exact"):
                assert ("SortMergeJoin" not in got._jdf.queryExecution().optimizedPlan().toString()) and ("broadcast" in got._jdf.queryExecution().optimizedPlan().toString()) == (limit > 0)
            found.append(sorted(map(str, got.collect())))
        assert found[0] == found[1] and len(found[0]) == 321
