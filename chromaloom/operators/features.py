"""Feature annotation on contact matrices: aggregate peaks, loops, motifs.

Neighbourhood work is done on square tiles of the matrix. A tile and its margin hold a
fixed number of pixels, so no task input grows with the number of contacts; Spark shuffles
the pixels to their tiles and numpy works inside one.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import greedy
from .support import cut, lookup_join


def _spread_tiles(lo: Column, hi: Column, side: int) -> Column:
    return F.sequence(F.floor(lo / side).cast("bigint"), F.floor(hi / side).cast("bigint"))


def apa(matrix: DataFrame, loops: DataFrame, res: int, window: int = 100, min_dist: int = 300,
        value: str = "n") -> DataFrame:
    """Pixels around all loops added up: (dx, dy, total), offsets within the window.

    Loops closer to the diagonal than ``min_dist`` bins are left out. Pixels meet loops by
    tile, and the sums are combined before the shuffle, so it ends in (2w+1)^2 rows.
    """
    side = 2 * window + 1
    x = F.expr(f"((x1 + x2) div 2) div {res}")
    y = F.expr(f"((y1 + y2) div 2) div {res}")
    centres = (loops.where("c1 = c2").select(F.col("c1").alias("chrom"), F.least(x, y).alias("cx"), F.greatest(x, y).alias("cy"))
               .where(F.col("cy") - F.col("cx") >= min_dist))
    centres = centres.groupBy("chrom", "cx", "cy").agg(F.count("*").alias("times"))
    placed = (centres.withColumn("tx", F.explode(_spread_tiles(F.col("cx") - window, F.col("cx") + window, side)))
              .withColumn("ty", F.explode(_spread_tiles(F.col("cy") - window, F.col("cy") + window, side))))
    pixels = (matrix.where((F.col("res") == res) & (F.col("c1") == F.col("c2")))
              .select(F.col("c1").alias("chrom"), "b1", "b2", F.col(value).alias("value"),
                      F.expr(f"b1 div {side}").alias("tx"), F.expr(f"b2 div {side}").alias("ty")))
    joined = lookup_join(pixels, placed, ["chrom", "tx", "ty"], "inner", salt_from=["b1", "b2"])
    dx, dy = F.col("b1") - F.col("cx"), F.col("b2") - F.col("cy")
    return (joined.where((F.abs(dx) <= window) & (F.abs(dy) <= window))
            .groupBy(dx.alias("dx"), dy.alias("dy")).agg(F.sum(F.col("value") * F.col("times")).alias("total")))


def apa_scores(summed: DataFrame, window: int = 100, corner: int = 60) -> DataFrame:
    """Centre over the mean of the rest (P2M) and over the mean of each corner square."""
    cells = (2 * window + 1) ** 2
    edge = window - corner + 1
    centre = F.sum(F.when((F.col("dx") == 0) & (F.col("dy") == 0), F.col("total")).otherwise(0))

    def mean(cond: Column) -> Column:
        return F.sum(F.when(cond, F.col("total")).otherwise(0)) / (corner * corner)

    up, down = F.col("dx") <= -edge, F.col("dx") >= edge
    left, right = F.col("dy") <= -edge, F.col("dy") >= edge
    agg = summed.agg(centre.alias("centre"), ((F.sum("total") - centre) / (cells - 1)).alias("rest"),
                     mean(up & left).alias("ul"), mean(up & right).alias("ur"),
                     mean(down & left).alias("ll"), mean(down & right).alias("lr"))
    return agg.select("centre", *[F.try_divide(F.col("centre"), F.col(c)).alias(n) for n, c in (
        ("p2m", "rest"), ("p2ul", "ul"), ("p2ur", "ur"), ("p2ll", "ll"), ("p2lr", "lr"))])


# fixed values: (peak width, window) in bins per resolution
PEAK_SHAPE = {5_000: (4, 7), 10_000: (2, 5), 25_000: (1, 3)}
FDR = 0.1
FOLD_NEAR = 1.75
FOLD_LINE = 1.5
FOLD_ANY = 2.0
CLUSTER_RADIUS = 20_000
REGIONS = ("donut", "lower_left", "horizontal", "vertical")

TILE = 256


def _tiled(pixels: DataFrame, side: int, margin: int) -> DataFrame:
    """Send every pixel to its tile and to those whose margin it lies in."""
    return (pixels.withColumn("ti", F.explode(_spread_tiles(F.col("b1") - margin, F.col("b1") + margin, side)))
            .withColumn("tj", F.explode(_spread_tiles(F.col("b2") - margin, F.col("b2") + margin, side)))
            .where("ti >= 0 and tj >= ti"))


def _box(prefix: np.ndarray, i: np.ndarray, j: np.ndarray, i0: int, i1: int, j0: int, j1: int) -> np.ndarray:
    """Sum over rows i+i0..i+i1 and columns j+j0..j+j1, from a padded 2-d prefix sum."""
    a, b, c, d = i + i0, i + i1 + 1, j + j0, j + j1 + 1
    return prefix[b, d] - prefix[a, d] - prefix[b, c] + prefix[a, c]


def _region_sums(grid: np.ndarray, i: np.ndarray, j: np.ndarray, p: int, w: int) -> dict[str, np.ndarray]:
    prefix = np.zeros((grid.shape[0] + 1, grid.shape[1] + 1))
    prefix[1:, 1:] = grid.cumsum(axis=0).cumsum(axis=1)

    def box(*edges):
        return _box(prefix, i, j, *edges)

    arms = box(0, 0, -w, -p - 1) + box(0, 0, p + 1, w) + box(-w, -p - 1, 0, 0) + box(p + 1, w, 0, 0)
    return {
        "donut": box(-w, w, -w, w) - box(-p, p, -p, p) - arms,
        "lower_left": box(1, w, -w, -1) - box(1, p, -p, -1),
        "horizontal": box(-1, 1, -w, -p - 1) + box(-1, 1, p + 1, w),
        "vertical": box(-w, -p - 1, -1, 1) + box(p + 1, w, -1, 1),
    }


def local_expected(values: DataFrame, exp: DataFrame, sizes: DataFrame, res: int, p: int, w: int,
                   tile: int = TILE) -> DataFrame:
    """Expected raw count of every pixel from four surroundings.

    ``values`` has (chrom, b1, b2, n, value) with normalised ``value``; ``exp`` the expected
    normalised value per diagonal. The mean enrichment of a surrounding times the pixel's
    own expectation, turned back into raw counts.
    """
    lengths = sizes.select("chrom", (F.expr(f"length div {res}") + 1).alias("nb"))
    known = values.where(F.col("value").isNotNull()).select("chrom", "b1", "b2", "n", "value")
    pixels = lookup_join(known, lengths, ["chrom"], "inner", salt_from=["b1", "b2"]).where("b2 < nb")
    spread = _tiled(pixels, tile, w)
    tiles = spread.select("chrom", "ti", "tj").distinct()
    span = tile + 2 * w
    # the diagonals a tile can see, as rows of their own
    seen = tiles.withColumn("d", F.explode(F.sequence(
        F.greatest((F.col("tj") - F.col("ti")) * tile - span, F.lit(0)), (F.col("tj") - F.col("ti")) * tile + span)))
    diagonals = lookup_join(seen, exp.select("d", "expected"), ["d"], "inner", salt_from=["ti", "tj"])
    rows = (spread.select("chrom", "ti", "tj", "b1", "b2", "n", "value")
            .unionByName(diagonals.select("chrom", "ti", "tj", F.lit(-1).cast("bigint").alias("b1"), F.col("d").alias("b2"),
                                          F.lit(0).cast("bigint").alias("n"), F.col("expected").alias("value"))))
    rows = lookup_join(rows, lengths, ["chrom"], "inner", salt_from=["b1", "b2"])

    def surroundings(key: tuple, cells: pd.DataFrame) -> pd.DataFrame:
        chrom, ti, tj = key
        is_exp = cells["b1"].to_numpy() < 0
        e, px = cells[is_exp], cells[~is_exp]
        nb = int(cells["nb"].iloc[0])
        top, left = ti * tile - w, tj * tile - w
        by_distance = np.zeros(2 * span + tile + abs(left - top) + 1)
        by_distance[e["b2"].to_numpy()] = e["value"].to_numpy()
        ii, jj = np.arange(top, top + span)[:, None], np.arange(left, left + span)[None, :]
        valid = (ii >= 0) & (jj < nb) & (jj >= ii)
        expect = np.where(valid, by_distance[np.where(valid, jj - ii, 0)], 0.0)
        grid = np.zeros((span, span))
        b1, b2 = px["b1"].to_numpy(), px["b2"].to_numpy()
        grid[b1 - top, b2 - left] = px["value"].to_numpy()
        home = (b1 // tile == ti) & (b2 // tile == tj)
        i, j, n, v = (a[home] for a in (b1 - top, b2 - left, px["n"].to_numpy(), px["value"].to_numpy()))
        seen_sum, exp_sum = _region_sums(grid, i, j, p, w), _region_sums(expect, i, j, p, w)
        out = {"chrom": chrom, "b1": b1[home], "b2": b2[home], "n": n}
        with np.errstate(invalid="ignore", divide="ignore"):
            for name in REGIONS:
                out[name] = seen_sum[name] / exp_sum[name] * expect[i, j] * (n / v)
        return pd.DataFrame(out)

    fields = ", ".join(f"{r} double" for r in REGIONS)
    found = rows.groupBy("chrom", "ti", "tj").applyInPandas(
        surroundings, f"chrom string, b1 bigint, b2 bigint, n bigint, {fields}")
    return found.withColumns({r: F.when(~F.isnan(r) & (F.col(r) < float("inf")), F.col(r)) for r in REGIONS})


def _chunk(expected: Column) -> Column:
    """Chunks of expected counts whose bounds grow by the cube root of two."""
    return F.greatest(F.ceil(F.log2(F.greatest(expected, F.lit(1e-9))) * 3), F.lit(0)).cast("int")


def _poisson_tail(rate: float, counts: np.ndarray) -> np.ndarray:
    """P(X >= k) for the counts k, the terms of each run between two of them added up in numpy."""
    order = np.argsort(counts)
    below, at, out = 0.0, 0, np.empty(len(counts))
    for place in order.tolist():
        k, log_factorial = np.arange(at, counts[place]), None
        if len(k):
            log_factorial = math.lgamma(at + 1) + np.concatenate([[0.0], np.cumsum(np.log(k[1:]))])
            below += float(np.exp(-rate + k * math.log(rate) - log_factorial).sum())
        at = int(counts[place])
        out[place] = min(max(1.0 - below, 0.0), 1.0)
    return out


def enriched(expectations: DataFrame, fdr: float = FDR) -> DataFrame:
    """Pixels above the count that keeps the false discovery rate, in all four surroundings.

    Counts are tallied per surrounding and chunk first; the test then sees one row per
    distinct count.
    """
    kept = expectations.dropna(subset=list(REGIONS))
    long = kept.select("n", F.explode(F.array(*[
        F.struct(F.lit(r).alias("region"), _chunk(F.col(r)).alias("chunk")) for r in REGIONS])).alias("x"))
    tally = long.groupBy("x.region", "x.chunk", "n").agg(F.count("*").alias("pixels"))

    def threshold(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        region, chunk = key
        rows = rows.sort_values("n", ascending=False)
        counts, above = rows["n"].to_numpy(), rows["pixels"].cumsum().to_numpy()
        rate = rows["pixels"].sum() * _poisson_tail(2.0 ** (chunk / 3.0), counts) / above
        good = counts[rate <= fdr]
        return pd.DataFrame({"region": [region], "chunk": [chunk], "least": [int(good.min()) if len(good) else -1]})

    limits = cut(tally.groupBy("region", "chunk").applyInPandas(threshold, "region string, chunk int, least bigint"))
    out = kept
    for r in REGIONS:
        mine = limits.where((F.col("region") == r) & (F.col("least") >= 0)).select(
            F.col("chunk").alias("_chunk"), F.col("least").alias("_least"))
        # one row per chunk: a few dozen
        out = lookup_join(out.withColumn("_chunk", _chunk(F.col(r))), mine, ["_chunk"], "inner",
                          salt_from=["b1", "b2"]).where("n >= _least").drop("_chunk", "_least")
    near = F.greatest("donut", "lower_left")
    return out.where((F.col("n") >= FOLD_NEAR * F.col("donut")) & (F.col("n") >= FOLD_NEAR * F.col("lower_left"))
                     & (F.col("n") >= FOLD_LINE * F.col("horizontal")) & (F.col("n") >= FOLD_LINE * F.col("vertical"))
                     & (F.col("n") >= FOLD_ANY * F.least("donut", "lower_left")) & near.isNotNull())


# Bins of a tile of the first round of clustering.
CLUSTER_TILE = 1024


def strongest_first(peaks: DataFrame, radius: int) -> DataFrame:
    """Greedy clustering: take the strongest pixel, absorb those within ``radius`` bins, go on.

    Equal ones are taken in the order of their bins. Returns the tops with ``members``, the pixels
    whose strongest near top they are, themselves included. A ramp of pixels settles in a few
    rounds of tiles; pixels meet their tops by cells of side ``radius``, which hold a fixed number.
    """
    pixels = cut(peaks.select("chrom", "b1", "b2", "n"))
    points = pixels.select("chrom", F.array("b1", "b2").alias("pos"), F.col("n").alias("rep"))
    tops = cut(greedy.select(points, ["chrom"], radius, max(CLUSTER_TILE, 4 * radius), [F.col("rep").desc(), F.col("pos")]).select(
        "chrom", F.get("pos", F.lit(0)).alias("b1"), F.get("pos", F.lit(1)).alias("b2"), F.col("rep").alias("n")))
    side = radius + 1
    cells = pixels.select("chrom", "b1", "b2", F.expr(f"b1 div {side}").alias("ci"), F.expr(f"b2 div {side}").alias("cj"))
    near = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    sent = tops.withColumn("di", F.explode(near)).withColumn("dj", F.explode(near)).select(
        "chrom", (F.expr(f"b1 div {side}") + F.col("di")).alias("ci"), (F.expr(f"b2 div {side}") + F.col("dj")).alias("cj"),
        F.col("b1").alias("o1"), F.col("b2").alias("o2"), F.col("n").alias("on"))
    close = (F.abs(F.col("b1") - F.col("o1")) <= radius) & (F.abs(F.col("b2") - F.col("o2")) <= radius)
    owner = cells.join(sent, ["chrom", "ci", "cj"]).where(close).groupBy("chrom", "b1", "b2").agg(F.max(F.struct("on", -F.col("o1"), -F.col("o2"))).alias("t"))
    sizes = owner.groupBy("chrom", (-F.col("t.col2")).alias("b1"), (-F.col("t.col3")).alias("b2")).agg(F.count("*").alias("members"))
    return tops.join(sizes, ["chrom", "b1", "b2"]).select("chrom", "b1", "b2", "n", "members")


def loops(values: DataFrame, exp: DataFrame, sizes: DataFrame, res: int, peak: int | None = None,
          window: int | None = None, fdr: float = FDR, radius: int = CLUSTER_RADIUS) -> DataFrame:
    """Loop pixels: enriched over all surroundings, clustered, one row per cluster (BEDPE)."""
    if res not in PEAK_SHAPE and (peak is None or window is None):
        raise ValueError(f"give peak and window: there are no usual ones at {res} bp")
    p, w = (x if y is None else y for x, y in zip(PEAK_SHAPE.get(res, (peak, window)), (peak, window)))
    stored = cut(local_expected(values, exp, sizes, res, p, w))
    tops = strongest_first(enriched(stored, fdr), max(radius // res, 1))
    return tops.select(
        F.col("chrom").alias("c1"), (F.col("b1") * res).alias("x1"), ((F.col("b1") + 1) * res).alias("x2"),
        F.col("chrom").alias("c2"), (F.col("b2") * res).alias("y1"), ((F.col("b2") + 1) * res).alias("y2"),
        "n", "members")


# A loop found at the finest resolution alone stays if it is as near the diagonal, in bp, or has more contacts.
NEAR_DIAGONAL = 110_000
STRONG = 100


def _beside(loops_: DataFrame, others: DataFrame, radius: int, how: str) -> DataFrame:
    """Semi or anti join to loops whose middles both lie within ``radius``; loops meet by cells of that side."""
    def middles(df: DataFrame) -> DataFrame:
        return df.withColumns({"mx": F.expr("(x1 + x2) div 2"), "my": F.expr("(y1 + y2) div 2")}).withColumns(
            {"ci": F.expr(f"mx div {radius + 1}"), "cj": F.expr(f"my div {radius + 1}")})

    near = F.array(*[F.lit(i) for i in (-1, 0, 1)])
    sent = middles(others).withColumn("di", F.explode(near)).withColumn("dj", F.explode(near)).select(
        F.col("c1").alias("o1"), F.col("c2").alias("o2"), F.col("mx").alias("ox"), F.col("my").alias("oy"), (F.col("ci") + F.col("di")).alias("oi"), (F.col("cj") + F.col("dj")).alias("oj"))
    on = ((F.col("c1") == F.col("o1")) & (F.col("c2") == F.col("o2")) & (F.col("ci") == F.col("oi")) & (F.col("cj") == F.col("oj"))
          & (F.abs(F.col("mx") - F.col("ox")) <= radius) & (F.abs(F.col("my") - F.col("oy")) <= radius))
    return middles(loops_).join(sent, on, how).select(*loops_.columns)


def merged_loops(lists: dict[int, DataFrame], near: int = NEAR_DIAGONAL, strong: int = STRONG) -> DataFrame:
    """One loop list out of those of several resolutions, with the resolution ``res`` of each loop.

    A coarser loop within two of its bins of a finer one is the same loop, and the finer one stands for
    it. Loops of the finest list that the next one does not confirm need to be ``near`` the diagonal or
    ``strong``; coarser loops of their own are all kept.
    """
    order = sorted(lists)
    found = [cut(lists[res].withColumn("res", F.lit(res).cast("bigint"))) for res in order]
    merged = found[0]
    for k, own in enumerate(found[1:], 1):
        radius = 2 * order[k]
        added = _beside(own, merged, radius, "left_anti")
        if k == 1:
            single = _beside(merged, own, radius, "left_anti").where((F.col("y1") - F.col("x1") < near) | (F.col("n") > strong))
            merged = _beside(merged, own, radius, "left_semi").unionByName(single)
        merged = cut(merged.unionByName(added))
    return merged


ANCHOR_BIN = 16_384


def _binned_intervals(df: DataFrame, start: str, end: str) -> DataFrame:
    return df.withColumn("_bin", F.explode(F.sequence(F.expr(f"{start} div {ANCHOR_BIN}"), F.expr(f"({end} - 1) div {ANCHOR_BIN}"))))


def anchors(loops_: DataFrame) -> DataFrame:
    """Distinct loop anchors with their side: 1 upstream, 2 downstream."""
    sides = F.array(F.struct(F.lit(1).alias("side"), F.col("c1").alias("chrom"), F.col("x1").alias("start"), F.col("x2").alias("end")),
                    F.struct(F.lit(2).alias("side"), F.col("c2").alias("chrom"), F.col("y1").alias("start"), F.col("y2").alias("end")))
    return loops_.select(F.explode(sides).alias("a")).select("a.*").distinct()


def anchor_overlap(anchors_: DataFrame, intervals: DataFrame) -> DataFrame:
    """Anchors with the intervals that overlap them, each pair once."""
    a = _binned_intervals(anchors_, "start", "end")
    b = _binned_intervals(intervals.withColumnsRenamed({"start": "i_start", "end": "i_end"}), "i_start", "i_end")
    hits = lookup_join(b, a, ["chrom", "_bin"], "inner", salt_from=["i_start", "i_end"])
    hits = hits.where((F.col("i_start") < F.col("end")) & (F.col("i_end") > F.col("start")))
    # an overlapping pair meets in several bins; the first of them reports it
    first = F.greatest(F.expr(f"start div {ANCHOR_BIN}"), F.expr(f"i_start div {ANCHOR_BIN}"))
    return hits.where(F.col("_bin") == first).drop("_bin")


def anchor_motifs(loops_: DataFrame, peaks: DataFrame, motifs: DataFrame) -> DataFrame:
    """The motif of each anchor that has exactly one under a peak.

    ``peaks`` is (chrom, start, end), ``motifs`` (chrom, start, end, strand). Upstream anchors
    are expected to carry a forward motif and downstream ones a reverse motif.
    """
    sites = motifs.select("chrom", "start", "end", "strand").distinct()
    bound = anchor_overlap(sites, peaks.select("chrom", "start", "end").distinct()).select(
        "chrom", "start", "end", "strand").distinct()
    hits = anchor_overlap(anchors(loops_), bound)
    one = hits.groupBy("chrom", "start", "end", "side").agg(
        F.count("*").alias("motifs"), F.min("i_start").alias("motif_start"),
        F.min("i_end").alias("motif_end"), F.min("strand").alias("strand")).where("motifs = 1")
    wanted = F.when(F.col("side") == 1, "+").otherwise("-")
    return one.drop("motifs").withColumn("convergent", F.col("strand") == wanted)
