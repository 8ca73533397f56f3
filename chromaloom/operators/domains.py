"""Contact domains of every size from summed tables over tiles of the matrix.

A(r, d) compares the contacts of bin r at distance d upstream and downstream. A domain [a, b] has an
upper triangle, where the downstream partner r + d lies inside and the upstream one outside, and
a lower triangle the other way round. Sums over a triangle are sums, along the domain's other end,
of pieces of columns; a piece is the difference of two prefix sums of a column. So the score of
every domain follows from tiles of these sums: a tile of domains (their starts in one block of
bins, their ends in another) reads the cells of its columns near both ends of the pieces, the
columns' sums before those, and what the tiles before it have added up. Whatever the length of the
chromosome, a task holds a few arrays of ``TILE`` by ``TILE`` cells.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .features import strongest_first
from .support import cut

TILE = 512
# Scores are rounded so that their order does not depend on the order of additions.
DIGITS = 9

# what a row brings to a tile: cells or column sums of the upper (0, 1) and lower (2, 3) triangle near
# the own end (0, 2) and the middle (1, 3); sums of the tiles before (4, 5); the tile itself (6)
SENT = "chrom string, ti bigint, tj bigint, part int, t bigint, q bigint, w double"


def preferences(values: DataFrame) -> DataFrame:
    """chrom, r, d, w: sign plus size of the preference of bin r for its upstream contact at distance d.

    ``values(chrom, b1, b2, value)``; bins off the map have no contacts.
    """
    ends = F.array(F.struct(F.col("b2").alias("r"), F.col("value").alias("up"), F.lit(0.0).alias("down")),
                   F.struct(F.col("b1").alias("r"), F.lit(0.0).alias("up"), F.col("value").alias("down")))
    cells = values.where("value is not null and b1 <> b2").select("chrom", (F.col("b2") - F.col("b1")).alias("d"), F.explode(ends).alias("x"))
    both = cells.select("chrom", "d", "x.*").groupBy("chrom", "r", "d").agg(F.sum("up").alias("up"), F.sum("down").alias("down"))
    return both.where("up + down > 0 and up <> down").select("chrom", "r", "d", ((F.col("up") - F.col("down")) / (F.col("up") + F.col("down")) + F.signum(F.col("up") - F.col("down"))).alias("w"))


def _sent(values: DataFrame, tile: int, reach: int | None) -> DataFrame:
    half = tile // 2
    bins = values.where("value is not null").groupBy("chrom").agg((F.max("b2") + 1).alias("nb"))
    bins = cut(bins)
    cells = preferences(values).join(F.broadcast(bins), "chrom")  # a row per chromosome
    upper = cells.select("chrom", "nb", F.lit(0).alias("side"), "r", (F.col("r") + F.col("d")).alias("col"), "w").where("col < nb")
    lower = cells.select("chrom", "nb", F.lit(1).alias("side"), "r", (F.col("r") - F.col("d")).alias("col"), "w").where("col >= 0")
    placed = cut(upper.unionByName(lower).withColumns({"own": F.expr(f"col div {tile}"), "h": F.expr(f"r div {half}")}))

    # tiles whose pieces of columns end near a cell: at the domain's own end, or at its middle
    def near(side: int) -> Column:
        others = [("h div 2", 0), ("h - own", 1), ("h - 1 - own", 1)]
        return F.array(*(F.struct(F.expr(o).cast("bigint").alias("other"), F.lit(2 * side + p).alias("part")) for o, p in others))

    sent = placed.withColumn("x", F.explode(F.when(F.col("side") == 0, near(0)).otherwise(near(1)))).select("*", "x.*")
    ti = F.when(F.col("side") == 0, F.col("other")).otherwise(F.col("own"))
    tj = F.when(F.col("side") == 0, F.col("own")).otherwise(F.col("other"))
    start = F.when(F.col("part") == 0, F.col("ti") * tile).when(F.col("part") == 2, F.col("tj") * tile).otherwise((F.col("ti") + F.col("tj")) * half)
    near_cells = sent.withColumns({"ti": ti, "tj": tj}).where(f"ti >= 0 and tj >= ti and tj <= (nb - 1) div {tile}").select(
        "chrom", "ti", "tj", "part", (F.col("r") - start + 1).alias("t"), (F.col("col") % tile).alias("q"), "w")

    # the sum of a column before each half block, from a few dozen sums a column
    sums = placed.groupBy("chrom", "nb", "side", "col", "own", "h").agg(F.sum("w").alias("w"))
    before = sums.withColumns({"upto": F.sum("w").over(Window.partitionBy("chrom", "side", "col").orderBy("h")),
                               "next": F.lead("h").over(Window.partitionBy("chrom", "side", "col").orderBy("h"))})
    # k: half blocks before the piece; for the upper triangle its tile is own + other = k, or 2 * other = k
    ks = before.withColumn("k", F.explode(F.sequence(F.col("h") + 1, F.coalesce("next", F.expr(f"2 * ((nb - 1) div {tile}) + 1")))))
    own_end = ks.where("k % 2 = 0").withColumns({"other": F.expr("k div 2"), "p": F.lit(0)})
    middle = ks.withColumns({"other": F.col("k") - F.col("own"), "p": F.lit(1)})
    carried = own_end.unionByName(middle).withColumns({"ti": ti, "tj": tj}).where(f"ti >= 0 and tj >= ti and tj <= (nb - 1) div {tile}").select(
        "chrom", "ti", "tj", (2 * F.col("side") + F.col("p")).alias("part"), F.lit(0).cast("bigint").alias("t"), (F.col("col") % tile).alias("q"), F.col("upto").alias("w"))

    blocks = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(nb - 1) div {tile}"))
    own = bins.withColumn("ti", F.explode(blocks)).withColumn("tj", F.explode(blocks)).where("tj >= ti").select(
        "chrom", "ti", "tj", F.lit(6).alias("part"), F.lit(0).cast("bigint").alias("t"), F.col("nb").alias("q"), F.lit(0.0).alias("w"))
    rows = near_cells.unionByName(carried).unionByName(own)
    return cut(rows if reach is None else rows.where((F.col("tj") - F.col("ti") - 1) * tile < reach))


def _pieces(rows: pd.DataFrame, ti: int, tj: int, tile: int) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the pieces of columns of a tile: upper ones by start and column, lower ones by column and end."""
    part, t, q, w = (rows[c].to_numpy() for c in ("part", "t", "q", "w"))
    sums = []
    for k in range(4):
        grid = np.zeros((tile + 1, tile))
        mine = part == k
        inside = mine & (t <= tile)
        grid[t[inside], q[inside]] = w[inside]
        sums.append(grid.cumsum(axis=0))
    a, b = np.arange(tile)[:, None], np.arange(tile)[None, :]
    apart = (tj - ti) * tile + b - a > 0
    upper = np.where(apart, sums[1][(a + b + 1) // 2, b] - sums[0][a, b], 0.0)
    lower = np.where(apart, sums[2][b + 1, a] - sums[3][(a + b) // 2 + 1, a], 0.0)
    return upper, lower


def _totals(tile: int):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        chrom, ti, tj = key
        upper, lower = _pieces(rows, ti, tj, tile)
        return pd.DataFrame({"chrom": chrom, "ti": ti, "tj": tj, "part": np.repeat([4, 5], tile), "t": 0, "q": np.tile(np.arange(tile), 2),
                             "w": np.concatenate([upper.sum(axis=1), lower.sum(axis=0)])}).astype({"part": "int32"})
    return run


def _scores(tile: int, least: int, most: int | None, min_score: float):
    def run(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        chrom, ti, tj = key
        upper, lower = _pieces(rows, ti, tj, tile)
        carry = np.zeros((2, tile))
        for k in (4, 5):
            some = rows[rows["part"] == k]
            carry[k - 4, some["q"].to_numpy()] = some["w"].to_numpy()
        nb = int(rows.loc[rows["part"] == 6, "q"].iloc[0])
        up = carry[0][:, None] + upper.cumsum(axis=1)
        down = carry[1][None, :] + lower[::-1].cumsum(axis=0)[::-1]
        a, b = ti * tile + np.arange(tile)[:, None], tj * tile + np.arange(tile)[None, :]
        size = b - a
        half = size // 2
        cells = np.maximum((half + 1) * (size - half), 1)
        score = np.round((down - up) / (4 * cells), DIGITS)
        good = (size >= least) & (b < nb) & (score >= min_score)
        if most is not None:
            good &= size <= most
        i, j = np.nonzero(good)
        return pd.DataFrame({"chrom": chrom, "b1": ti * tile + i, "b2": tj * tile + j, "score": score[i, j]})
    return run


def scored(values: DataFrame, span: int | None = None, min_bins: int = 4, min_score: float = 0.6, tile: int = TILE) -> DataFrame:
    """chrom, b1, b2 and score of all domains of ``min_bins`` bins after the first or more that score ``min_score``."""
    if tile % 2 or tile < 2:
        raise ValueError("tiles have an even number of bins")
    place = ["chrom", "ti", "tj"]
    sent = _sent(values, tile, span)
    totals = cut(sent.groupBy(*place).applyInPandas(_totals(tile), SENT))
    # what the tiles between have added: to the left for starts, and from the next start on for ends
    left = Window.partitionBy("chrom", "ti", "q").orderBy("tj").rowsBetween(Window.unboundedPreceding, -1)
    right = Window.partitionBy("chrom", "tj", "q").orderBy(F.col("ti").desc()).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.where("part = 4").withColumn("w", F.sum("w").over(left)).unionByName(totals.where("part = 5").withColumn("w", F.sum("w").over(right)))
    every = sent.unionByName(carry.where("w is not null and w <> 0"))
    return every.groupBy(*place).applyInPandas(_scores(tile, min_bins, span, min_score), "chrom string, b1 bigint, b2 bigint, score double")


def domains(values: DataFrame, res: int, span: int | None = None, min_bins: int = 4, min_score: float = 0.6, tile: int = TILE) -> DataFrame:
    """Contact domains as (chrom, start, end, score).

    The score of [a, b] is the mean preference of its two triangles plus its mean sign, downstream
    less upstream, over four. Of near ones, whose ends both differ by ``min_bins`` at most, the best
    is kept. Domains of every size within the chromosome's bins are looked for; ``span`` asks for
    those of at most so many bins after the first.
    """
    found = scored(values, span, min_bins, min_score, tile)
    ranked = strongest_first(found.withColumnRenamed("score", "n"), min_bins)
    return ranked.select("chrom", (F.col("b1") * res).alias("start"), ((F.col("b2") + 1) * res).alias("end"), F.col("n").alias("score"))
