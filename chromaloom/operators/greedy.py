"""Greedy selection of points: in a given order, a point is kept unless a kept one lies within a radius.

Points go to square tiles and to those whose border they lie near. A tile is walked in order; a
point that an undecided one of another tile might remove stays open. Open points go through a
further round with tiles that are wider by a factor, so that even a chain through a whole
chromosome ends after a number of rounds that grows with the logarithm of its length. A walk streams
the rows of its tile and holds points that are still within reach.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .support import cut_measuring

# Sides of the tiles of a round over those of the round before.
GROWTH = 16


def near_border(radius: int, side: int) -> Column:
    """Whether a tile other than its own needs to see ``pos``."""
    def test(p: str) -> str:
        return f"({p} % {side} < {radius} or {p} % {side} >= {side - radius})"

    return F.expr(f"{test('pos[0]')} or {test('pos[1]')}")


def spread(df: DataFrame, columns: list[str], radius: int, side: int) -> DataFrame:
    """A row per tile that needs to see ``pos``: its own (``n`` = 0), then those within the radius.

    Tiles lie over the first two positions, so a point has four rows at most; further positions
    are compared inside the tile.
    """
    def step(p: str) -> str:
        return f"case when {p} % {side} < {radius} then -1 when {p} % {side} >= {side - radius} then 1 else 0 end"

    flat = df.selectExpr(*columns, f"pos[0] div {side} as h0", f"pos[1] div {side} as h1",
                         f"{step('pos[0]')} as d0", f"{step('pos[1]')} as d1")
    # bit 1 of n moves along the first coordinate, bit 2 along the second
    moves = """explode(case when d0 = 0 and d1 = 0 then array(0) when d1 = 0 then array(0, 1)
               when d0 = 0 then array(0, 2) else array(0, 1, 2, 3) end) as n"""
    return flat.selectExpr(*columns, "h0", "h1", "d0", "d1", moves).selectExpr(
        *columns, "n", "h0 + if(n in (1, 3), d0, 0) as t0", "h1 + if(n in (2, 3), d1, 0) as t1")


class _Seen:
    """Points by cells of the radius; with ``forgets`` rows of cells that a walk by position has left go."""

    def __init__(self, radius: int, forgets: bool):
        self.radius, self.forgets = radius, forgets
        self.rows: dict[int, dict[int, list[tuple[int, ...]]]] = {}

    def near(self, x: tuple[int, ...]) -> bool:
        r, cell = self.radius, self.radius + 1
        for i in range(x[0] // cell - 1, x[0] // cell + 2):
            row = self.rows.get(i)
            if row:
                for j in range(x[1] // cell - 1, x[1] // cell + 2):
                    for y in row.get(j, ()):
                        if all(abs(a - b) <= r for a, b in zip(x, y, strict=True)):
                            return True
        return False

    def add(self, x: tuple[int, ...]) -> None:
        i, j = x[0] // (self.radius + 1), x[1] // (self.radius + 1)
        if self.forgets and i not in self.rows:
            for old in [k for k in self.rows if k < i - 1]:
                del self.rows[old]
        self.rows.setdefault(i, {}).setdefault(j, []).append(x)


def walked(sent: DataFrame, key: list[str], order: list[Column], radius: int, by_position: bool) -> DataFrame:
    """key, pos, rep, known of the points at home in their tiles that are kept (known) or stay open."""
    place = [*key, "t0", "t1"]
    rows = sent.select(*place, "pos", "rep", "known", (F.col("n") == 0).alias("home")).repartition(*place).sortWithinPartitions(*place, *order)
    out = sent.select(*key, "pos", "rep", "known").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tile, kept, open_ = None, None, None
        for batch in batches:
            rows, known = [], []
            columns = (batch.column(c).to_pylist() for c in (*place, "pos", "known", "home"))
            for k, (*here, pos, settled, home) in enumerate(zip(*columns, strict=True)):
                if here != tile:
                    tile, kept, open_ = here, _Seen(radius, by_position), _Seen(radius, by_position)
                x = tuple(pos)
                if settled:
                    kept.add(x)
                elif not kept.near(x):
                    keep = home and not open_.near(x)
                    (kept if keep else open_).add(x)
                    if home:
                        rows.append(k)
                        known.append(keep)
            some = batch.take(pa.array(rows, pa.int64()))
            yield pa.RecordBatch.from_arrays([*(some.column(c) for c in (*key, "pos", "rep")), pa.array(known, pa.bool_())], names=[*key, "pos", "rep", "known"])

    return rows.mapInArrow(run, out)


def settle(sent: DataFrame, key: list[str], radius: int, side: int, order: list[Column], by_position: bool) -> DataFrame:
    """Points kept of those that ``sent(key, pos, rep, known, n, t0, t1)`` deals to tiles of ``side``.

    Rounds go on with wider tiles until no point is open.
    """
    columns, found = [*key, "pos", "rep", "known"], []
    while True:
        solved, left = cut_measuring(walked(sent, key, order, radius, by_position), F.count_if(~F.col("known")))
        found.append(solved.where("known").drop("known"))
        if not left:
            return reduce(DataFrame.unionByName, found)
        sent = next_round(solved, key, columns, radius, side, side * GROWTH)
        side *= GROWTH


def next_round(solved: DataFrame, key: list[str], columns: list[str], radius: int, side: int, wider: int) -> DataFrame:
    """What the tiles of the next round see: open points, and those settled near a border of this one."""
    waiting = spread(solved.where("not known"), columns, radius, wider)
    active = waiting.where("n = 0").select(*key, "t0", "t1").distinct()
    around = spread(solved.where(F.col("known") & near_border(radius, side)), columns, radius, wider)
    return waiting.unionByName(around.join(active, [*key, "t0", "t1"], "left_semi"))


def select(points: DataFrame, key: list[str], radius: int, side: int, order: list[Column], by_position: bool = False) -> DataFrame:
    """The points of ``points(key, pos, rep)`` that are kept in ``order``; positions are distinct within a key."""
    columns = [*key, "pos", "rep", "known"]
    return settle(spread(points.select(*key, "pos", "rep", F.lit(False).alias("known")), columns, radius, side), key, radius, side, order, by_position)
