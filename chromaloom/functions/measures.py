"""Distances, bins, orientation and number formats."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# eleven log-spaced edges per decade from 10 to 1e10
LOG_EDGES = tuple(round(10 ** (1 + k / 11)) for k in range(100))

LONG_RANGE = 20000
VERY_SHORT = 10
CHROMOSOME_GAP = 10_000_000


def bin_index(pos: Column, size: Column | int) -> Column:
    return F.floor(pos / size).cast("bigint")


def bin_start(pos: Column, size: int) -> Column:
    return (bin_index(pos, size) * size).cast("bigint")


def genome_distance(c1: Column, p1: Column, c2: Column, p2: Column, mode: str = "strict") -> Column:
    """Distance used by the closeness test of chimeric reads.

    ``strict`` is null between different chromosomes. ``numeric_compat`` reads
    chromosome names as numbers (anything else counts as 0) and charges 1e7 per step.
    """
    gap = F.abs(p1 - p2)
    if mode == "strict":
        return F.when(c1 == c2, gap)
    if mode == "numeric_compat":
        a, b = (F.coalesce(c.try_cast("bigint"), F.lit(0)) for c in (c1, c2))
        return F.abs(a - b) * CHROMOSOME_GAP + gap
    raise ValueError(f"unknown distance mode: {mode}")


def pair_orientation(s1: Column, p1: Column, s2: Column, p2: Column) -> Column:
    """inner, outer, left or right for two ends on one chromosome."""
    toward = F.when(p1 < p2, s1 == 0).otherwise(s1 != 0)
    return (F.when((s1 == s2) & (s1 == 0), "right").when(s1 == s2, "left")
            .when(toward, "inner").otherwise("outer"))


def log_bin(distance: Column) -> Column:
    """Number of log edges below ``distance``: a guess from log10 and two edge checks."""
    edges = F.array(*[F.lit(e).cast("bigint") for e in LOG_EDGES])
    last = len(LOG_EDGES) - 1
    guess = F.floor((F.coalesce(F.log10(distance.cast("double")), F.lit(0.0)) - 1) * 11)
    guess = F.greatest(F.lit(0), F.least(F.lit(last), guess)).cast("int")
    here = F.element_at(edges, guess + 1) < distance
    above = F.coalesce(F.get(edges, guess + 1) < distance, F.lit(False))
    return (guess + here.cast("int") + above.cast("int")).cast("bigint")


def pct(n: Column, total: Column) -> Column:
    """Percentage; an empty total counts as 1."""
    return F.round(n * 100.0 / F.greatest(total, F.lit(1)), 2)


def commify(n: Column) -> Column:
    return F.format_number(n, 0)
