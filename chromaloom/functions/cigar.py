"""CIGAR arithmetic as Spark column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _total(cigar: Column, ops: str) -> Column:
    lengths = F.regexp_extract_all(cigar, F.lit(rf"(\d+)[{ops}]"), F.lit(1))
    return F.aggregate(lengths, F.lit(0).cast("bigint"), lambda a, x: a + x.cast("bigint"))


def ref_len(cigar: Column) -> Column:
    """Reference bases covered: M, D, N, X and =."""
    return _total(cigar, "MDNX=")


def query_len(cigar: Column) -> Column:
    """Bases present in the read sequence: M, I, S, X and =."""
    return _total(cigar, "MISX=")


def span_len(cigar: Column) -> Column:
    """Reference bases plus clips: the extent used when a read is laid out for phasing."""
    return _total(cigar, "MDNX=SH")


def _clip(cigar: Column, pattern: str) -> Column:
    # most records have no clip, and a failed cast costs many times a passed one
    return F.coalesce(F.nullif(F.regexp_extract(cigar, pattern, 1), F.lit("")).try_cast("bigint"), F.lit(0))


def lead_clip(cigar: Column) -> Column:
    return _clip(cigar, r"^(\d+)[SH]")


def trail_clip(cigar: Column) -> Column:
    return _clip(cigar, r"(\d+)[SH]$")


def five_prime_pos(pos: Column, cigar: Column, strand: Column, secondary: Column) -> Column:
    """Unclipped 5' position; clips are ignored on secondary records."""
    primary = ~secondary
    forward = F.when(primary & (lead_clip(cigar) > 0), F.greatest(pos - lead_clip(cigar), F.lit(1))).otherwise(pos)
    reverse = pos + ref_len(cigar) - 1 + F.when(primary, trail_clip(cigar)).otherwise(F.lit(0))
    return F.when(strand == 16, reverse).otherwise(forward).cast("bigint")


def interior_pos(five_prime: Column, cigar: Column, strand: Column, secondary: Column) -> Column:
    """Position on the ligation side of a record, from its 5' position."""
    forward = five_prime + lead_clip(cigar) + ref_len(cigar) - 1
    reverse = five_prime - ref_len(cigar) + 1 - trail_clip(cigar)
    moved = F.when(secondary, five_prime).when(strand == 0, forward).otherwise(reverse)
    return F.greatest(moved, F.lit(0)).cast("bigint")


def outer_pos(pos: Column, cigar: Column, strand: Column, secondary: Column) -> Column:
    """Far end of the second alignment of a single-end read."""
    return F.when((strand == 0) & secondary, pos + ref_len(cigar) - 1).otherwise(pos).cast("bigint")


def downstream_clip(cigar: Column, strand: Column) -> Column:
    """Clip length on the 3' side of a record."""
    return F.when(strand == 0, trail_clip(cigar)).otherwise(lead_clip(cigar))


def base_at(cigar: Column, seq: Column, start: Column, target: Column) -> Column:
    """Read base lying over reference position ``target``, null when none does.

    ``start`` is the reference position of the first CIGAR operation. M yields a base;
    D, N, S and H cover reference without one; I and S use up read bases.
    """
    ops = F.regexp_extract_all(cigar, F.lit(r"\d+[MDNSHI]"), F.lit(0))
    zero = F.struct(
        start.cast("bigint").alias("g"), F.lit(0).cast("bigint").alias("r"),
        F.lit(False).alias("done"), F.lit(None).cast("bigint").alias("at"))

    def walk(acc: Column, token: Column) -> Column:
        n = F.regexp_extract(token, r"^(\d+)", 1).cast("bigint")
        op = F.substring(token, -1, 1)
        on_ref = op != "I"
        hit = ~acc["done"] & on_ref & (acc["g"] + n > target)
        moving = ~acc["done"] & ~hit
        return F.struct(
            F.when(moving & on_ref, acc["g"] + n).otherwise(acc["g"]).alias("g"),
            F.when(moving & op.isin("M", "S", "I"), acc["r"] + n).otherwise(acc["r"]).alias("r"),
            (acc["done"] | hit).alias("done"),
            F.when(hit & (op == "M"), acc["r"] + target - acc["g"]).otherwise(acc["at"]).alias("at"))

    at = F.aggregate(ops, zero, walk, lambda acc: acc["at"])
    return F.when(at.isNotNull() & (at < F.length(seq)), F.substr(seq, (at + 1).cast("int"), F.lit(1)))
