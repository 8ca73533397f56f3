"""Read names, chromosome names and the serialised contact block."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed value: the comma is literally part of the character class
STANDARD_CHROMOSOME = r"^(chr)?[1-9,X,Y,M][0-9,T]?$"

# fixed value: chromosomes left out of homolog work by default
UNPHASED_CHROMOSOMES = ("Y", "chrY", "MT", "chrM")


def read_base_name(qname: Column) -> Column:
    return F.substring_index(qname, "/", 1)


def read_end(qname: Column, flag: Column) -> Column:
    """Read end: text after ``/`` when the name has it, else the first-in-pair bit."""
    by_flag = (flag.bitwiseAND(F.lit(64)) > 0).cast("int").cast("string")
    return F.when(qname.contains("/"), F.split_part(qname, F.lit("/"), F.lit(2))).otherwise(by_flag)


def clean_chrom(chrom: Column) -> Column:
    return F.replace(chrom, F.lit("_"), F.lit(""))


def on_standard_chromosome(chrom: Column) -> Column:
    return chrom.rlike(STANDARD_CHROMOSOME)


def illumina_tile(qname: Column) -> Column:
    """Flow cell, lane and tile run together; null for names without ``:``."""
    parts = [F.split_part(qname, F.lit(":"), F.lit(i)) for i in (3, 4, 5)]
    return F.when(qname.contains(":"), F.concat(*parts))


def illumina_x(qname: Column) -> Column:
    return F.when(qname.contains(":"), F.split_part(qname, F.lit(":"), F.lit(6)).try_cast("bigint"))


def illumina_y(qname: Column) -> Column:
    last = F.substring_index(F.split_part(qname, F.lit(":"), F.lit(7)), "/", 1)
    return F.when(qname.contains(":"), last.try_cast("bigint"))


def cb_format(c1, c2, f1, f2, s1, s2, p1, p2, frag_width: int = 9, pos_width: int = 9) -> Column:
    """Contact block text: zero padding makes it sort like the typed columns."""
    def pad(col: Column, width: int) -> Column:
        text = col.cast("string")
        return F.when(F.length(text) >= width, text).otherwise(F.lpad(text, width, "0"))
    return F.concat_ws("_", c1, c2, pad(f1, frag_width), pad(f2, frag_width),
                       s1.cast("string"), s2.cast("string"), pad(p1, pos_width), pad(p2, pos_width))


def cb_parse(cb: Column) -> dict[str, Column]:
    """Typed columns back from a contact block."""
    def part(i: int) -> Column:
        return F.split_part(cb, F.lit("_"), F.lit(i))
    return {
        "c1": part(1), "c2": part(2),
        "f1": part(3).cast("bigint"), "f2": part(4).cast("bigint"),
        "s1": part(5).cast("int"), "s2": part(6).cast("int"),
        "p1": part(7).cast("bigint"), "p2": part(8).cast("bigint"),
    }


def sam_tag(tags: Column, name: str) -> Column:
    """Value of the first tag of a name; null without one."""
    return F.get(F.filter(tags, lambda t: t["tag"] == name), F.lit(0))["value"]


def homolog_name(chrom: Column, homolog: Column) -> Column:
    return F.concat(chrom, F.lit("-"), homolog)


def strip_homolog(chrom: Column) -> Column:
    return F.regexp_replace(chrom, "-[ra]$", "")


def is_dna(col: Column) -> Column:
    return col.rlike("(?i)^[acgtn]+$")
