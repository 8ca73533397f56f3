"""Reads with three or more distinct alignments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import flags, names
from .duplicates import WOBBLE, greedy_unique
from .support import BROADCAST_ROWS, cut, cut_measuring, number_within

# Records of a row of a group. A read has at most one alignment per base, so its records form a
# short array; the groups of names with more records, which are malformed, have several rows.
MAX_WAYS = 10_000


def collect_abnormal(tagged: DataFrame) -> DataFrame:
    """Records of ambiguous reads (read type 8)."""
    return tagged.where(F.col("rt") == 8)


def abnormal_groups(alignments: DataFrame, q: int = 10) -> DataFrame:
    """Reads whose every record is on a standard chromosome at or above ``q``: qname, k, part, recs.

    ``recs`` is ordered by chromosome and position. The test is evaluated while counting; only
    reads that pass it are gathered. A read has one row (part 0), but for names with more than
    ``MAX_WAYS`` of the ``k`` records: these are numbered by a range sort and have a row for each so many.
    """
    read, fine = _tested(q)
    grouped = alignments.groupBy(read.alias("qname")).agg(
        F.count("*").alias("k"), F.bool_and(fine).alias("ok"),
        F.array_sort(F.collect_list(F.when(fine & (F.col("rec_no") <= MAX_WAYS), _record()))).alias("recs"))
    whole = grouped.where(F.col("ok") & (F.col("k") <= MAX_WAYS)).select("qname", "k", F.lit(0).cast("bigint").alias("part"), "recs")
    large, n = cut_measuring(oversized_reads(alignments, q), F.count("*"))
    if not n:
        return whole
    # at most one name for each MAX_WAYS records
    rows = alignments.select(read.alias("qname"), _record().alias("rec")).join(F.broadcast(large) if n <= BROADCAST_ROWS else large, "qname")
    placed = number_within(rows.select("qname", "k", "rec.*"), F.col("qname"), ["chrom", "pos", "strand", "rec_no"], "at", "size")
    parts = placed.groupBy("qname", "k", F.expr(f"(at - 1) div {MAX_WAYS}").cast("bigint").alias("part")).agg(
        F.array_sort(F.collect_list(F.struct("chrom", "pos", "strand", "rec_no", "mapq", "cigar"))).alias("recs"))
    return whole.unionByName(parts)


def _record() -> Column:
    return F.struct(F.col("rname").alias("chrom"), "pos", flags.strand(F.col("flag")).cast("int").alias("strand"), F.col("rec_no"), "mapq", "cigar")


def oversized_reads(alignments: DataFrame, q: int = 10) -> DataFrame:
    """Names that pass the test of ``abnormal_groups`` with more records than a read can have, the groups of several rows: (qname, k)."""
    read, fine = _tested(q)
    counted = alignments.groupBy(read.alias("qname")).agg(F.count("*").alias("k"), F.bool_and(fine).alias("ok"))
    return counted.where(F.col("ok") & (F.col("k") > MAX_WAYS)).select("qname", "k")


def _tested(q: int) -> tuple[Column, Column]:
    return names.read_base_name(F.col("qname")), names.on_standard_chromosome(F.col("rname")) & (F.col("mapq") >= q)


def _keyed(groups: DataFrame) -> DataFrame:
    return groups.select(
        "qname", "k", "part", F.transform("recs", lambda r: r["strand"]).alias("strands"),
        F.transform("recs", lambda r: r["chrom"]).alias("chroms"), F.transform("recs", lambda r: r["pos"]).alias("pos"))


def dedup_groups(groups: DataFrame, wobble: int = WOBBLE) -> DataFrame:
    """Add ``is_dup``: same strands and chromosomes, and all positions within the wobble of
    an earlier kept group. All rows of a group have its verdict."""
    key = ["strands", "chroms"]
    keyed = _keyed(groups)
    points = keyed.where(F.col("k") <= MAX_WAYS).groupBy(*key, "pos").agg(F.min("qname").alias("rep"))
    kept = greedy_unique(points, key, wobble).select(F.col("rep").alias("qname"))
    large = cut(keyed.where(F.col("k") > MAX_WAYS))
    if not large.isEmpty():
        kept = kept.unionByName(_large_kept(large, wobble))
    return groups.join(kept.withColumn("is_dup", F.lit(False)), "qname", "left").withColumn("is_dup", F.coalesce("is_dup", F.lit(True)))


def _large_kept(large: DataFrame, wobble: int) -> DataFrame:
    """Kept names of groups of several rows, of which there is one for each MAX_WAYS records.

    Groups are told apart by a hash over the strands and chromosomes of all their rows, meet by
    their first position, and are compared row by row. A group is decided once no earlier near one is open.
    """
    marks = large.groupBy("qname").agg(F.max("k").alias("k"), F.bit_xor(F.xxhash64("part", "strands", "chroms")).alias("mark"))
    heads = cut(large.where("part = 0").select("qname", F.col("pos")[0].alias("first")).join(marks, "qname").withColumn("cell", F.expr(f"first div {wobble + 1}")))
    other = heads.select("k", "mark", F.col("qname").alias("_name"), F.col("first").alias("_first"), F.explode(F.array(*(F.col("cell") + i for i in (-1, 0, 1)))).alias("cell"))
    met = heads.join(other, ["k", "mark", "cell"]).where((F.col("qname") < F.col("_name")) & (F.abs(F.col("first") - F.col("_first")) <= wobble)).select("qname", "_name")
    mine, theirs = large.select("qname", "part", "pos"), large.select(F.col("qname").alias("_name"), "part", F.col("pos").alias("_pos"))
    # of two groups that are near in every row, that with the smaller positions comes first
    compared = met.join(mine, "qname").join(theirs, ["_name", "part"]).groupBy("qname", "_name").agg(
        F.bool_and(F.forall(F.arrays_zip("pos", "_pos"), lambda x: F.abs(x["pos"] - x["_pos"]) <= wobble)).alias("near"),
        F.min(F.when(F.col("pos") != F.col("_pos"), F.struct("part", (F.col("pos") < F.col("_pos")).alias("first")))).alias("order"))
    mine_first = F.coalesce("order.first", F.lit(True))
    edges = cut(compared.where("near").select(F.when(mine_first, F.col("qname")).otherwise(F.col("_name")).alias("before"),
                                              F.when(mine_first, F.col("_name")).otherwise(F.col("qname")).alias("qname")))
    todo, kept = marks.select("qname"), []
    while True:
        free = cut(todo.join(edges.select("qname"), "qname", "left_anti"))
        kept.append(free)
        gone = edges.join(free.withColumnRenamed("qname", "before"), "before", "left_semi").select("qname").distinct()
        todo = cut(todo.join(free, "qname", "left_anti").join(gone, "qname", "left_anti"))
        if todo.isEmpty():
            return reduce(DataFrame.unionByName, kept)
        edges = cut(edges.join(todo, "qname", "left_semi").join(todo.withColumnRenamed("qname", "before"), "before", "left_semi"))


def sort_groups(groups: DataFrame) -> DataFrame:
    """By chromosome and position of the first five records."""
    order = []
    for i in range(5):
        rec = F.get("recs", F.lit(i))
        order += [rec["chrom"], rec["pos"]]
    return groups.orderBy(*order)
