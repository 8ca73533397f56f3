"""Coverage, map resolution and accessibility tracks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import names
from .pairs import junction_reads, stack_ends
from .support import cut_measuring

# fixed values: coverage unit, search step and default genome length of the resolution rule
UNIT = 50
STEP = 1000
GENOME_SIZE = 3_137_161_264

COARSE_BATCH = 16


def coverage(pairs: DataFrame, size: int = UNIT) -> DataFrame:
    """Ends per ``size``-bp bin over pairs mapped at both ends on different fragments."""
    kept = pairs.where((F.col("q1") > 0) & (F.col("q2") > 0) & (F.col("f1") != F.col("f2")))
    ends = stack_ends(kept, ["c", "p"])
    return (ends.groupBy(F.col("c").alias("chrom"), F.expr(f"p div {size} * {size}").alias("start"))
            .agg(F.count("*").alias("n")))


def _wanted(size: int, genome_size: int) -> int:
    """Bins of a size that must hold enough contacts."""
    return genome_size // size * 4 // 5


def _passing(cov: DataFrame, sizes: list[int], genome_size: int, min_contacts: int) -> dict[int, bool]:
    """Which bin sizes reach the threshold: one job for all of them, one row per size back."""
    sized = cov.withColumn("size", F.explode(F.array(*[F.lit(s).cast("bigint") for s in sizes])))
    bins = sized.groupBy("size", "chrom", F.expr("start div size").alias("b")).agg(F.sum("n").alias("n"))
    rows = bins.groupBy("size").agg(F.count_if(F.col("n") >= min_contacts).alias("good")).collect()
    good = {r["size"]: r["good"] for r in rows}
    return {s: good.get(s, 0) >= _wanted(s, genome_size) for s in sizes}


def map_resolution(cov: DataFrame, genome_size: int = GENOME_SIZE, min_contacts: int = 1000) -> DataFrame:
    """Smallest bin size, in steps of 50 bp, at which 80 % of the bins hold enough contacts.

    Coarse sizes (50, 1050, ...) are tried until one passes, a batch per job, from the first
    that all ends together could fill; then the sizes between the last failure and it, again in
    one job, are bisected.
    """
    spark = cov.sparkSession
    cov, ends = cut_measuring(cov, F.sum("n"))
    size = UNIT
    while ends < min_contacts * _wanted(size, genome_size):
        size += STEP
    low, passed = max(size - STEP, UNIT), False
    while not passed:
        batch = [size + i * STEP for i in range(COARSE_BATCH)]
        verdict = _passing(cov, batch, genome_size, min_contacts)
        for candidate in batch:
            passed = verdict[candidate]
            size = candidate
            if passed:
                break
            low = candidate
        if not passed:
            size = low + STEP

    def middle(a: int, b: int) -> int:
        return ((b - a) // 2 + a + UNIT - 1) // UNIT * UNIT

    between = list(range(low + UNIT, size, UNIT))
    verdict = _passing(cov, between, genome_size, min_contacts) if between else {}
    mid = middle(low, size)
    while mid < size:
        if verdict[mid]:
            size = mid
        else:
            low = mid
        mid = middle(low, size)
    return spark.range(1).select(F.lit(size).cast("bigint").alias("resolution"))


def _track(df: DataFrame, chrom: str = "chrom") -> DataFrame:
    return (df.groupBy(F.col(chrom).alias("chrom"), F.col("ip").alias("end")).agg(F.count("*").alias("n"))
            .select("chrom", (F.col("end") - 1).alias("start"), "end", "n"))


def accessibility(tagged: DataFrame, platform: str = "ILLUMINA", q: int = 1) -> DataFrame:
    """Per-base count of junction-side positions, as (chrom, start, end, n)."""
    return _track(junction_reads(tagged, platform).where(F.col("mapq") >= q), "rname")


def phased_reads(homologs: DataFrame) -> DataFrame:
    """Reads with one homolog per chromosome and the read types that carry the call."""
    chrom = names.strip_homolog(F.col("homolog"))
    return (homologs.groupBy("qname", chrom.alias("rname"))
            .agg(F.min("homolog").alias("homolog"), F.max("homolog").alias("_top"),
                 F.collect_set("rt").alias("rts"))
            .where("homolog = _top").drop("_top"))


def diploid_accessibility(tagged: DataFrame, homologs: DataFrame, platform: str = "ILLUMINA") -> DataFrame:
    """Tracks per homolog: ``raw`` counts all junction records of a phased read, ``corrected``
    those whose partner carries the call."""
    reads = phased_reads(homologs)
    hits = junction_reads(tagged, platform).join(reads, ["qname", "rname"])
    partner = F.col("rt") + 1 - 2 * (F.col("rt") % 2)
    counted = hits.groupBy(F.col("homolog").alias("chrom"), F.col("ip").alias("end")).agg(
        F.count("*").alias("raw"), F.count_if(F.array_contains("rts", partner)).alias("corrected"))
    return counted.select("chrom", (F.col("end") - 1).alias("start"), "end", "raw", "corrected")


def assign_homologs(tagged: DataFrame, homologs: DataFrame, exclude=names.UNPHASED_CHROMOSOMES) -> DataFrame:
    """Contacts between homologs: reads with one homolog on the chromosome and both ends there."""
    kept = phased_reads(homologs).where(~F.col("rname").isin(*exclude)).drop("rts")
    own = tagged.where(F.col("rt").between(0, 5) & F.col("rnext").isin("=", "*"))
    ends = own.join(kept, ["qname", "rname"])
    end = F.struct("rt", "ip")
    both = ends.groupBy("qname", "homolog").agg(
        F.count("*").alias("n"), F.min(end).alias("a"), F.max(end).alias("b")).where("n = 2")
    return both.select("qname", F.lit(0).alias("s1"), F.col("homolog").alias("c1"), F.col("a.ip").alias("p1"),
                       F.lit(0).cast("bigint").alias("f1"), F.lit(1).alias("s2"), F.col("homolog").alias("c2"),
                       F.col("b.ip").alias("p2"), F.lit(1).cast("bigint").alias("f2"))


def sort_track(track: DataFrame) -> DataFrame:
    return track.orderBy("chrom", "start")
