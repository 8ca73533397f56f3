"""Phasing of contacts to parental homologs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cigar as cg
from .pairs import SHORT_FORM, phasing_candidates, to_phased_export
from .support import cut_measuring, lookup_join

SNP_BIN = 256

# Largest table of SNPs that is broadcast, in rows plus SNPs of about 40 bytes: a few hundred
# megabytes, above the phased sites of one human genome.
SNP_WEIGHT = 8_000_000
CATEGORIES = ("mismatch", "paternal_both", "maternal_both", "diff", "maternal", "paternal", "problem")

# fixed value: the mitochondrial chromosome is not phased
UNPHASED = "MT"


def snp_bins(snps: DataFrame, size: int = SNP_BIN) -> DataFrame:
    """SNPs per chromosome and bin; a bin holds at most ``size`` positions."""
    one = snps.groupBy("chrom", "pos").agg(F.min(F.struct("pat", "mat")).alias("alleles"))
    entry = F.struct("pos", F.col("alleles.pat").alias("pat"), F.col("alleles.mat").alias("mat"))
    return (one.groupBy("chrom", F.expr(f"pos div {size}").alias("bin"))
            .agg(F.array_sort(F.collect_list(entry)).alias("snps")))


def phase_call(base: Column, pat: Column, mat: Column) -> Column:
    return F.when(base == pat, "paternal").when(base == mat, "maternal").otherwise("mismatch")


def read_start(strand: Column, pos: Column, cigar: Column) -> Column:
    """Reference position at which the read, clips included, begins."""
    return F.when(strand == 0, pos).otherwise(pos - cg.span_len(cigar) + 1)


def of_sample(snps: DataFrame, sample: str | None) -> DataFrame:
    """SNPs of one sample; a table of several samples needs the choice."""
    if "sample" not in snps.columns:
        return snps
    if sample is None:
        raise ValueError("the variants are of several samples: name one")
    return snps.where(F.col("sample") == sample).drop("sample")


def overlap_snps(pairs: DataFrame, snps: DataFrame, size: int = SNP_BIN, keep: tuple[str, ...] = (), sample: str | None = None) -> DataFrame:
    """(qname, end, snp_pos, pat, mat, base) for every SNP strictly past the start of an end.

    A read touches one or two bins, so this is an equi-join on the bin with the SNPs of
    the bin as an array; only SNPs on the read are emitted. ``base`` is null where the read
    has a gap or a clip.
    """
    bins, weight = cut_measuring(snp_bins(of_sample(snps, sample), size), F.sum(1 + F.size("snps")))
    ends = F.array(*[F.struct(
        F.lit(i).alias("end"), F.col(f"c{i}").alias("chrom"), F.col(f"cigar{i}").alias("cigar"),
        F.col(f"seq{i}").alias("seq"),
        read_start(F.col(f"s{i}"), F.col(f"p{i}"), F.col(f"cigar{i}")).alias("start"),
        cg.span_len(F.col(f"cigar{i}")).alias("length")) for i in (1, 2)])
    rows = pairs.select("qname", *keep, F.explode(ends).alias("e")).select("qname", *keep, "e.*")
    rows = rows.where((F.col("chrom") != UNPHASED) & (F.col("length") > 0))
    touched = F.sequence(F.expr(f"(start + 1) div {size}"), F.expr(f"(start + length) div {size}"))
    probe = rows.withColumn("bin", F.explode(touched))
    joined = lookup_join(probe, bins, ["chrom", "bin"], "inner", salt_from=["qname"], small=weight <= SNP_WEIGHT)
    on_read = F.filter("snps", lambda s: (s["pos"] > F.col("start")) & (s["pos"] <= F.col("start") + F.col("length")))
    hit = joined.withColumn("snp", F.explode(on_read))
    base = cg.base_at(F.col("cigar"), F.col("seq"), F.col("start"), F.col("snp.pos"))
    return hit.select("qname", *keep, "end", "chrom", F.col("snp.pos").alias("snp_pos"),
                      F.col("snp.pat").alias("pat"), F.col("snp.mat").alias("mat"), base.alias("base"))


def phase_pairs(pairs: DataFrame, snps: DataFrame, q: int = 10, sample: str | None = None) -> DataFrame:
    """Pairs with at least one call, their calls per end and their category."""
    keep = tuple(c for c in SHORT_FORM if c in pairs.columns)
    hits = overlap_snps(phasing_candidates(pairs, q), snps, keep=keep, sample=sample).where("base is not null")
    call = F.struct(F.col("snp_pos").alias("pos"), "base", phase_call(F.col("base"), F.col("pat"), F.col("mat")).alias("call"))

    def calls(i: int) -> Column:
        return F.array_sort(F.collect_list(F.when(F.col("end") == i, call))).alias(f"calls{i}")

    grouped = hits.groupBy("qname", *keep).agg(calls(1), calls(2))
    return grouped.withColumn("category", category(F.col("calls1"), F.col("calls2")))


def category(calls1: Column, calls2: Column) -> Column:
    def has(calls: Column, name: str) -> Column:
        return F.exists(calls, lambda x: x["call"] == name)

    pat1, pat2, mat1, mat2 = (has(c, n) for n in ("paternal", "maternal") for c in (calls1, calls2))
    return (F.when(has(calls1, "mismatch") | has(calls2, "mismatch"), "mismatch")
            .when((pat1 & mat1) | (pat2 & mat2), "mismatch")
            .when(pat1 & pat2, "paternal_both").when(mat1 & mat2, "maternal_both")
            .when((mat1 & pat2) | (pat1 & mat2), "diff")
            .when(mat1 | mat2, "maternal").when(pat1 | pat2, "paternal").otherwise("problem"))


def phase_string(calls: Column, end: int) -> Column:
    """``SNP1:base:position:call`` and so on for all calls of an end."""
    parts = F.transform(calls, lambda x: F.concat_ws(":", x["base"], x["pos"].cast("string"), x["call"]))
    return F.concat_ws(":", F.lit(f"SNP{end}"), F.when(F.size(parts) > 0, F.array_join(parts, ":")))


def category_counts(phased: DataFrame) -> DataFrame:
    return phased.groupBy("category").agg(F.count("*").alias("n"))


def parental_contacts(phased: DataFrame, parent: str) -> DataFrame:
    """Contact list of one parent: pairs phased by one end or by both."""
    kept = phased.where(F.col("category").isin(parent, f"{parent}_both"))
    return to_phased_export(kept)


def phased_snps(vcf: DataFrame, samples: list[str]) -> tuple[DataFrame, DataFrame]:
    """Phased heterozygous single-base sites per sample, and the sites left out.

    Sites phased to the same allele number are in neither. The first allele is the paternal one.
    """
    sample = F.explode(F.array(*[F.struct(F.lit(s).alias("sample"), F.col(s).alias("gt")) for s in samples]))
    rows = vcf.select("chrom", "pos", "ref", "alt", sample.alias("x")).select("chrom", "pos", "ref", "alt", "x.*")
    alleles = F.concat(F.array("ref"), F.split("alt", ","))
    genotype = F.split_part("gt", F.lit(":"), F.lit(1))
    single = F.forall(alleles, lambda a: F.length(a) == 1)
    phased = single & genotype.contains("|")

    def number(i: int) -> Column:
        return F.split_part(genotype, F.lit("|"), F.lit(i))

    def allele(i: int) -> Column:
        return F.get(alleles, number(i).try_cast("int"))

    called = rows.where(phased & (number(1) != number(2)))
    found = called.select("sample", "chrom", "pos", allele(1).alias("pat"), allele(2).alias("mat"))
    return found, rows.where(~phased).select("sample", "chrom", "pos", "ref", "alt", "gt")


def write_by_chromosome(phased: DataFrame, path: str) -> None:
    """Phased pairs as one folder per chromosome, spread over files by read name."""
    out = phased.select("qname", "c1", "p1", "c2", "p2", phase_string(F.col("calls1"), 1).alias("snps1"), phase_string(F.col("calls2"), 2).alias("snps2"), "category")
    out.withColumn("chrom", F.col("c1")).write.partitionBy("chrom").parquet(path)
