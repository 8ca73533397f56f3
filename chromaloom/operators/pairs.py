"""Filters and projections over contact pairs and alignments."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names

SHORT_FORM = ["s1", "c1", "p1", "f1", "s2", "c2", "p2", "f2"]
LONG_FORM = [*SHORT_FORM, "q1", "cigar1", "seq1", "q2", "cigar2", "seq2", "name1", "name2"]
PHASED_FORM = ["qname", *SHORT_FORM, "q1", "q2"]

# fixed value: mapping quality written for both ends of a phased export
PHASED_QUALITY = 100

BLOCK = ["c1", "c2", "f1", "f2", "s1", "s2"]


def mapq_filter(pairs: DataFrame, q: int = -1) -> DataFrame:
    """Both ends at or above ``q``."""
    return pairs.where((F.col("q1") >= q) & (F.col("q2") >= q))


def read_type_filter(alignments: DataFrame, low: int = 0, high: int = 5) -> DataFrame:
    return alignments.where(F.col("rt").between(low, high))


def usable_alignments(alignments: DataFrame, q: int = 1) -> DataFrame:
    """Records merged across experiments: read types 0 to 5, not duplicate, mapped well."""
    kept = read_type_filter(alignments)
    return kept.where((F.col("flag").bitwiseAND(F.lit(1024)) == 0) & (F.col("mapq") >= q))


def junction_reads(alignments: DataFrame, platform: Column | str = "ILLUMINA") -> DataFrame:
    """Records whose interior end lies at a ligation junction, by sequencing platform."""
    name = F.lit(platform) if isinstance(platform, str) else platform
    crossing = F.when(name == "ILLUMINA", F.col("rt").between(2, 5)).when(name == "454", F.col("rt").between(0, 1))
    return alignments.where(F.coalesce(crossing, F.lit(False)))


def contact_status(pairs: DataFrame, q: int = 1) -> DataFrame:
    """Add ``status``: intra_fragment, below_mapq or contact."""
    same_fragment = (F.col("c1") == F.col("c2")) & (F.col("f1") == F.col("f2"))
    status = (F.when(same_fragment, "intra_fragment")
              .when(F.least("q1", "q2") < q, "below_mapq").otherwise("contact"))
    return pairs.withColumn("status", status)


def valid_contacts(pairs: DataFrame, q: int = 1) -> DataFrame:
    return contact_status(pairs, q).where("status = 'contact'").drop("status")


def exclude_chromosomes(df: DataFrame, chroms=names.UNPHASED_CHROMOSOMES,
                        columns: tuple[str, ...] = ("c1", "c2")) -> DataFrame:
    keep = reduce(lambda a, b: a & b, [~F.col(c).isin(*chroms) for c in columns])
    return df.where(keep)


def standard_chromosomes(df: DataFrame, columns: tuple[str, ...] = ("c1", "c2")) -> DataFrame:
    keep = reduce(lambda a, b: a & b, [names.on_standard_chromosome(F.col(c)) for c in columns])
    return df.where(keep)


def phasing_candidates(pairs: DataFrame, q: int = 10) -> DataFrame:
    """Pairs on one chromosome with both ends at or above ``q``."""
    return mapq_filter(pairs.where(F.col("c1") == F.col("c2")), q)


def _sided(columns: list[str]) -> list[str]:
    return [c[:-1] for c in columns if c.endswith("1") and c[:-1] + "2" in columns]


def canonical_pair(pairs: DataFrame) -> DataFrame:
    """Order the two ends by chromosome, strand and position, moving every end column."""
    first, second = (F.struct(f"c{i}", f"s{i}", f"p{i}") for i in (1, 2))
    keep = first <= second
    sided = _sided(pairs.columns)
    swapped = {}
    for base in sided:
        a, b = F.col(f"{base}1"), F.col(f"{base}2")
        swapped[f"{base}1"] = F.when(keep, a).otherwise(b)
        swapped[f"{base}2"] = F.when(keep, b).otherwise(a)
    return pairs.select(*[swapped[c].alias(c) if c in swapped else F.col(c) for c in pairs.columns])


def dummy_fragments(pairs: DataFrame) -> DataFrame:
    """Without an enzyme the ends get fragments 0 and 1, so no pair is intra-fragment."""
    return pairs.withColumns({"f1": F.lit(0).cast("bigint"), "f2": F.lit(1).cast("bigint")})


def tag_read_end(alignments: DataFrame, end: int) -> DataFrame:
    """Append ``/1`` or ``/2`` to names and drop rows without a sequence column value."""
    named = alignments.withColumn("qname", F.concat("qname", F.lit(f"/{end}")))
    return named.where(F.col("seq").isNotNull()) if "seq" in alignments.columns else named


def to_short(pairs: DataFrame) -> DataFrame:
    return pairs.select(*SHORT_FORM)


def to_long(pairs: DataFrame) -> DataFrame:
    return pairs.withColumns({"name1": F.col("qname"), "name2": F.col("qname")}).select(*LONG_FORM)


def to_phased_export(pairs: DataFrame) -> DataFrame:
    quality = F.lit(PHASED_QUALITY)
    return pairs.withColumns({
        "qname": names.read_base_name(F.col("qname")), "q1": quality, "q2": quality}).select(*PHASED_FORM)


def stack_ends(pairs: DataFrame, columns: list[str], keep: list[str] | None = None) -> DataFrame:
    """One row per end, with the side columns under their common names."""
    ends = F.array(*[
        F.struct(F.lit(i).alias("end"), *[F.col(f"{c}{i}").alias(c) for c in columns]) for i in (1, 2)])
    return pairs.select(*(keep or []), F.explode(ends).alias("e")).select(*(keep or []), "e.*")


def _tie(pairs: DataFrame) -> list[str]:
    """Names break ties, so that rows at one hot position still spread over tasks."""
    return ["qname"] if "qname" in pairs.columns else []


def sort_by_contact_block(pairs: DataFrame, partitions: int | None = None) -> DataFrame:
    """Range partitions in contact-block order, each sorted: a global order without one task."""
    order = [*BLOCK, "p1", "p2", *_tie(pairs)]
    ranged = pairs.repartitionByRange(partitions, *order) if partitions else pairs.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*order)


def sort_by_chromosomes_first(pairs: DataFrame) -> DataFrame:
    """Older order: chromosomes, fragments, strands, first position."""
    return pairs.orderBy("c1", "c2", "f1", "f2", "s1", "s2", "p1", "p2", *_tie(pairs))


def merge_sorted(parts: list[DataFrame]) -> DataFrame:
    """Union of contact lists ordered by chromosome pair, then by position."""
    merged = merge_experiments(parts)
    return merged.orderBy("c1", "c2", "p1", "p2", *_tie(merged))


def merge_experiments(parts: list[DataFrame]) -> DataFrame:
    """Union without deduplication across experiments."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def union_header(headers: list[DataFrame]) -> DataFrame:
    """Distinct sequence lines of several headers."""
    return merge_experiments(headers).distinct()


def missing_chroms(header: DataFrame, sizes: DataFrame) -> DataFrame:
    """Header sequences that the sizes table lacks."""
    return header.select("chrom").distinct().join(sizes.select("chrom"), "chrom", "left_anti")


def chunk_index(pairs: DataFrame, n: int = 500_000) -> DataFrame:
    """Row ranges of at most ``n`` rows per chromosome pair, in (c1, c2) order.

    Only counts are ordered: offsets are running sums over chromosomes, then over the
    partners of one chromosome, so no window sees more rows than there are chromosomes.
    """
    counts = pairs.groupBy("c1", "c2").agg(F.count("*").alias("rows"))
    earlier = Window.orderBy("c1").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("c1").orderBy("c2").rowsBetween(Window.unboundedPreceding, -1)
    firsts = counts.groupBy("c1").agg(F.sum("rows").alias("total")).select(
        "c1", F.coalesce(F.sum("total").over(earlier), F.lit(0)).alias("base"))
    placed = counts.withColumn("inside", F.coalesce(F.sum("rows").over(within), F.lit(0))).join(firsts, "c1")
    chunks = F.sequence(F.lit(0).cast("bigint"), F.expr(f"(rows - 1) div {n}"))
    return (placed.withColumn("chunk", F.explode(chunks))
            .select("c1", "c2", "chunk",
                    (F.col("base") + F.col("inside") + F.col("chunk") * n).alias("start_row"),
                    F.least(F.lit(n), F.col("rows") - F.col("chunk") * n).cast("bigint").alias("n_rows")))
