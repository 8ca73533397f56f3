"""Restriction sites of a genome."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.motifs import iupac_regex

LINE_GROUP = 4096


def with_offsets(lines: DataFrame, group: int = LINE_GROUP) -> DataFrame:
    """Add ``offset``: bases of the chromosome before the line.

    Offsets come from two short running sums, over groups of lines and inside one group,
    so a long chromosome is not ordered in one task.
    """
    sized = lines.withColumn("_g", F.expr(f"line_no div {group}"))
    totals = sized.groupBy("chrom", "_g").agg(F.sum(F.length("seq")).alias("n"))
    before = Window.partitionBy("chrom").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("chrom", "_g").orderBy("line_no").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("chrom", "_g", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    return (sized.join(bases, ["chrom", "_g"])
            .withColumn("offset", F.col("_base") + F.coalesce(F.sum(F.length("seq")).over(inside), F.lit(0)))
            .drop("_g", "_base"))


def stitch_lines(lines: DataFrame, overlap: int, group: int = LINE_GROUP) -> DataFrame:
    """Add ``ahead``: the next ``overlap`` bases after the line, over as many lines as needed.

    Every line hands its first bases back to the lines they follow, found by offset.
    """
    if "offset" not in lines.columns:
        lines = with_offsets(lines, group)
    if overlap == 0:
        return lines.withColumn("ahead", F.lit(""))
    # bases [offset, offset + overlap) of a line can be needed by the lines ending there
    cell = F.expr(f"offset div {group}")
    ends = lines.withColumn("_end", F.col("offset") + F.length("seq"))
    given = lines.select(F.col("chrom").alias("_c"), F.col("offset").alias("_o"),
                         F.substring("seq", 1, overlap).alias("_s"), cell.alias("_own"))
    wanted = ends.withColumn("_cell", F.explode(F.sequence(
        F.expr(f"_end div {group}"), F.expr(f"(_end + {overlap} - 1) div {group}"))))
    joined = wanted.join(given, (F.col("chrom") == F.col("_c")) & (F.col("_cell") == F.col("_own"))
                         & (F.col("_o") >= F.col("_end")) & (F.col("_o") < F.col("_end") + overlap), "left")
    parts = F.array_sort(F.collect_list(F.when(F.col("_o").isNotNull(), F.struct("_o", "_s"))))
    text = F.substring(F.array_join(F.transform(parts, lambda x: x["_s"]), ""), 1, overlap)
    return joined.groupBy(*lines.columns).agg(text.alias("ahead"))


def motif_positions(lines: DataFrame, motifs: str | tuple[str, ...]) -> DataFrame:
    """All overlapping 1-based hits per chromosome, hits across line ends included.

    Splitting at a lookahead cuts the text before every hit, so the hits are the running
    lengths of the pieces.
    """
    motifs = (motifs,) if isinstance(motifs, str) else motifs
    longest = max(len(m) for m in motifs)
    pattern = iupac_regex(tuple(motifs))
    stitched = stitch_lines(with_offsets(lines), longest - 1).withColumn(
        "text", F.concat(F.upper("seq"), F.upper("ahead")))
    zero = F.struct(F.array().cast("array<int>").alias("at"), F.lit(0).alias("sum"))
    starts = F.aggregate(
        F.split("text", f"(?={pattern})"), zero,
        lambda acc, piece: F.struct(F.concat(acc["at"], F.array(acc["sum"])).alias("at"),
                                    (acc["sum"] + F.length(piece)).alias("sum")),
        lambda acc: acc["at"])
    # the first piece begins at a hit only when the text itself does
    first = F.col("text").rlike(f"^{pattern}")
    hits = F.filter(starts, lambda s: (s < F.length("seq")) & ((s > 0) | first))
    return (stitched.select("chrom", "offset", F.explode(hits).alias("at"))
            .select("chrom", (F.col("offset") + F.col("at") + 1).alias("pos")))


def chrom_lengths(lines: DataFrame) -> DataFrame:
    return lines.groupBy("chrom").agg(F.sum(F.length("seq")).cast("bigint").alias("length"))


def restriction_sites(lines: DataFrame, motifs: str | tuple[str, ...], group: int = 1_000_000) -> DataFrame:
    """(chrom, idx, pos): all cut positions, then the chromosome length as the last one."""
    found = motif_positions(lines, motifs).unionByName(
        chrom_lengths(lines).withColumnRenamed("length", "pos")).distinct()
    return site_ranks(found, group)


def site_ranks(positions: DataFrame, group: int = 1_000_000) -> DataFrame:
    """Running index per chromosome, ranked inside position groups and offset by their counts."""
    placed = positions.withColumn("_g", F.expr(f"pos div {group}"))
    counts = placed.groupBy("chrom", "_g").agg(F.count("*").alias("n"))
    before = Window.partitionBy("chrom").orderBy("_g").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("chrom", "_g", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("_base"))
    inside = Window.partitionBy("chrom", "_g").orderBy("pos")
    return (placed.join(bases, ["chrom", "_g"])
            .select("chrom", (F.col("_base") + F.row_number().over(inside) - 1).alias("idx"), "pos"))
