"""Text reports: statistics, histograms, variants and methylation."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.measures import LOG_EDGES, commify
from ..functions.motifs import UNKNOWN_JUNCTION
from ..operators.phasing import phased_snps
from ..operators.statistics import MAX_MAPQ, MAX_SITE_DISTANCE, merge_stats

CYTOSINE = "chrom string, pos bigint, strand string, n_meth int, n_unmeth int, context string, trinucleotide string"


def read_cytosine_report(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema=CYTOSINE).drop("trinucleotide")


def read_vcf(spark: SparkSession, path: str) -> tuple[DataFrame, list[str]]:
    """Variant rows with one column per sample, and the sample names of the header line."""
    lines = spark.read.text(path)
    head = lines.where("value like '#CHROM%'").first()
    if head is None:
        raise ValueError("no #CHROM header line")
    samples = head["value"].split("\t")[9:]
    cols = F.split("value", "\t")
    fixed = [("chrom", 0, "string"), ("pos", 1, "bigint"), ("ref", 3, "string"), ("alt", 4, "string")]
    body = lines.where("value not like '#%' and value <> ''").select(
        *[F.get(cols, F.lit(i)).cast(t).alias(n) for n, i, t in fixed],
        *[F.get(cols, F.lit(9 + i)).alias(s) for i, s in enumerate(samples)])
    return body, samples


def read_phased_vcf(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """Phased SNPs per sample, and the rows left out."""
    body, samples = read_vcf(spark, path)
    return phased_snps(body, samples)


# fixed values: report labels and the counters they print, in order
PAIRED_LABELS = (
    ("Sequenced Read Pairs", "total", None),
    ("No chimera found", "unmapped", "unmapped_pct"),
    (" One or both reads unmapped", "unmapped", "unmapped_pct"),
    ("2 alignments", "alignable", "alignable_pct"),
    (" 2 alignments (A...B)", "normal", "normal_pct"),
    (" 2 alignments (A1...A2B; A1B2...B1A2)", "chimeric", "chimeric_pct"),
    ("3 or more alignments", "ambiguous", "ambiguous_pct"),
    ("Ligation Motif Present", "ligations", "ligations_pct"),
)
SINGLE_LABELS = (
    ("Sequenced Reads", "total", None),
    ("No chimera found", "no_chimera", "no_chimera_pct"),
    (" 0 alignments", "unmapped", "unmapped_pct"),
    (" 1 alignment", "singleton", "singleton_pct"),
    ("2 alignments", "chimeric", "chimeric_pct"),
    ("3 or more alignments", "ambiguous", "ambiguous_pct"),
    ("Ligation Motif Present", "ligations", "ligations_pct"),
)
PAIRED_TOTALS = (
    ("Total Unique", "unique", "alignable"),
    ("Total Duplicates", "duplicates", "alignable"),
)
SINGLE_TOTALS = (
    ("1 alignment unique", "single_unique", "aligned"),
    ("1 alignment duplicates", "single_duplicates", "aligned"),
    ("2 alignment unique", "unique", "alignable"),
    ("2 alignment duplicates", "duplicates", "alignable"),
    ("Total Unique", "total_unique", "aligned"),
    ("Total Duplicates", "total_duplicates", "aligned"),
)
CONTACT_LABELS = (
    ("Intra-fragment Reads", "intra_fragment"),
    ("Below MAPQ Threshold", "below_mapq"),
    ("Hi-C Contacts", "contacts"),
    (" Ligation Motif Present", "ligation"),
    ("Inter-chromosomal", "inter"),
    ("Intra-chromosomal", "intra"),
    ("Short Range (<20Kb)", "short"),
    ("Long Range (>20Kb)", "long"),
)


# fixed values: further lines of a report, and the counters that reports are merged by
READ_TYPE = {False: "Read type: Paired End", True: "Read type: Single End"}
LIGATION_LABEL = "Ligation Motif Present"
NOT_KNOWN = "N/A"
INSERT_LINE = "Average insert size: %.2f"
BIAS_LINE = " 3' Bias (Long Range): %.0f%% - %.0f%%"
TYPE_LINE = " Pair Type %%(L-I-O-R): %.0f%% - %.0f%% - %.0f%% - %.0f%%"
MERGED_LABELS = {
    "Sequenced Read Pairs": "total",
    "One or both reads unmapped": "unmapped",
    "2 alignments (A...B)": "normal",
    "2 alignments (A1...A2B; A1B2...B1A2)": "chimeric",
    "3 or more alignments": "ambiguous",
    "Ligation Motif Present": "ligations",
    "Total Unique": "unique",
    "Total Duplicates": "duplicates",
    "Average insert size": "avg_insert",
}


def _percent(col: Column) -> Column:
    return F.format_string("%.2f%%", col)


def _lines(df: DataFrame, texts: list[Column]) -> DataFrame:
    rows = F.posexplode(F.array(*texts)).alias("line", "value")
    return df.select(rows).where("value is not null")


def format_sequencing(summary: DataFrame, single_end: bool = False, junction: str | None = None) -> DataFrame:
    """Report lines (line, value) of a one-row sequencing summary.

    Without an enzyme, when ``junction`` is the pattern of none, ligations are not known.
    """
    texts = [F.lit(READ_TYPE[single_end])]
    for label, counter, share in SINGLE_LABELS if single_end else PAIRED_LABELS:
        if label == LIGATION_LABEL and junction == UNKNOWN_JUNCTION:
            texts.append(F.lit(f"{label}: {NOT_KNOWN}"))
            continue
        text = F.concat(F.lit(f"{label}: "), commify(F.col(counter)))
        texts.append(F.concat(text, F.lit(" ("), _percent(F.col(share)), F.lit(")")) if share else text)
    if not single_end:
        texts.append(F.format_string(INSERT_LINE, F.col("avg_insert").cast("double")))
    for label, c, base in SINGLE_TOTALS if single_end else PAIRED_TOTALS:
        texts.append(F.concat(F.lit(f"{label}: "), commify(F.col(c)), F.lit(" ("), _percent(F.col(f"{c}_of_{base}_pct")),
                              F.lit(", "), _percent(F.col(f"{c}_pct")), F.lit(")")))
    return _lines(summary, texts)


def format_contact_statistics(stats: DataFrame) -> DataFrame:
    """Report lines of one-row contact statistics."""
    texts = []
    for label, c in CONTACT_LABELS:
        share = _percent(F.col(f"{c}_of_unique_pct"))
        if f"{c}_of_reads_pct" in stats.columns:
            share = F.concat(_percent(F.col(f"{c}_of_reads_pct")), F.lit(" / "), share)
        texts.append(F.concat(F.lit(f"{label}: "), commify(F.col(c)), F.lit(" ("), share, F.lit(")")))
        if c == "ligation":
            if "three_prime_pct" in stats.columns:
                texts.append(F.format_string(BIAS_LINE, "three_prime_pct", "five_prime_pct"))
            texts.append(F.format_string(TYPE_LINE,
                                         *[F.col(f"{o}_long_pct") for o in ("left", "inner", "outer", "right")]))
    return _lines(stats, texts)


def write_stats_report(lines: DataFrame, path: str) -> None:
    """A report is a few dozen lines, written as one ordered file."""
    lines.orderBy("line").select("value").coalesce(1).write.mode("overwrite").text(path)


def parse_stats(lines: DataFrame, keys: tuple[str, ...] = ()) -> DataFrame:
    """(keys, label, n) from report lines: text before the colon, number without separators."""
    label = F.trim(F.regexp_extract("text", r"^([^:]*):", 1))
    number = F.regexp_replace(F.regexp_extract("text", r":\s*([0-9][0-9,]*(?:\.[0-9]+)?)", 1), ",", "")
    return (lines.select(*keys, label.alias("label"), number.try_cast("double").alias("n"))
            .where("label <> '' and n is not null"))


def read_stats_report(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """(file, label, n) of every report under ``path``."""
    lines = spark.read.text(path).select(F.input_file_name().alias("file"), F.col("value").alias("text"))
    return parse_stats(lines, ("file",))


def merge_reports(found: DataFrame) -> DataFrame:
    """One row of summed counters with shares from the lines of several reports (file, label, n).

    The insert size is averaged. A counter that no report has is null.
    """
    names = F.create_map(*[F.lit(x) for pair in MERGED_LABELS.items() for x in pair])
    counters = tuple(dict.fromkeys(MERGED_LABELS.values()))
    wide = (found.withColumn("counter", F.try_element_at(names, F.col("label"))).where("counter is not null")
            .groupBy("file").pivot("counter", list(counters)).agg(F.max("n")))
    return merge_stats(wide, tuple(c for c in counters if c != "avg_insert"))


def _dense(hists: DataFrame, hist: str, first: int, last: int, series: list[str]) -> DataFrame:
    """Every bin from ``first`` to ``last`` with one column per series."""
    spark = hists.sparkSession
    wide = hists.where(F.col("hist") == hist).groupBy("bin").pivot("series", series).agg(F.sum("n"))
    return spark.range(first, last + 1).withColumnRenamed("id", "bin").join(wide, "bin", "left").fillna(0, series)


def format_hists(hists: DataFrame) -> DataFrame:
    """(section, line, value) of the histogram file: A, B and D arrays and the edges x."""
    def row(df: DataFrame, section: str, columns: list[str]) -> DataFrame:
        return df.select(F.lit(section).alias("section"), (F.col("bin") + 1).cast("int").alias("line"),
                         F.concat_ws(" ", *[F.col(c).cast("bigint").cast("string") for c in columns]).alias("value"))

    sections = [row(_dense(hists, "A", 1, MAX_SITE_DISTANCE, ["all"]), "A", ["all"]),
                row(_dense(hists, "B", 0, MAX_MAPQ, ["all", "intra", "inter"]), "B", ["all", "intra", "inter"]),
                row(_dense(hists, "D", 0, len(LOG_EDGES) - 1, ["inner", "outer", "right", "left"]), "D",
                    ["inner", "outer", "right", "left"])]
    edges = hists.sparkSession.createDataFrame([(i, e) for i, e in enumerate(LOG_EDGES)], "bin bigint, edge bigint")
    sections.append(row(edges, "x", ["edge"]))
    out = sections[0]
    for s in sections[1:]:
        out = out.unionByName(s)
    brackets = hists.sparkSession.createDataFrame(
        [(s, at, text) for s in "ABDx" for at, text in ((0, f"{s} = ["), (2 ** 30, "];"))],
        "section string, line int, value string")
    return out.unionByName(brackets)


def write_hists(hists: DataFrame, path: str) -> None:
    """The file has a few thousand lines whatever the data size."""
    format_hists(hists).orderBy("section", "line").select("value").coalesce(1).write.mode("overwrite").text(path)


def parse_hists(lines: DataFrame) -> DataFrame:
    """(hist, bin, series, n) from histogram lines (file, line, text); zero entries are left out."""
    ahead = Window.partitionBy("file").orderBy("line")
    opened = F.nullif(F.regexp_extract("text", r"^([A-Za-z]) = \[", 1), F.lit(""))
    tagged = lines.withColumn("hist", F.last(opened, ignorenulls=True).over(ahead))
    numbers = tagged.where(F.col("text").rlike(r"^\s*\d") & (F.col("hist") != "x")).withColumn(
        "values", F.transform(F.split(F.trim("text"), r"\s+"), lambda x: x.cast("bigint")))
    row_no = F.row_number().over(Window.partitionBy("file", "hist").orderBy("line"))
    # A lists one series along a line or one value per line; B and D have a row per bin
    flat = numbers.withColumn("row", row_no - 1).select("file", "hist", "line", "row", F.posexplode("values").alias("at", "n"))
    along = F.row_number().over(Window.partitionBy("file", "hist").orderBy("line", "at"))
    series = (F.when(F.col("hist") == "B", F.get(F.array(*map(F.lit, ("all", "intra", "inter"))), F.col("at")))
              .when(F.col("hist") == "D", F.get(F.array(*map(F.lit, ("inner", "outer", "right", "left"))), F.col("at")))
              .otherwise("all"))
    at_bin = F.when(F.col("hist") == "A", along).otherwise(F.col("row"))
    return flat.select("file", "hist", at_bin.cast("bigint").alias("bin"), series.alias("series"), "n").where("n > 0")


def read_hists(spark: SparkSession, path: str | list[str]) -> DataFrame:
    lines = spark.read.text(path).select(
        F.input_file_name().alias("file"), F.monotonically_increasing_id().alias("line"), F.col("value").alias("text"))
    return parse_hists(lines)
