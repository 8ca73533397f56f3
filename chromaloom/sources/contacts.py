"""Contact lists, pair files, site files and tracks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import names
from ..operators.pairs import LONG_FORM, PHASED_FORM, SHORT_FORM

TYPES = {"p": "bigint", "f": "bigint", "s": "int", "q": "int"}
FORMS = {"short": SHORT_FORM, "long": LONG_FORM, "phased": PHASED_FORM}


def _schema(columns: list[str]) -> str:
    return ", ".join(f"{c} {TYPES.get(c[:-1], 'string')}" for c in columns)


def read_contacts(spark: SparkSession, path: str | list[str], form: str = "short") -> DataFrame:
    """Whitespace-separated contacts with 8, 16 or 11 columns; files may be gzipped."""
    df = spark.read.csv(path, sep=" ", schema=_schema(FORMS[form]))
    return df.withColumn("qname", F.col("name1")) if form == "long" else df


def format_contacts(pairs: DataFrame, form: str = "short") -> DataFrame:
    columns = FORMS[form]
    if form == "long" and "name1" not in pairs.columns:
        pairs = pairs.withColumns({"name1": F.col("qname"), "name2": F.col("qname")})
    return pairs.select(F.concat_ws(" ", *[F.col(c).cast("string") for c in columns]).alias("value"))


def write_contacts(pairs: DataFrame, path: str, form: str = "short") -> None:
    format_contacts(pairs, form).write.mode("overwrite").text(path)


PAIR_FILE = "qname string, c1 string, p1 bigint, c2 string, p2 bigint, strand1 string, strand2 string"


def parse_pairs(lines: DataFrame) -> DataFrame:
    """Contacts from pair-file lines; files that already carry fragments are refused."""
    has_fragments = lines.where("text like '#columns:%' and (text like '%frag1%' or text like '%frag2%')")
    if not has_fragments.isEmpty():
        raise ValueError("the file already has fragment columns")
    cols = F.split("text", r"\s+")

    def strand(i: int):
        text = F.get(cols, F.lit(i))
        return F.when(text.isin("-", "16"), 16).otherwise(0)

    return lines.where("text not like '#%' and text <> ''").select(
        F.get(cols, F.lit(0)).alias("qname"), strand(5).alias("s1"), F.get(cols, F.lit(1)).alias("c1"),
        F.get(cols, F.lit(2)).cast("bigint").alias("p1"), strand(6).alias("s2"),
        F.get(cols, F.lit(3)).alias("c2"), F.get(cols, F.lit(4)).cast("bigint").alias("p2"))


def read_pairs_4dn(spark: SparkSession, path: str) -> DataFrame:
    return parse_pairs(spark.read.text(path).withColumnRenamed("value", "text"))


def pairs_header(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.text(path).where("value like '#%'")


def parse_sites(lines: DataFrame) -> DataFrame:
    """(chrom, idx, pos) from lines of a chromosome name and its sorted positions."""
    cols = F.split(F.trim("text"), r"\s+")
    # a line is taken apart below the generator, once, and not again for each of its positions
    parted = lines.where("trim(text) <> ''").select(
        names.clean_chrom(F.regexp_extract(F.trim("text"), r"^\S*", 0)).alias("chrom"), F.slice(cols, 2, F.size(cols)).alias("sites"))
    return parted.select("chrom", F.posexplode("sites").alias("i", "text_pos")).select(
        "chrom", F.col("i").cast("bigint").alias("idx"), F.col("text_pos").cast("bigint").alias("pos"))


def read_sites(spark: SparkSession, path: str) -> DataFrame:
    return parse_sites(spark.read.text(path).withColumnRenamed("value", "text"))


def format_sites(sites: DataFrame) -> DataFrame:
    """One line per chromosome, as the file format has it; length follows the genome."""
    listed = sites.groupBy("chrom").agg(F.array_sort(F.collect_list(F.struct("idx", "pos"))).alias("s"))
    return listed.select(F.concat_ws(" ", "chrom", F.array_join(
        F.transform("s", lambda x: x["pos"].cast("string")), " ")).alias("value"))


def read_chrom_sizes(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="chrom string, length bigint")


def read_bed(spark: SparkSession, path: str) -> DataFrame:
    cols = F.split("value", "\t")
    lines = spark.read.text(path).where("value not like '#%' and value not like 'track%' and value <> ''")
    return lines.select(F.get(cols, F.lit(0)).alias("chrom"), F.get(cols, F.lit(1)).cast("bigint").alias("start"),
                        F.get(cols, F.lit(2)).cast("bigint").alias("end"), F.get(cols, F.lit(3)).alias("name"),
                        F.get(cols, F.lit(5)).alias("strand"))


def read_bedpe(spark: SparkSession, path: str) -> DataFrame:
    """Loop and domain lists; header lines start with # or have no number in column 2."""
    cols = F.split("value", "\t")
    ends = [("c1", "string"), ("x1", "bigint"), ("x2", "bigint"), ("c2", "string"), ("y1", "bigint"), ("y2", "bigint")]
    lines = spark.read.text(path).where(F.get(cols, F.lit(1)).try_cast("bigint").isNotNull() & ~F.startswith("value", F.lit("#")))
    return lines.select(*[F.get(cols, F.lit(i)).cast(t).alias(n) for i, (n, t) in enumerate(ends)])


def read_homologs(spark: SparkSession, path: str) -> DataFrame:
    """Read to homolog map: qname, chromosome with -r or -a, read type."""
    return spark.read.csv(path, sep=" ", schema="qname string, homolog string, rt int")


def write_bedgraph(track: DataFrame, path: str, value: str = "n") -> None:
    """Track sorted by chromosome and start over range partitions, tab separated."""
    track.select("chrom", "start", "end", value).orderBy("chrom", "start").write.mode("overwrite").csv(path, sep="\t")


def read_bedgraph(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.csv(path, sep="\t", schema="chrom string, start bigint, end bigint, n bigint")


def write_matrix(matrix: DataFrame, path: str) -> None:
    """Parquet partitioned by resolution and chromosome pair, rows near in space together.

    Range partitions follow the pixel order, so a chromosome pair with many pixels is
    spread over many files and small ones share a task.
    """
    (matrix.repartitionByRange("res", "c1", "c2", "b1", "b2").sortWithinPartitions("res", "c1", "c2", "b1", "b2")
     .write.mode("overwrite").partitionBy("res", "c1", "c2").parquet(path))


def read_matrix(spark: SparkSession, path: str, res: int | None = None) -> DataFrame:
    df = spark.read.parquet(path).select(
        F.col("res").cast("bigint").alias("res"), F.col("c1").cast("string").alias("c1"),
        F.col("c2").cast("string").alias("c2"), "b1", "b2", "n")
    return df if res is None else df.where(F.col("res") == res)
