"""SAM text, FASTQ and FASTA."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType, StructField, StructType

from ..functions import names
from ..operators.support import BROADCAST_ROWS, cut, cut_measuring, lookup_join

FIXED = ("qname", "flag", "rname", "pos", "mapq", "cigar", "rnext", "pnext", "tlen", "seq", "qual")
TYPES = {"flag": "int", "pos": "bigint", "mapq": "int", "pnext": "bigint", "tlen": "bigint"}

# longest stretch of sequence kept in one row
MAX_LINE = 65_536


def _numbered(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Lines with file, their order and text. Order follows file offsets split by split."""
    lines = spark.read.text(path).select(
        F.input_file_name().alias("file"), F.col("_metadata.file_block_start").alias("block"),
        F.monotonically_increasing_id().alias("seq_id"), F.col("value").alias("text"))
    return lines


def parse_sam(lines: DataFrame) -> DataFrame:
    """Fixed columns and the tags (tag, type, value) in order from SAM text lines; ``lines`` has ``text`` and ``order``."""
    cols = F.split("text", "\t")
    body = lines.where(~F.startswith("text", F.lit("@")) & (F.size(cols) >= 11))
    fixed = [F.get(cols, F.lit(i)).cast(TYPES.get(name, "string")).alias(name) for i, name in enumerate(FIXED)]
    tag = F.transform(F.slice(cols, 12, F.greatest(F.size(cols) - 11, F.lit(0))), lambda t: F.struct(
        F.split_part(t, F.lit(":"), F.lit(1)).alias("tag"), F.split_part(t, F.lit(":"), F.lit(2)).alias("type"),
        F.regexp_replace(t, "^[^:]*:[^:]*:", "").alias("value")))
    return body.select("order", *fixed, tag.alias("tags"))


def read_sam(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Alignment records; ``rec_no`` is the position of a record among those of its read.

    The lines are scanned once and shuffled once, by read name and the part of the file they
    stand in, so a name that fills many parts is not gathered. What a name has in earlier parts
    of the files is added by a lookup with a row per such name and part.
    """
    raw = _numbered(spark, path)
    parsed = parse_sam(raw.select("text", F.struct("file", "block", "seq_id").alias("order")))
    place = ["_name", "_file", "_block"]
    named = parsed.withColumns({"_name": names.read_base_name(F.col("qname")), "_file": F.col("order.file"), "_block": F.col("order.block")})
    here = Window.partitionBy(*place)
    local = cut(named.withColumns({"rec_no": F.row_number().over(here.orderBy("order.seq_id")), "_n": F.count("*").over(here)}).drop("order"))
    before = Window.partitionBy("_name").orderBy("_file", "_block").rowsBetween(Window.unboundedPreceding, -1)
    bases = cut(local.where("rec_no = 1").withColumn("_base", F.sum("_n").over(before)).where("_base is not null").select(*place, "_base"))
    joined = lookup_join(local.drop("_n"), bases, place, salt_from=["rec_no"])
    return joined.withColumn("rec_no", (F.col("rec_no") + F.coalesce("_base", F.lit(0))).cast("int")).drop(*place, "_base")


def sam_header(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Header lines, and sequence names and lengths of the @SQ lines."""
    lines = spark.read.text(path).where(F.startswith("value", F.lit("@")))
    return lines.select(F.col("value").alias("line"),
                        F.nullif(F.regexp_extract("value", r"^@SQ.*\tSN:([^\t]*)", 1), F.lit("")).alias("chrom"),
                        F.regexp_extract("value", r"^@SQ.*\tLN:(\d+)", 1).try_cast("bigint").alias("length"))


def format_sam(alignments: DataFrame) -> DataFrame:
    """Text lines with the derived tags appended after the existing ones."""
    kept = F.transform("tags", lambda t: F.concat_ws(":", t["tag"], t["type"], t["value"]))
    derived = [("MQ", "i", "mate_mapq"), ("ip", "i", "ip"), ("mp", "i", "mp"), ("rt", "A", "rt"), ("cb", "Z", "cb")]
    extra = [F.when(F.col(c).isNotNull(), F.concat(F.lit(f"{t}:{k}:"), F.col(c).cast("string")))
             for t, k, c in derived if c in alignments.columns]
    fixed = [F.col(c).cast("string") for c in FIXED]
    tags = [F.array_join(kept, "\t")] if "tags" in alignments.columns else []
    parts = [F.when(F.length(t) > 0, t) for t in tags]
    return alignments.select(F.concat_ws("\t", *fixed, *parts, *extra).alias("value"))


def write_sam(alignments: DataFrame, path: str, header: list[str] | None = None) -> None:
    """Record lines under ``path``; the header, small by nature, goes to ``path``/_header."""
    format_sam(alignments).write.mode("overwrite").text(path)
    if header:
        spark = alignments.sparkSession
        lines = [*header, "@PG\tID:chromaloom\tPN:chromaloom"]
        spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, value string").orderBy("i").select(
            "value").coalesce(1).write.mode("overwrite").text(f"{path}_header")


def _parts(lines: DataFrame) -> DataFrame:
    """file, part, block, first and n of the read splits of ``lines``, a row each."""
    part = F.shiftright("seq_id", 33).alias("part")
    return lines.groupBy("file", part).agg(F.count("*").alias("n"), F.min("seq_id").alias("first"), F.min("block").alias("block"))


def _line_numbers(lines: DataFrame, parts: DataFrame | None = None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Number lines per file: rank inside a read split plus the lines of earlier splits."""
    before = Window.partitionBy("file").orderBy("block", "first").rowsBetween(Window.unboundedPreceding, -1)
    parts, n_parts = cut_measuring(_parts(lines) if parts is None else parts, F.count("*"))
    bases = parts.select("file", "part", "first", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    tagged = lines.withColumn("part", F.shiftright("seq_id", 33))
    # a split's lines stay where they were read
    return (lookup_join(tagged, bases, ["file", "part"], "inner", salt_from=["seq_id"], small=n_parts <= BROADCAST_ROWS)
            .select("file", "text", (F.col("base") + F.col("seq_id") - F.col("first")).alias("line"), *keep))


def _sequences(spark: SparkSession, path: str, column: str) -> DataFrame:
    numbered = _line_numbers(_numbered(spark, path))
    return numbered.where(F.col("line") % 4 == 1).select(F.expr("line div 4").alias("read_no"), F.col("text").alias(column))


def read_fastq(spark: SparkSession, r1: str, r2: str | None = None) -> DataFrame:
    """Sequence lines of one FASTQ file, or of two paired by their order in the file."""
    first = _sequences(spark, r1, "seq1")
    if r2 is None:
        return first
    return first.join(_sequences(spark, r2, "seq2"), "read_no")


def _headed(lines: DataFrame) -> DataFrame:
    """``lines`` with ``head``, whether a line is a header, and ``chrom``, the name in the last header of its split up to it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        split, last = None, None
        for batch in batches:
            if not batch.num_rows:
                continue
            heads = pc.starts_with(batch.column("text"), ">")
            found = pc.struct_field(pc.extract_regex(batch.column("text"), r"^>\s*(?P<name>\S*)"), "name").to_pylist()
            # a batch may hold the end of one file and the start of another
            places = pa.StructArray.from_arrays([batch.column("file"), pc.shift_right(batch.column("seq_id"), 33)], ["file", "part"]).to_pylist() if len(
                pc.unique(batch.column("file"))) > 1 else None
            first = places[0] if places else {"file": batch.column("file")[0].as_py(), "part": batch.column("seq_id")[0].as_py() >> 33}
            if first != split:
                split, last = first, None
            names = []
            for k, (head, name) in enumerate(zip(heads.to_pylist(), found, strict=True)):
                if places and places[k] != split:
                    split, last = places[k], None
                last = name if head else last
                names.append(last)
            yield pa.RecordBatch.from_arrays([*batch.columns, heads, pa.array(names, pa.string())], names=[*batch.schema.names, "head", "chrom"])

    return lines.mapInArrow(run, StructType([*lines.schema.fields, StructField("head", BooleanType()), StructField("chrom", StringType())]))


def read_fasta(spark: SparkSession, path: str) -> DataFrame:
    """(chrom, line_no, seq) upper-cased; the name is the first word of the header line.

    A line belongs to the last header before it in its file. Headers are carried along inside a
    read split; what a split begins with comes from a table with a row per split, so the work does
    not grow with headers times lines. Lines before the first header of a file are left out. Very
    long lines are cut into pieces.
    """
    raw = _numbered(spark, path)
    parts, n_parts = cut_measuring(_parts(raw), F.count("*"))
    headed = _headed(raw)
    ends = headed.where("head").groupBy("file", F.shiftright("seq_id", 33).alias("part")).agg(F.max_by("chrom", "seq_id").alias("last"))
    before = Window.partitionBy("file").orderBy("block", "first").rowsBetween(Window.unboundedPreceding, -1)
    carried = cut(parts.join(ends, ["file", "part"], "left").select("file", "part", F.last("last", ignorenulls=True).over(before).alias("carried")))
    numbered = _line_numbers(headed, parts, ("part", "head", "chrom")).where(~F.col("head") & (F.length(F.trim("text")) > 0))
    joined = lookup_join(numbered, carried, ["file", "part"], salt_from=["line"], small=n_parts <= BROADCAST_ROWS)
    joined = joined.withColumn("chrom", F.coalesce("chrom", "carried")).where("chrom is not null")
    text = F.upper(F.trim("text"))
    pieces = F.transform(F.sequence(F.lit(0), F.expr(f"(length(trim(text)) - 1) div {MAX_LINE}")),
                         lambda i: F.struct(i.alias("piece"), F.substr(text, i * MAX_LINE + 1, F.lit(MAX_LINE)).alias("seq")))
    rows = joined.select("chrom", "line", F.explode(pieces).alias("x"))
    return rows.select("chrom", (F.col("line") * MAX_LINE + F.col("x.piece")).cast("bigint").alias("line_no"), "x.seq")
