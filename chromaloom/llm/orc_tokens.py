"""Token ids in ORC files, in ascending order of document ids.

Files hold runs of document ids that do not overlap, and each is sorted, so that stripe and row
index statistics prune by doc_id; Bloom filters on doc_id prune lookups inside the ranges. Ids are
an integer list column, which ORC run-length encodes. Stripes are read in parallel.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import tokens
from .support import body, release

END = 2
# Rows of one row index entry, and bytes of a stripe before compression.
INDEX_ROWS = 1000
STRIPE = 16 << 20

STORED = "doc_id long, part int, row long, part_start long, ids array<int>"


def write_ids(docs: DataFrame, path: str, vocabulary: str, end: int = END, parts: int | None = None,
              stripe: int = STRIPE, index_rows: int = INDEX_ROWS) -> None:
    """Encode ``docs(doc_id, text)``, add the id ``end`` to each and write ORC files under ``path``.

    Rows: doc_id, part (number of the file in ascending order), row and part_start (rows and ids
    of the part before this one) and ids. Rows of one doc_id are ordered by a hash of the text and
    then as they were read, so that one doc_id can fill more than one part. Null text is an empty
    text; null doc_ids come first; an empty table gives files without rows.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select("doc_id", body().alias("text"))
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text"), F.monotonically_increasing_id()]
    placed = rows.withColumn("_text_hash", order[1]).withColumn("_read", order[2])
    by: list[Column | str] = [order[0], "_text_hash", "_read"]
    dealt = placed.repartitionByRange(parts, *by).sortWithinPartitions(*by).select("doc_id", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part, row, before = tokens.byte_bpe(vocabulary), TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            done = 0
            for some in tokens.slices(batch.column(1)):
                flat, bounds = encoder.encode(some)
                n = len(some)
                # one more id at the end of each document
                flat, bounds = np.insert(flat, bounds[1:], end), bounds + np.arange(n + 1)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(done, n), pa.array(np.full(n, part, np.int32)), pa.array(row + np.arange(n)),
                    pa.array(before + bounds[:-1]), pa.ListArray.from_arrays(pa.array(bounds.astype(np.int32)), pa.array(flat.view(np.int32))),
                ], names=["doc_id", "part", "row", "part_start", "ids"])
                done, row, before = done + n, row + n, before + int(bounds[-1])
            release()

    (dealt.mapInArrow(run, STORED).write.option("orc.bloom.filter.columns", "doc_id").option("orc.row.index.stride", index_rows)
     .option("orc.stripe.size", stripe).option("compression", "zstd").orc(path))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """The stored rows; Spark splits files by stripes and pushes doc_id filters into them."""
    return spark.read.schema(STORED).orc(path)


def lookup(spark: SparkSession, path: str, doc_ids: list[int]) -> DataFrame:
    """Ids of some documents: ranges, row indexes and Bloom filters skip the other rows."""
    return read_ids(spark, path).where(F.col("doc_id").isin([int(d) for d in doc_ids])).select("doc_id", "ids")


def positions(spark: SparkSession, path: str) -> DataFrame:
    """Per document of the files: doc_id, start (ids of all documents before it), n_tokens, ids_crc32.

    The checksum is that of the ids as little-endian unsigned 32-bit integers. Starts within a
    part are stored; those of the parts come from one total per part.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column(3)
            bounds = lists.offsets.to_numpy()
            flat = lists.values.to_numpy(zero_copy_only=False).astype("<u4")
            sums = [zlib.crc32(flat[a:b]) for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(np.diff(bounds).astype(np.int64)), pa.array(sums, pa.int64())],
                                             names=["doc_id", "part", "part_start", "n_tokens", "ids_crc32"])

    stored = read_ids(spark, path)
    found = stored.select("doc_id", "part", "part_start", "ids").mapInArrow(
        run, "doc_id long, part int, part_start long, n_tokens long, ids_crc32 long")
    # one total per file: the driver adds up as many numbers as there are files
    totals = (stored.select("part", (F.col("part_start") + F.size("ids")).alias("n")).groupBy("part")
              .agg(F.max("n").alias("n")).orderBy("part").collect())
    starts = np.cumsum([0, *(r["n"] for r in totals)]).tolist()
    base = spark.createDataFrame([(r["part"], s) for r, s in zip(totals, starts)] or [(0, 0)], "part int, base long")
    return found.join(F.broadcast(base), "part").select(
        "doc_id", (F.col("base") + F.col("part_start")).alias("start"), "n_tokens", "ids_crc32")
