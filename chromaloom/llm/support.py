"""Helpers of this subpackage: Arrow rows, joins that stand hot keys, numbering."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.support import components, cut, cut_measuring, own_tables, shared_folder  # noqa: F401

# A key with more than this share of all rows is hot. So there are at most HOT_PARTS such keys,
# which bounds every table of hot keys that is broadcast.
HOT_PARTS = 1000
# Largest verdict or drop list that is broadcast, in rows of one or two longs; it is counted first.
BROADCAST_ROWS = 200_000
_C = ctypes.CDLL(None)


def body(text: str = "text") -> Column:
    """A text column with null read as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))


def by_batch(df: DataFrame, schema: str, each: Callable[[], Callable[[pa.RecordBatch], pa.RecordBatch]]) -> DataFrame:
    """Map Arrow batches; ``each`` is called once per task and makes the function of a batch."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fn = each()
        for batch in batches:
            if batch.num_rows:
                yield fn(batch)
            release()
    return df.mapInArrow(run, schema)


def release() -> None:
    """Give memory that Arrow and the C library keep for reuse back: Python workers stay between tasks and stages."""
    pa.default_memory_pool().release_unused()
    if hasattr(_C, "malloc_trim"):
        _C.malloc_trim(0)


def join_hot(rows: DataFrame, table: DataFrame, key: str, total: int, how: str = "left") -> DataFrame:
    """Join ``rows`` to ``table``, which has one row per key and the key's row count as ``_n``.

    Keys with over 1/HOT_PARTS of the ``total`` rows are broadcast: there are at most HOT_PARTS
    of them, whatever the data. Rows of all other keys are shuffled; none of their keys fills
    more than 1/HOT_PARTS of the rows. ``table`` should be a written table: it is read three times.
    """
    limit = max(total // HOT_PARTS, 1000)
    hot = table.where(F.col("_n") > limit).drop("_n")
    cold = table.where(F.col("_n") <= limit).drop("_n")
    marked = rows.join(F.broadcast(hot.select(key, F.lit(True).alias("_hot"))), key, "left")
    some = marked.where("_hot").drop("_hot").join(F.broadcast(hot), key, how)
    rest = marked.where("_hot is null").drop("_hot").join(cold.hint("shuffle_hash"), key, how)
    return some.unionByName(rest)


def numbered(rows: DataFrame, by: list[Column], index: str = "_index") -> tuple[DataFrame, int]:
    """``rows`` numbered from 0 in the order of ``by``, and their count.

    A range sort deals them over tasks, also within one value of the first columns; the driver
    adds up one count per task.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    row = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    placed = cut(rows.repartitionByRange(parts, *by).sortWithinPartitions(*by).select("*", F.spark_partition_id().alias("_part"), row.alias("_row")))
    starts, total = [], 0
    for r in placed.groupBy("_part").agg(F.count("*").alias("n")).orderBy("_part").collect():
        starts.append((r["_part"], total))
        total += r["n"]
    base = spark.createDataFrame(starts or [(0, 0)], "_part int, _base long")
    return placed.join(F.broadcast(base), "_part").withColumn(index, F.col("_base") + F.col("_row")).drop("_part", "_row", "_base"), total
