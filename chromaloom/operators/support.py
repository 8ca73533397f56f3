"""Scale helpers: size-checked broadcast, salted lookups, intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

# Largest lookup table sent to every executor: rows of a few longs and a short name each.
# Callers with wider rows pass a lower limit or their own size check.
BROADCAST_ROWS = 2_000_000
SALTS = 16

# tables written by ``cut`` in this session, outside of blocks of ``own_tables``
WRITTEN: list[str] = []
_BLOCK: ContextVar[list[str] | None] = ContextVar("block", default=None)


def lookup_join(df: DataFrame, lookup: DataFrame, on: list[str], how: str = "left",
                salt_from: list[str] | None = None, max_rows: int = BROADCAST_ROWS,
                salts: int = SALTS, small: bool | None = None) -> DataFrame:
    """Join a large side to a lookup that has one row per key.

    A lookup of checked size is broadcast. A larger one is shuffled, with every key
    spread over ``salts`` tasks so that one hot key does not end in one task. ``small``
    passes on a size check the caller has already made; without it the lookup is written once
    and counted on the way.
    """
    if small is None:
        lookup, rows = cut_measuring(lookup, F.count("*"))
        small = rows <= max_rows
    if small:
        return df.join(F.broadcast(lookup), on, how)
    salted = df.withColumn("_salt", row_salt(salt_from or df.columns, salts))
    copies = lookup.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(copies.hint("merge"), [*on, "_salt"], how).drop("_salt")


def row_salt(columns: list[str], salts: int = SALTS) -> Column:
    """Salt that stays the same when a task is run again."""
    plain = [F.col(c) for c in columns]
    return F.pmod(F.xxhash64(*plain), F.lit(salts)).cast("int")


def number_within(df: DataFrame, key: Column, order: list[Column | str], number: str, size: str) -> DataFrame:
    """Number the rows of each key in ``order`` from 1 and count them; all rows stay.

    A range sort over key and order deals a hot key over many partitions. Windows work inside
    one partition; what a key has in earlier partitions is added from a table with at most one
    key per border between partitions.
    """
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    by = ["_key", *order]
    placed = cut(df.withColumn("_key", F.coalesce(key.cast("string"), F.lit(""))).repartitionByRange(parts, *by).sortWithinPartitions(*by)
                 .select("*", F.spark_partition_id().alias("_part"), F.monotonically_increasing_id().alias("_row")))
    spans = placed.groupBy("_part").agg(F.min("_key").alias("first"), F.max("_key").alias("last")).orderBy("_part").collect()
    split = sorted({a["last"] for a, b in zip(spans, spans[1:]) if a["last"] == b["first"]})
    counts = (placed.join(F.broadcast(spark.createDataFrame([(k,) for k in split], "_key string")), "_key")
              .groupBy("_key", "_part").count().orderBy("_key", "_part").collect())
    totals: dict[str, int] = {}
    before = []
    for r in counts:
        before.append((r["_key"], r["_part"], totals.get(r["_key"], 0)))
        totals[r["_key"]] = totals.get(r["_key"], 0) + r["count"]
    bases = spark.createDataFrame([(*b, totals[b[0]]) for b in before], "_key string, _part int, _base long, _total long")
    here = Window.partitionBy("_part", "_key")
    numbered = placed.withColumns({"_no": F.row_number().over(here.orderBy("_row")), "_n": F.count("*").over(here)})
    joined = numbered.join(F.broadcast(bases), ["_key", "_part"], "left")
    return joined.withColumns({number: F.col("_no") + F.coalesce("_base", F.lit(0)), size: F.coalesce("_total", "_n")}).drop(
        "_key", "_part", "_row", "_no", "_n", "_base", "_total")


def shared_folder(spark: SparkSession) -> str:
    """Folder for intermediate tables, shared by all executors.

    It is the one the cluster names in ``spark.checkpoint.dir``. Only a local session
    without that setting gets a folder of its own.
    """
    sc = spark.sparkContext
    if not sc.getCheckpointDir():
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None:
            if not sc.master.startswith("local"):
                raise ValueError("set spark.checkpoint.dir to a folder all executors share")
            named = tempfile.mkdtemp(prefix="chromaloom-checkpoint-")
        sc.setCheckpointDir(named)
    return sc.getCheckpointDir()


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a table in the shared folder and go on from there.

    The lineage ends at the files, so a lost executor costs no recomputation, and later
    steps read only the columns and rows they need and know the table's size.
    """
    path = f"{shared_folder(df.sparkSession)}/stage-{uuid.uuid4().hex}"
    block = _BLOCK.get()
    (WRITTEN if block is None else block).append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def own_tables(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """A block whose tables are deleted at its end, but for those written by the function it gives.

        with own_tables(spark) as keep:
            result = keep(frame_over_tables_of_the_block)

    Kept tables belong to the block around, if there is one, or stay until ``drop_stages``. Tables
    of other blocks and callers are left alone.
    """
    outer, mine = _BLOCK.get(), []
    inside = _BLOCK.set(mine)

    def keep(df: DataFrame) -> DataFrame:
        here = _BLOCK.set(outer)
        try:
            return cut(df)
        finally:
            _BLOCK.reset(here)

    try:
        yield keep
    finally:
        _BLOCK.reset(inside)
        _delete(spark, mine)


def _delete(spark: SparkSession, paths: list[str]) -> int:
    conf, fs = spark.sparkContext._jsc.hadoopConfiguration(), spark.sparkContext._jvm.org.apache.hadoop.fs
    dropped = 0
    while paths:
        path = fs.Path(paths.pop())
        dropped += bool(path.getFileSystem(conf).delete(path, True))
    return dropped


def drop_stages(spark: SparkSession) -> int:
    """Delete the tables that ``cut`` has written so far outside of blocks; returns their number.

    For callers that have written or collected all their results: frames that still read a stage
    fail afterwards. A query that shares the session with others takes ``own_tables``.
    """
    return _delete(spark, WRITTEN)


def cut_measuring(df: DataFrame, measure: Column) -> tuple[DataFrame, int]:
    """``cut`` that also evaluates an aggregate over the rows while they are written."""
    seen = Observation()
    table = cut(df.observe(seen, measure.alias("n")))
    return table, seen.get["n"] or 0


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest reachable node for every node of an undirected graph: columns node, root (longs).

    Each round hooks every root below the smallest root among its neighbours and then jumps
    pointers, so the number of rounds grows with the logarithm of the longest path. Only
    minima per node are aggregated, with map-side combining: no neighbour list is gathered.
    A star's centre has one row as a lookup, and its many rows on the other side are split
    by the skew rules of the join. A null end is no link.
    """
    both = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull() & (F.col(a) != F.col(b)))
    pairs = cut(both.select(F.least(a, b).alias("u"), F.greatest(a, b).alias("v")).distinct())
    labels = cut(pairs.select(F.explode(F.array("u", "v")).alias("node")).distinct().withColumn("root", F.col("node")))
    while True:
        # links between the current roots
        up = pairs.join(labels.select(F.col("node").alias("u"), F.col("root").alias("ru")), "u")
        up = up.join(labels.select(F.col("node").alias("v"), F.col("root").alias("rv")), "v")
        pairs = cut(up.where("ru != rv").select(F.least("ru", "rv").alias("u"), F.greatest("ru", "rv").alias("v")).distinct())
        if pairs.isEmpty():
            return labels
        hooks = cut(pairs.groupBy(F.col("v").alias("node")).agg(F.min("u").alias("root")))
        hooks = _jump(hooks)
        labels = cut(labels.join(hooks.select(F.col("node").alias("root"), F.col("root").alias("_up")), "root", "left")
                     .select("node", F.coalesce("_up", "root").alias("root")))


def _jump(hooks: DataFrame) -> DataFrame:
    """Follow parents (each smaller than its child) to the top, doubling the step each time."""
    while True:
        above = hooks.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        hooks, moved = cut_measuring(
            hooks.join(above, "root", "left").select("node", F.coalesce("_up", "root").alias("root"),
                                                     F.col("_up").isNotNull().cast("long").alias("_moved")),
            F.sum("_moved"))
        hooks = hooks.drop("_moved")
        if not moved:
            return hooks
