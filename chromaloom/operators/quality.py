"""Consistency of splits and stages."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

CLASSES = ("unmapped", "normal", "chimeric", "ambiguous", "singleton")


def _sum_of_classes(stats: DataFrame):
    present = [c for c in CLASSES if c in stats.columns]
    return sum((F.coalesce(F.col(c), F.lit(0)) for c in present), F.lit(0).cast("bigint"))


def splits_to_redo(inputs: DataFrame, stats: DataFrame) -> DataFrame:
    """Splits without counters, with a zero total or with classes that do not add up."""
    judged = inputs.select("split").join(stats, "split", "left")
    reason = (F.when(F.col("total").isNull(), "absent").when(F.col("total") == 0, "empty")
              .when(F.col("total") != _sum_of_classes(stats), "inconsistent"))
    return judged.select("split", reason.alias("reason")).where("reason is not null")


def consistency(stats: DataFrame, linecounts: DataFrame) -> DataFrame:
    """Whether classes add up to the total, and sequence lines / 4 to the reads."""
    sums = stats.agg(F.sum("total").alias("total"), F.sum(_sum_of_classes(stats)).alias("classified"))
    lines = linecounts.agg((F.sum("lines") / 4).cast("bigint").alias("reads"))
    # two one-row aggregates side by side
    return sums.withColumn("one", F.lit(1)).join(lines.withColumn("one", F.lit(1)), "one").drop("one").withColumns({
        "classes_add_up": F.col("total") == F.col("classified"), "reads_add_up": F.col("total") == F.col("reads")})


def paired_count(alignments: DataFrame) -> DataFrame:
    """Records flagged as paired, counted twice."""
    return alignments.agg((F.count_if(F.col("flag").bitwiseAND(F.lit(1)) == 1) * 2).alias("paired"))


def bad_sequences(pairs: DataFrame) -> DataFrame:
    """Pairs whose sequence columns are not DNA."""
    from ..functions.names import is_dna
    return pairs.where(~(is_dna(F.col("seq1")) & is_dna(F.col("seq2"))))
