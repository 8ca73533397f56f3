"""Restriction fragments: rank lookup, bounding sites and distances."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .support import cut_measuring, lookup_join

BIN = 4096
FRAGMENT_BIN = 1024

# Largest bin table that is broadcast, in longs: 160 MB, above that of a mammalian genome
# cut by a four-base enzyme.
SITE_WEIGHT = 20_000_000


def chrom_sizes(sites: DataFrame) -> DataFrame:
    """The last site of a chromosome is its length."""
    return sites.groupBy("chrom").agg(F.max_by("pos", "idx").alias("length"))


def site_bins(sites: DataFrame, size: int = BIN) -> DataFrame:
    """One row per chromosome and ``size``-bp bin up to the last site.

    ``base`` counts the sites in earlier bins and ``inside`` holds this bin's sites, at
    most ``size`` of them, so the rank of any position needs one row. ``low`` and
    ``high`` are the nearest sites outside the bin. The table grows with the genome,
    not with the reads.
    """
    filled = (sites.withColumn("bin", F.expr(f"pos div {size}"))
              .groupBy("chrom", "bin").agg(F.array_sort(F.collect_set("pos")).alias("inside")))
    every = (sites.groupBy("chrom").agg(F.max(F.expr(f"pos div {size}")).alias("last_bin"))
             .select("chrom", "last_bin", F.explode(F.sequence(F.lit(0).cast("bigint"), "last_bin")).alias("bin")))
    before = Window.partitionBy("chrom").orderBy("bin").rowsBetween(Window.unboundedPreceding, -1)
    # running from the far end: a frame that ends there would be gone through again for every bin
    after = Window.partitionBy("chrom").orderBy(F.desc("bin")).rowsBetween(Window.unboundedPreceding, -1)
    empty = F.array().cast("array<bigint>")
    return (every.join(filled, ["chrom", "bin"], "left")
            .withColumn("inside", F.coalesce("inside", empty))
            .select("chrom", "bin", "last_bin", "inside",
                    F.coalesce(F.sum(F.size("inside")).over(before), F.lit(0)).alias("base"),
                    F.max(F.array_max("inside")).over(before).alias("low"),
                    F.min(F.array_min("inside")).over(after).alias("high")))


def _last_bins(bins: DataFrame) -> DataFrame:
    return bins.groupBy("chrom").agg(F.first("last_bin").alias("_last"))


def assign_fragments(df: DataFrame, sites: DataFrame, sides: tuple[str, ...] = ("1", "2"),
                     chrom: str = "c", pos: str = "p", out: str = "f", size: int = BIN,
                     max_rows: int = SITE_WEIGHT, bounds: bool = False) -> DataFrame:
    """Fragment = number of sites at or below the position, 0 on an unknown chromosome.

    The position's bin row carries everything needed, so this is an equi-join instead of
    a range join. With ``bounds`` the two sites around each end are added as ``lo``/``hi``.
    """
    # stored once for both ends; its weight is its rows plus its sites
    weight = F.sum(1 + F.size("inside"))
    bins, total = cut_measuring(site_bins(sites, size).withColumnRenamed("bin", "_bin"), weight)
    small = total <= max_rows
    for side in sides:
        c, p = f"{chrom}{side}", f"{pos}{side}"
        table = bins.withColumnRenamed("chrom", c)
        # positions past the last bin use the last bin; chromosomes are few
        last = _last_bins(bins).withColumnRenamed("chrom", c)
        probe = lookup_join(df, last, [c], salt_from=[c, p, *_spread(df)], small=small)
        probe = probe.withColumn("_bin", F.least(F.expr(f"{p} div {size}"), F.col("_last")))
        joined = lookup_join(probe, table, [c, "_bin"], salt_from=[c, p, *_spread(df)], small=small)
        below = F.filter("inside", lambda s: s <= F.col(p))
        new = {f"{out}{side}": F.coalesce(F.col("base") + F.size(below), F.lit(0)).cast("bigint")}
        if bounds:
            above = F.filter("inside", lambda s: s > F.col(p))
            new[f"lo{side}"] = F.coalesce(F.array_max(below), F.col("low"))
            new[f"hi{side}"] = F.coalesce(F.array_min(above), F.col("high"))
        df = joined.withColumns(new).drop("_last", "_bin", "last_bin", "inside", "base", "low", "high")
    return df


def _spread(df: DataFrame) -> list[str]:
    return ["qname"] if "qname" in df.columns else []


def fragment_bins(sites: DataFrame, size: int = FRAGMENT_BIN) -> DataFrame:
    """Sites of every run of ``size`` fragments, with the last one before it: (chrom, fbin, first, inside).

    ``inside`` holds the sites from rank ``first`` on. Fragment f lies between the sites of rank
    f - 1 and f.
    """
    run = F.expr(f"idx div {size}")
    # the last site of a run is also the lower bound of the next run's first fragment
    runs = F.when(F.col("idx") % size == size - 1, F.array(run, run + 1)).otherwise(F.array(run))
    return (sites.select("chrom", "idx", "pos", F.explode(runs).alias("fbin")).groupBy("chrom", "fbin")
            .agg(F.min("idx").alias("first"), F.array_sort(F.collect_list(F.struct("idx", "pos"))).alias("s"))
            .select("chrom", "fbin", "first", F.transform("s", lambda x: x["pos"]).alias("inside")))


def nearest_site(pos: Column, frag: Column, lo: Column, hi: Column) -> tuple[Column, Column]:
    """Distance to the nearer bounding site and whether that is the lower one.

    On fragment 0 the lower end is position 0. Past the last site only the lower counts.
    """
    low = F.when(frag == 0, pos).otherwise(F.abs(pos - lo))
    high = F.abs(pos - hi)
    distance = F.least(low, high)
    return distance, low <= F.coalesce(high, low)


def site_distance(pairs: DataFrame, sites: DataFrame, sides: tuple[str, ...] = ("1", "2"),
                  max_rows: int = SITE_WEIGHT, size: int = FRAGMENT_BIN) -> DataFrame:
    """Add ``site_dist`` and ``near_lower`` per end, from the fragments already assigned.

    The table of bounding sites is stored and weighed once for both ends.
    """
    bins, weight = cut_measuring(fragment_bins(sites, size), F.sum(1 + F.size("inside")))
    for side in sides:
        frag = F.col(f"f{side}")
        table = bins.select(F.col("chrom").alias(f"c{side}"), F.col("fbin").alias("_fbin"), F.col("first").alias("_first"), F.col("inside").alias("_inside"))
        joined = lookup_join(pairs.withColumn("_fbin", F.expr(f"f{side} div {size}")), table, [f"c{side}", "_fbin"],
                             salt_from=[f"p{side}", *_spread(pairs)], small=weight <= max_rows)
        lo, hi = (F.get("_inside", (frag - i - F.col("_first")).cast("int")) for i in (1, 0))
        distance, lower = nearest_site(F.col(f"p{side}"), frag, lo, hi)
        # an end on an unknown chromosome has no distance
        known = F.col("_first").isNotNull()
        pairs = joined.withColumns({f"site_dist{side}": F.when(known, distance), f"near_lower{side}": F.when(known, lower)}).drop(
            "_fbin", "_first", "_inside")
    return pairs
