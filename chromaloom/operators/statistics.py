"""Sequencing and contact statistics, histograms and library complexity."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import measures, motifs
from .fragments import site_distance
from .pairs import contact_status, stack_ends

# fixed values: extents of the printed histograms
MAX_SITE_DISTANCE = 2000
MAX_MAPQ = 200

ORIENTATIONS = ("inner", "outer", "right", "left")
SUMMARY_COUNTERS = ("ligations", "total", "unmapped", "normal", "chimeric", "ambiguous", "singleton")


def with_percent(df: DataFrame, counters: list[str], total: Column, suffix: str) -> DataFrame:
    return df.withColumns({f"{c}_{suffix}": measures.pct(F.col(c), total) for c in counters})


def sequencing_summary(split_stats: DataFrame, dups: int | Column = 0, singdups: int | Column = 0,
                       single_end: bool = False) -> DataFrame:
    """Totals over splits with shares of the sequenced and of the alignable reads."""
    have = set(split_stats.columns)
    sums = [F.sum(c if c in have else F.lit(0)).cast("bigint").alias(c) for c in SUMMARY_COUNTERS]
    insert = F.avg("avg_insert") if "avg_insert" in have else F.lit(0.0)
    df = split_stats.agg(*sums, F.round(insert, 2).alias("avg_insert"))
    dups, singdups = (F.lit(d) if isinstance(d, int) else d for d in (dups, singdups))
    df = df.withColumns({"alignable": F.col("normal") + F.col("chimeric"),
                         "duplicates": dups.cast("bigint")})
    df = df.withColumn("unique", F.col("alignable") - F.col("duplicates"))
    counters = ["unmapped", "normal", "chimeric", "ambiguous", "alignable", "ligations", "unique", "duplicates"]
    if single_end:
        df = df.withColumn("single_duplicates", singdups.cast("bigint"))
        df = df.withColumns({
            "single_unique": F.col("singleton") - F.col("single_duplicates"),
            "no_chimera": F.col("unmapped") + F.col("singleton"),
            "total_unique": F.col("unique") + F.col("singleton") - F.col("single_duplicates"),
            "total_duplicates": F.col("duplicates") + F.col("single_duplicates")})
        counters += ["singleton", "no_chimera", "single_unique", "single_duplicates", "total_unique", "total_duplicates"]
        both = F.greatest("alignable", F.lit(1)) + F.greatest("singleton", F.lit(1))
        for c, base in (("single_unique", F.col("singleton")), ("single_duplicates", F.col("singleton")),
                        ("total_unique", both), ("total_duplicates", both)):
            df = with_percent(df, [c], base, "of_aligned_pct")
    df = with_percent(df, ["unique", "duplicates"], F.col("alignable"), "of_alignable_pct")
    return with_percent(df, counters, F.col("total"), "pct")


def count_ligations(reads: DataFrame, junction: str, seqs: tuple[str, ...] = ("seq1", "seq2")) -> DataFrame:
    """Read pairs in which either sequence contains the junction."""
    hit = reduce(lambda a, b: a | b, [motifs.has_junction(F.col(s), junction) for s in seqs])
    return reads.agg(F.count_if(hit).alias("ligations"), F.count("*").alias("reads"))


def _described(pairs: DataFrame, junction: str) -> DataFrame:
    """Per-contact facts that the counters below combine."""
    p1, p2 = F.col("p1"), F.col("p2")
    same = F.col("c1") == F.col("c2")
    dangling = motifs.dangling_motif(junction)

    def starts(seq: str) -> Column:
        if dangling is None or seq not in pairs.columns:
            return F.lit(False)
        return F.coalesce(F.startswith(F.col(seq), F.lit(dangling)), F.lit(False))

    ligated = F.lit(False)
    if "seq1" in pairs.columns:
        ligated = motifs.has_junction(F.col("seq1"), junction) | motifs.has_junction(F.col("seq2"), junction)
    return pairs.withColumns({
        "contact": F.col("status") == "contact",
        "same": same,
        "d": F.abs(p1 - p2),
        "orientation": F.when(same, measures.pair_orientation(F.col("s1"), p1, F.col("s2"), p2)),
        "dangling1": starts("seq1"), "dangling2": starts("seq2"), "ligated": ligated,
    }).withColumn("range", F.when(~F.col("same"), "inter").when(F.col("d") < measures.VERY_SHORT, "very_short")
                  .when(F.col("d") < measures.LONG_RANGE, "short").otherwise("long"))


def contact_statistics(pairs: DataFrame, sites: DataFrame | None = None, q: int = 1,
                       junction: str = "GATCGATC", total_reads: int | None = None) -> DataFrame:
    """One row of contact counters in a single pass over unique pairs.

    ``three_prime``/``five_prime`` and ``true_dangling_*`` need ``sites``; counters of junctions
    and dangling ends are null without sequences. Shares of the
    unique pairs, and of the sequenced reads when known, follow the counters.
    """
    df = _described(contact_status(pairs, q), junction)
    contact, d = F.col("contact"), F.col("d")
    is_long = F.col("range") == "long"
    dangling = F.col("dangling1") | F.col("dangling2")

    # without sequences nothing is known about junctions and dangling ends
    sequenced = "seq1" in pairs.columns

    def n(cond: Column, name: str) -> Column:
        if not sequenced and ("ligation" in name or "dangling" in name):
            return F.max(F.lit(None).cast("bigint")).alias(name)
        return F.count_if(contact & F.coalesce(cond, F.lit(False))).alias(name)

    aggs = [F.count("*").alias("unique_pairs"),
            F.count_if(F.col("status") == "intra_fragment").alias("intra_fragment"),
            F.count_if(F.col("status") == "below_mapq").alias("below_mapq"),
            F.count_if(contact).alias("contacts"),
            n(F.col("ligated"), "ligation"),
            *[n(F.col("range") == r, r) for r in ("inter", "very_short", "short", "long")],
            n(F.col("same"), "intra"),
            *[n(is_long & (F.col("orientation") == o), f"{o}_long") for o in ORIENTATIONS],
            n(dangling, "dangling"),
            *[n(dangling & (F.col("range") == r), f"dangling_{r}") for r in ("inter", "very_short", "short", "long")]]
    if sites is not None:
        df = site_distance(df, sites)
        far = ~F.col("same") | (d >= measures.LONG_RANGE)

        def five(i: int) -> Column:
            return F.when(F.col(f"near_lower{i}"), F.col(f"s{i}") == 0).otherwise(F.col(f"s{i}") == 16)

        def sided(test) -> Column:
            return sum((F.coalesce((contact & far & test(i)).cast("int"), F.lit(0)) for i in (1, 2)), F.lit(0))

        at_site = F.when(F.col("dangling1"), F.col("site_dist1")).otherwise(F.col("site_dist2")) == 1
        true = dangling & at_site
        aggs += [F.sum(sided(five)).alias("five_prime"), F.sum(sided(lambda i: ~five(i))).alias("three_prime"),
                 n(true & F.col("same") & (d < measures.LONG_RANGE), "true_dangling_intra_short"),
                 n(true & F.col("same") & (d >= measures.LONG_RANGE), "true_dangling_intra_long"),
                 n(true & ~F.col("same"), "true_dangling_inter")]
    counted = df.agg(*aggs)
    return _with_shares(counted, total_reads)


def _with_shares(counted: DataFrame, total_reads: int | None = None) -> DataFrame:
    """Counters of contacts with their shares of unique pairs, reads, long contacts and sided ends."""
    shares = ["intra_fragment", "below_mapq", "contacts", "ligation", "inter", "intra", "short", "long"]
    counted = with_percent(counted, shares, F.col("unique_pairs"), "of_unique_pct")
    if total_reads is not None:
        counted = with_percent(counted, shares, F.lit(total_reads), "of_reads_pct")
    for o in ORIENTATIONS:
        counted = with_percent(counted, [f"{o}_long"], F.col("long"), "pct")
    if "three_prime" in counted.columns:
        for c in ("three_prime", "five_prime"):
            counted = with_percent(counted, [c], F.col("three_prime") + F.col("five_prime"), "pct")
    return counted


def add_contact_statistics(parts: list[DataFrame], by: tuple[str, ...] = ()) -> DataFrame:
    """Statistics of several experiments as one: counters added up, shares taken anew."""
    every = reduce(DataFrame.unionByName, parts)
    counters = [c for c in every.columns if c not in by and not c.endswith("_pct")]
    return _with_shares(every.groupBy(*by).agg(*(F.sum(c).cast("bigint").alias(c) for c in counters)))


def pair_type_counts(pairs: DataFrame, q: int = 1) -> DataFrame:
    """Long-range contacts of one chromosome by orientation."""
    df = _described(contact_status(pairs, q).where("status = 'contact'"), motifs.UNKNOWN_JUNCTION)
    return (df.where("same").where(F.col("d") >= measures.LONG_RANGE)
            .groupBy("orientation").agg(F.count("*").alias("n")))


def ligation_in_pairs(pairs: DataFrame, junction: str, q: int = 1) -> DataFrame:
    contacts = contact_status(pairs, q).where("status = 'contact'")
    return count_ligations(contacts, junction)


def dangling_ends(pairs: DataFrame, junction: str, sites: DataFrame, q: int = 1) -> DataFrame:
    """Contacts whose end starts with half a junction, by range, and those cut at a site."""
    df = _described(contact_status(pairs, q).where("status = 'contact'"), junction)
    hit = df.where("dangling1 or dangling2")
    at_site = F.when(F.col("dangling1"), F.col("site_dist1")).otherwise(F.col("site_dist2")) == 1
    return site_distance(hit, sites).groupBy("range").agg(
        F.count("*").alias("dangling"), F.count_if(at_site).alias("at_site"))


def three_prime_bias(pairs: DataFrame, sites: DataFrame, q: int = 1) -> DataFrame:
    """Long-range ends by the fragment end they are nearer to."""
    df = _described(contact_status(pairs, q).where("status = 'contact'"), motifs.UNKNOWN_JUNCTION)
    far = site_distance(df.where(~F.col("same") | (F.col("d") >= measures.LONG_RANGE)), sites)
    ends = stack_ends(far, ["s", "near_lower"])
    five = F.when(F.col("near_lower"), F.col("s") == 0).otherwise(F.col("s") == 16)
    return ends.where("near_lower is not null").agg(
        F.count_if(five).alias("five_prime"), F.count_if(~five).alias("three_prime"))


def site_distance_hist(pairs: DataFrame, sites: DataFrame, q: int = 1, top: int = MAX_SITE_DISTANCE) -> DataFrame:
    """Ends per distance to the nearest site, 1 to ``top``."""
    contacts = contact_status(pairs, q).where("status = 'contact'").select("qname", "c1", "p1", "f1", "c2", "p2", "f2")
    ends = stack_ends(site_distance(contacts, sites), ["site_dist"])
    return (ends.where(F.col("site_dist").between(1, top))
            .groupBy(F.col("site_dist").cast("bigint").alias("bin")).agg(F.count("*").alias("n")))


def mapq_hist(pairs: DataFrame, q: int = 1, top: int = MAX_MAPQ) -> DataFrame:
    """Contacts per lower mapping quality: (bin, series, n) for all, intra and inter."""
    contacts = contact_status(pairs, q).where("status = 'contact'")
    low = F.least("q1", "q2").cast("bigint")
    same = F.col("c1") == F.col("c2")
    wide = contacts.where(low <= top).groupBy(low.alias("bin")).agg(
        F.count("*").alias("all"), F.count_if(same).alias("intra"), F.count_if(~same).alias("inter"))
    return wide.unpivot("bin", ["all", "intra", "inter"], "series", "n").where("n > 0")


def distance_hist(pairs: DataFrame, q: int = 1) -> DataFrame:
    """Contacts of one chromosome per log-spaced distance bin and orientation."""
    contacts = contact_status(pairs, q).where("status = 'contact' and c1 = c2")
    gap = F.abs(F.col("p1") - F.col("p2"))
    side = measures.pair_orientation(F.col("s1"), F.col("p1"), F.col("s2"), F.col("p2"))
    return contacts.groupBy(measures.log_bin(gap).alias("bin"), side.alias("series")).agg(F.count("*").alias("n"))


def hists(pairs: DataFrame, sites: DataFrame | None, q: int = 1) -> DataFrame:
    """All histograms as (hist, bin, series, n)."""
    parts = [mapq_hist(pairs, q).withColumn("hist", F.lit("B")), distance_hist(pairs, q).withColumn("hist", F.lit("D"))]
    if sites is not None:
        site = site_distance_hist(pairs, sites, q)
        parts.insert(0, site.select("bin", F.lit("all").alias("series"), "n", F.lit("A").alias("hist")))
    return reduce(DataFrame.unionByName, parts).select("hist", "bin", "series", "n")


def merge_hists(parts: list[DataFrame]) -> DataFrame:
    return (reduce(DataFrame.unionByName, parts).groupBy("hist", "bin", "series").agg(F.sum("n").alias("n")))


def merge_stats(stats: DataFrame, counters: tuple[str, ...]) -> DataFrame:
    """Sum counters over experiments, average the insert size, recompute the shares."""
    aggs = [F.sum(c).cast("bigint").alias(c) for c in counters]
    if "avg_insert" in stats.columns:
        aggs.append(F.round(F.avg("avg_insert"), 2).alias("avg_insert"))
    merged = stats.agg(*aggs)
    return with_percent(merged, [c for c in counters if c != "total"], F.col("total"), "pct")


def library_complexity(unique: Column, total: Column) -> Column:
    """Distinct molecules in the library, from c / x = 1 - exp(-n / x); null without duplicates.

    The root is bracketed in multiples of c by powers of ten, then halved until it stops
    moving, at most a thousand times. Meant for aggregated rows.
    """
    c, n = unique.cast("double"), total.cast("double")

    def f(x: Column) -> Column:
        return c / x - 1 + F.exp(-n / x)

    bracket = F.aggregate(
        F.sequence(F.lit(1), F.lit(300)),
        F.struct(F.lit(1.0).alias("lo"), F.lit(100.0).alias("hi"), F.lit(False).alias("done")),
        lambda a, _: F.when(a["done"] | (f(a["hi"] * c) < 0), F.struct(
            a["lo"].alias("lo"), a["hi"].alias("hi"), F.lit(True).alias("done")))
        .otherwise(F.struct(a["hi"].alias("lo"), (a["hi"] * 10.0).alias("hi"), F.lit(False).alias("done"))),
        lambda a: F.struct(a["lo"].alias("lo"), a["hi"].alias("hi"), F.lit(False).alias("done")))

    def halve(a: Column, _: Column) -> Column:
        mid = (a["lo"] + a["hi"]) / 2.0
        value = f(mid * c)
        return (F.when(a["done"] | (value == 0), F.struct(a["lo"].alias("lo"), a["hi"].alias("hi"), F.lit(True).alias("done")))
                .when(value > 0, F.struct(mid.alias("lo"), a["hi"].alias("hi"), F.lit(False).alias("done")))
                .otherwise(F.struct(a["lo"].alias("lo"), mid.alias("hi"), F.lit(False).alias("done"))))

    solved = F.aggregate(F.sequence(F.lit(1), F.lit(1000)), bracket, halve,
                         lambda a: (c * (a["lo"] + a["hi"]) / 2.0).cast("bigint"))
    return F.when((total > unique) & (unique > 0), solved)


def conversion_report(cytosine: DataFrame) -> DataFrame:
    """Bisulfite conversion and coverage, CpG against the other contexts."""
    cpg = F.col("context") == "CG"
    covered = F.col("n_meth") + F.col("n_unmeth") > 0
    unmeth = covered & (F.col("n_meth") < F.col("n_unmeth"))
    counts = cytosine.agg(*[
        F.count_if(scope & test).alias(f"{name}_{what}")
        for name, scope in (("chx", ~cpg), ("cpg", cpg))
        for what, test in (("unmeth", unmeth), ("meth", covered & ~unmeth), ("sites", F.lit(True)))])
    out = {}
    for name in ("chx", "cpg"):
        hits = F.col(f"{name}_unmeth") + F.col(f"{name}_meth")
        out[f"conv_{name}"] = F.round(F.col(f"{name}_unmeth") * 100.0 / (hits + 1), 2)
        out[f"cov_{name}"] = F.round(F.try_divide(hits * 100.0, F.col(f"{name}_sites")), 2)
    return counts.withColumns(out)
