"""Inputs of the queries after the shared first steps, and the whole-experiment flow."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import duplicates, fragments, matrix, pairs, reads, statistics, tracks
from ..operators.support import cut
from . import inputs
from .stages import Stages, of_input

PAYLOAD = ("q1", "q2", "seq1", "seq2", "experiment")


def sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inputs.derive(spark, sf_dir, "sites")


def contact_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical pairs with fragments."""
    raw = pairs.canonical_pair(inputs.derive(spark, sf_dir, "raw_pairs"))
    return fragments.assign_fragments(raw, sites(spark, sf_dir))


def unique_contacts(spark: SparkSession, sf_dir: str, carry: tuple[str, ...] = ("q1", "q2")) -> DataFrame:
    return duplicates.unique_pairs(contact_pairs(spark, sf_dir), carry=carry)


def classified(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reads.classify(inputs.derive(spark, sf_dir, "alignments"))


def tagged(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = inputs.derive(spark, sf_dir, "alignments")
    return reads.tag_records(records, reads.classify(records))


def linked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged records with the mate's chromosome, as a sorted alignment file has it."""
    records = inputs.derive(spark, sf_dir, "alignments")
    found = cut(reads.classify(records))
    mates = found.where("rec1 is not null").select(
        "qname", F.explode(F.array(F.struct(F.col("rec1").alias("rec_no"), F.col("c2").alias("mate")),
                                   F.struct(F.col("rec2").alias("rec_no"), F.col("c1").alias("mate")))).alias("m"))
    mates = mates.select("qname", "m.*")
    rnext = F.when(F.col("mate").isNull(), "*").when(F.col("mate") == F.col("rname"), "=").otherwise(F.col("mate"))
    return reads.tag_records(records, found).join(mates, ["qname", "rec_no"], "left").withColumn("rnext", rnext).drop("mate")


def homologs(linked_: DataFrame) -> DataFrame:
    """A read-to-homolog map: one end of each read, some reads called for both homologs."""
    number = F.substring("qname", 3, 20).cast("bigint")
    own = linked_.where("rt between 0 and 5")
    called = own.where(F.col("rt") % 2 == number % 2).select(
        "qname", F.concat("rname", F.when(number % 3 == 0, "-a").otherwise("-r")).alias("homolog"), "rt")
    conflicting = own.where(number % 9 == 0).select("qname", F.concat("rname", F.lit("-r")).alias("homolog"), "rt")
    return called.unionByName(conflicting)


LEVELS = (1, 30)


def with_sequences(unique: DataFrame, alignments: DataFrame) -> DataFrame:
    """Sequences of both ends' records, where the alignments have them."""
    if "seq" not in alignments.columns:
        return unique
    # a chosen record is one of a read's first four
    own = alignments.where(F.col("rec_no") <= reads.MAX_RECORDS).select(reads.names.read_base_name(F.col("qname")).alias("qname"), "rec_no", "seq")
    for i in (1, 2):
        unique = unique.join(own.select("qname", F.col("rec_no").alias(f"rec{i}"), F.col("seq").alias(f"seq{i}")), ["qname", f"rec{i}"], "left")
    return unique


NORMS = ("VC", "VC_SQRT", "BALANCE")


def _leveled(levels: tuple[int, ...], make: Callable[[int], DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionByName, [make(q).withColumn("q", F.lit(q)) for q in levels])


def _norms(maps: DataFrame, levels: tuple[int, ...], kinds: tuple[str, ...]) -> DataFrame:
    return reduce(DataFrame.unionByName, [
        _leveled(levels, lambda q, kind=kind: matrix.norm_vectors(maps.where(F.col("q") == q).drop("q"), kind)) for kind in kinds])


def process(alignments: DataFrame, sites_: DataFrame | None, path: str, resolutions=matrix.RESOLUTIONS, junction: str = "GATCGATC",
            wobble: int = duplicates.WOBBLE, levels: tuple[int, ...] = LEVELS, sizes: DataFrame | None = None,
            norms: tuple[str, ...] = NORMS, stages: Stages | None = None) -> dict[str, DataFrame]:
    """A whole experiment: reads to contacts, statistics, matrices and normalisation.

    Duplicates and fragments follow the outer positions of the ends; contact lists, statistics
    and matrices use the interior ones. Statistics, histograms and matrices come for each
    mapping quality of ``levels`` (column ``q``); matrices hold all contacts at that quality, also
    those within a fragment. Without sites the ends get dummy fragments, and interior positions
    are moved by the average insert size; ``sizes`` then gives the chromosomes. Counters that
    need sequences are null when the alignments have none.

    Every result is a stage table under ``path``, a folder all executors reach. A rerun reads the
    stages that were finished from the same inputs with the same parameters and makes the others;
    ``stages`` tells which.
    """
    stages = stages or Stages(alignments.sparkSession, path)
    reads_in, sites_in = of_input(alignments), of_input(sites_)
    found = stages.table("classified", (reads_in,), lambda: reads.classify(alignments))
    insert = stages.table("insert", (stages.stage("classified"),), lambda: reads.insert_size(found))
    if sites_ is not None:
        sizes = fragments.chrom_sizes(sites_)

    def placed() -> DataFrame:
        if sites_ is None:
            return pairs.dummy_fragments(reads.adjust_insert_size(reads.accepted(found), insert))
        return fragments.assign_fragments(reads.accepted(found), sites_)

    unique = stages.table("unique", (stages.stage("classified"), sites_in, wobble), lambda: with_sequences(
        duplicates.unique_pairs(placed(), wobble, carry=("q1", "q2", "ip1", "ip2", "rec1", "rec2")), alignments))
    ends = [c for c in unique.columns if c.startswith("seq")]
    contacts = unique.withColumns({"p1": F.col("ip1"), "p2": F.col("ip2")}).select("qname", *pairs.SHORT_FORM, "q1", "q2", *ends)
    of_contacts = (stages.stage("unique"), sites_in, of_input(sizes), list(levels))
    maps = stages.table("matrix", (*of_contacts, list(resolutions)), lambda: _leveled(levels, lambda q: matrix.contact_matrix(contacts, resolutions, q, sizes)))
    return {
        "split_stats": stages.table("split_stats", (stages.stage("classified"),), lambda: reads.split_counters(found)),
        "insert_size": insert,
        "unique": unique,
        "contacts": contacts,
        "statistics": stages.table("statistics", (*of_contacts, junction), lambda: _leveled(levels, lambda q: statistics.contact_statistics(contacts, sites_, q, junction))),
        "hists": stages.table("hists", of_contacts, lambda: _leveled(levels, lambda q: statistics.hists(contacts, sites_, q))),
        "matrix": maps,
        "norm": stages.table("norm", (stages.stage("matrix"), list(norms)), lambda: _norms(maps, levels, norms)),
    }


def merge(experiments: list[dict[str, DataFrame]], path: str, norms: tuple[str, ...] = NORMS, stages: Stages | None = None) -> dict[str, DataFrame]:
    """Several processed experiments as one, from their stage tables.

    Contacts are put together in the order of chromosome pairs and positions, without removing
    duplicates across experiments. Statistics, histograms and matrices are added up from those
    stored, so no contact is counted again; only normalisation is made anew, from the merged maps.
    Results are stages under ``path`` like those of ``process``.
    """
    stages = stages or Stages(experiments[0]["matrix"].sparkSession, path)

    def every(name: str) -> tuple[list[DataFrame], tuple[str, ...]]:
        parts = [e[name] for e in experiments]
        return parts, tuple(of_input(p) for p in parts)

    lists, of_lists = every("contacts")
    stored, of_stored = every("matrix")
    stats, of_stats = every("statistics")
    counts, of_counts = every("hists")
    levels = tuple(r["q"] for r in stored[0].select("q").distinct().orderBy("q").collect())
    maps = stages.table("matrix", of_stored, lambda: pairs.merge_experiments(stored).groupBy("q", "res", *matrix.PIXEL).agg(F.sum("n").alias("n")))
    return {
        "contacts": stages.table("contacts", of_lists, lambda: pairs.merge_sorted(lists)),
        "statistics": stages.table("statistics", of_stats, lambda: statistics.add_contact_statistics(stats, ("q",))),
        "hists": stages.table("hists", of_counts, lambda: pairs.merge_experiments(counts).groupBy("q", "hist", "bin", "series").agg(F.sum("n").alias("n"))),
        "matrix": maps,
        "norm": stages.table("norm", (stages.stage("matrix"), list(norms)), lambda: _norms(maps, levels, norms)),
    }


def diploid(records: DataFrame, homologs_: DataFrame, path: str, resolutions=matrix.RESOLUTIONS, platform: str = "ILLUMINA",
            stages: Stages | None = None) -> dict[str, DataFrame]:
    """A diploid experiment from tagged ``records`` with mates and a read-to-homolog map ``homologs_``.

    Contacts within homologs, the matrix of all homologs and one set of matrices for each of the two, and accessibility
    tracks, of all reads and by homolog (raw and corrected). Results are stages under ``path`` like
    those of ``process``.
    """
    stages = stages or Stages(records.sparkSession, path)
    made_from = (of_input(records), of_input(homologs_))
    contacts = stages.table("homolog_contacts", made_from, lambda: tracks.assign_homologs(records, homologs_))
    of_contacts = (stages.stage("homolog_contacts"), list(resolutions))
    return {
        "contacts": contacts,
        "matrix": stages.table("diploid_matrix", of_contacts, lambda: matrix.homolog_matrices(contacts, resolutions)),
        "homolog_matrices": stages.table("homolog_matrices", of_contacts, lambda: matrix.homolog_matrices(contacts, resolutions, separate=True)),
        "track": stages.table("track", (made_from[0], platform), lambda: tracks.accessibility(records, platform)),
        "diploid_tracks": stages.table("diploid_tracks", (*made_from, platform), lambda: tracks.diploid_accessibility(records, homologs_, platform)),
    }
