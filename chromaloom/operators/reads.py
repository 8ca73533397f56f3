"""Read groups: classification, tagging, mate pairing and insert size."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import cigar as cg
from ..functions import flags, measures, names
from .support import lookup_join, number_within

# Reads with more records than this are ambiguous whatever the records say, so a group
# never needs more than its first four records and a count.
MAX_RECORDS = 4
NEAR = 1000
INNER_INSERT = 1000


def record_ordinals(alignments: DataFrame, order: list | None = None) -> DataFrame:
    """Number all records within each read when the input has no order of its own.

    Adds ``rec_no`` and the group size ``k``; no read is gathered, however many records it has.
    """
    order = order or [F.col("flag").bitwiseAND(F.lit(64)).desc(), F.col("flag").bitwiseAND(F.lit(256)),
                      "rname", "pos", "cigar"]
    base = alignments.withColumn("qname", names.read_base_name(F.col("qname")))
    return number_within(base, F.col("qname"), order, "rec_no", "k")


def _prepared(alignments: DataFrame) -> DataFrame:
    flag, cig, pos = F.col("flag"), F.col("cigar"), F.col("pos")
    strand = flags.strand(flag)
    secondary = flags.has_flag(flag, flags.SECONDARY)
    five = cg.five_prime_pos(pos, cig, strand, secondary)
    return alignments.withColumns({
        "_end": names.read_end(F.col("qname"), flag),
        "_strand": strand.cast("int"),
        "_sec": secondary,
        "_mapped": flags.lacks_flag(flag, flags.UNMAPPED),
        "_chrom": names.clean_chrom(F.col("rname")),
        "_pos": five,
    }).withColumns({
        "_ip": cg.interior_pos(F.col("_pos"), cig, F.col("_strand"), F.col("_sec")),
        "_ep": cg.outer_pos(pos, cig, F.col("_strand"), F.col("_sec")),
    })


def _groups(alignments: DataFrame, carry: list[str]) -> DataFrame:
    """One row per read: size and at most four narrow records, partially combined map-side."""
    fields = F.struct(
        F.col("rec_no"), F.col("_end").alias("end"), F.col("_strand").alias("s"), F.col("_sec").alias("sec"),
        F.col("_mapped").alias("mapped"), F.col("_chrom").alias("c"), F.col("_pos").alias("p"),
        F.col("_ip").alias("ip"), F.col("_ep").alias("ep"), F.col("mapq").alias("q"), F.col("cigar").alias("cigar"))
    size = F.max("k") if "k" in alignments.columns else F.count("*")
    kept = F.collect_list(F.when(F.col("rec_no") <= MAX_RECORDS, fields))
    return (_prepared(alignments).groupBy(names.read_base_name(F.col("qname")).alias("qname"))
            .agg(size.alias("k"), F.sort_array(kept).alias("r"), *[F.min(c).alias(c) for c in carry]))


def classify(alignments: DataFrame, single_end: bool = False, distance: str = "strict",
             carry: tuple[str, ...] = ("split",), rules: str = "current") -> DataFrame:
    """One row per read: status, read type and the two chosen ends in canonical order.

    ``alignments`` needs qname, rec_no (1.. within the read), flag, rname, pos, mapq and
    cigar. ``rt`` is the read type of end 1 (end 2 has ``rt + 1``); ``rec1``/``rec2`` name
    the records chosen. ``p`` is the outer 5' position and ``ip`` the interior one.
    ``rules='legacy'`` drops the strand, end and secondary tests and takes the mate that
    is farther from the lone end.
    """
    if rules not in ("current", "legacy"):
        raise ValueError(f"unknown rules: {rules}")
    legacy = rules == "legacy"
    carry_cols = [c for c in carry if c in alignments.columns]
    rec = {i: F.get("r", F.lit(i - 1)) for i in range(1, MAX_RECORDS + 1)}
    k = F.col("k")

    def apart(i: int, j: int) -> Column:
        return measures.genome_distance(rec[i]["c"], rec[i]["p"], rec[j]["c"], rec[j]["p"], distance)

    def near(i: int, j: int) -> Column:
        close = F.coalesce(apart(i, j) < NEAR, F.lit(False))
        if legacy:
            return close
        return (close & (rec[i]["s"] != rec[j]["s"]) & (rec[i]["end"] != rec[j]["end"])
                & (rec[i]["sec"] | rec[j]["sec"]))

    ends = [(i, j) for i in range(1, 5) for j in range(i + 1, 5)]
    groups = _groups(alignments, carry_cols).withColumns({
        **{f"near{i}{j}": near(i, j) for i, j in ends},
        **{f"sec{i}": rec[i]["sec"] for i in rec},
        "end12": rec[1]["end"] == rec[2]["end"], "end13": rec[1]["end"] == rec[3]["end"]})

    def flag(name: str, i: int, j: int) -> Column:
        return F.coalesce(F.col(f"{name}{i}{j}"), F.lit(False))

    # a choice is three record numbers: end A, end B, and the record giving B's interior side
    def primary(i: int, j: int) -> Column:
        return F.when(F.col(f"sec{i}"), j).otherwise(i)

    def other(i: int, j: int) -> Column:
        return F.when(F.col(f"sec{i}"), i).otherwise(j)

    def choice(a, b, inside) -> Column:
        return F.array(*[x if isinstance(x, Column) else F.lit(x) for x in (a, b, inside)])

    def lone(b: int, i: int, j: int) -> Column:
        if not legacy:
            return choice(primary(i, j), b, other(i, j))
        far = F.coalesce(apart(i, b), F.lit(2 ** 62)) > F.coalesce(apart(j, b), F.lit(2 ** 62))
        return choice(F.when(far, i).otherwise(j), b, F.when(far, j).otherwise(i))

    def crossed(i: int, j: int, m: int, n: int) -> Column:
        return choice(primary(i, j), primary(m, n), other(m, n))

    if single_end:
        chosen = F.when(k == 2, choice(primary(1, 2), other(1, 2), other(1, 2)))
    else:
        three = (k == 3) & (flag("near", 1, 2) | flag("near", 1, 3) | flag("near", 2, 3))
        four = k == 4
        chosen = (F.when(k == 2, choice(1, 2, 2))
                  .when(three & flag("end", 1, 2), lone(3, 1, 2)).when(three & flag("end", 1, 3), lone(2, 1, 3))
                  .when(three, lone(1, 2, 3))
                  .when(four & flag("near", 1, 3) & flag("near", 2, 4), crossed(1, 3, 2, 4))
                  .when(four & flag("near", 1, 4) & flag("near", 2, 3), crossed(1, 4, 2, 3))
                  .when(four & flag("near", 1, 2) & flag("near", 3, 4), crossed(1, 2, 3, 4)))

    def record(at: int) -> Column:
        return F.get("r", F.get("x", F.lit(at)) - 1)

    picked = groups.select("qname", "k", "r", *carry_cols, chosen.alias("x")).withColumns(
        {"a": record(0), "b": record(1), "inside": record(2)["ip"]})
    both = F.col("a.mapped") & F.col("b.mapped")
    status = (F.when((k == 1) & ~rec[1]["mapped"], "unmapped")
              .when((k == 1) & F.lit(not legacy), "singleton")
              .when(F.col("x").isNull(), "ambiguous")
              .when(~both, "unmapped")
              .when((k == 2) & F.lit(not single_end), "normal").otherwise("chimeric"))
    b_strand = F.when(F.col("b.s") == 0, 16).otherwise(0) if single_end else F.col("b.s")
    judged = picked.withColumns({"status": status, "b_strand": b_strand.cast("int")})
    paired = F.col("status").isin("normal", "chimeric")
    first = F.struct("a.c", "a.s", "a.p") <= F.struct("b.c", "b_strand", "b.p")
    ranked = judged.withColumn("keep", F.when(paired, first))

    def at(letter: str) -> Column:
        inside = F.col("a.ip") if letter == "a" else F.col("inside")
        outer = F.col("b.ep") if single_end and letter == "b" else F.col(f"{letter}.p")
        strand = F.col("b_strand") if letter == "b" else F.col("a.s")
        block = inside if single_end else F.col(f"{letter}.p")
        return F.struct(strand.cast("int").alias("s"), F.col(f"{letter}.c").alias("c"), block.alias("p"), inside.alias("ip"),
                        outer.alias("ep"), F.col(f"{letter}.q").alias("q"), F.col(f"{letter}.cigar").alias("cigar"),
                        F.col(f"{letter}.rec_no").alias("rec"))

    sided = ranked.withColumns({"one": F.when(F.col("keep"), at("a")).when(~F.col("keep"), at("b")),
                                "two": F.when(F.col("keep"), at("b")).when(~F.col("keep"), at("a"))})
    rt = (F.when(F.col("status") == "normal", 0)
          .when(F.col("status") == "chimeric", F.when(k == 2, 0).when(k == 3, 2).otherwise(4))
          .when(F.col("status") == "singleton", 7).when(F.col("status") == "ambiguous", 8))
    out = {f"{f}{i}": F.col(f"{side}.{f}") for i, side in ((1, "one"), (2, "two"))
           for f in ("s", "c", "p", "ip", "ep", "q", "cigar", "rec")}
    if single_end:
        solo, only = F.col("status") == "singleton", rec[1]
        block = {"s1": only["s"], "s2": only["s"], "c1": only["c"], "c2": only["c"], "p1": only["p"],
                 "p2": cg.interior_pos(only["p"], only["cigar"], only["s"], F.lit(False))}
        out.update({n: F.when(solo, v).otherwise(out[n]) for n, v in block.items()})
    row = F.struct(F.col("status"), rt.cast("int").alias("rt"), *[v.alias(n) for n, v in out.items()])
    # unpacked by a generator, so that filters on the result are not rewritten in terms of the records
    return sided.select("qname", "k", *carry_cols, F.inline(F.array(row)))


def accepted(classified: DataFrame) -> DataFrame:
    """Reads that make a contact."""
    return classified.where(F.col("status").isin("normal", "chimeric"))


def tag_records(alignments: DataFrame, classified: DataFrame) -> DataFrame:
    """Write read type, interior positions and mate quality back on every record.

    A record past the fourth can only belong to an ambiguous read, so only the first four
    of each read are joined by name.
    """
    verdict = classified.select(F.col("qname").alias("_name"), "status", F.col("rt").alias("_rt"), "rec1", "rec2",
                                "ip1", "ip2", F.col("q1").alias("_q1"), F.col("q2").alias("_q2"))
    early = alignments.where(F.col("rec_no") <= MAX_RECORDS).withColumn("_name", names.read_base_name(F.col("qname")))
    first, second = F.col("rec_no") == F.col("rec1"), F.col("rec_no") == F.col("rec2")
    paired = F.col("status").isin("normal", "chimeric")
    tagged = early.join(verdict, "_name", "left").withColumns({
        "rt": F.when(paired & first, F.col("_rt")).when(paired & second, F.col("_rt") + 1)
               .when(paired, F.lit(9)).otherwise(F.col("_rt")),
        "ip": F.when(first, F.col("ip1")).when(second, F.col("ip2")),
        "mp": F.when(first, F.col("ip2")).when(second, F.col("ip1")),
        "mate_mapq": F.when(first, F.col("_q2")).when(second, F.col("_q1")),
    }).select(*alignments.columns, "rt", "ip", "mp", "mate_mapq")
    late = alignments.where(F.col("rec_no") > MAX_RECORDS).withColumns({
        "rt": F.lit(8), "ip": F.lit(None).cast("bigint"), "mp": F.lit(None).cast("bigint"),
        "mate_mapq": F.lit(None).cast("int")})
    return tagged.unionByName(late)


def split_counters(classified: DataFrame) -> DataFrame:
    """Reads per class and split."""
    def count(name: str) -> Column:
        return F.count_if(F.col("status") == name).alias(name)
    return classified.groupBy("split").agg(
        F.count("*").alias("total"), count("unmapped"), count("normal"), count("chimeric"),
        count("ambiguous"), count("singleton"))


def insert_size(classified: DataFrame) -> DataFrame:
    """Mean outer distance of inner pairs under 1 kb, per split; 0 without any."""
    inner = ((F.col("status") == "normal") & (F.col("s1") == 0) & (F.col("s2") == 16)
             & (F.col("c1") == F.col("c2")) & (F.col("p1") < F.col("p2"))
             & (F.col("p2") - F.col("p1") < INNER_INSERT))
    gap = F.when(inner, F.col("p2") - F.col("p1"))
    return classified.groupBy("split").agg(
        F.count(gap).alias("inner_pairs"), F.coalesce(F.sum(gap), F.lit(0)).cast("bigint").alias("insert_sum"),
    ).withColumn("avg_insert", F.col("insert_sum") / F.greatest("inner_pairs", F.lit(1)))


def adjust_insert_size(pairs: DataFrame, insert: DataFrame) -> DataFrame:
    """Shift interior positions by the unsequenced gap of the average insert.

    Used when no enzyme tells where the junction is. ``insert`` has one row per split and
    should be a stored table: its size is checked before it is broadcast.
    """
    joined = lookup_join(pairs, insert.select("split", "avg_insert"), ["split"], salt_from=["qname"])
    gap = (F.coalesce("avg_insert", F.lit(0.0))
           - cg.query_len(F.col("cigar1")) - cg.query_len(F.col("cigar2")))
    clip = {i: cg.downstream_clip(F.col(f"cigar{i}"), F.col(f"s{i}")) for i in (1, 2)}

    def whole(x: Column) -> Column:
        return F.when(x < 0, F.ceil(x)).otherwise(F.floor(x)).cast("bigint")

    def moved(i: int, j: int) -> Column:
        sign = F.when(F.col(f"s{i}") == 0, 1).otherwise(-1)
        step = (F.when((clip[i] == 0) & (clip[j] == 0), whole(F.col("_gap") / 2))
                .when((clip[i] == 0) & (clip[j] > 0), whole(F.col("_gap")) + clip[j]).otherwise(F.lit(0)))
        return F.col(f"ip{i}") + sign * step

    return (joined.withColumn("_gap", gap)
            .withColumns({"ip1": moved(1, 2), "ip2": moved(2, 1)}).drop("_gap", "avg_insert"))


def pair_mates(tagged: DataFrame, q: int = -1, columns: tuple[str, ...] = ("seq",)) -> DataFrame:
    """One contact per read from its two records with read type 0 to 5; even type is end 1."""
    extra = [c for c in columns if c in tagged.columns]
    side = F.struct("rt", flags.strand(F.col("flag")).cast("int").alias("s"), F.col("rname").alias("c"),
                    F.col("ip").alias("p"), F.col("mapq").alias("q"), "cigar", *extra)
    even = F.max(F.when(F.col("rt") % 2 == 0, side)).alias("a")
    odd = F.max(F.when(F.col("rt") % 2 == 1, side)).alias("b")
    joined = (tagged.where(F.col("rt").between(0, 5))
              .groupBy(names.read_base_name(F.col("qname")).alias("qname")).agg(even, odd)
              .where("a is not null and b is not null"))
    fields = ["s", "c", "p", "q", "cigar", *extra]
    out = joined.select("qname", *[F.col(f"{v}.{f}").alias(f"{f}{i}") for i, v in ((1, "a"), (2, "b")) for f in fields])
    return out.where((F.col("q1") >= q) & (F.col("q2") >= q))


def pair_mates_sorted(tagged: DataFrame, q: int = 1) -> DataFrame:
    """Contacts straight from records, without bringing mates together.

    Each record already knows its mate, so one of the two is kept: the lower interior
    position on one chromosome, the later chromosome otherwise. Equal positions keep one
    row per read.
    """
    own = tagged.where(F.col("rt").between(0, 5) & (F.col("mapq") >= q) & (F.col("mate_mapq") >= q))
    intra = F.col("rnext") == "="
    def row(second: Column) -> list:
        zero = F.lit(0)
        return [F.col("qname"), zero.alias("s1"), F.col("rname").alias("c1"), F.col("ip").alias("p1"),
                zero.cast("bigint").alias("f1"), zero.alias("s2"), second.alias("c2"), F.col("mp").alias("p2"),
                F.lit(1).cast("bigint").alias("f2")]
    lower = own.where(intra & (F.col("ip") < F.col("mp"))).select(*row(F.col("rname")))
    level = own.where(intra & (F.col("ip") == F.col("mp"))).select(*row(F.col("rname"))).dropDuplicates(["qname"])
    inter = own.where(~intra & (F.col("rnext") >= F.col("rname"))).select(*row(F.col("rnext")))
    return lower.unionByName(level).unionByName(inter)
