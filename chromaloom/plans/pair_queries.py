"""Queries over contact pairs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import measures, motifs, names
from ..operators import duplicates, fragments, pairs, phasing, quality, statistics, tracks
from ..sources import contacts as files
from ..sources import reports
from . import flow
from .checks import span_len
from .inputs import derive
from .registry import query

JUNCTION = "GATC"


@query("canonical_pairs", "select qname, s1, c1, p1, s2, c2, p2, q1, q2, cigar1, cigar2 from @canon")
def canonical_pairs(spark, d):
    return pairs.canonical_pair(derive(spark, d, "raw_pairs")).select(
        "qname", "s1", "c1", "p1", "s2", "c2", "p2", "q1", "q2", "cigar1", "cigar2")


@query("mapq_filter", "select qname, q1, q2 from @raw_pairs where q1 >= 30 and q2 >= 30")
def mapq_filter(spark, d):
    return pairs.mapq_filter(derive(spark, d, "raw_pairs"), 30).select("qname", "q1", "q2")


_CHROMS = """
select concat(case l_linenumber % 3 when 0 then 'chr' when 1 then '' else 'scaffold_' end, case l_partkey % 26 when 0 then 'X' when 24 then 'Y'
 when 25 then 'MT' else cast(l_partkey % 26 as varchar) end) as chrom from lineitem"""


def _chroms(spark, d):
    number = F.col("l_partkey") % 26
    prefix = F.when(F.col("l_linenumber") % 3 == 0, "chr").when(F.col("l_linenumber") % 3 == 1, "").otherwise("scaffold_")
    name = F.when(number == 0, "X").when(number == 24, "Y").when(number == 25, "MT").otherwise(number.cast("string"))
    return spark.read.parquet(f"{d}/lineitem.parquet").select(F.concat(prefix, name).alias("chrom"))


@query("standard_chromosomes", f"""
select chrom, replace(chrom, '_', '') as cleaned, count(*) as n from ({_CHROMS}) x
 where regexp_matches(chrom, '{names.STANDARD_CHROMOSOME}') group by all""")
def standard_chromosomes(spark, d):
    kept = pairs.standard_chromosomes(_chroms(spark, d), ("chrom",))
    return kept.groupBy("chrom", names.clean_chrom(F.col("chrom")).alias("cleaned")).agg(F.count("*").alias("n"))


@query("exclude_chromosomes", f"select chrom, count(*) as n from ({_CHROMS}) x where chrom not in ('Y', 'chrY', 'MT', 'chrM') group by all")
def exclude_chromosomes(spark, d):
    return pairs.exclude_chromosomes(_chroms(spark, d), columns=("chrom",)).groupBy("chrom").agg(F.count("*").alias("n"))


@query("missing_chromosomes", f"""
select distinct chrom from ({_CHROMS}) x where chrom not in (select distinct c1 from @raw_pairs)""")
def missing_chromosomes(spark, d):
    sizes = derive(spark, d, "raw_pairs").select(F.col("c1").alias("chrom")).distinct()
    return pairs.missing_chroms(_chroms(spark, d), sizes)


@query("union_header", f"select distinct chrom from (select chrom from ({_CHROMS}) x union all select c1 from @raw_pairs)")
def union_header(spark, d):
    return pairs.union_header([_chroms(spark, d), derive(spark, d, "raw_pairs").select(F.col("c1").alias("chrom"))])


@query("homolog_names", """
select concat(c1, case when p1 % 2 = 0 then '-r' else '-a' end) as homolog, c1 as stripped, count(*) as n from @raw_pairs group by all""")
def homolog_names(spark, d):
    which = F.when(F.col("p1") % 2 == 0, "r").otherwise("a")
    named = derive(spark, d, "raw_pairs").select(names.homolog_name(F.col("c1"), which).alias("homolog"))
    return named.groupBy("homolog", names.strip_homolog(F.col("homolog")).alias("stripped")).agg(F.count("*").alias("n"))


@query("sequence_check", """
select qname from (select qname, case when q1 % 7 = 0 then concat(seq1, '.') else lower(seq1) end as seq1, seq2 from @raw_pairs)
 where not (regexp_matches(seq1, '^[acgtnACGTN]+$') and regexp_matches(seq2, '^[acgtnACGTN]+$'))""")
def sequence_check(spark, d):
    spoiled = derive(spark, d, "raw_pairs").withColumn(
        "seq1", F.when(F.col("q1") % 7 == 0, F.concat("seq1", F.lit("."))).otherwise(F.lower("seq1")))
    return quality.bad_sequences(spoiled).select("qname")


@query("assign_fragments", "select qname, c1, p1, f1, c2, p2, f2 from @pairs")
def assign_fragments(spark, d):
    return flow.contact_pairs(spark, d).select("qname", "c1", "p1", "f1", "c2", "p2", "f2")


@query("site_distance", """
select qname, cast(d1 as bigint) as site_dist1, near1 as near_lower1, cast(d2 as bigint) as site_dist2, near2 as near_lower2 from @pairs""")
def site_distance(spark, d):
    return fragments.site_distance(flow.contact_pairs(spark, d), flow.sites(spark, d)).select(
        "qname", "site_dist1", "near_lower1", "site_dist2", "near_lower2")


@query("fragment_bounds", """
select qname, cast(lo1 as bigint) as lo1, cast(hi1 as bigint) as hi1, cast(lo2 as bigint) as lo2, cast(hi2 as bigint) as hi2 from @pairs""")
def fragment_bounds(spark, d):
    raw = pairs.canonical_pair(derive(spark, d, "raw_pairs"))
    both = fragments.assign_fragments(raw, flow.sites(spark, d), bounds=True)
    return both.select("qname", "lo1", "hi1", "lo2", "hi2")


@query("contact_status", "select status, count(*) as n, cast(sum(q1) as bigint) as q1_sum from @status group by status")
def contact_status(spark, d):
    judged = pairs.contact_status(flow.unique_contacts(spark, d))
    return judged.groupBy("status").agg(F.count("*").alias("n"), F.sum("q1").alias("q1_sum"))


@query("dummy_fragments", "select qname, cast(0 as bigint) as f1, cast(1 as bigint) as f2 from @canon")
def dummy_fragments(spark, d):
    return pairs.dummy_fragments(pairs.canonical_pair(derive(spark, d, "raw_pairs"))).select("qname", "f1", "f2")


_TEXT = {
    "short": "concat_ws(' ', s1, c1, p1, f1, s2, c2, p2, f2)",
    "long": "concat_ws(' ', s1, c1, p1, f1, s2, c2, p2, f2, q1, cigar1, seq1, q2, cigar2, seq2, qname, qname)",
    "phased": "concat_ws(' ', qname, s1, c1, p1, f1, s2, c2, p2, f2, 100, 100)",
}


@query("contact_text", " union all ".join(f"select '{k}' as form, {v} as value from @pairs" for k, v in _TEXT.items()))
def contact_text(spark, d):
    both = flow.contact_pairs(spark, d)
    forms = {"short": pairs.to_short(both), "long": pairs.to_long(both), "phased": pairs.to_phased_export(both)}
    return pairs.merge_experiments([
        files.format_contacts(df, form).select(F.lit(form).alias("form"), "value") for form, df in forms.items()])


@query("pair_file", "select qname, cast(s1 as int) as s1, c1, p1, cast(s2 as int) as s2, c2, p2 from @raw_pairs")
def pair_file(spark, d):
    sign = {i: F.when(F.col(f"s{i}") == 0, "+").otherwise("-") for i in (1, 2)}
    lines = derive(spark, d, "raw_pairs").select(F.concat_ws(
        "\t", "qname", "c1", F.col("p1").cast("string"), "c2", F.col("p2").cast("string"), sign[1], sign[2]).alias("text"))
    return files.parse_pairs(lines)


@query("contact_block", """
select qname, concat_ws('_', c1, c2, lpad(cast(f1 as varchar), 9, '0'), lpad(cast(f2 as varchar), 9, '0'), s1, s2,
 lpad(cast(p1 as varchar), 9, '0'), lpad(cast(p2 as varchar), 9, '0')) as cb, f1, p2 from @pairs""")
def contact_block(spark, d):
    cols = [F.col(c) for c in ("c1", "c2", "f1", "f2", "s1", "s2", "p1", "p2")]
    blocks = flow.contact_pairs(spark, d).select("qname", names.cb_format(*cols).alias("cb"))
    parsed = names.cb_parse(F.col("cb"))
    return blocks.select("qname", "cb", parsed["f1"].alias("f1"), parsed["p2"].alias("p2"))


_LOG = ", ".join(map(str, measures.LOG_EDGES))


@query("pair_measures", f"""
select qname, cast(p1 // 50 * 50 as bigint) as start1, cast(len(list_filter([{_LOG}], lambda e: e < abs(p1 - p2))) as bigint) as log_bin,
 case when s1 = s2 and s1 = 0 then 'right' when s1 = s2 then 'left' when s1 = 0 and p1 < p2 then 'inner' when s1 = 0 then 'outer'
  when p1 < p2 then 'outer' else 'inner' end as orientation,
 case when c1 = c2 then abs(p1 - p2) end as strict_distance,
 abs(cast(substr(c1, 4) as bigint) - cast(substr(c2, 4) as bigint)) * 10000000 + abs(p1 - p2) as numeric_distance
from @raw_pairs""")
def pair_measures(spark, d):
    c1, c2, p1, p2 = (F.col(c) for c in ("c1", "c2", "p1", "p2"))
    return derive(spark, d, "raw_pairs").select(
        "qname", measures.bin_start(p1, 50).alias("start1"), measures.log_bin(F.abs(p1 - p2)).alias("log_bin"),
        measures.pair_orientation(F.col("s1"), p1, F.col("s2"), p2).alias("orientation"),
        measures.genome_distance(c1, p1, c2, p2).alias("strict_distance"),
        measures.genome_distance(F.substring("c1", 4, 9), p1, F.substring("c2", 4, 9), p2, "numeric_compat").alias("numeric_distance"))


@query("dedup_pairs", "select qname, case when dup then 'pcr' else 'unique' end as dup_class from @verdicts")
def dedup_pairs(spark, d):
    return duplicates.dedup(flow.contact_pairs(spark, d)).select("qname", "dup_class")


@query("dedup_exact", """
select qname, case when row_number() over (partition by c1, c2, f1, f2, s1, s2, p1, p2 order by qname) = 1 then 'unique' else 'pcr' end as dup_class
from @pairs""")
def dedup_exact(spark, d):
    return duplicates.dedup(flow.contact_pairs(spark, d), exact=True).select("qname", "dup_class")


@query("dedup_without_enzyme", """
with recursive g as (select qname, c1, c2, s1, s2, p1, p2, case when p1 - lag(p1) over w <= 4 then 0 else 1 end as fresh
  from @canon window w as (partition by c1, c2, s1, s2 order by p1, p2, qname)),
i as (select *, sum(fresh) over (order by c1, c2, s1, s2, p1, p2, qname rows unbounded preceding) as isl from g),
n as (select *, row_number() over (partition by isl order by p1, p2, qname) as rn from i),
walk as (select isl, rn, qname, [{'a': p1, 'b': p2}] as kept, false as dup from n where rn = 1
 union all
 select n.isl, n.rn, n.qname, case when len(list_filter(w.kept, lambda k: abs(k.a - n.p1) <= 4 and abs(k.b - n.p2) <= 4)) > 0 then w.kept
   else list_append(w.kept, {'a': n.p1, 'b': n.p2}) end, len(list_filter(w.kept, lambda k: abs(k.a - n.p1) <= 4 and abs(k.b - n.p2) <= 4)) > 0
 from walk w join n on n.isl = w.isl and n.rn = w.rn + 1)
select qname from walk where not dup""")
def dedup_without_enzyme(spark, d):
    canonical = pairs.canonical_pair(derive(spark, d, "raw_pairs"))
    return duplicates.unique_pairs(pairs.dummy_fragments(canonical)).select("qname")


_FLOWCELL = """concat_ws(':', concat('M', split_part(qname, ':', 1), '-', split_part(qname, ':', 2)), concat(split_part(qname, ':', 3), '-', split_part(qname, ':', 4)),
 'FC', q1 % 2, q2 % 2, s1 + q1 * 2, s2 + q2 * 2)"""


def _flowcell_pairs(spark, d):
    part = [F.split_part("qname", F.lit(":"), F.lit(i)) for i in range(1, 5)]
    name = F.concat_ws(":", F.concat(F.lit("M"), part[0], F.lit("-"), part[1]), F.concat(part[2], F.lit("-"), part[3]),
                       F.lit("FC"), (F.col("q1") % 2).cast("string"), (F.col("q2") % 2).cast("string"),
                       (F.col("s1") + F.col("q1") * 2).cast("string"), (F.col("s2") + F.col("q2") * 2).cast("string"))
    return flow.contact_pairs(spark, d).select(name.alias("qname"), *pairs.BLOCK, "p1", "p2")


_OPTICAL = f"""
with recursive fc as (select {_FLOWCELL} as qname, c1, c2, f1, f2, s1, s2, p1, p2 from @pairs),
g as (select *, case when p1 - lag(p1) over w <= 4 then 0 else 1 end as fresh from fc window w as (partition by c1, c2, f1, f2, s1, s2 order by p1, p2, qname)),
i as (select *, sum(fresh) over (order by c1, c2, f1, f2, s1, s2, p1, p2, qname rows unbounded preceding) as isl from g),
n as (select *, row_number() over (partition by isl order by p1, p2, qname) as rn, concat(split_part(qname, ':', 3), split_part(qname, ':', 4), split_part(qname, ':', 5)) as tile,
  cast(split_part(qname, ':', 6) as bigint) as x, cast(split_part(qname, ':', 7) as bigint) as y from i),
walk as (select isl, rn, qname, [{{'a': p1, 'b': p2}}] as kept, false as dup from n where rn = 1
 union all
 select n.isl, n.rn, n.qname, case when len(list_filter(w.kept, lambda k: abs(k.a - n.p1) <= 4 and abs(k.b - n.p2) <= 4)) > 0 then w.kept
   else list_append(w.kept, {{'a': n.p1, 'b': n.p2}}) end, len(list_filter(w.kept, lambda k: abs(k.a - n.p1) <= 4 and abs(k.b - n.p2) <= 4)) > 0
 from walk w join n on n.isl = w.isl and n.rn = w.rn + 1),
judged as (select n.*, w.dup from n join walk w on n.isl = w.isl and n.rn = w.rn),
optical as (select a.isl, a.rn, bool_or(not (a.tile = b.tile and abs(a.x - b.x) < 50 and abs(a.y - b.y) < 50)) as pcr from judged a join judged b on a.isl = b.isl
  and a.dup and not b.dup and b.rn < a.rn and abs(a.p1 - b.p1) <= 4 and abs(a.p2 - b.p2) <= 4 group by a.isl, a.rn),
classes as (select j.qname, case when not dup then 'unique' when o.pcr then 'pcr' else 'optical' end as dup_class from judged j left join optical o on j.isl = o.isl and j.rn = o.rn)
"""


@query("dedup_optical", _OPTICAL + "select qname, dup_class from classes")
def dedup_optical(spark, d):
    return duplicates.dedup(_flowcell_pairs(spark, d), optical=True).select("qname", "dup_class")


def _complexity(c: str, n: str) -> str:
    """A pure-SQL bisection over the same bracket."""
    def at(x: str) -> str:
        return f"(c / ({x}) - 1 + exp(-n / ({x})))"

    return f"""
lib as (select cast({c} as double) as c, cast({n} as double) as n),
br as (select 1.0::double as lo, 100.0::double as hi, c, n from lib
 union all select hi, hi * 10, c, n from br where {at('hi * c')} >= 0),
bi as (select lo, hi, c, n, 0 as i from (select * from br order by hi desc limit 1)
 union all select case when {at('(lo + hi) / 2 * c')} > 0 then (lo + hi) / 2 else lo end, case when {at('(lo + hi) / 2 * c')} > 0 then hi else (lo + hi) / 2 end, c, n, i + 1
 from bi where i < 200 and {at('(lo + hi) / 2 * c')} <> 0)
"""


@query("duplicate_report", _OPTICAL + """,
k as (select count(*) as total, count_if(dup_class = 'unique') as u, count_if(dup_class = 'pcr') as p, count_if(dup_class = 'optical') as o from classes),
""" + _complexity("(select u from k)", "(select u + p from k)") + """
select total, u as "unique", p as pcr, o as optical, round(u * 100.0::double / total, 2) as unique_pct, round(p * 100.0::double / total, 2) as pcr_pct,
 round(o * 100.0::double / total, 2) as optical_pct, (select cast(trunc(c * (lo + hi) / 2) as bigint) from bi order by i desc limit 1) as complexity from k""")
def duplicate_report(spark, d):
    return duplicates.duplicate_report(duplicates.dedup(_flowcell_pairs(spark, d), optical=True))


@query("library_complexity", "with recursive k as (select count(*) as n, count_if(not dup) as u from @verdicts)," + _complexity("(select u from k)", "(select n from k)") + """
select u as unique_pairs, n as total_pairs, (select cast(trunc(c * (lo + hi) / 2) as bigint) from bi order by i desc limit 1) as complexity from k""")
def library_complexity(spark, d):
    verdicts = duplicates.dedup(flow.contact_pairs(spark, d))
    counts = verdicts.agg(F.count_if(F.col("dup_class") == "unique").alias("unique_pairs"), F.count("*").alias("total_pairs"))
    return counts.withColumn("complexity", statistics.library_complexity(F.col("unique_pairs"), F.col("total_pairs")))


@query("row_conservation", """
select count(*) as sorted_rows, count_if(not dup) as unique_rows, count_if(dup) as dup_rows, true as conserved from @verdicts""")
def row_conservation(spark, d):
    both = flow.contact_pairs(spark, d)
    return duplicates.conservation(both, duplicates.dedup(both))


_NEAR = {i: f"(case when near{i} then s{i} = 0 else s{i} = 16 end)" for i in (1, 2)}
_DANGLING = "(starts_with(seq1, 'TC') or starts_with(seq2, 'TC'))"
_TRUE = "(case when starts_with(seq1, 'TC') then d1 else d2 end) = 1"


@query("contact_statistics", f"""
with c as (select *, {_DANGLING} as dang from @contacts),
s as (select count(*) as unique_pairs, count_if(status = 'intra_fragment') as intra_fragment, count_if(status = 'below_mapq') as below_mapq from @status),
t as (select count(*) as contacts, count_if(contains(seq1, 'GATC') or contains(seq2, 'GATC')) as ligation,
 count_if(rng = 'inter') as inter, count_if(rng = 'very_short') as very_short, count_if(rng = 'short') as short, count_if(rng = 'long') as "long",
 count_if(same) as intra, count_if(rng = 'long' and orientation = 'inner') as inner_long, count_if(rng = 'long' and orientation = 'outer') as outer_long,
 count_if(rng = 'long' and orientation = 'right') as right_long, count_if(rng = 'long' and orientation = 'left') as left_long,
 count_if(dang) as dangling, count_if(dang and rng = 'inter') as dangling_inter, count_if(dang and rng = 'very_short') as dangling_very_short,
 count_if(dang and rng = 'short') as dangling_short, count_if(dang and rng = 'long') as dangling_long,
 cast(sum(case when not same or d >= 20000 then cast({_NEAR[1]} as int) + cast({_NEAR[2]} as int) else 0 end) as bigint) as five_prime,
 cast(sum(case when not same or d >= 20000 then cast(not {_NEAR[1]} as int) + cast(not {_NEAR[2]} as int) else 0 end) as bigint) as three_prime,
 count_if(dang and {_TRUE} and same and d < 20000) as true_dangling_intra_short, count_if(dang and {_TRUE} and same and d >= 20000) as true_dangling_intra_long,
 count_if(dang and {_TRUE} and not same) as true_dangling_inter from c)
select s.*, t.*, round(contacts * 100.0::double / unique_pairs, 2) as contacts_of_unique_pct, round(inner_long * 100.0::double / "long", 2) as inner_long_pct,
 round(three_prime * 100.0::double / (three_prime + five_prime), 2) as three_prime_pct from s, t""")
def contact_statistics(spark, d):
    unique = flow.unique_contacts(spark, d, ("q1", "q2", "seq1", "seq2"))
    stats = statistics.contact_statistics(unique, flow.sites(spark, d), junction=JUNCTION)
    dropped = [c for c in stats.columns if c.endswith("_pct") and c not in ("contacts_of_unique_pct", "inner_long_pct", "three_prime_pct")]
    return stats.drop(*dropped)


@query("pair_types", "select orientation, count(*) as n from @contacts where same and d >= 20000 group by orientation")
def pair_types(spark, d):
    return statistics.pair_type_counts(flow.unique_contacts(spark, d))


@query("ligation_in_pairs", "select count_if(contains(seq1, 'GATC') or contains(seq2, 'GATC')) as ligations, count(*) as reads from @contacts")
def ligation_in_pairs(spark, d):
    return statistics.ligation_in_pairs(flow.unique_contacts(spark, d, ("q1", "q2", "seq1", "seq2")), JUNCTION)


@query("count_ligations", f"""
select count_if(regexp_matches(seq1, '{motifs.junction_for("Arima")}') or regexp_matches(seq2, '{motifs.junction_for("Arima")}')) as ligations,
 count(*) as reads from @raw_pairs""")
def count_ligations(spark, d):
    return statistics.count_ligations(derive(spark, d, "raw_pairs"), motifs.junction_for("Arima"))


@query("dangling_ends", f"""
select rng as range, count(*) as dangling, count_if({_TRUE}) as at_site from @contacts where {_DANGLING} group by rng""")
def dangling_ends(spark, d):
    unique = flow.unique_contacts(spark, d, ("q1", "q2", "seq1", "seq2"))
    return statistics.dangling_ends(unique, JUNCTION, flow.sites(spark, d))


@query("three_prime_bias", f"""
select count_if({_NEAR[1]}) + count_if({_NEAR[2]}) as five_prime, count_if(not {_NEAR[1]}) + count_if(not {_NEAR[2]}) as three_prime
from @contacts where not same or d >= 20000""")
def three_prime_bias(spark, d):
    return statistics.three_prime_bias(flow.unique_contacts(spark, d), flow.sites(spark, d))


_SITE_HIST = """select cast(b as bigint) as bin, count(*) as n from (select d1 as b from @contacts
 union all select d2 from @contacts) where b between 1 and 2000 group by b"""
_MAPQ_HIST = """select cast(least(q1, q2) as bigint) as bin, series, count(*) as n from @contacts, (values ('all'), ('intra'), ('inter')) as v(series)
 where series = 'all' or (series = 'intra') = same group by all"""
_DIST_HIST = f"""select cast(len(list_filter([{_LOG}], lambda e: e < d)) as bigint) as bin, orientation as series, count(*) as n from @contacts where same group by all"""


@query("site_distance_hist", _SITE_HIST)
def site_distance_hist(spark, d):
    return statistics.site_distance_hist(flow.unique_contacts(spark, d), flow.sites(spark, d))


@query("mapq_hist", _MAPQ_HIST)
def mapq_hist(spark, d):
    return statistics.mapq_hist(flow.unique_contacts(spark, d))


@query("distance_hist", _DIST_HIST)
def distance_hist(spark, d):
    return statistics.distance_hist(flow.unique_contacts(spark, d))


@query("merge_hists", f"""
select hist, bin, series, cast(2 * n as bigint) as n from (select 'A' as hist, bin, 'all' as series, n from ({_SITE_HIST}) a
 union all select 'B', bin, series, n from ({_MAPQ_HIST}) b union all select 'D', bin, series, n from ({_DIST_HIST}) e)""")
def merge_hists(spark, d):
    own = statistics.hists(flow.unique_contacts(spark, d), flow.sites(spark, d))
    return statistics.merge_hists([own, own])


@query("merge_experiments", "select experiment, count(*) as n, cast(sum(p1) as bigint) as p1_sum from @pairs group by experiment")
def merge_experiments(spark, d):
    both = flow.contact_pairs(spark, d)
    parts = [both.where(F.col("experiment") == f"exp{i}") for i in range(3)]
    merged = pairs.merge_sorted(parts)
    return merged.groupBy("experiment").agg(F.count("*").alias("n"), F.sum("p1").alias("p1_sum"))


@query("sort_by_contact_block", "select qname, c1, c2, f1, f2, s1, s2, p1, p2 from @pairs order by c1, c2, f1, f2, s1, s2, p1, p2")
def sort_by_contact_block(spark, d):
    return pairs.sort_by_contact_block(flow.contact_pairs(spark, d)).select("qname", *pairs.BLOCK, "p1", "p2")


@query("sort_by_chromosomes_first", "select qname, c1, c2, f1, f2, s1, s2, p1 from @pairs order by c1, c2, f1, f2, s1, s2, p1")
def sort_by_chromosomes_first(spark, d):
    return pairs.sort_by_chromosomes_first(flow.contact_pairs(spark, d)).select("qname", *pairs.BLOCK, "p1")


@query("chunk_index", """
with k as (select c1, c2, count(*) as n from @pairs group by all), o as (select *, coalesce(sum(n) over (order by c1, c2 rows between unbounded preceding and 1 preceding), 0) as base from k)
select c1, c2, cast(chunk as bigint) as chunk, cast(base + chunk * 500 as bigint) as start_row, cast(least(500, n - chunk * 500) as bigint) as n_rows
from (select *, unnest(range(0, (n - 1) // 500 + 1)) as chunk from o)""")
def chunk_index(spark, d):
    return pairs.chunk_index(flow.contact_pairs(spark, d), 500)


@query("coverage", """
select chrom, cast(p // 50 * 50 as bigint) as start, count(*) as n from (select c1 as chrom, p1 as p from @uniq where q1 > 0 and q2 > 0 and f1 <> f2
 union all select c2, p2 from @uniq where q1 > 0 and q2 > 0 and f1 <> f2) group by all""")
def coverage(spark, d):
    return tracks.coverage(flow.unique_contacts(spark, d))


@query("map_resolution", """
with recursive cov as (select chrom, p // 50 * 50 as start, count(*) as n from (select c1 as chrom, p1 as p from @uniq where q1 > 0 and q2 > 0 and f1 <> f2
  union all select c2, p2 from @uniq where q1 > 0 and q2 > 0 and f1 <> f2) group by all),
tried as (select unnest(range(0, 500)) * 1000 + 50 as size),
good as (select size, (select count(*) from (select chrom, start // size as b, sum(n) as m from cov group by all) where m >= 20) as good from tried),
coarse as (select min(size) as size from good where good >= 15000300 // size * 4 // 5),
fine as (select unnest(range(1, 20)) * 50 + (select size - 1000 from coarse) as size),
verdict as (select size, (select count(*) from (select chrom, start // size as b, sum(n) as m from cov group by all) where m >= 20) >= 15000300 // size * 4 // 5 as ok from fine),
step as (select greatest(size - 1000, 50) as lo, size as hi, false as done from coarse
 union all
 select case when v.ok then lo else v.size end, case when v.ok then v.size else hi end, false
 from step join verdict v on v.size = ((hi - lo) // 2 + lo + 49) // 50 * 50 where v.size < hi)
select cast(min(hi) as bigint) as resolution from step""")
def map_resolution(spark, d):
    cov = tracks.coverage(flow.unique_contacts(spark, d))
    return tracks.map_resolution(cov, genome_size=15_000_300, min_contacts=20)




_PHASE = f"""
with cand as (select * from @pairs where c1 = c2 and q1 >= 10 and q2 >= 10),
ends as (select qname, 1 as e, c1 as chrom, s1 as s, p1 as p, cigar1 as cigar, seq1 as seq from cand
 union all select qname, 2, c2, s2, p2, cigar2, seq2 from cand),
laid as (select *, {span_len('cigar')} as len, case when s = 0 then p else p - {span_len('cigar')} + 1 end as start from ends),
hit as (select l.*, n.pos as snp, n.pat, n.mat from laid l join @snps n on l.chrom = n.chrom and n.pos > l.start and n.pos <= l.start + l.len),
ops as (select qname, e, snp, unnest(regexp_extract_all(cigar, '\\d+[MDNSHI]')) as tok, generate_subscripts(regexp_extract_all(cigar, '\\d+[MDNSHI]'), 1) as i from hit),
num as (select *, cast(regexp_extract(tok, '^(\\d+)', 1) as bigint) as n, right(tok, 1) as op from ops),
run as (select *, coalesce(sum(case when op <> 'I' then n else 0 end) over w, 0) as g0, coalesce(sum(case when op in ('M', 'S', 'I') then n else 0 end) over w, 0) as r0
  from num window w as (partition by qname, e, snp order by i rows between unbounded preceding and 1 preceding)),
over_ as (select r.qname, r.e, r.snp, r.op, r.r0 + r.snp - h.start - r.g0 as at from run r join hit h on r.qname = h.qname and r.e = h.e and r.snp = h.snp
  where r.op <> 'I' and r.snp - h.start >= r.g0 and r.snp - h.start < r.g0 + r.n),
based as (select h.*, case when o.op = 'M' and o.at < length(h.seq) then substr(h.seq, cast(o.at + 1 as int), 1) end as base
  from hit h left join over_ o on h.qname = o.qname and h.e = o.e and h.snp = o.snp),
calls as (select qname, e, snp, base, case when base = pat then 'paternal' when base = mat then 'maternal' else 'mismatch' end as call from based where base is not null),
per as (select qname, bool_or(call = 'mismatch') as mis, bool_or(e = 1 and call = 'paternal') as a1, bool_or(e = 1 and call = 'maternal') as m1,
  bool_or(e = 2 and call = 'paternal') as a2, bool_or(e = 2 and call = 'maternal') as m2,
  coalesce(string_agg(concat(':', base, ':', snp, ':', call), '' order by snp) filter (where e = 1), '') as t1,
  coalesce(string_agg(concat(':', base, ':', snp, ':', call), '' order by snp) filter (where e = 2), '') as t2 from calls group by qname),
phased as (select qname, concat('SNP1', t1) as snp1, concat('SNP2', t2) as snp2, case when mis or (a1 and m1) or (a2 and m2) then 'mismatch' when a1 and a2 then 'paternal_both' when m1 and m2 then 'maternal_both'
  when (m1 and a2) or (a1 and m2) then 'diff' when m1 or m2 then 'maternal' when a1 or a2 then 'paternal' else 'problem' end as category from per)
"""


@query("overlap_snps", _PHASE + """select qname, cast(e as int) as "end", cast(snp as bigint) as snp_pos, base from based""")
def overlap_snps(spark, d):
    candidates = pairs.phasing_candidates(flow.contact_pairs(spark, d))
    return phasing.overlap_snps(candidates, derive(spark, d, "snps")).select("qname", "end", "snp_pos", "base")


@query("phase_pairs", _PHASE + "select qname, snp1, snp2, category from phased")
def phase_pairs(spark, d):
    phased = phasing.phase_pairs(flow.contact_pairs(spark, d), derive(spark, d, "snps"))
    return phased.select("qname", phasing.phase_string(F.col("calls1"), 1).alias("snp1"),
                         phasing.phase_string(F.col("calls2"), 2).alias("snp2"), "category")


@query("phase_categories", _PHASE + "select category, count(*) as n from phased group by category")
def phase_categories(spark, d):
    return phasing.category_counts(phasing.phase_pairs(flow.contact_pairs(spark, d), derive(spark, d, "snps")))


def _phased_once() -> str:
    """The same blocks, each step made once, and SNPs met by bins of 64 bp before the exact test."""
    text = _PHASE
    for name in ("cand", "ends", "laid", "hit", "phased"):
        text = text.replace(f"{name} as (", f"{name} as materialized (")
    return text.replace("select l.*, n.pos as snp", "select l.* exclude (bin), n.pos as snp").replace(
        "from laid l join @snps n on l.chrom = n.chrom and",
        "from (select *, unnest(range(cast(start // 64 as bigint), cast((start + len) // 64 + 1 as bigint))) as bin from laid) l join @snps n on l.chrom = n.chrom and n.pos // 64 = l.bin and")


@query("parental_contacts", _phased_once() + """
select replace(h.category, '_both', '') as parent, p.qname, p.c1, p.p1, p.f1, p.c2, p.p2, p.f2 from phased h join @pairs p on h.qname = p.qname
 where h.category in ('maternal', 'maternal_both', 'paternal', 'paternal_both')""")
def parental_contacts(spark, d):
    phased = phasing.phase_pairs(flow.contact_pairs(spark, d), derive(spark, d, "snps"))
    parts = [phasing.parental_contacts(phased, p).withColumn("parent", F.lit(p)) for p in ("maternal", "paternal")]
    return parts[0].unionByName(parts[1]).select("parent", "qname", "c1", "p1", "f1", "c2", "p2", "f2")


@query("phasing_candidates", "select qname from @pairs where c1 = c2 and q1 >= 10 and q2 >= 10")
def phasing_candidates(spark, d):
    return pairs.phasing_candidates(flow.contact_pairs(spark, d)).select("qname")


@query("illumina_names", f"""
select tile, cast(min(x) as bigint) as min_x, cast(max(y) as bigint) as max_y, count(*) as n from (select concat(split_part(qname, ':', 3), split_part(qname, ':', 4), split_part(qname, ':', 5)) as tile,
 cast(split_part(qname, ':', 6) as bigint) as x, cast(split_part(qname, ':', 7) as bigint) as y from (select {_FLOWCELL} as qname from @pairs)) group by tile""")
def illumina_names(spark, d):
    name = F.concat(F.col("qname"), F.lit("/1"))
    named = _flowcell_pairs(spark, d).select(
        names.illumina_tile(name).alias("tile"), names.illumina_x(name).alias("x"), names.illumina_y(name).alias("y"))
    return named.groupBy("tile").agg(F.min("x").alias("min_x"), F.max("y").alias("max_y"), F.count("*").alias("n"))


@query("report_text", """
with s as (select count(*) as u, count_if(status = 'intra_fragment') as intra, count_if(status = 'below_mapq') as low, count_if(status = 'contact') as c from @status)
select label, cast(n as double) as n from s, lateral (values ('Intra-fragment Reads', intra), ('Below MAPQ Threshold', low), ('Hi-C Contacts', c)) v(label, n)""")
def report_text(spark, d):
    stats = statistics.contact_statistics(flow.unique_contacts(spark, d))
    lines = reports.format_contact_statistics(stats).withColumnRenamed("value", "text")
    return reports.parse_stats(lines).where(F.col("label").isin("Intra-fragment Reads", "Below MAPQ Threshold", "Hi-C Contacts"))
