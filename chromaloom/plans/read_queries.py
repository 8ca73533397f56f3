"""Queries over alignment records and read groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cigar as cg
from ..functions import flags, names
from ..operators import collisions, duplicates, fragments, pairs, phasing, quality, reads, statistics, tracks
from ..operators.support import cut
from ..sources import alignments as sam
from . import flow
from .checks import lead_clip, query_len, ref_len, span_len, trail_clip
from .inputs import derive
from .registry import query


@query("cigar_positions", f"""
select qname, rec_no, cast({ref_len('cigar')} as bigint) as ref_len, cast({query_len('cigar')} as bigint) as query_len,
 cast({span_len('cigar')} as bigint) as span_len, {lead_clip('cigar')} as lead_clip, {trail_clip('cigar')} as trail_clip,
 cast(p as bigint) as five_prime, cast(ip as bigint) as interior, cast(ep as bigint) as outer_end, cast(s as int) as strand
from @recs""")
def cigar_positions(spark, d):
    c, pos, flag = F.col("cigar"), F.col("pos"), F.col("flag")
    strand, sec = flags.strand(flag), flags.has_flag(flag, flags.SECONDARY)
    five = cg.five_prime_pos(pos, c, strand, sec)
    return derive(spark, d, "alignments").select(
        "qname", "rec_no", cg.ref_len(c).alias("ref_len"), cg.query_len(c).alias("query_len"),
        cg.span_len(c).alias("span_len"), cg.lead_clip(c).cast("bigint").alias("lead_clip"),
        cg.trail_clip(c).cast("bigint").alias("trail_clip"), five.alias("five_prime"),
        cg.interior_pos(five, c, strand, sec).alias("interior"), cg.outer_pos(pos, c, strand, sec).alias("outer_end"),
        strand.cast("int").alias("strand"))


@query("flag_filter", "select qname, rec_no, flag from @alignments where (flag & 65) = 65 and (flag & 260) = 0")
def flag_filter(spark, d):
    kept = flags.flag_filter(derive(spark, d, "alignments"), all_of=65, none_of=260)
    return kept.select("qname", "rec_no", "flag")


@query("read_names", """
select split_part(name, '/', 1) as base, split_part(name, '/', 2) as read_end, cast(flag & 64 > 0 as int) as first, count(*) as n
from (select concat(qname, '/', case when (flag & 64) > 0 then '1' else '2' end) as name, flag from @alignments) group by all""")
def read_names(spark, d):
    records = derive(spark, d, "alignments")
    first = flags.has_flag(F.col("flag"), flags.FIRST)
    ends = pairs.tag_read_end(records.where(first), 1).unionByName(pairs.tag_read_end(records.where(~first), 2))
    return ends.groupBy(names.read_base_name(F.col("qname")).alias("base"),
                        names.read_end(F.col("qname"), F.col("flag")).alias("read_end"),
                        flags.has_flag(F.col("flag"), flags.FIRST).cast("int").alias("first")).agg(F.count("*").alias("n"))


@query("record_ordinals", """
select qname, rname, pos, cigar, flag, row_number() over (partition by qname order by (flag & 64) desc, (flag & 256), rname, pos, cigar) as ordinal,
 count(*) over (partition by qname) as k from @alignments""")
def record_ordinals(spark, d):
    numbered = reads.record_ordinals(derive(spark, d, "alignments"))
    return numbered.select("qname", "rname", "pos", "cigar", "flag", F.col("rec_no").cast("bigint").alias("ordinal"), "k")


_CLASS = ["qname", "k", "status", "rt", "split", *[f"{c}{i}" for c in ("s", "c", "p", "ip", "q", "rec") for i in (1, 2)]]


@query("classify_reads", """
select qname, k, status, cast(rt as int) as rt, split, cast(s1 as int) as s1, cast(s2 as int) as s2, c1, c2, cast(p1 as bigint) as p1,
 cast(p2 as bigint) as p2, cast(ip1 as bigint) as ip1, cast(ip2 as bigint) as ip2, q1, q2, rec1, rec2 from @classified""")
def classify_reads(spark, d):
    return flow.classified(spark, d).select(*_CLASS)


_SOLO = "case when r1.sec then r2 else r1 end"
_TAIL = "case when r1.sec then r1 else r2 end"


@query("classify_single_end", f"""
select qname, status, cast(case status when 'chimeric' then 0 when 'singleton' then 7 when 'ambiguous' then 8 end as int) as rt,
 cast(case when status = 'singleton' then r1.s when not ok then null when keep then a.s else bs end as int) as s1,
 cast(case when status = 'singleton' then r1.s when not ok then null when keep then bs else a.s end as int) as s2,
 cast(case when status = 'singleton' then r1.p when not ok then null when keep then a.ip else b.ip end as bigint) as p1,
 cast(case when status = 'singleton' then greatest(case when r1.s = 0 then r1.p + {lead_clip('r1.cigar')} + {ref_len('r1.cigar')} - 1
   else r1.p - {ref_len('r1.cigar')} + 1 - {trail_clip('r1.cigar')} end, 0)
  when not ok then null when keep then b.ip else a.ip end as bigint) as p2,
 cast(case when not ok then null when keep then a.p else b.ep end as bigint) as ep1,
 cast(case when not ok then null when keep then b.ep else a.p end as bigint) as ep2
from (select *, status = 'chimeric' as ok, (a.c < b.c or (a.c = b.c and (a.s < bs or (a.s = bs and a.p <= b.p)))) as keep
 from (select *, case when k = 1 and r1.mapped then 'singleton' when k = 1 then 'unmapped' when k > 2 then 'ambiguous'
   when a.mapped and b.mapped then 'chimeric' else 'unmapped' end as status, case when b.s = 0 then 16 else 0 end as bs
  from (select *, {_SOLO} as a, {_TAIL} as b from @groups)))""")
def classify_single_end(spark, d):
    found = reads.classify(derive(spark, d, "alignments"), single_end=True)
    return found.select("qname", "status", "rt", "s1", "s2", "p1", "p2", "ep1", "ep2")


@query("read_types", "select qname, rec_no, cast(rt as int) as rt, cast(ip as bigint) as ip, cast(mp as bigint) as mp, cast(mate_mapq as int) as mate_mapq from @tagged")
def read_types(spark, d):
    return flow.tagged(spark, d).select("qname", "rec_no", "rt", "ip", "mp", "mate_mapq")


@query("usable_records", "select qname, rec_no, mapq from @tagged where rt between 0 and 5 and (flag & 1024) = 0 and mapq >= 1")
def usable_records(spark, d):
    return pairs.usable_alignments(flow.tagged(spark, d)).select("qname", "rec_no", "mapq")


@query("split_counters", """
select split, count(*) as total, count_if(status = 'unmapped') as unmapped, count_if(status = 'normal') as normal,
 count_if(status = 'chimeric') as chimeric, count_if(status = 'ambiguous') as ambiguous, count_if(status = 'singleton') as singleton
from @classified group by split""")
def split_counters(spark, d):
    return reads.split_counters(flow.classified(spark, d))


_INNER = "status = 'normal' and s1 = 0 and s2 = 16 and c1 = c2 and p1 < p2 and p2 - p1 < 1000"


@query("insert_size", f"""
select split, count_if({_INNER}) as inner_pairs, cast(coalesce(sum(case when {_INNER} then p2 - p1 end), 0) as bigint) as insert_sum,
 round(coalesce(sum(case when {_INNER} then p2 - p1 end), 0) / greatest(count_if({_INNER}), 1), 6) as avg_insert
from @classified group by split""")
def insert_size(spark, d):
    return reads.insert_size(flow.classified(spark, d)).withColumn("avg_insert", F.round("avg_insert", 6))


def _shift(i: int, j: int) -> str:
    gap = f"(avg_insert - {query_len('cigar1')} - {query_len('cigar2')})"
    clip = {n: f"(case when s{n} = 0 then {trail_clip(f'cigar{n}')} else {lead_clip(f'cigar{n}')} end)" for n in (1, 2)}
    return (f"cast(ip{i} + (case when s{i} = 0 then 1 else -1 end) * (case when {clip[i]} = 0 and {clip[j]} = 0 then trunc({gap} / 2)"
            f" when {clip[i]} = 0 and {clip[j]} > 0 then trunc({gap}) + {clip[j]} else 0 end) as bigint) as ip{i}")


@query("adjust_insert_size", f"""
select qname, {_shift(1, 2)}, {_shift(2, 1)} from @classified join (select split,
 coalesce(sum(case when {_INNER} then p2 - p1 end), 0) / greatest(count_if({_INNER}), 1) as avg_insert from @classified group by split) using (split)
where status in ('normal', 'chimeric')""")
def adjust_insert_size(spark, d):
    found = cut(flow.classified(spark, d))
    sizes = cut(reads.insert_size(found))
    return reads.adjust_insert_size(reads.accepted(found), sizes).select("qname", "ip1", "ip2")


@query("pair_mates", """
select a.qname, cast(a.flag & 16 as int) as s1, a.rname as c1, cast(a.ip as bigint) as p1, a.mapq as q1, cast(b.flag & 16 as int) as s2, b.rname as c2,
 cast(b.ip as bigint) as p2, b.mapq as q2 from @tagged a join @tagged b on a.qname = b.qname
 where a.rt in (0, 2, 4) and b.rt = a.rt + 1 and a.mapq >= 1 and b.mapq >= 1""")
def pair_mates(spark, d):
    return reads.pair_mates(flow.tagged(spark, d), 1).select("qname", *[f"{c}{i}" for i in (1, 2) for c in "scpq"])


@query("pair_mates_sorted", """
select qname, rname as c1, cast(ip as bigint) as p1, case when rnext = '=' then rname else rnext end as c2, cast(mp as bigint) as p2
from @linked where rt between 0 and 5 and mapq >= 1 and mate_mapq >= 1
 and ((rnext = '=' and ip < mp) or (rnext <> '=' and rnext >= rname))
union all
select distinct qname, rname, cast(ip as bigint), rname, cast(mp as bigint) from @linked
 where rt between 0 and 5 and mapq >= 1 and mate_mapq >= 1 and rnext = '=' and ip = mp""")
def pair_mates_sorted(spark, d):
    return reads.pair_mates_sorted(flow.linked(spark, d), 1).select("qname", "c1", "p1", "c2", "p2")


@query("junction_reads", """
select platform, rt, count(*) as n from (select cast(rt as int) as rt, case when cast(substr(qname, 3) as bigint) % 4 = 0 then '454' else 'ILLUMINA' end as platform
 from @tagged) where (platform = 'ILLUMINA' and rt between 2 and 5) or (platform = '454' and rt between 0 and 1) group by all""")
def junction_reads(spark, d):
    number = F.substring("qname", 3, 20).cast("bigint")
    records = flow.tagged(spark, d).withColumn("platform", F.when(number % 4 == 0, "454").otherwise("ILLUMINA"))
    return pairs.junction_reads(records, F.col("platform")).groupBy("platform", "rt").agg(F.count("*").alias("n"))


@query("accessibility_track", """
select rname as chrom, cast(ip - 1 as bigint) as start, cast(ip as bigint) as "end", count(*) as n from @tagged
 where rt between 2 and 5 and mapq >= 1 group by rname, ip""")
def accessibility_track(spark, d):
    return tracks.sort_track(tracks.accessibility(flow.tagged(spark, d), "ILLUMINA", 1))


@query("diploid_tracks", """
select homolog as chrom, cast(ip - 1 as bigint) as start, cast(ip as bigint) as "end", count(*) as raw,
 count_if(list_contains(rts, rt + 1 - 2 * (rt % 2))) as corrected
from @linked l join @phased_reads p on l.qname = p.qname and l.rname = p.rname where l.rt between 2 and 5 group by homolog, ip""")
def diploid_tracks(spark, d):
    records = flow.linked(spark, d)
    return tracks.diploid_accessibility(records, flow.homologs(records))


@query("assign_homologs", """
select l.qname, homolog as c1, cast(min_by(ip, rt) as bigint) as p1, cast(max_by(ip, rt) as bigint) as p2
from @linked l join @phased_reads p on l.qname = p.qname and l.rname = p.rname
where rt between 0 and 5 and rnext in ('=', '*') group by l.qname, homolog having count(*) = 2""")
def assign_homologs(spark, d):
    records = cut(flow.linked(spark, d))
    return tracks.assign_homologs(records, flow.homologs(records)).select("qname", "c1", "p1", "p2")


@query("mark_duplicates", """
with ends as (select *, row_number() over (partition by c1, c2, s1, s2, p1, p2 order by qname) as rn from @classified where status in ('normal', 'chimeric'))
select t.qname, t.rec_no, cast(case when e.rn > 1 then t.flag | 1024 else t.flag end as int) as flag
from @tagged t left join ends e on t.qname = e.qname""")
def mark_duplicates(spark, d):
    records = derive(spark, d, "alignments")
    found = reads.classify(records)
    verdicts = duplicates.dedup(pairs.dummy_fragments(reads.accepted(found)), exact=True)
    return duplicates.mark_duplicates(reads.tag_records(records, found), verdicts).select("qname", "rec_no", "flag")


@query("count_duplicates", """
with ends as (select *, row_number() over (partition by c1, c2, s1, s2, p1, p2 order by qname) as rn from @classified where status in ('normal', 'chimeric'))
select count(*) as dups from @tagged t join ends e on t.qname = e.qname
where e.rn > 1 and (flag & 65) = 65 and (flag & 256) = 0""")
def count_duplicates(spark, d):
    records = derive(spark, d, "alignments")
    found = reads.classify(records)
    verdicts = duplicates.dedup(pairs.dummy_fragments(reads.accepted(found)), exact=True)
    return duplicates.count_duplicates(duplicates.mark_duplicates(reads.tag_records(records, found), verdicts))


@query("paired_count", "select count_if((flag & 1) = 1) * 2 as paired from @alignments")
def paired_count(spark, d):
    return quality.paired_count(derive(spark, d, "alignments"))


@query("abnormal_records", "select qname, rec_no, rname, pos from @tagged where rt = 8")
def abnormal_records(spark, d):
    return collisions.collect_abnormal(flow.tagged(spark, d)).select("qname", "rec_no", "rname", "pos")


_WAYS = f"""
with abn as (select qname, list({{'chrom': rname, 'pos': pos, 'strand': flag & 16, 'rec_no': rec_no}} order by rname, pos, flag & 16, rec_no) as recs,
  count(*) as k from @tagged where rt = 8 group by qname having bool_and(mapq >= 10 and regexp_matches(rname, '{names.STANDARD_CHROMOSOME}')))
"""


@query("abnormal_groups", _WAYS + """
select qname, k, list_aggregate(list_transform(recs, lambda r: concat(r.chrom, ':', r.pos, ':', r.strand)), 'string_agg', ',') as ways from abn""")
def abnormal_groups(spark, d):
    groups = collisions.abnormal_groups(collisions.collect_abnormal(flow.tagged(spark, d)))
    text = F.transform("recs", lambda r: F.concat_ws(":", r["chrom"], r["pos"].cast("string"), r["strand"].cast("string")))
    return collisions.sort_groups(groups).select("qname", "k", F.array_join(text, ",").alias("ways"))


# positions are folded to a few hundred loci so that groups of one kind come close
_FOLD = 40


@query("collision_duplicates", f"""
with recursive folded as (select qname, list({{'chrom': rname, 'pos': pos % {_FOLD}, 'strand': flag & 16, 'rec_no': rec_no}}
   order by rname, pos % {_FOLD}, flag & 16, rec_no) as recs from @tagged where rt = 8 group by qname
  having bool_and(mapq >= 10 and regexp_matches(rname, '{names.STANDARD_CHROMOSOME}'))),
keyed as (select qname, list_transform(recs, lambda r: concat(r.strand, r.chrom)) as key, list_transform(recs, lambda r: r.pos) as pos from folded),
num as (select *, row_number() over (partition by key order by pos, qname) as rn from keyed),
walk as (select key, rn, qname, [pos] as kept, false as dup from num where rn = 1
 union all
 select n.key, n.rn, n.qname, case when len(list_filter(w.kept, lambda k: list_bool_and(list_transform(list_zip(k, n.pos), lambda z: abs(z[1] - z[2]) <= 4)))) > 0
   then w.kept else list_append(w.kept, n.pos) end,
  len(list_filter(w.kept, lambda k: list_bool_and(list_transform(list_zip(k, n.pos), lambda z: abs(z[1] - z[2]) <= 4)))) > 0
 from walk w join num n on n.key = w.key and n.rn = w.rn + 1)
select qname, dup as is_dup from walk""")
def collision_duplicates(spark, d):
    records = collisions.collect_abnormal(flow.tagged(spark, d)).withColumn("pos", F.col("pos") % _FOLD)
    return collisions.dedup_groups(collisions.abnormal_groups(records)).select("qname", "is_dup")


def _tag(name, kind, value):
    return F.struct(F.lit(name).alias("tag"), F.lit(kind).alias("type"), value.alias("value"))


@query("sam_text", """
select qname, rec_no, flag, rname, pos, mapq, cigar, concat(cast(rec_no as varchar), ':', split) as note, 'iZfA' as types from @alignments""")
def sam_text(spark, d):
    records = derive(spark, d, "alignments").withColumns({
        "rnext": F.lit("*"), "pnext": F.lit(0), "tlen": F.lit(0), "seq": F.lit("*"), "qual": F.lit("*"),
        "tags": F.array(_tag("RC", "i", F.col("rec_no").cast("string")), _tag("NT", "Z", F.concat_ws(":", F.col("rec_no").cast("string"), "split")),
                        _tag("AS", "f", (F.col("mapq") / 2).cast("string")), _tag("NT", "A", F.lit("x")))})
    lines = sam.format_sam(records).select(F.col("value").alias("text"), F.lit(0).alias("order"))
    parsed = sam.parse_sam(lines)
    return parsed.select("qname", names.sam_tag(F.col("tags"), "RC").cast("int").alias("rec_no"), "flag", "rname", "pos",
                         "mapq", "cigar", names.sam_tag(F.col("tags"), "NT").alias("note"), F.array_join(F.transform("tags", lambda t: t["type"]), "").alias("types"))


@query("sequencing_summary", """
with t as (select cast(sum(total) as bigint) as total, cast(sum(unmapped) as bigint) as unmapped, cast(sum(normal) as bigint) as normal,
 cast(sum(chimeric) as bigint) as chimeric, cast(sum(ligations) as bigint) as ligations from @split_stats),
k as (select count_if(dup) as dups from @verdicts)
select total, unmapped, normal, chimeric, ligations, normal + chimeric as alignable, dups as duplicates, normal + chimeric - dups as "unique",
 round(unmapped * 100.0::double / total, 2) as unmapped_pct, round((normal + chimeric - dups) * 100.0::double / (normal + chimeric), 2) as unique_of_alignable_pct,
 round(dups * 100.0::double / total, 2) as duplicates_pct from t, k""")
def sequencing_summary(spark, d):
    verdicts = duplicates.dedup(flow.contact_pairs(spark, d))
    dups = verdicts.agg(F.count_if(F.col("dup_class") != "unique")).first()[0]
    summary = statistics.sequencing_summary(derive(spark, d, "split_stats"), dups)
    return summary.select("total", "unmapped", "normal", "chimeric", "ligations", "alignable", "duplicates", "unique",
                          "unmapped_pct", "unique_of_alignable_pct", "duplicates_pct")


@query("sequencing_summary_single_end", """
with c as (select count(*) as total, count_if(k = 1 and not r1.mapped or k = 2 and not (r1.mapped and r2.mapped)) as unmapped,
 count_if(k = 2 and r1.mapped and r2.mapped) as chimeric, count_if(k > 2) as ambiguous, count_if(k = 1 and r1.mapped) as singleton from @groups)
select total, unmapped, chimeric, ambiguous, singleton, unmapped + singleton as no_chimera, singleton - 5 as single_unique,
 chimeric - 20 as "unique", chimeric - 20 + singleton - 5 as total_unique, cast(25 as bigint) as total_duplicates,
 round((singleton - 5) * 100.0::double / singleton, 2) as single_unique_of_aligned_pct,
 round((chimeric - 20 + singleton - 5) * 100.0::double / (singleton + chimeric), 2) as total_unique_of_aligned_pct from c""")
def sequencing_summary_single_end(spark, d):
    counters = reads.split_counters(reads.classify(derive(spark, d, "alignments"), single_end=True))
    summary = statistics.sequencing_summary(counters, 20, 5, single_end=True)
    return summary.select("total", "unmapped", "chimeric", "ambiguous", "singleton", "no_chimera", "single_unique", "unique",
                          "total_unique", "total_duplicates", "single_unique_of_aligned_pct", "total_unique_of_aligned_pct")


@query("read_contacts_dedup", """
with recursive p as (select qname, cast(s1 as int) as s1, cast(s2 as int) as s2, c1, c2, cast(p1 as bigint) as p1, cast(p2 as bigint) as p2 from @classified where status in ('normal', 'chimeric')),
f as (select p.*, coalesce(a.idx + 1, 0) as f1, coalesce(b.idx + 1, 0) as f2 from p asof left join @sites a on p.c1 = a.chrom and p.p1 >= a.pos
 asof left join @sites b on p.c2 = b.chrom and p.p2 >= b.pos),
g as (select *, row_number() over (partition by c1, c2, f1, f2, s1, s2 order by p1, p2, qname) as rn from f),
walk as (select c1, c2, f1, f2, s1, s2, rn, qname, [{'a': p1, 'b': p2}] as kept, false as dup from g where rn = 1
 union all
 select g.c1, g.c2, g.f1, g.f2, g.s1, g.s2, g.rn, g.qname,
  case when len(list_filter(w.kept, lambda k: abs(k.a - g.p1) <= 4 and abs(k.b - g.p2) <= 4)) > 0 then w.kept else list_append(w.kept, {'a': g.p1, 'b': g.p2}) end,
  len(list_filter(w.kept, lambda k: abs(k.a - g.p1) <= 4 and abs(k.b - g.p2) <= 4)) > 0
 from walk w join g on g.c1 = w.c1 and g.c2 = w.c2 and g.f1 = w.f1 and g.f2 = w.f2 and g.s1 = w.s1 and g.s2 = w.s2 and g.rn = w.rn + 1)
select qname from walk where not dup""")
def read_contacts_dedup(spark, d):
    both = fragments.assign_fragments(reads.accepted(flow.classified(spark, d)), flow.sites(spark, d))
    return duplicates.unique_pairs(both).select("qname")


@query("phase_candidates_by_read", """
select qname, c1, cast(p1 as bigint) as p1, cast(p2 as bigint) as p2 from @classified
 where status in ('normal', 'chimeric') and c1 = c2 and q1 >= 10 and q2 >= 10""")
def phase_candidates_by_read(spark, d):
    return phasing.phasing_candidates(reads.accepted(flow.classified(spark, d))).select("qname", "c1", "p1", "p2")
