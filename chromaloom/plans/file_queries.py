"""Queries that write text or matrix files of the domain and read them back."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions import measures
from ..operators import collisions, duplicates, fragments, matrix, pairs, phasing, reads, statistics, tracks
from ..operators.support import cut, shared_folder
from ..sources import alignments as sam
from ..sources import contacts, reports
from . import flow
from .inputs import derive
from .matrix_queries import _LOOPS, _MIRROR, _TYPED, _loops, _matrix, _pixels
from .pair_queries import _DIST_HIST, _MAPQ_HIST, _PHASE, _SITE_HIST
from .read_queries import _tag
from .registry import TWINS, query
from .stages import Stages


def _folder(spark, name):
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


# lines of one gzipped file, which is read by one task whatever its length
GZ_LINES = 500_000


def _gz(lines, path):
    lines.write.options(compression="gzip", maxRecordsPerFile=GZ_LINES, **{"zlib.compress.level": "BEST_SPEED"}).text(path)


@query("sam_records", """
select qname, rec_no, flag, rname, pos, mapq, cigar, split as "group", cast(mapq as varchar) as score, 'Zi' as types from @alignments""")
def sam_records(spark, d):
    """Alignment text in order of reads, gzipped, read back with ordinals and typed tags."""
    records = derive(spark, d, "alignments").withColumns({
        "rnext": F.lit("*"), "pnext": F.lit(0), "tlen": F.lit(0), "seq": F.lit("*"), "qual": F.lit("*"),
        "tags": F.array(_tag("RG", "Z", F.col("split")), _tag("AS", "i", F.col("mapq").cast("string")))})
    path = _folder(spark, "sam")
    _gz(sam.format_sam(records.orderBy("qname", "rec_no")), path)
    found = sam.read_sam(spark, path)
    tag = sam.names.sam_tag
    return found.select("qname", "rec_no", "flag", "rname", "pos", "mapq", "cigar", tag(F.col("tags"), "RG").alias("group"),
                        tag(F.col("tags"), "AS").alias("score"), F.array_join(F.transform("tags", lambda t: t["type"]), "").alias("types"))


@query("fastq_reads", "select seq1, count(*) as n from @raw_pairs group by 1")
def fastq_reads(spark, d):
    """Read sequences from four-line records, gzipped."""
    lines = derive(spark, d, "raw_pairs").select(F.concat_ws("\n", F.concat(F.lit("@"), "qname"), "seq1", F.lit("+"), F.repeat(F.lit("I"), F.length("seq1"))).alias("value"))
    path = _folder(spark, "fastq")
    _gz(lines, path)
    return sam.read_fastq(spark, path).groupBy("seq1").agg(F.count("*").alias("n"))


@query("fasta_lines", """
select chrom, cast(row_number() over (partition by chrom order by line_no) as bigint) as line, seq from @genome_lines""")
def fasta_lines(spark, d):
    """Genome text with a header line per chromosome."""
    body = derive(spark, d, "genome_lines")
    heads = body.select("chrom").distinct().select("chrom", F.lit(-1).cast("bigint").alias("line_no"), F.concat(F.lit(">"), "chrom", F.lit(" assembled")).alias("value"))
    lines = heads.unionByName(body.select("chrom", "line_no", F.lower("seq").alias("value")))
    path = _folder(spark, "fasta")
    # a chromosome's lines follow its header in one file, as the format has it
    lines.repartition("chrom").sortWithinPartitions("chrom", "line_no").select("value").write.text(path)
    found = cut(sam.read_fasta(spark, path))
    first = found.groupBy("chrom").agg(F.min("line_no").alias("first"))
    return found.join(first, "chrom").select("chrom", ((F.col("line_no") - F.col("first")) / sam.MAX_LINE + 1).cast("bigint").alias("line"), "seq")


@query("contact_list", """
select qname, s1, c1, p1, f1, s2, c2, p2, f2, q1, cigar1, seq1, q2, cigar2, seq2, qname as name1, qname as name2 from @pairs""")
def contact_list(spark, d):
    """Contacts with 16 columns, gzipped, read back."""
    path = _folder(spark, "contacts")
    _gz(contacts.format_contacts(flow.contact_pairs(spark, d), "long"), path)
    return contacts.read_contacts(spark, path, "long")


@query("cytosine_file", "select chrom, pos, strand, n_meth, n_unmeth, context from @cytosine")
def cytosine_file(spark, d):
    path = _folder(spark, "cytosine")
    report = derive(spark, d, "cytosine").select("chrom", "pos", "strand", "n_meth", "n_unmeth", "context", F.lit("CNN").alias("trinucleotide"))
    report.write.option("sep", "\t").option("compression", "gzip").csv(path)
    return reports.read_cytosine_report(spark, path)


@query("histogram_file", f"""
select hist, bin, series, n from (select 'A' as hist, bin, 'all' as series, n from ({_SITE_HIST}) a
 union all select 'B', bin, series, n from ({_MAPQ_HIST}) b union all select 'D', bin, series, n from ({_DIST_HIST}) e) where n > 0""")
def histogram_file(spark, d):
    path = _folder(spark, "hists")
    reports.write_hists(cut(statistics.hists(flow.unique_contacts(spark, d), flow.sites(spark, d))), path)
    return reports.read_hists(spark, path).select("hist", "bin", "series", "n")


@query("loop_list", f"""
with {_LOOPS} select c1, cast(cx * 100000 as bigint) as x1, cast(cx * 100000 + 100000 as bigint) as x2, c1 as c2, cast(cy * 100000 as bigint) as y1,
 cast(cy * 100000 + 100000 as bigint) as y2 from lp""")
def loop_list(spark, d):
    """Loops as a paired interval list with a header line."""
    path = _folder(spark, "bedpe")
    header = spark.createDataFrame([("#chr1\tx1\tx2\tchr2\ty1\ty2",)], "value string")
    rows = _loops(spark, d).select(F.concat_ws("\t", "c1", "x1", "x2", "c2", "y1", "y2").alias("value"))
    header.unionByName(rows).write.text(path)
    return contacts.read_bedpe(spark, path)


@query("interval_list", "select c1 as chrom, p1 as start, p1 + 20 as \"end\", qname as name, case when s1 = 0 then '+' else '-' end as strand from @canon")
def interval_list(spark, d):
    path = _folder(spark, "bed")
    canonical = pairs.canonical_pair(derive(spark, d, "raw_pairs"))
    rows = canonical.select(F.concat_ws("\t", "c1", "p1", (F.col("p1") + 20).cast("string"), "qname", F.lit("0"), F.when(F.col("s1") == 0, "+").otherwise("-")).alias("value"))
    _gz(rows, path)
    return contacts.read_bed(spark, path)


@query("homolog_file", "select qname, homolog, rt from @homologs")
def homolog_file(spark, d):
    path = _folder(spark, "homologs")
    flow.homologs(flow.linked(spark, d)).select(F.concat_ws(" ", "qname", "homolog", F.col("rt").cast("string")).alias("value")).write.text(path)
    return contacts.read_homologs(spark, path)


@query("track_file", """
select chrom, cast(p // 50 * 50 as bigint) as start, cast(p // 50 * 50 + 50 as bigint) as "end", count(*) as n from (select c1 as chrom, p1 as p from @uniq where q1 > 0 and q2 > 0 and f1 <> f2
 union all select c2, p2 from @uniq where q1 > 0 and q2 > 0 and f1 <> f2) group by all""")
def track_file(spark, d):
    path = _folder(spark, "track")
    contacts.write_bedgraph(tracks.coverage(flow.unique_contacts(spark, d)).withColumn("end", F.col("start") + 50), path)
    return contacts.read_bedgraph(spark, path)


@query("matrix_store", f"select {_TYPED} from ({_pixels(100_000)}) x")
def matrix_store(spark, d):
    """Pixels of one resolution out of a store of two."""
    path = _folder(spark, "matrix")
    contacts.write_matrix(_matrix(spark, d, (500_000, 100_000)), path)
    return contacts.read_matrix(spark, path, 100_000)


def _placed(df):
    """Rows with their place in a sorted table: the partition's rows before it and those of earlier partitions."""
    table = cut(df.select("*", F.monotonically_increasing_id().alias("_id")))
    part = F.shiftright("_id", 33)
    counts = table.groupBy(part.alias("_part")).agg(F.count("*").alias("n")).orderBy("_part").collect()
    starts, total = [], 0
    for r in counts:
        starts.append((r["_part"], total))
        total += r["n"]
    base = df.sparkSession.createDataFrame(starts, "_part long, _base long")
    placed = table.withColumn("_part", part).join(F.broadcast(base), "_part")
    return placed.withColumn("place", F.col("_base") + F.col("_id").bitwiseAND(F.lit((1 << 33) - 1)) + 1).drop("_part", "_base", "_id")


@query("block_order", "select qname, row_number() over (order by c1, c2, f1, f2, s1, s2, p1, p2, qname) as place from @pairs")
def block_order(spark, d):
    """Place of every pair in contact-block order."""
    return _placed(pairs.sort_by_contact_block(flow.contact_pairs(spark, d)).select("qname"))


@query("chromosome_order", "select qname, row_number() over (order by c1, c2, f1, f2, s1, s2, p1, p2, qname) as place from @pairs")
def chromosome_order(spark, d):
    return _placed(pairs.sort_by_chromosomes_first(flow.contact_pairs(spark, d)).select("qname"))


@query("merged_order", "select qname, experiment, row_number() over (order by c1, c2, p1, p2, qname) as place from @pairs")
def merged_order(spark, d):
    """Place of every pair in the merged list of three experiments."""
    both = cut(flow.contact_pairs(spark, d).select("qname", "experiment", "c1", "c2", "p1", "p2"))
    merged = pairs.merge_sorted([both.where(F.col("experiment") == f"exp{i}") for i in range(3)])
    return _placed(merged.select("qname", "experiment"))


def _unique_reads(experiment: str = "0") -> str:
    """Whole experiments from alignment records: unique contacts of the accepted reads at interior positions."""
    key = "e, c1, c2, f1, f2, s1, s2"
    same = " and ".join(f"g.{c} = w.{c}" for c in key.split(", "))
    return f"""recursive p as (select {experiment} as e, qname, cast(s1 as int) as s1, cast(s2 as int) as s2, c1, c2, cast(p1 as bigint) as p1, cast(p2 as bigint) as p2, cast(ip1 as bigint) as ip1,
 cast(ip2 as bigint) as ip2, q1, q2 from @classified where status in ('normal', 'chimeric')),
f as (select p.*, coalesce(a.idx + 1, 0) as f1, coalesce(b.idx + 1, 0) as f2 from p asof left join @sites a on p.c1 = a.chrom and p.p1 >= a.pos
 asof left join @sites b on p.c2 = b.chrom and p.p2 >= b.pos),
g as (select *, row_number() over (partition by {key} order by p1, p2, qname) as rn from f),
walk as (select {key}, rn, qname, [{{'a': p1, 'b': p2}}] as kept, false as dup from g where rn = 1
 union all
 select {", ".join(f"g.{c}" for c in key.split(", "))}, g.rn, g.qname,
  case when len(list_filter(w.kept, lambda k: abs(k.a - g.p1) <= 4 and abs(k.b - g.p2) <= 4)) > 0 then w.kept else list_append(w.kept, {{'a': g.p1, 'b': g.p2}}) end,
  len(list_filter(w.kept, lambda k: abs(k.a - g.p1) <= 4 and abs(k.b - g.p2) <= 4)) > 0
 from walk w join g on {same} and g.rn = w.rn + 1),
u as (select g.*, l.v as q, abs(ip1 - ip2) as d from g join (select qname from walk where not dup) k on g.qname = k.qname, (values (1), (30)) as l(v))"""


_UNIQUE_READS = _unique_reads()
_READ_NUMBER = "cast(substr(qname, 3) as bigint) % 3"
_EXPERIMENT_STATISTICS = """t as (select *, case when c1 = c2 and f1 = f2 then 'intra' when least(q1, q2) < q then 'low' else 'contact' end as status from u)
select cast(q as int) as q, count(*) as unique_pairs, count_if(status = 'intra') as intra_fragment, count_if(status = 'low') as below_mapq,
 count_if(status = 'contact') as contacts, count_if(status = 'contact' and c1 <> c2) as inter, count_if(status = 'contact' and c1 = c2) as intra,
 count_if(status = 'contact' and c1 = c2 and d >= 10 and d < 20000) as short, count_if(status = 'contact' and c1 = c2 and d >= 20000) as long,
 cast(null as bigint) as ligation, cast(null as bigint) as dangling from t group by q"""
_EXPERIMENT_MATRIX = """select cast(q as int) as q, cast(100000 as bigint) as res, c1, c2,
 cast(case when c1 = c2 then least(ip1 // 100000, ip2 // 100000) else ip1 // 100000 end as bigint) as b1,
 cast(case when c1 = c2 then greatest(ip1 // 100000, ip2 // 100000) else ip2 // 100000 end as bigint) as b2, count(*) as n from u
 where q1 >= q and q2 >= q group by all"""


def _experiment(spark, d):
    return flow.process(derive(spark, d, "alignments"), flow.sites(spark, d), _folder(spark, "experiment"), (100_000,), norms=("VC",))


@query("experiment_statistics", f"with {_UNIQUE_READS}, {_EXPERIMENT_STATISTICS}")
def experiment_statistics(spark, d):
    """Statistics of a whole experiment at two mapping qualities; the reads have no sequences."""
    return _experiment(spark, d)["statistics"].select(
        "q", "unique_pairs", "intra_fragment", "below_mapq", "contacts", "inter", "intra", "short", "long", "ligation", "dangling")


@query("experiment_matrix", f"with {_UNIQUE_READS} {_EXPERIMENT_MATRIX}")
def experiment_matrix(spark, d):
    """Contact matrix of a whole experiment at two mapping qualities."""
    return _experiment(spark, d)["matrix"].select("q", "res", "c1", "c2", "b1", "b2", "n")


@query("resumed_experiment", f"with {_UNIQUE_READS}, x as ({_EXPERIMENT_MATRIX}) select *, cast(0 as bigint) as stages_made, cast(8 as bigint) as stages_read from x")
def resumed_experiment(spark, d):
    """Matrix of an experiment that is run again: all its stages are read."""
    path = _folder(spark, "resumed")
    flow.process(derive(spark, d, "alignments"), flow.sites(spark, d), path, (100_000,), norms=("VC",))
    again = Stages(spark, path)
    found = flow.process(derive(spark, d, "alignments"), flow.sites(spark, d), path, (100_000,), norms=("VC",), stages=again)
    counts = {"stages_made": F.lit(len(again.made)).cast("bigint"), "stages_read": F.lit(len(again.read)).cast("bigint")}
    return found["matrix"].select("q", "res", "c1", "c2", "b1", "b2", "n").withColumns(counts)


def _merged_experiment(spark, d):
    """Three experiments, by the number of the read, each processed on its own and then merged."""
    records = derive(spark, d, "alignments")
    number = F.substring("qname", 3, 20).cast("bigint") % 3
    parts = [flow.process(records.where(number == k), flow.sites(spark, d), _folder(spark, f"experiment{k}"), (100_000,), norms=("VC",)) for k in range(3)]
    return flow.merge(parts, _folder(spark, "merged"), norms=("VC",))


@query("merged_experiment", f"with {_unique_reads(_READ_NUMBER)} {_EXPERIMENT_MATRIX}")
def merged_experiment(spark, d):
    """Matrix of three experiments added up from their own."""
    return _merged_experiment(spark, d)["matrix"].select("q", "res", "c1", "c2", "b1", "b2", "n")


@query("merged_experiment_statistics", f"with {_unique_reads(_READ_NUMBER)}, {_EXPERIMENT_STATISTICS}")
def merged_experiment_statistics(spark, d):
    """Statistics of three experiments added up from their own."""
    return _merged_experiment(spark, d)["statistics"].select(
        "q", "unique_pairs", "intra_fragment", "below_mapq", "contacts", "inter", "intra", "short", "long", "ligation", "dangling")


@query("merged_experiment_contacts", f"with {_unique_reads(_READ_NUMBER)} select qname, c1, ip1 as p1, c2, ip2 as p2, q1, q2 from u where q = 1")
def merged_experiment_contacts(spark, d):
    """Contacts of three experiments in one list."""
    return _merged_experiment(spark, d)["contacts"].select("qname", "c1", "p1", "c2", "p2", "q1", "q2")


def _diploid(spark, d):
    path = _folder(spark, "linked")
    flow.linked(spark, d).write.parquet(path)
    records = spark.read.parquet(path)
    return flow.diploid(records, flow.homologs(records), _folder(spark, "diploid"), (100_000,))


@query("diploid_experiment", TWINS["homolog_matrices"])
def diploid_experiment(spark, d):
    """Matrices of each homolog from a diploid experiment's stages."""
    return _diploid(spark, d)["homolog_matrices"].select("res", "homolog", "c1", "b1", "b2", "n")


@query("diploid_experiment_tracks", TWINS["diploid_tracks"])
def diploid_experiment_tracks(spark, d):
    """Accessibility by homolog from a diploid experiment's stages."""
    return _diploid(spark, d)["diploid_tracks"]


@query("phased_by_chromosome", _PHASE + "select p.c1 as chrom, p.qname, cast(p.p1 as bigint) as p1, p.c2, cast(p.p2 as bigint) as p2, snp1 as snps1, snp2 as snps2, category from phased h join @pairs p on h.qname = p.qname")
def phased_by_chromosome(spark, d):
    """Phased pairs written by chromosome and read back, each with the folder it lay in."""
    path = _folder(spark, "phased")
    phasing.write_by_chromosome(phasing.phase_pairs(flow.contact_pairs(spark, d), derive(spark, d, "snps")), path)
    folder = F.regexp_extract(F.input_file_name(), "/chrom=([^/]+)/", 1)
    return spark.read.parquet(path).select(folder.alias("chrom"), "qname", "p1", "c2", "p2", "snps1", "snps2", "category")


@query("phased_variants_of_sample", """
with v as (select 's2' as sample, * from @snps union all select 's1', chrom, pos, mat, pat from @snps), one as (select chrom, pos, pat, mat from v where sample = 's1')
select p.qname, s.pos as snp_pos, nullif(substr(p.seq1, cast(s.pos - p.p1 + 1 as int), 1), '') as base, s.pat, s.mat from @pairs p join one s on s.chrom = p.c1
 and p.s1 = 0 and p.cigar1 = '32M' and s.pos > p.p1 and s.pos <= p.p1 + 32 where p.c1 = p.c2 and p.q1 >= 10 and p.q2 >= 10""")
def phased_variants_of_sample(spark, d):
    """SNPs under forward first ends without gaps, for one of two samples."""
    own = derive(spark, d, "snps")
    both = own.withColumn("sample", F.lit("s2")).unionByName(own.select(
        "chrom", "pos", F.col("mat").alias("pat"), F.col("pat").alias("mat"), F.lit("s1").alias("sample")))
    plain = phasing.phasing_candidates(flow.contact_pairs(spark, d)).where("s1 = 0 and cigar1 = '32M'")
    return phasing.overlap_snps(plain, both, sample="s1").where("end = 1").select("qname", "snp_pos", "base", "pat", "mat")


@query("contacts_long", """
with recursive """ + _UNIQUE_READS.removeprefix("recursive ").rpartition(",\nu as")[0] + """
select g.qname, g.s1, g.c1, g.p1, g.f1, g.s2, g.c2, g.p2, g.f2, g.q1, g.q2, x.cigar1, x.cigar2 from g join (select qname from walk where not dup) k on g.qname = k.qname
 join @classified x on x.qname = g.qname""")
def contacts_long(spark, d):
    """Unique contacts of the long list: outer positions, fragments, qualities and alignments of both ends."""
    found = reads.accepted(flow.classified(spark, d))
    both = fragments.assign_fragments(found, flow.sites(spark, d))
    unique = duplicates.unique_pairs(both, carry=("q1", "q2", "cigar1", "cigar2"))
    return unique.select("qname", *pairs.SHORT_FORM, "q1", "q2", "cigar1", "cigar2")


@query("oversized_reads", "select qname, count(*) as k from (select 'rd' || cast(cast(substr(qname, 3) as bigint) % 2 as varchar) as qname, * exclude (qname) from @alignments) group by 1 having count(*) > 10000 and min(mapq) >= 0")
def oversized_reads(spark, d):
    """Names with more records than a read has bases: all records under two names."""
    hot = derive(spark, d, "alignments").withColumn("qname", F.concat(F.lit("rd"), (F.substring("qname", 3, 20).cast("bigint") % 2).cast("string")))
    return collisions.oversized_reads(hot, 0)


@query("region_of_two_chromosomes", f"""
with {_MIRROR}, av as (select c1, c2, b1, b2, n from ({_pixels(100_000)}) x where c1 = 'chr1' and c2 = 'chr2'),
raw as (select p.*, n / (a.total * b.total) as value from av p join rs a on a.chrom = p.c1 and a.i = p.b1 join rs b on b.chrom = p.c2 and b.i = p.b2)
select cast(b1 * 100000 as bigint) as x, cast(b2 * 100000 as bigint) as y, round(value * (select sum(n) / sum(value) from raw), 6) as value from raw
 where b1 between 5 and 20 and b2 between 10 and 40""")
def region_of_two_chromosomes(spark, d):
    """Normalised rectangle between two chromosomes."""
    m = cut(_matrix(spark, d, (100_000,)))
    found = matrix.extract_region(m, 100_000, ("chr1", 500_000, 2_000_000), ("chr2", 1_000_000, 4_000_000), cut(matrix.norm_vectors(m, "VC")))
    return found.select("x", "y", F.round("value", 6).alias("value"))


@query("merged_report", """
select cast(sum(total) as bigint) as total, cast(sum(unmapped) as bigint) as unmapped, cast(sum(normal) as bigint) as normal, cast(sum(chimeric) as bigint) as chimeric,
 cast(sum(ligations) as bigint) as ligations, round(sum(unmapped) * 100.0::double / sum(total), 2) as unmapped_pct, round(avg(total % 97 + 0.25), 2) as avg_insert from @split_stats""")
def merged_report(spark, d):
    """One report per split, written as text, read back and merged."""
    stats = derive(spark, d, "split_stats")
    label = {c: k for k, c in reports.MERGED_LABELS.items()}
    lines = [F.concat(F.lit(f" {label[c]}: "), measures.commify(F.col(c)), F.lit(" (1.50%)")) for c in ("total", "unmapped", "normal", "chimeric", "ligations")]
    lines.append(F.format_string(reports.INSERT_LINE, (F.col("total") % 97 + 0.25)))
    path = _folder(spark, "reports")
    stats.select("split", F.explode(F.array(*lines)).alias("value")).write.partitionBy("split").text(path)
    merged = reports.merge_reports(reports.read_stats_report(spark, f"{path}/*"))
    return merged.select("total", "unmapped", "normal", "chimeric", "ligations", "unmapped_pct", "avg_insert")


@query("report_lines", f"""
with c as ({TWINS["contact_statistics"]}) select label, cast(n as double) as n from c, lateral (values ('Intra-fragment Reads', intra_fragment), ('Below MAPQ Threshold', below_mapq),
 ('Hi-C Contacts', contacts), ('Ligation Motif Present', ligation), ('Inter-chromosomal', inter), ('Intra-chromosomal', intra), ('Short Range (<20Kb)', short), ('Long Range (>20Kb)', long)) v(label, n)""")
def report_lines(spark, d):
    """All counters of the contact report, formatted and read back."""
    unique = flow.unique_contacts(spark, d, ("q1", "q2", "seq1", "seq2"))
    lines = reports.format_contact_statistics(cut(statistics.contact_statistics(unique, flow.sites(spark, d), junction="GATC")))
    wanted = [label.strip() for label, _ in reports.CONTACT_LABELS]
    return reports.parse_stats(lines.withColumnRenamed("value", "text")).where(F.col("label").isin(wanted))
