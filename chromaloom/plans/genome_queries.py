"""Queries over genome text, variants, methylation and split counters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import measures, motifs
from ..operators import fragments, phasing, quality, sites, statistics
from ..sources import contacts as files
from ..sources import reports
from .inputs import derive
from .registry import query

_GENOME = """
with l as (select chrom, line_no, upper(seq) as seq from @genome_lines),
g as (select chrom, string_agg(seq, '' order by line_no) as seq from l group by chrom)
"""


def _hits(patterns: list[str], width: int = 5) -> str:
    tests = " or ".join(f"regexp_matches(substr(seq, i, {len(p.replace('[ACGT]', 'N'))}), '^{p}$')" for p in patterns)
    return f"select chrom, cast(i as bigint) as pos from (select chrom, seq, unnest(range(1, length(seq) + 1)) as i from g) where {tests}"


_SITES = _GENOME + """,
hit as (""" + _hits(["GATC", "GA[ACGT]TC"]) + """),
every as (select chrom, pos from hit union select chrom, length(seq) from g)
"""


@query("motif_positions", _GENOME + _hits(["GA[ACGT]TC", "GATC"]))
def motif_positions(spark, d):
    return sites.motif_positions(derive(spark, d, "genome_lines"), motifs.RECOGNITION["Arima"])


@query("restriction_sites", _SITES + "select chrom, row_number() over (partition by chrom order by pos) - 1 as idx, pos from every")
def restriction_sites(spark, d):
    return sites.restriction_sites(derive(spark, d, "genome_lines"), motifs.RECOGNITION["Arima"], group=1000)


@query("chrom_sizes", "select chrom, cast(sum(length(seq)) as bigint) as length from @genome_lines group by chrom")
def chrom_sizes(spark, d):
    cut_sites = sites.restriction_sites(derive(spark, d, "genome_lines"), motifs.RECOGNITION["DpnII"])
    return fragments.chrom_sizes(cut_sites)


@query("site_file", _SITES + "select chrom, row_number() over (partition by chrom order by pos) - 1 as idx, pos from every")
def site_file(spark, d):
    found = sites.restriction_sites(derive(spark, d, "genome_lines"), motifs.RECOGNITION["Arima"])
    return files.parse_sites(files.format_sites(found).withColumnRenamed("value", "text"))


@query("stitch_lines", """
select chrom, line_no, coalesce(sum(length(seq)) over (partition by chrom order by line_no rows between unbounded preceding and 1 preceding), 0)::bigint as "offset",
 coalesce(substr(lead(seq) over (partition by chrom order by line_no), 1, 5), '') as ahead from @genome_lines""")
def stitch_lines(spark, d):
    stitched = sites.stitch_lines(sites.with_offsets(derive(spark, d, "genome_lines"), group=100), 5)
    return stitched.select("chrom", "line_no", "offset", "ahead")


@query("fragments_of_genome", _SITES + """,
num as (select chrom, pos, row_number() over (partition by chrom order by pos) as n from every),
probe as (select concat('chr', 1 + l_partkey % 3) as chrom, cast(l_partkey * 37 + l_suppkey as bigint) as pos, count(*) as reads from lineitem group by all)
select p.chrom, p.pos, cast(coalesce(n.n, 0) as bigint) as frag, p.reads from probe p asof left join num n on p.chrom = n.chrom and p.pos >= n.pos""")
def fragments_of_genome(spark, d):
    found = sites.restriction_sites(derive(spark, d, "genome_lines"), motifs.RECOGNITION["Arima"])
    line = spark.read.parquet(f"{d}/lineitem.parquet")
    probe = line.groupBy(F.concat(F.lit("chr"), (1 + F.col("l_partkey") % 3).cast("string")).alias("c1"),
                         (F.col("l_partkey") * 37 + F.col("l_suppkey")).cast("bigint").alias("p1")).agg(F.count("*").alias("reads"))
    placed = fragments.assign_fragments(probe, found, sides=("1",), size=512)
    return placed.select(F.col("c1").alias("chrom"), F.col("p1").alias("pos"), F.col("f1").alias("frag"), "reads")


_JUNCTIONS = " ".join(f"when '{n}' then '{motifs.junction_for(n)}'" for n in sorted(motifs.JUNCTIONS))
_ENZYMES = ("HindIII", "MboI", "Arima", "StyI", "none", "CviAII+MseI", "MseI+CviAII", "Csp6I+CviAII", "MseI+CviAII+Csp6I", "MseI+Csp6I")
_ENZYME = f"case p_partkey % {len(_ENZYMES)} " + " ".join(f"when {i} then '{e}'" for i, e in enumerate(_ENZYMES)) + " end"
# the mixes in the order they are listed in
_LISTED = "case enzyme " + " ".join(f"when '{a}' then '{b}'" for a, b in (
    ("MseI+CviAII", "CviAII+MseI"), ("Csp6I+CviAII", "CviAII+Csp6I"), ("MseI+CviAII+Csp6I", "Csp6I+CviAII+MseI"), ("MseI+Csp6I", "Csp6I+MseI"))) + " else enzyme end"


@query("junction_by_enzyme", f"""
select enzyme, coalesce(case {_LISTED} {_JUNCTIONS} end, 'XXXX') as junction, count(*) as n from (select {_ENZYME} as enzyme from part) group by all""")
def junction_by_enzyme(spark, d):
    k = F.col("p_partkey") % len(_ENZYMES)
    enzyme = F.element_at(F.array(*map(F.lit, _ENZYMES)), (k + 1).cast("int"))
    return spark.read.parquet(f"{d}/part.parquet").groupBy(
        enzyme.alias("enzyme"), motifs.junction_column(enzyme).alias("junction")).agg(F.count("*").alias("n"))


_METHYL = motifs.methyl_pattern(motifs.junction_for("MboI"))


@query("methylated_junctions", f"select chrom, count_if(regexp_matches(seq, '{_METHYL}')) as ligations, count(*) as reads from @genome_lines group by chrom")
def methylated_junctions(spark, d):
    pattern = motifs.methyl_pattern(motifs.junction_for("MboI"))
    hit = motifs.has_junction(F.col("seq"), pattern)
    return derive(spark, d, "genome_lines").groupBy("chrom").agg(F.count_if(hit).alias("ligations"), F.count("*").alias("reads"))


_GENOTYPES = """
with v as (select 's1' as sample, chrom, pos, ref, alt, s1 as gt from @vcf union all select 's2', chrom, pos, ref, alt, s2 from @vcf),
x as (select *, list_prepend(ref, string_split(alt, ',')) as alleles, split_part(gt, ':', 1) as g from v),
y as (select *, len(list_filter(alleles, lambda a: length(a) <> 1)) = 0 and contains(g, '|') as phased from x)
"""


@query("phased_variants", _GENOTYPES + """
select sample, chrom, pos, alleles[cast(split_part(g, '|', 1) as int) + 1] as pat, alleles[cast(split_part(g, '|', 2) as int) + 1] as mat
from y where phased and split_part(g, '|', 1) <> split_part(g, '|', 2)""")
def phased_variants(spark, d):
    return phasing.phased_snps(derive(spark, d, "vcf"), ["s1", "s2"])[0]


@query("skipped_variants", _GENOTYPES + "select sample, chrom, pos, ref, alt, gt from y where not phased")
def skipped_variants(spark, d):
    return phasing.phased_snps(derive(spark, d, "vcf"), ["s1", "s2"])[1]


@query("conversion_report", """
with k as (select context = 'CG' as cpg, n_meth + n_unmeth > 0 as cov, n_meth < n_unmeth as un from @cytosine),
c as (select count_if(not cpg and cov and un) as chx_unmeth, count_if(not cpg and cov and not un) as chx_meth, count_if(not cpg) as chx_sites,
 count_if(cpg and cov and un) as cpg_unmeth, count_if(cpg and cov and not un) as cpg_meth, count_if(cpg) as cpg_sites from k)
select *, round(chx_unmeth * 100.0::double / (chx_unmeth + chx_meth + 1), 2) as conv_chx, round((chx_unmeth + chx_meth) * 100.0::double / chx_sites, 2) as cov_chx,
 round(cpg_unmeth * 100.0::double / (cpg_unmeth + cpg_meth + 1), 2) as conv_cpg, round((cpg_unmeth + cpg_meth) * 100.0::double / cpg_sites, 2) as cov_cpg from c""")
def conversion_report(spark, d):
    return statistics.conversion_report(derive(spark, d, "cytosine"))


@query("merge_stats", """
select cast(sum(total) as bigint) as total, cast(sum(unmapped) as bigint) as unmapped, cast(sum(normal) as bigint) as normal, cast(sum(chimeric) as bigint) as chimeric,
 round(sum(unmapped) * 100.0::double / sum(total), 2) as unmapped_pct, round(sum(normal) * 100.0::double / sum(total), 2) as normal_pct,
 round(sum(chimeric) * 100.0::double / sum(total), 2) as chimeric_pct from @split_stats""")
def merge_stats(spark, d):
    return statistics.merge_stats(derive(spark, d, "split_stats"), ("total", "unmapped", "normal", "chimeric"))


@query("stats_text", """
select split, label, cast(n as double) as n from @split_stats, lateral (values ('Sequenced Read Pairs', total), ('Unmapped', unmapped)) v(label, n)""")
def stats_text(spark, d):
    stats = derive(spark, d, "split_stats")
    lines = stats.select("split", F.explode(F.array(
        F.concat(F.lit("Sequenced Read Pairs:  "), measures.commify(F.col("total"))),
        F.concat(F.lit(" Unmapped: "), measures.commify(F.col("unmapped")), F.lit(" (1.50%)")))).alias("text"))
    return reports.parse_stats(lines, ("split",))


_BROKEN = """
with broken as (select split, case when split = 'split2' then total + 1 when split = 'split5' then 0 else total end as total, unmapped, normal, chimeric
 from @split_stats where split <> 'split7')
"""


def _broken(stats):
    total = F.when(F.col("split") == "split2", F.col("total") + 1).when(F.col("split") == "split5", 0).otherwise(F.col("total"))
    return stats.where("split <> 'split7'").withColumn("total", total)


@query("splits_to_redo", _BROKEN + """
select s.split, case when b.total is null then 'absent' when b.total = 0 then 'empty' else 'inconsistent' end as reason from @split_stats s
 left join broken b on s.split = b.split where b.total is null or b.total = 0 or b.total <> b.unmapped + b.normal + b.chimeric""")
def splits_to_redo(spark, d):
    stats = derive(spark, d, "split_stats")
    return quality.splits_to_redo(stats.select("split"), _broken(stats))


@query("split_consistency", _BROKEN + """
select cast(sum(total) as bigint) as total, cast(sum(unmapped + normal + chimeric) as bigint) as classified, (select cast(sum(total) as bigint) from @split_stats) as reads,
 sum(total) = sum(unmapped + normal + chimeric) as classes_add_up, sum(total) = (select sum(total) from @split_stats) as reads_add_up from broken""")
def split_consistency(spark, d):
    stats = derive(spark, d, "split_stats")
    return quality.consistency(_broken(stats), stats.select("split", (F.col("total") * 4).alias("lines")))
