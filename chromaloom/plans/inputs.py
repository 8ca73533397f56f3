"""Inputs of the domain derived from the given tables.

Every statement runs unchanged on Spark and on a plain SQL engine, so queries and their
checks start from the same rows. ``TABLES`` names the tables each one reads.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

SITES = """
select concat('chr',c.v) as chrom, cast(h.v*100+t.v*10+u.v as bigint) as idx,
 cast(case when h.v*100+t.v*10+u.v=999 then 5000100 else (h.v*100+t.v*10+u.v)*5000+((h.v*100+t.v*10+u.v)*(h.v*100+t.v*10+u.v)*37+c.v*11)%4000+1 end as bigint) as pos
from (values (1),(2),(3)) as c(v)
cross join (values (0),(1),(2),(3),(4),(5),(6),(7),(8),(9)) as h(v)
cross join (values (0),(1),(2),(3),(4),(5),(6),(7),(8),(9)) as t(v)
cross join (values (0),(1),(2),(3),(4),(5),(6),(7),(8),(9)) as u(v)
"""

RAW_PAIRS = """
with a as (select l.*, cast(l_quantity as bigint) as qty, cast(floor(l_extendedprice) as bigint) as ep,
 cast(1+((l_partkey%200)*99991)%5000000+(cast(l_quantity as bigint)%7) as bigint) as p1 from lineitem l)
select concat_ws(':',l_orderkey,l_linenumber,l_partkey,l_suppkey) as qname,
 cast(16*(l_linenumber%2) as int) as s1, concat('chr',1+l_partkey%3) as c1, p1,
 cast(16*(qty%2) as int) as s2,
 case when l_linenumber=3 then concat('chr',1+l_partkey%3) else concat('chr',1+l_suppkey%3) end as c2,
 cast(case when l_linenumber=3 then p1+(l_suppkey%10)*(l_suppkey%10)*400+ep%5 else 1+((l_suppkey%25)*123457+(l_partkey%4)*1500)%5000000+ep%7 end as bigint) as p2,
 cast((l_orderkey*7+l_linenumber*13)%61 as int) as q1, cast((l_orderkey*11+l_linenumber*5)%61 as int) as q2,
 translate(md5(concat('a',l_orderkey,'_',l_partkey)),'0123456789abcdef','ACGTACGTACGTACGT') as seq1,
 translate(md5(concat('b',l_orderkey,'_',l_suppkey)),'0123456789abcdef','ACGTACGTACGTACGT') as seq2,
 case l_linenumber%4 when 0 then '10S22M' when 1 then '12M2D20M' when 2 then '12M3I17M' else '32M' end as cigar1,
 case qty%4 when 0 then '22M10S' when 1 then '10H32M' when 2 then '32M' else '8M4N24M' end as cigar2,
 concat('exp',l_orderkey%3) as experiment
from a
"""

ALIGNMENTS = """
with e as (select event_id as e, cast(event_id%16 as int) as t, user_id as u, cast(floor(value) as bigint) as v from events),
b as (select e.*, concat('chr',1+u%3) as ca, cast(2000+((u*7919)%200)*10007+e%6 as bigint) as pa,
  case when t=4 then concat('chr',1+u%3) else concat('chr',1+(e*5)%3) end as cb,
  case when t=4 then cast(2000+((u*7919)%200)*10007+e%6+300 as bigint) else cast(5000+((e*31)%40)*50021+v%6 as bigint) end as pb,
  case when t=4 then 0 else cast(16*(u%2) as int) end as sa, case when t=4 then 16 else cast(16*(v%2) as int) end as sb,
  case when t in (12,13) then 1 when t<=5 then 2 when t in (6,7,8,15) then 3 when t=14 then 5 else 4 end as k from e),
r as (select b.*, j.v as j from b cross join (values (1),(2),(3),(4),(5)) as j(v) where j.v<=b.k),
x as (select r.*,
  case when k=2 then j when k=3 then (case when j=3 then 2 else 1 end) when k=4 then (case when j>=3 then 2 else 1 end) else 1+(j+1)%2 end as endno,
  case when k=3 and j=2 then 256 when k=4 and j in (2,4) then 256 when k=5 and j>2 then 256 else 0 end as sec,
  case when (k=2 and j=2) or (k=3 and j>=2) or (k=4 and j in (2,3)) then 'B' else 'A' end as side from r)
select concat('rd',e) as qname, cast(j as int) as rec_no,
 cast(1 + (case when endno=1 then 64 else 128 end) + sec
  + (case when (t=5 and j=2) or t=13 then 4 else 0 end)
  + (case when sec=0 then (case when side='A' then sa else sb end) else (case when side='A' then 16-sa else 16-sb end) end) as int) as flag,
 case when side='A' then ca else cb end as rname,
 cast((case when side='A' then pa else pb end) + (case when sec=256 then (case when t in (11,15) then 50000 else 200 end) else 0 end) + (case when k=5 then j*20000 else 0 end) as bigint) as pos,
 cast((e*7+j*13)%61 as int) as mapq,
 case when sec=256 then '30H20M' when (e+j)%5=0 then '10S40M' when (e+j)%5=1 then '40M10S' when (e+j)%5=2 then '20M2D30M' when (e+j)%5=3 then '20M3I27M' else '50M' end as cigar,
 concat('split',e%4) as split
from x
"""

SNPS = """
select chrom, pos, substr('ACGT',cast(1+k%4 as int),1) as pat, substr('CGTA',cast(1+k%4 as int),1) as mat from
 (select distinct concat('chr',1+l_partkey%3) as chrom, cast(1+((l_partkey%200)*99991)%5000000+(l_partkey%4)*5+3 as bigint) as pos, l_partkey%200 as k from lineitem where l_partkey%2=0)
"""

GENOME_LINES = """
select concat('chr',1+p_partkey%3) as chrom, cast(floor(p_partkey/3) as bigint) as line_no,
 translate(concat(md5(cast(p_partkey as string)),md5(concat(p_partkey,'x'))),'0123456789abcdef','ACGTACGTACGTACGT') as seq from part
"""

VCF = """
select concat('chr',1+p_partkey%3) as chrom, cast(100+p_partkey*17 as bigint) as pos,
 case when p_partkey%11=0 then 'AC' else substr('ACGT',cast(1+p_partkey%4 as int),1) end as ref,
 case when p_partkey%7=0 then 'G,T' when p_partkey%13=0 then 'TG' else substr('CGTA',cast(1+p_partkey%4 as int),1) end as alt,
 concat(case when p_partkey%7=0 then '1|2' when p_partkey%5=0 then '1|1' when p_partkey%3=0 then '0/1' when p_partkey%2=0 then '0|1' else '1|0' end,':35') as s1,
 concat(case when p_partkey%4=0 then '0|0' else '0|1' end,':20') as s2 from part
"""

CYTOSINE = """
select concat('chr',1+o_custkey%3) as chrom, o_orderkey as pos, case when o_orderkey%2=0 then '+' else '-' end as strand,
 cast(o_custkey%9 as int) as n_meth, cast(cast(floor(o_totalprice) as bigint)%6 as int) as n_unmeth,
 case when o_orderkey%5=0 then 'CG' when o_orderkey%5<3 then 'CHG' else 'CHH' end as context from orders
"""

SPLIT_STATS = """
select concat('split',s) as split, cast(count(*) as bigint) as total, cast(sum(case when o_orderstatus='F' then 1 else 0 end) as bigint) as unmapped,
 cast(sum(case when o_orderstatus='O' then 1 else 0 end) as bigint) as normal, cast(sum(case when o_orderstatus not in ('F','O') then 1 else 0 end) as bigint) as chimeric,
 cast(sum(case when o_custkey%9=0 then 1 else 0 end) as bigint) as ligations from (select *, o_orderkey%8 as s from orders) o group by s
"""

STATEMENTS = {
    "sites": SITES,
    "raw_pairs": RAW_PAIRS,
    "alignments": ALIGNMENTS,
    "snps": SNPS,
    "genome_lines": GENOME_LINES,
    "vcf": VCF,
    "cytosine": CYTOSINE,
    "split_stats": SPLIT_STATS,
}

SOURCE_TABLES = ("lineitem", "events", "part", "orders")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def derive(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A derived input as a DataFrame over the tables in ``sf_dir``."""
    text = STATEMENTS[name]
    used = [t for t in SOURCE_TABLES if re.search(rf"from {t}\b", text)]
    frames = {t: table(spark, sf_dir, t) for t in used}
    for t in used:
        text = re.sub(rf"from {t}\b", f"from {{{t}}}", text)
    return spark.sql(text, **frames) if frames else spark.sql(text)
