import gzip
import random
import re

import pytest
from pyspark.sql import functions as F

from chromaloom.functions import measures, motifs
from chromaloom.operators import fragments, quality, sites, statistics
from chromaloom.operators.support import lookup_join
from chromaloom.sources import alignments, contacts, reports

SAM = """@SQ\tSN:chr1\tLN:5000
@SQ\tSN:chr_2\tLN:900
r1/1\t65\tchr1\t100\t60\t50M\t=\t200\t0\tACGT\tIIII\tNM:i:0\tZZ:Z:a:b
r1/2\t145\tchr_2\t200\t50\t50M\t=\t100\t0\tACGT\tIIII
r2\t65\tchr1\t100\t60\t50M\t*\t0\t0\t*\t*
"""


def test_sam_round_trip(spark, tmp_path):
    (tmp_path / "a.sam").write_text(SAM)
    df = alignments.read_sam(spark, str(tmp_path / "a.sam"))
    got = {(r.qname, r.rec_no): r for r in df.collect()}
    assert set(got) == {("r1/1", 1), ("r1/2", 2), ("r2", 1)}
    assert [tuple(t) for t in got["r1/1", 1].tags] == [("NM", "i", "0"), ("ZZ", "Z", "a:b")]
    header = alignments.sam_header(spark, str(tmp_path / "a.sam")).where("chrom is not null").collect()
    assert {(r.chrom, r.length) for r in header} == {("chr1", 5000), ("chr_2", 900)}
    alignments.write_sam(df.withColumn("rt", F.lit(0)), str(tmp_path / "out"), ["@HD\tVN:1.6"])
    again = alignments.read_sam(spark, str(tmp_path / "out"))
    assert {tuple(t) for r in again.collect() for t in r.tags if t.tag in ("rt", "NM")} == {("rt", "A", "0"), ("NM", "i", "0")}
    assert again.count() == 3


def test_all_records_of_a_read_are_numbered(spark, tmp_path):
    """One name holds a third of the records and runs over many parts of the file; one tag is repeated."""
    rows = [("hot" if i % 3 == 0 else f"r{i // 2}", i) for i in range(3000)]
    (tmp_path / "a.sam").write_text("".join(f"{n}\t0\tchr1\t{i + 1}\t9\t5M\t*\t0\t0\t*\t*\tXA:Z:a\tXA:Z:b\n" for n, i in rows))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        got = {(r.qname, r.rec_no): r.pos for r in alignments.read_sam(spark, str(tmp_path / "a.sam")).collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    want, seen = {}, {}
    for n, i in rows:
        seen[n] = seen.get(n, 0) + 1
        want[n, seen[n]] = i + 1
    assert got == want


def test_fastq_pairs_and_gzip(spark, tmp_path):
    with gzip.open(tmp_path / "x_R1.fastq.gz", "wt") as f:
        f.write("".join(f"@r{i}\nAC{i}\n+\nIII\n" for i in range(40)))
    (tmp_path / "x_R2.fastq").write_text("".join(f"@r{i}\nGT{i}\n+\nIII\n" for i in range(40)))
    got = alignments.read_fastq(spark, str(tmp_path / "x_R1.fastq.gz"), str(tmp_path / "x_R2.fastq")).collect()
    assert {(r.seq1, r.seq2) for r in got} == {(f"AC{i}", f"GT{i}") for i in range(40)}


def test_line_numbers_over_many_splits(spark, tmp_path):
    (tmp_path / "long.fastq").write_text("".join(f"@r{i}\nSEQ{i}\n+\nIII\n" for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "5000")
    try:
        got = alignments.read_fastq(spark, str(tmp_path / "long.fastq")).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert {(r.read_no, r.seq1) for r in got} == {(i, f"SEQ{i}") for i in range(3000)}


@pytest.mark.parametrize("width", [7, 60])
def test_motifs_over_line_ends(spark, tmp_path, width):
    rng = random.Random(width)
    genome = {f"chr{k}": "".join(rng.choice("ACGT") for _ in range(700)) + "GATCGATC" for k in range(2)}
    text = "".join(f">{n} extra\n" + "\n".join(s[i:i + width].lower() for i in range(0, len(s), width)) + "\n" for n, s in genome.items())
    (tmp_path / "g.fa").write_text(text)
    lines = alignments.read_fasta(spark, str(tmp_path / "g.fa"))
    got = {(r.chrom, r.pos) for r in sites.motif_positions(lines, motifs.RECOGNITION["Arima"]).collect()}
    pattern = re.compile("(?=GATC|GA[ACGT]TC)")
    assert got == {(n, m.start() + 1) for n, s in genome.items() for m in pattern.finditer(s)}
    cut = sites.restriction_sites(lines, motifs.RECOGNITION["Arima"])
    assert {(r.chrom, r.length) for r in fragments.chrom_sizes(cut).collect()} == {(n, 708) for n in genome}


def test_site_file_round_trip(spark, tmp_path):
    (tmp_path / "s.txt").write_text("chr_1 10 20 35\nchr2 7\n")
    df = contacts.read_sites(spark, str(tmp_path / "s.txt"))
    assert {(r.chrom, r.idx, r.pos) for r in df.collect()} == {("chr1", 0, 10), ("chr1", 1, 20), ("chr1", 2, 35), ("chr2", 0, 7)}
    assert {r.value for r in contacts.format_sites(df).collect()} == {"chr1 10 20 35", "chr2 7"}


def test_fragment_edges(spark):
    cuts = spark.createDataFrame([("chr1", 0, 10), ("chr1", 1, 20), ("chr1", 2, 9000)], "chrom string, idx long, pos long")
    ends = [("a", 9, 0), ("b", 10, 1), ("c", 11, 1), ("d", 20, 2), ("e", 8999, 2), ("f", 9000, 3), ("g", 99999, 3)]
    df = spark.createDataFrame([(n, "chr1", p) for n, p, _ in ends] + [("u", "chrU", 5)], "qname string, c1 string, p1 long")
    for limit in (10**6, 0):  # broadcast, then salted shuffle
        got = {r.qname: r.f1 for r in fragments.assign_fragments(df, cuts, ("1",), size=64, max_rows=limit).collect()}
        assert got == {**{n: f for n, _, f in ends}, "u": 0}


def test_salted_lookup_equals_broadcast(spark):
    df = spark.range(5000).selectExpr("id", "if(id % 3 = 0, 7, id % 50) as k")
    table = spark.range(40).selectExpr("id as k", "id * 10 as v")
    a, b = (lookup_join(df, table, ["k"], salt_from=["id"], max_rows=n) for n in (100, 1))
    assert a.exceptAll(b).isEmpty() and b.exceptAll(a).isEmpty() and a.count() == 5000


def test_pair_file_with_fragments_is_refused(spark, tmp_path):
    (tmp_path / "p.pairs").write_text("## pairs format v1.0\n#columns: readID chr1 pos1 chr2 pos2 strand1 strand2\nq\tchr1\t5\tchr2\t9\t+\t-\n")
    row = contacts.read_pairs_4dn(spark, str(tmp_path / "p.pairs")).collect()[0]
    assert (row.qname, row.s1, row.p1, row.s2, row.c2) == ("q", 0, 5, 16, "chr2")
    (tmp_path / "f.pairs").write_text("#columns: readID chr1 pos1 chr2 pos2 strand1 strand2 frag1 frag2\n")
    with pytest.raises(ValueError):
        contacts.read_pairs_4dn(spark, str(tmp_path / "f.pairs"))


def test_contact_files(spark, tmp_path):
    row = spark.createDataFrame([("q", 0, "chr1", 5, 1, 16, "chr2", 9, 2, 30, "50M", "ACGT", 40, "50M", "TTTT")],
                                "qname string, s1 int, c1 string, p1 long, f1 long, s2 int, c2 string, p2 long, f2 long,"
                                "q1 int, cigar1 string, seq1 string, q2 int, cigar2 string, seq2 string")
    for form in ("short", "long"):
        contacts.write_contacts(row, str(tmp_path / form), form)
        back = contacts.read_contacts(spark, str(tmp_path / form), form).collect()[0]
        assert (back.p1, back.c2, back.f2) == (5, "chr2", 2)


def test_variants(spark, tmp_path):
    (tmp_path / "v.vcf").write_text("##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tA\tB\n"
                                    "chr1\t5\t.\tA\tC,G\t.\t.\t.\tGT\t0|2:9\t1|1\nchr1\t6\t.\tAT\tC\t.\t.\t.\tGT\t0|1\t0/1\n")
    snps, skipped = reports.read_phased_vcf(spark, str(tmp_path / "v.vcf"))
    assert [(r["sample"], r.pos, r.pat, r.mat) for r in snps.collect()] == [("A", 5, "A", "G")]
    assert skipped.count() == 2


def test_lists(spark, tmp_path):
    (tmp_path / "l.bedpe").write_text("#chr1\tx1\tx2\tchr2\ty1\ty2\nchr1\t0\t10\tchr1\t50\t60\n")
    assert contacts.read_bedpe(spark, str(tmp_path / "l.bedpe")).collect()[0].y1 == 50
    (tmp_path / "p.bed").write_text("track x\nchr1\t0\t10\tn\t0\t-\n")
    assert contacts.read_bed(spark, str(tmp_path / "p.bed")).collect()[0].strand == "-"
    track = spark.createDataFrame([("chr2", 4, 5, 1), ("chr1", 9, 10, 3), ("chr1", 1, 2, 7)], "chrom string, start long, end long, n long")
    contacts.write_bedgraph(track, str(tmp_path / "t"))
    assert contacts.read_bedgraph(spark, str(tmp_path / "t")).count() == 3


def test_histogram_file(spark, tmp_path):
    rows = [("A", 5, "all", 3), ("B", 0, "all", 4), ("B", 0, "intra", 1), ("B", 0, "inter", 3), ("D", 7, "outer", 2), ("A", 2000, "all", 9)]
    hists = spark.createDataFrame(rows, "hist string, bin long, series string, n long")
    reports.write_hists(hists, str(tmp_path / "h"))
    back = reports.read_hists(spark, str(tmp_path / "h"))
    assert {(r.hist, r.bin, r.series, r.n) for r in back.collect()} == set(rows)


def test_report_text(spark, tmp_path):
    stats = spark.createDataFrame([("s1", 1_234_000, 1000, 800_000, 400_000, 33_000, 7)],
                                  "split string, total long, unmapped long, normal long, chimeric long, ambiguous long, ligations long")
    lines = reports.format_sequencing(statistics.sequencing_summary(stats, 200_000))
    reports.write_stats_report(lines, str(tmp_path / "r"))
    text = [r.value for r in lines.orderBy("line").collect()]
    assert "Sequenced Read Pairs: 1,234,000" in text
    assert "Total Unique: 1,000,000 (83.33%, 81.04%)" in text
    parsed = {r.label: r.n for r in reports.read_stats_report(spark, str(tmp_path / "r")).collect()}
    assert parsed["Total Duplicates"] == 200_000
    assert "Ligation Motif Present: 7 (0.00%)" in text
    without = [r.value for r in reports.format_sequencing(statistics.sequencing_summary(stats, 0), junction="XXXX").collect()]
    assert "Ligation Motif Present: N/A" in without


def test_single_end_report(spark):
    stats = spark.createDataFrame([("s1", 100, 10, 0, 50, 10, 30, 7)],
                                  "split string, total long, unmapped long, normal long, chimeric long, ambiguous long, singleton long, ligations long")
    summary = statistics.sequencing_summary(stats, 20, 6, single_end=True)
    text = [r.value for r in reports.format_sequencing(summary, single_end=True).orderBy("line").collect()]
    assert text[0] == "Read type: Single End"
    assert "1 alignment unique: 24 (80.00%, 24.00%)" in text and "Total Duplicates: 26 (32.50%, 26.00%)" in text


def test_log_bins(spark):
    values = [0, 1, 9, 10, 11, 12, 13, 99, 100, 101, 19_999, 20_000, 123_285, 123_286, 10**10, 10**11, *measures.LOG_EDGES]
    df = spark.createDataFrame([(v,) for v in values], "d long").select("d", measures.log_bin(F.col("d")).alias("b"))
    assert {r.d: r.b for r in df.collect()} == {v: sum(e < v for e in measures.LOG_EDGES) for v in values}


def test_library_size_solves_the_equation(spark):
    import math
    df = spark.createDataFrame([(800, 1000), (999_999, 1_000_000), (5, 5), (0, 9)], "u long, n long")
    got = [r.x for r in df.select(statistics.library_complexity(F.col("u"), F.col("n")).alias("x")).collect()]
    assert got[2:] == [None, None]
    for x, u, n in zip(got, (800, 999_999), (1000, 1_000_000)):
        assert abs(u / x - 1 + math.exp(-n / x)) < 1e-3


def test_enzyme_order_and_methylation():
    assert motifs.junctions("MseI+Csp6I") == motifs.junctions("Csp6I+MseI")
    assert motifs.junction_for("StyI") == "CC[AT][AT]GC[AT][AT]GG"
    assert motifs.junction_for("nothing") == "XXXX"
    assert motifs.methyl_pattern("GATCGATC") == "GAT[CT]GATC"
    assert motifs.dangling_motif("GATCGATC") == "GATC" and motifs.dangling_motif("(A|B)") is None
    assert len(motifs.junctions("Arima")) == 25


def test_redo_reasons(spark):
    stats = spark.createDataFrame([("a", 10, 4, 6), ("b", 10, 4, 5), ("c", 0, 0, 0)], "split string, total long, unmapped long, normal long")
    inputs = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "split string")
    assert {r.split: r.reason for r in quality.splits_to_redo(inputs, stats).collect()} == {"b": "inconsistent", "c": "empty", "d": "absent"}


def test_long_site_lines_are_taken_apart_once(spark):
    lines = spark.range(2).select(F.concat(F.lit("chr_"), (F.col("id") + 1).cast("string"), F.lit(" "), F.array_join(
        F.transform(F.sequence(F.lit(1), F.lit(20_000)), lambda i: (i * 7).cast("string")), " ")).alias("text"))
    found = contacts.parse_sites(lines)
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # nothing above the generator works on the text
    assert "split" not in plan[:plan.index("Generate")] and "text" not in plan[:plan.index("Generate")].replace("text_pos", "")
    got = found.groupBy("chrom").agg(F.count("*").alias("n"), F.count_if(F.col("pos") == (F.col("idx") + 1) * 7).alias("right")).collect()
    assert {(r.chrom, r.n, r.right) for r in got} == {("chr1", 20_000, 20_000), ("chr2", 20_000, 20_000)}


def test_bins_know_the_sites_around_them_without_frames_to_the_end(spark):
    cuts = spark.createDataFrame([("chr1", i, p) for i, p in enumerate((3, 9, 130, 700))], "chrom string, idx long, pos long")
    bins = fragments.site_bins(cuts, 64)
    # a frame that reaches to the end is gone through again for every row
    assert "unboundedfollowing" not in bins._jdf.queryExecution().optimizedPlan().toString().lower()
    got = {r.bin: (r.inside, r.base, r.low, r.high) for r in bins.collect()}
    assert got[0] == ([3, 9], 0, None, 130) and got[1] == ([], 2, 9, 130) and got[2] == ([130], 2, 9, 700) and got[10] == ([700], 3, 130, None)


def test_lines_of_a_split_are_numbered_where_they_were_read(spark, tmp_path):
    for name in ("a", "b"):
        with gzip.open(tmp_path / f"{name}.gz", "wt") as f:
            f.write("".join(f"@{name}{i}\n{'ACGT'[i % 4] * 3}\n+\nIII\n" for i in range(50)))
    # lines of many reads are too large for a broadcast chosen by estimated size
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        found = alignments.read_fastq(spark, str(tmp_path))
        assert sorted((r.read_no, r.seq1) for r in found.collect()) == sorted(2 * [(i, "ACGT"[i % 4] * 3) for i in range(50)])
        assert "SortMergeJoin" not in found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
