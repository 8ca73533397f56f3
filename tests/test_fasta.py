"""FASTA lines under their headers, across read splits and files."""

import random

from chromaloom.sources import alignments


def expected(files):
    rows = []
    for text in files:
        name = None
        for k, line in enumerate(text.split("\n")):
            if line.startswith(">"):
                name = line[1:].split()[0] if line[1:].split() else ""
            elif line.strip() and name is not None:
                rows.append((name, k, line.strip().upper()))
    return sorted(rows)


def read(spark, path):
    return sorted((r.chrom, r.line_no // alignments.MAX_LINE, r.seq) for r in alignments.read_fasta(spark, path).collect())


def test_lines_belong_to_the_last_header_before_them(spark, tmp_path):
    rng = random.Random(2)
    files = ["acgt\n" * 3 + ">a x\nACGT\n\n>b\n", ">c\n" + "acgtn\n" * 900 + ">d\tx\nGG\n", ">\nAA\n> e\nTT"]
    files.append("".join(f">s{k}\n" + "ACGT\n" * rng.randrange(0, 6) for k in range(800)))
    for k, text in enumerate(files):
        (tmp_path / f"f{k}.fa").write_text(text)
    for size in ("700", "128m"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", "100")
        try:
            assert read(spark, str(tmp_path)) == expected(files)
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")


def test_many_headers_need_no_range_join(spark, tmp_path):
    (tmp_path / "g.fa").write_text("".join(f">scaffold{k} of many\nacgt\n" for k in range(100_000)))
    df = alignments.read_fasta(spark, str(tmp_path))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "line" not in "".join(x for x in plan.split("\n") if "Join" in x)
    rows = df.collect()
    assert len(rows) == 100_000 and all(r.chrom == f"scaffold{r.line_no // alignments.MAX_LINE // 2}" for r in rows)
