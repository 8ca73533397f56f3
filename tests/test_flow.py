"""Runs that go on from finished stages, and experiments merged from theirs."""

import pytest
from pyspark.sql import functions as F

from chromaloom.plans import flow
from chromaloom.plans.inputs import derive
from chromaloom.plans.stages import Stages, of_input

SF = "/root/testdata/sf0.001"
RES = (500_000, 100_000)


def run(spark, path, alignments=None, **more):
    stages = Stages(spark, path)
    reads = derive(spark, SF, "alignments") if alignments is None else alignments
    return flow.process(reads, flow.sites(spark, SF), path, RES, stages=stages, norms=("VC",), **more), stages


def rows(df):
    return sorted(map(str, df.collect()))


def test_a_second_run_reads_what_the_first_has_finished(spark, tmp_path):
    path = str(tmp_path / "run")
    first, made = run(spark, path)
    want = {k: rows(v) for k, v in first.items()}
    again, read = run(spark, path)
    assert not read.made and sorted(read.read) == sorted(made.made) and len(made.made) == 8
    assert {k: rows(v) for k, v in again.items()} == want
    # another parameter: only what depends on it
    _, other = run(spark, path, junction="AAGCTAGCTT")
    assert other.made == ["statistics"]
    # a stage that was left half-written has no success mark
    folder = other.marked("matrix")["folder"]
    (tmp_path / "run" / folder.rsplit("/", 1)[1] / "_SUCCESS").unlink()
    half, third = run(spark, path, junction="AAGCTAGCTT")
    assert third.made[0] == "matrix" and "unique" in third.read and rows(half["matrix"]) == want["matrix"]


def test_changed_inputs_make_stages_anew(spark, tmp_path):
    source, path = str(tmp_path / "reads"), str(tmp_path / "run")
    derive(spark, SF, "alignments").write.parquet(source)
    run(spark, path, spark.read.parquet(source))
    derive(spark, SF, "alignments").where("rname = 'chr1'").write.mode("overwrite").parquet(source)
    found, stages = run(spark, path, spark.read.parquet(source))
    assert len(stages.made) == 8 and {r.c1 for r in found["matrix"].select("c1").distinct().collect()} == {"chr1"}
    assert of_input(spark.read.parquet(source)) != of_input(spark.read.parquet(source).where("mapq > 1"))


def test_merged_experiments_add_up(spark, tmp_path):
    number = F.substring("qname", 3, 20).cast("bigint") % 2
    parts = [run(spark, str(tmp_path / f"e{k}"), derive(spark, SF, "alignments").where(number == k))[0] for k in range(2)]
    stages = Stages(spark, str(tmp_path / "merged"))
    merged = flow.merge(parts, str(tmp_path / "merged"), norms=("VC",), stages=stages)
    assert merged["contacts"].count() == sum(p["unique"].count() for p in parts)
    by_q = {r.q: r for r in merged["statistics"].collect()}
    for q, r in by_q.items():
        own = [next(x for x in p["statistics"].collect() if x.q == q) for p in parts]
        assert r.contacts == sum(x.contacts for x in own) and r.three_prime == sum(x.three_prime for x in own)
        assert r.inter_of_unique_pct == pytest.approx(100 * r.inter / r.unique_pairs, abs=0.01)
    total = F.sum("n").alias("n")
    assert rows(merged["hists"].groupBy("q", "hist").agg(total)) == rows(parts[0]["hists"].unionByName(parts[1]["hists"]).groupBy("q", "hist").agg(total))
    # files hold the merged order
    for file in sorted(merged["contacts"].inputFiles()):
        places = [(r.c1, r.c2, r.p1, r.p2, r.qname) for r in spark.read.parquet(file).collect()]
        assert places == sorted(places)
    again = Stages(spark, str(tmp_path / "merged"))
    flow.merge(parts, str(tmp_path / "merged"), norms=("VC",), stages=again)
    assert not again.made and len(stages.made) == 5


def test_diploid_stages(spark, tmp_path):
    records = str(tmp_path / "linked")
    flow.linked(spark, SF).write.parquet(records)
    linked = spark.read.parquet(records)
    runs = []
    for _ in range(2):
        stages = Stages(spark, str(tmp_path / "diploid"))
        found = flow.diploid(linked, flow.homologs(linked), str(tmp_path / "diploid"), RES, stages=stages)
        runs.append({k: rows(v) for k, v in found.items()})
    assert runs[0] == runs[1] and len(stages.read) == 5 and not stages.made
    assert found["homolog_matrices"].agg(F.sum("n")).first()[0] == found["matrix"].agg(F.sum("n")).first()[0] == found["contacts"].count() * len(RES)
