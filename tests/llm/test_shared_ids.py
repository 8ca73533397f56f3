"""Rows that share a doc_id and a text but come from different hosts."""

from pyspark.sql import functions as F

from chromaloom.llm import host_rules


def test_a_copy_on_a_rejected_host_does_not_drop_the_row(spark):
    good, bad = " ".join(f"w{k}" for k in range(60)), "word " * 60
    rows = [(k, good, "fine") for k in range(40)] + [(100 + k, bad, "spam") for k in range(40)]
    rows += [(d, good, s) for d in (500, None) for s in ("fine", "spam", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    kept = host_rules.kept_documents(docs, F.col("source")).where("doc_id is null or doc_id = 500").collect()
    assert {(r.doc_id, r.source) for r in kept} == {(d, s) for d in (500, None) for s in ("fine", None)}
