"""The pipeline against its operators one by one, held in the driver."""

from collections import Counter

import numpy as np
from pyspark.sql import functions as F

import corpus_pipeline
from chromaloom.llm import host_rules, line_crf, tokens
from test_near_copies import brute_firsts
from test_operators import ODD, SF, frame, ids_of


def test_pipeline(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_classifier", "quality_rules", "near_duplicates", "packing"]
    rows = corpus_pipeline.run(spark, SF).collect()

    model = line_crf.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    left = [(r.doc_id, r.text, r.source) for r in docs.collect()]
    scores = np.concatenate([model.score([t or ""]) for _, t, _ in left])
    left = [r for r, s in zip(left, scores) if s >= line_crf.THRESHOLD]
    judged = host_rules.verdicts(spark.createDataFrame(left, "doc_id long, text string, source string"), F.col("source"), "doc_id").collect()
    kept = {r.doc_id for r in judged if r.kept}
    left = [r for r in left if r[0] in kept]
    one = set(brute_firsts([(d, t) for d, t, _ in left]))
    want = {d: np.array(ids_of(tokens.default_vocabulary(), t, [1]), "<u4").tobytes() for d, t, _ in left if d in one}

    got: dict[int, list] = {}
    for r in rows:
        got.setdefault(r.doc_id, []).append((r.start, bytes(r.ids)))
    assert {d: b"".join(x for _, x in sorted(p)) for d, p in got.items()} == want


def test_pipeline_on_odd_tables(spark, tmp_path):
    """Nulls, empty and repeated rows, shared ids, clashing columns and an empty table, from end to end."""
    fine = [" ".join(f"{w}{k}" for k in range(80)) for w in ("alpha", "beta", "gamma")]
    rows = [*ODD, (20, fine[0]), (21, fine[0]), (21, fine[0]), (22, fine[1]), (22, fine[2]), (None, fine[1]), (23, fine[1] + " end"), (24, None)]
    extra = ("hash", "set_id", "root", "key", "keys", "name", "n", "fp", "_n", "_first", "_hot", "first", "kept", "times", "own", "df", "s", "at", "score", "_host", "_from")
    docs = frame(spark, rows, extra=False).withColumns({c: F.lit("x") for c in extra})
    folder = str(tmp_path / "sf")
    docs.write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(d, k % 2, None) for k, d in enumerate([20, 22, 8, 5, None, 3])], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    left = spark.read.parquet(f"{folder}/documents.parquet")
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before, left = left, stage(spark, left, folder)
        assert sorted(left.columns) == sorted(docs.columns)
        assert left.exceptAll(before).isEmpty()  # rows are kept as they are
    kept = corpus_pipeline.near_duplicates(spark, docs, folder).select("doc_id", "text").collect()
    by_id = Counter(r.doc_id for r in kept if r.text in fine)
    assert by_id == Counter({20: 1, 22: 2, None: 1}) and not any(r.doc_id in (21, 23) for r in kept)
    assert sum((r.text or "").strip() == "" for r in kept) == 1
    packed = corpus_pipeline.packed(spark, docs, folder)
    assert packed.where("length(ids) = 4 * length").select("doc_id").distinct().count() == len({d for d, _ in rows})
    # four labels and one host say little of quality; the run ends and keeps only rows of the table
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder).collect()} <= {d for d, _ in rows}
    nothing = str(tmp_path / "none")
    docs.where("false").write.parquet(f"{nothing}/documents.parquet")
    spark.read.parquet(f"{folder}/labels.parquet").write.parquet(f"{nothing}/labels.parquet")
    assert corpus_pipeline.run(spark, nothing).count() == 0
