"""The pipeline, stage by stage, against brute force."""

from __future__ import annotations

from test_decontamination import brute as leaks
from test_lines import brute as lines
from test_minhash import brute as classes

import corpus_pipeline as cp
from cartulary.llm.quality import quality_rules

SF_DIR = "/root/testdata/sf0.001"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    steps = [docs]
    for number, (_, stage) in enumerate(cp.STAGES):
        stage(spark, steps[-1], SF_DIR).write.parquet(f"{tmp_path}/{number}")
        steps.append(spark.read.parquet(f"{tmp_path}/{number}"))
    assert all(s.schema.names == docs.schema.names and [f.dataType for f in s.schema] == [f.dataType for f in docs.schema] for s in steps[:-1])
    rows = [sorted((r.doc_id, r.text) for r in s.select("doc_id", "text").collect()) for s in steps[:-1]]
    kept = {r.doc_id for r in quality_rules(docs).collect() if r.kept}
    assert rows[1] == [r for r in rows[0] if r[0] in kept] and 0 < len(kept) < 200
    assert rows[2] == sorted((i, text) for i, _, _, text in lines(rows[1]))
    firsts = {c for _, c, _ in classes(rows[2])}
    assert rows[3] == [r for r in rows[2] if r[0] in firsts]
    items = [tuple(r) for r in spark.read.parquet(f"{SF_DIR}/benchmark.parquet").select("item_id", "text").collect()]
    gone = {d for d, _, _ in leaks(rows[3], items)}
    assert rows[4] == [r for r in rows[3] if r[0] not in gone]
    assert {r.doc_id for r in steps[5].select("doc_id").distinct().collect()} == {i for i, _ in rows[4]}


def test_odd_documents(spark, odd):
    rows = odd.select("doc_id", "text").selectExpr("*", "CAST(NULL AS string) AS lang", "'s' AS source", "CAST(length(text) AS bigint) AS n_chars", "1 AS row", "2 AS doc", "3 AS lines", "4 AS kept")
    for _, stage in cp.STAGES[:-1]:
        out = stage(spark, rows, SF_DIR)
        assert out.columns == rows.columns
        assert out.count() <= rows.count()
    assert cp.drop_lines(spark, rows, SF_DIR).where("text IS NULL").count() == 1
