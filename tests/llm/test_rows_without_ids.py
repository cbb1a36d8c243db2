"""Rows with a null or repeated doc_id are judged by their own text in the stages of the pipeline."""

import corpus_pipeline
import pytest

ITEM = " ".join(f"bench{i}" for i in range(12))
PROSE = [" ".join(f"{stem}{i}" for i in range(30)) for stem in ("north", "south", "east", "west", "up")]


@pytest.mark.parametrize("doc_id", [None, 7])
def test_rows_of_one_id(spark, tmp_path, doc_id):
    spark.createDataFrame([(1, ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    rows = [(doc_id, PROSE[0]), (doc_id, PROSE[1]), (doc_id, f"{PROSE[2]} {ITEM}"), (doc_id, PROSE[0]), (9, PROSE[3]), (3, PROSE[1])]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    near = sorted((r.doc_id or 0, r.text) for r in corpus_pipeline.near_deduplication(spark, docs, "").collect())
    assert near == sorted([(doc_id or 0, PROSE[0]), (doc_id or 0, rows[2][1]), (9, PROSE[3]), (3, PROSE[1])])
    clean = sorted((r.doc_id or 0, r.text) for r in corpus_pipeline.decontamination(spark, docs, str(tmp_path)).collect())
    assert clean == sorted((i or 0, t) for i, t in rows if ITEM not in t)
