"""The pipeline's stages on their own inputs, and run() as their chain."""

import corpus_pipeline
import numpy as np

WORDS = [f"w{chr(97 + i % 26)}{chr(97 + i // 26 % 26)}{chr(97 + i // 676)}" for i in range(3000)]


def test_stages(spark, tmp_path):
    rng = np.random.default_rng(5)
    prose = lambda n: " ".join(rng.choice(WORDS, n))
    item = " ".join(f"bench{i}" for i in range(12))
    texts = [prose(80) for _ in range(40)] + [" ".join(w + "$$$" for w in rng.choice(WORDS, 80)) for _ in range(40)]
    texts += [texts[0], f"{prose(40)} {item} {prose(40)}", f"{texts[1]}\n{prose(70)}", None, ""]
    rows = [(i, t, "en", "s", len(t or "")) for i, t in enumerate(texts)]
    d = f"{tmp_path}/sf"
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{d}/documents.parquet")
    spark.createDataFrame([(i, int(i < 40), 0) for i in range(80)], "doc_id long, quality int, toxic int").write.parquet(f"{d}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{d}/benchmark.parquet")
    docs = spark.read.parquet(f"{d}/documents.parquet")
    assert len(corpus_pipeline.STAGES) == 5
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, d).columns == docs.columns
    out = {r.doc_id: r for r in corpus_pipeline.run(spark, d).collect()}
    assert set(range(40)) <= set(out) and not set(range(40, 80)) & set(out)  # junk goes, prose stays
    assert 80 not in out and 81 not in out  # the copy and the contaminated document
    assert texts[1] not in out[82].text and out[82].n_chars == len(out[82].text)
    assert all(r.piece_text == (r.text or "") for r in out.values())
