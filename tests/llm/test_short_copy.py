"""A copy whose lines are all removed, short ones too, leaves the pipeline."""

import corpus_pipeline

LONG = [" ".join(f"{stem}{i}" for i in range(9)) for stem in ("north", "south", "east")]
TEXTS = ["one\nread on\nread  On\nOne", "a b c d\na b c d e\nd c b a", "x y z\nx y\n\nx x y", None, "", " \none", "\n".join([*LONG, "the end"]), "\n".join([*LONG, "the end"]), "\n".join([LONG[0], "another end"])]


def test_copy_that_ends_in_a_short_line_leaves_the_pipeline(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string")
    out = {r.doc_id: r.text for r in corpus_pipeline.line_deduplication(spark, docs, "").collect()}
    assert 7 not in out and out[6] == TEXTS[6]
    assert out[8] == "another end"  # a line that no earlier one matches stays
    assert out[3] is None and out[4] == "" and 5 not in out
