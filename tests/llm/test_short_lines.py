"""Lines of one to four words: the query compares and removes them like all others."""

import re

import pytest

from arbograph.llm import registry

LONG = [" ".join(f"{stem}{i}" for i in range(9)) for stem in ("north", "south", "east")]
TEXTS = ["one\nread on\nread  On\nOne", "a b c d\na b c d e\nd c b a", "x y z\nx y\n\nx x y", None, "", " \none", "\n".join([*LONG, "the end"]), "\n".join([*LONG, "the end"]), "\n".join([LONG[0], "another end"])]


def slow_report(texts):
    sets = []
    for t in texts:
        kept = []
        for p, line in enumerate((t or "").split("\n")):
            own = set(re.findall(r"[^\x20\x09-\x0D]+", line.lower()))
            if own and not any(len(own & s) >= 0.8 * len(own | s) - 1e-9 for s in sets):
                kept.append(p)
            if own:
                sets.append(own)
        yield ",".join(map(str, kept))


@pytest.fixture
def sf_dir(spark, tmp_path):
    spark.createDataFrame(list(enumerate(TEXTS)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    return str(tmp_path)


def test_query_compares_lines_of_one_word_or_more(spark, sf_dir):
    found = {r.doc_id: r for r in registry.op8_line_dedup(spark, sf_dir).collect()}
    for i, kept in enumerate(slow_report(TEXTS)):
        assert found[i].kept_lines == kept, i
    assert (found[0].n_compared, found[0].n_removed) == (4, 2)
