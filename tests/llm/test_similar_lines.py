"""Line dedup against brute force: sets of all sizes on both sides of the threshold, common words, crowded groups, rows without ids."""

import numpy as np
import pytest

from arbograph.llm import line_dedup

ORDER = "doc_id long, text string"


def slow_kept(rows, threshold=0.8):
    """Of each (doc_id, text) the kept lines; lines are ordered by doc_id (null first) and number."""
    lines, out, sets = [], {}, []
    for i, (d, t) in enumerate(rows):
        out[i] = []
        lines += [(-1 if d is None else d, p, i, frozenset(x.lower().split())) for p, x in enumerate(t.split("\n"))]
    for _, p, i, own in sorted(lines, key=lambda x: x[:2]):
        if own and not any(len(own & s) >= threshold * len(own | s) - 1e-9 for s in sets):
            out[i].append(p)
        if own:
            sets.append(own)
    return [",".join(map(str, out[i])) for i in range(len(rows))]


def edited(rng, words, vocabulary, share):
    words = list(words)
    for at in range(len(words)):
        if rng.random() < share:
            words[at] = vocabulary[rng.integers(len(vocabulary))] if rng.random() < 0.8 else f"new{rng.integers(10**6)}"
    return words


def make_rows(seed):
    rng = np.random.default_rng(seed)
    vocabulary = [f"v{i}" for i in range(60)] + [f"r{i}" for i in range(3000)]
    lines = []
    for n in [*range(1, 14)] * 3 + [20, 36, 50, 63, 64, 65, 70, 90, 130, 200, 320] * 2:
        base = [vocabulary[int(len(vocabulary) * rng.random() ** 3)] for _ in range(n)]
        lines += [edited(rng, base, vocabulary, s) for s in (0, 0.02, 0.05, 0.08, 0.11, 0.14)]
    base = [vocabulary[int(60 * rng.random())] for _ in range(40)]
    lines += [edited(rng, base, vocabulary, 0.1) for _ in range(60)]  # a crowded group around the threshold
    order = rng.permutation(len(lines))
    texts = ["\n".join(" ".join(lines[i]) for i in order[at : at + 7]) for at in range(0, len(lines), 7)]
    return list(enumerate(texts))


@pytest.mark.parametrize(("hot", "threshold"), [(2, 0.8), (3, 0.4)])
def test_join_is_brute_force(spark, hot, threshold, monkeypatch):
    monkeypatch.setattr(line_dedup, "HOT", hot)
    rows = make_rows(hot)
    found = {r.doc_id: r.kept_lines for r in line_dedup.line_report(spark.createDataFrame(rows, ORDER).repartition(3), threshold, 1).collect()}
    assert [found[i] for i, _ in rows] == slow_kept(rows, threshold)


def test_rows_without_an_id_and_repeated_ids(spark):
    rows = [(None, "a b c d e f\nonly here x y"), (None, "one two three\nfour five"), (1, "four five\nsix seven"), (1, "six seven eight nine\nten"), (2, "TEN\nsix  seven"), (None, "other words\nfour five six")]
    found = line_dedup.line_report(spark.createDataFrame(rows, ORDER), min_words=1).collect()
    expected = sorted((-1 if d is None else d, k) for (d, _), k in zip(rows, slow_kept(rows), strict=True))
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.kept_lines) for r in found) == expected
    twice = spark.createDataFrame([(3, "p q r s\nt u"), (3, "p q r s\nt u")], ORDER)
    assert [r.kept_lines for r in line_dedup.line_report(twice, min_words=1).collect()] == ["0,1", "0,1"]


def test_no_row_carries_the_table_of_counts(spark):
    docs = spark.createDataFrame([(1, "a b c")], ORDER)
    plans = []
    saved = line_dedup.saved
    line_dedup.saved = lambda df, label="table": (plans.append(df._jdf.queryExecution().optimizedPlan().toString()), saved(df, label))[1]
    try:
        line_dedup.line_classes(docs, 0.8, 1, 3)
    finally:
        line_dedup.saved = saved
    assert "scalar-subquery" in plans[-1] and " AS table" not in plans[-1] and all(len(p) < 20_000 for p in plans)


def test_text_of_many_lines(spark):
    text = "\n".join(f"line {i // 2} of many" for i in range(60_000))
    row = line_dedup.dedup_lines(spark.createDataFrame([(1, text)], ORDER), 1.0, 1).first()
    assert row.text == "\n".join(f"line {i} of many" for i in range(30_000))
