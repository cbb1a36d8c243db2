"""What the joins of line dedup read: one shuffle for both sides of a pair, and no leaders for keys that one line has."""

from arbograph.llm import line_dedup

TEXTS = ["one two three four five six\nalpha beta gamma delta epsilon zeta", "one two three four five seven\nbeta gamma delta", "\nq r s t u v w x", "\t \nfour five\n"]


def traced(spark, monkeypatch, texts):
    """Of each table that is saved its label, optimized plan and number of rows."""
    seen, saved = [], line_dedup.saved

    def trace(df, label="table"):
        out = saved(df, label)
        seen.append((label, df._jdf.queryExecution().optimizedPlan(), out.count()))
        return out

    monkeypatch.setattr(line_dedup, "saved", trace)
    rows = line_dedup.line_report(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), min_words=1).collect()
    return seen, {r.doc_id: (r.n_lines, r.n_compared, r.kept_lines) for r in rows}


def test_both_sides_of_a_pair_are_the_same_rows(spark, monkeypatch):
    seen, rows = traced(spark, monkeypatch, TEXTS)
    plan = next(p for label, p, _ in seen if label == "pairs")
    while plan.nodeName() != "Join":
        plan = plan.children().head()
    assert plan.left().sameResult(plan.right())
    assert rows == {0: (2, 2, "0,1"), 1: (2, 2, "0,1"), 2: (2, 1, "1"), 3: (3, 1, "1")}


def test_a_key_of_one_line_leads_nowhere(spark, monkeypatch):
    copies = [" ".join(f"w{i}" for i in range(20)), " ".join([*(f"w{i}" for i in range(19)), "last"])]
    for texts, some in ((["a b c d e f", "u v w x y z"], False), (copies, True)):
        seen, _ = traced(spark, monkeypatch, texts)
        assert (next(n for label, _, n in seen if label == "heads") > 0) == some
