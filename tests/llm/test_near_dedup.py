"""The near-dedup stage of the pipeline against brute force over five-word shingles at 0.8."""

import re

import corpus_pipeline
import numpy as np
import pytest

from arbograph.llm import shingles, simhash

WORDS = [f"w{i}" for i in range(4000)]


def make_texts():
    rng = np.random.default_rng(11)
    prose = lambda n: list(rng.choice(WORDS, n))
    texts = [None, "", " \n", "Two  words", "two words", "two other words"]
    passage = prose(30)  # many texts quote it
    texts += [" ".join([*prose(60), *passage, *prose(20)]) for _ in range(30)]
    for n in (15, 60, 200, 900):  # copies with edits, on both sides of 0.8; chains that only links in between hold together
        for _ in range(4):
            words = prose(n)
            texts.append(" ".join(words))
            for _ in range(6):
                words = list(words)
                for at in rng.choice(n, max(1, int(n * rng.uniform(0, 0.035))), replace=False):
                    words[at] = "edited" + str(rng.integers(9))
                texts.append(" ".join(words).title() if rng.random() < 0.2 else " ".join(words))
    base = prose(120)  # a large group around one text
    for _ in range(70):
        words = list(base)
        words[rng.integers(120)] = str(rng.integers(50))
        texts.append(" ".join(words))
    return [texts[i] for i in rng.permutation(len(texts))]


def slow_groups(texts, k=5, least=0.8):
    def grams(t):
        w = re.findall(r"[^\x20\x09-\x0D]+", (t or "").lower())
        return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()

    sets, fps, label = [grams(t) for t in texts], [simhash.fingerprint(t or "", k) for t in texts], list(range(len(texts)))

    def find(i):
        while label[i] != i:
            i = label[i]
        return i

    missed = 0
    for a in range(len(texts)):
        for b in range(a):
            near, close = len(sets[a] & sets[b]) >= least * len(sets[a] | sets[b]) - 1e-9, (fps[a] ^ fps[b]).bit_count() <= 3
            missed += near and not close
            if near or close:
                x, y = find(a), find(b)
                label[max(x, y)] = min(x, y)
    return [find(i) for i in range(len(texts))], missed


@pytest.mark.parametrize("hot", [3, 10_000])
def test_stage_is_brute_force(spark, hot, monkeypatch):
    monkeypatch.setattr(shingles, "similar_edges", lambda d, n, k, t, f=shingles.similar_edges: f(d, n, k, t, hot))
    texts = make_texts()
    groups, missed = slow_groups(texts)
    assert missed > 100  # the fingerprints alone don't link these
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    out = corpus_pipeline.near_deduplication(spark, docs, "")
    assert out.columns == docs.columns and sorted(r.doc_id for r in out.collect()) == sorted(set(groups))
    assert corpus_pipeline.near_deduplication(spark, docs.limit(0), "").count() == 0
