"""Clashing and dotted column names, rows without ids, hashes that meet, hostile texts, bounds of samples."""

import base64
import json
import zlib

import public_tokenizers
import pytest

from arbograph.llm import batches, divergence, pieces, quality, sampling, secret_scan, simhash, winnow

ODD = "doc_id long, text string, `a.b` string, hit_id long, __score double, __row long, __hit long, node long, `x y` int"


@pytest.fixture(scope="module")
def odd(spark):
    texts = ["one two three four five six", "one two three four five six", None, "quite another text here it is", "", "a clean row of words that nothing else has"]
    ids = [1, 2, None, None, 2, 2]
    return spark.createDataFrame([(i, t, "z", 1, 0.5, 7, 8, 9, 3) for i, t in zip(ids, texts)], ODD)


def test_names_that_clash(spark, odd):
    bench = spark.createDataFrame([(1, "another text here")], "item_id long, text string")
    kept = winnow.decontaminate(odd, bench)
    assert kept.columns == odd.columns and sorted(r.text or "" for r in kept.collect()) == sorted(t for t in ["one two three four five six"] * 2 + ["", "", "a clean row of words that nothing else has"])
    single = simhash.deduplicate(odd, 5, 3, 0.8)
    assert single.columns == odd.columns and sorted(r.text or "" for r in single.collect()) == ["", "a clean row of words that nothing else has", "one two three four five six", "quite another text here it is"]
    labels = spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int")
    assert quality.keep_good(odd, labels).columns == odd.columns
    assert pieces.encode_decode(odd, public_tokenizers.path("piece_bpe_32k.model")).columns == [*odd.columns, "piece_ids", "piece_text"]


def test_repeated_rows_are_one(spark):
    docs = spark.createDataFrame([(1, "p q r s t u v"), (1, "p q r s t u v"), (None, "own words of a row"), (None, "own words of a row")], "doc_id long, text string")
    assert sorted(r.text for r in simhash.deduplicate(docs, 5, 3, 0.8).collect()) == ["own words of a row", "p q r s t u v"]


def test_large_sets_are_joined_without_a_broadcast(odd, spark, monkeypatch):
    monkeypatch.setattr(batches, "BROADCAST_ROWS", 0)
    assert len(simhash.deduplicate(odd, 5, 3, 0.8).collect()) == 4
    assert len(winnow.decontaminate(odd, spark.createDataFrame([(1, "another text here")], "item_id long, text string")).collect()) == 5


def test_long_texts_have_no_repeats_by_chance(spark):
    text = " ".join(f"{i:x}" for i in range(700_000))
    docs = spark.createDataFrame([(1, text), (2, "a b c d a b c x a b c"), (3, "x x x x")], "doc_id long, text string")
    assert {r.doc_id: r.n_repeat_words for r in divergence.features(docs).collect()} == {1: 0, 2: 9, 3: 4}


def base62(n):
    return secret_scan._base62(zlib.crc32(n.encode()), 6)


def test_added_kinds():
    scan = lambda t: [(secret_scan.RULES[r][0], t[s:e]) for s, r, e in secret_scan.scan(t, secret_scan._automaton()) if r >= secret_scan.BASE_KINDS]
    body = "a1B2c3D4e5F6g7H8i9J0k1L2m3N4o5"
    part = lambda x: base64.urlsafe_b64encode(json.dumps(x).encode()).decode().rstrip("=")
    jwt = f"{part({'alg': 'HS256', 'typ': 'JWT'})}.{part({'sub': '1234567890'})}.c2lnbmF0dXJlLW9mLWl0"
    google, slack = "AIza" + "x" * 35, "xoxb-1234567890-abcdef"
    pem = "-----BEGIN RSA PRIVATE KEY-----\nMIIB\nAAAA=\n-----END RSA PRIVATE KEY-----"
    for kind, secret in (("npm", f"npm_{body}{base62(body)}"), ("github", f"ghs_{body}{base62(body)}"), ("jwt", jwt), ("google", google), ("slack", slack), ("pem", pem)):
        assert scan(f"é {secret} .") == [(kind, secret)], kind
    for harmless in (f"npm_{body}000000", f"npm_{body}{base62(body)}x", "eyJhbGciXXXXXXXX.eyJhbGciXXXXXXXX.abcdefghij", google + "x", "xoxz-1234567890", "-----BEGIN PRIVATE KEY-----"):
        assert scan(harmless) == [], harmless


def test_hostile_head_of_a_token():
    for depth in (2_000, 100_000):
        head = base64.urlsafe_b64encode(b'{"alg":' + b"[" * depth).decode().rstrip("=")
        assert not [s for s in secret_scan.scan(f"{head}.eyJhbGciXXXXXXXX.abcdefghij", secret_scan._automaton()) if s[1] == 5]


def test_sample_is_bounded(spark):
    docs = spark.createDataFrame([(1, "b")] * 50 + [(1, "a")] + [(i, str(i)) for i in range(2, 30)] + [(99, "x" * (sampling.LONGEST + 1))], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in (*range(1, 30), 99)], "doc_id long, quality int")
    from pyspark.sql import functions as F

    found = sampling.labelled_sample(docs, labels, "quality", F.lit(True), 40).collect()
    assert len(found) == 29 and {r.text for r in found if r.doc_id == 1} == {"a"}
    assert len(sampling.labelled_sample(docs, labels, "quality", F.lit(True), 10).collect()) <= 10


def test_empty_tables(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert secret_scan.find_secrets(empty).count() == 0 and simhash.deduplicate(empty, 5, 3, 0.8).count() == 0
