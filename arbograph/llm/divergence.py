"""Quality rules by distribution divergence, with DataFrame functions only.

A document's histogram of character classes and of common words is compared with those of each language by Jensen-
Shannon distance. The language references are means over all documents of the corpus that carry the language and pass
the base rules; they are a few dozen numbers, whatever the size of the corpus.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from .batches import saved

#: Frequent words of each language.
COMMON = {
    "de": "der die und das in zu den von mit ist des ein dem für auf im sich eine als auch".split(),
    "en": "the of and to in is it that for was on with as at by be this from are or".split(),
    "es": "de la que el en y los se del las un por con para una su lo mi es como".split(),
    "fr": "de la le et les des en un du une que est pour qui dans au sur par elle il".split(),
}
WORDS = sorted({w for words in COMMON.values() for w in words})
#: Character classes by the characters of each; white space, symbols and the rest are counted apart.
CLASSES = {"lower": "a-z", "upper": "A-Z", "digit": "0-9", "punct": ".,;:'\"!?()-", "foreign": "^\\x00-\\x7F"}
SPACE = "[ \\t-\\r]+"


def _left(text: Column, keep: str) -> Column:
    """How many characters of a class text has."""
    outside = keep[1:] if keep[0] == "^" else "^" + keep
    return F.length(F.regexp_replace(text, f"[{outside}]+", "")).cast("long")


def features(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text, lang if there) -> (doc_id, lang, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
    chars array<long>, common array<long>): counts over the whole text; a null text has none."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lang = F.col("lang").cast("string") if "lang" in docs.columns else F.lit(None).cast("string")
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), lang.alias("lang"), text.alias("text"))
    rows = rows.withColumns({
        "words": F.array_remove(F.split("text", SPACE), ""),
        "lines": F.filter(F.split("text", "\n"), lambda x: x.rlike("[^ \\t-\\r]")),
        "word_chars": F.length(F.regexp_replace("text", SPACE, "")).cast("long"),
        "n_symbols": _left(F.col("text"), "#*$%&|<>"),
        "length": F.length("text").cast("long"),
    } | {k: _left(F.col("text"), v) for k, v in CLASSES.items()})
    rows = rows.withColumns({"n": F.size("words"), "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long")}).drop("text", "lines")
    # Windows of three words as sorted numbers: their hash in the high bits, their place in as many low bits as the text needs.
    low = "low"
    rows = rows.withColumn("low", F.length(F.bin("n"))).withColumn("keyed", F.expr(f"case when n < 4 then array() else sort_array(transform(sequence(0, n - 3), i -> shiftleft(shiftright(xxhash64(get(words, i), get(words, i + 1), get(words, i + 2)), {low}), {low}) | cast(i as bigint))) end"))
    same = f"coalesce(shiftright(get(keyed, k {{}} 1), {low}) = shiftright(v, {low}), false)"
    # Windows with an equal key are few; they are sorted by their words, so that keys cut short can't count.
    rows = rows.withColumn("alike", F.expr(f"transform(filter(keyed, (v, k) -> {same.format('-')} or {same.format('+')}), v -> cast(v & (shiftleft(1L, {low}) - 1) as int))"))
    rows = rows.withColumn("alike", F.expr("sort_array(transform(alike, p -> named_struct('w', array(get(words, p), get(words, p + 1), get(words, p + 2)), 'p', cast(p as bigint))))"))
    equal = "coalesce(get(alike, k {} 1).w = s.w, false)"
    rows = rows.withColumn("twice", F.expr(f"sort_array(transform(filter(alike, (s, k) -> {equal.format('-')} or {equal.format('+')}), s -> s.p))"))
    repeated = F.expr("aggregate(twice, named_struct('last', -3L, 'n', 0L), (a, p) -> named_struct('last', p, 'n', a.n + least(3L, p - a.last)), a -> a.n)")
    # Places of the common words in the list, and each place once more, sorted: the gaps between firsts are the counts.
    rows = rows.withColumn("places", F.sort_array(F.concat(F.transform(F.filter("words", lambda w: w.isin(WORDS)), lambda w: F.array_position(F.array(*map(F.lit, WORDS)), w).cast("int")), F.sequence(F.lit(1), F.lit(len(WORDS) + 1)))))
    firsts = F.transform(F.array("places"), lambda p: F.transform(F.sequence(F.lit(1), F.lit(len(WORDS) + 1)), lambda i: F.array_position(p, i)))[0]  # p is made once, not for each i
    rows = rows.select("doc_id", "lang", F.col("n").cast("long").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines", repeated.alias("n_repeat_words"), *CLASSES, "length", firsts.alias("firsts"))
    rest = F.col("word_chars") - F.col("n_symbols")
    for k in CLASSES:
        rest = rest - F.col(k)
    chars = F.array(*CLASSES, "n_symbols", F.col("length") - F.col("word_chars"), F.greatest(rest, F.lit(0).cast("long")))
    common = F.transform(F.sequence(F.lit(0), F.lit(len(WORDS) - 1)), lambda i: F.get("firsts", i + 1) - F.get("firsts", i) - 1)
    return rows.select("doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", chars.alias("chars"), common.alias("common"))


def _shares(counts: Column, total: Column) -> Column:
    return F.transform(counts, lambda x: x / total)


def js_distance(p: Column, q: list[float]) -> Column:
    """Square root of the Jensen-Shannon divergence (base 2, so from 0 to 1) of two arrays of shares."""
    part = lambda x, m: F.when(x > 0, x * F.log2(x / m)).otherwise(0.0)
    terms = F.zip_with(p, F.array(*map(F.lit, q)), lambda a, b: (part(a, (a + b) / 2) + part(b, (a + b) / 2)) / 2)
    return F.sqrt(F.greatest(F.lit(0.0), F.aggregate(terms, F.lit(0.0), lambda s, x: s + x)))


def judge(docs: DataFrame, min_words: int = 50, max_char_distance: float = 0.28, max_word_distance: float = 0.22, short_slack: float = 1.0) -> DataFrame:
    """``features`` and base_failed, char_distance, word_distance (to the nearest language), kept; a row for each row.

    base_failed: fewer than min_words words, or over half the words in repeated windows. A document that passes is kept
    if it is near enough to one language in both histograms; for words the limit is max_word_distance + short_slack /
    sqrt(n_words), as few words give a rough histogram. A document that names a language without a reference is kept,
    and where the corpus gives no reference at all, so are all that pass the base rules.
    """
    rows = features(docs)
    failed = (F.col("n_words") < min_words) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    n_common = F.aggregate("common", F.lit(0).cast("long"), lambda s, x: s + x)
    n_chars = F.aggregate("chars", F.lit(0).cast("long"), lambda s, x: s + x)
    words = F.concat(_shares(F.col("common"), F.greatest("n_words", F.lit(1))), F.array((F.col("n_words") - n_common) / F.greatest("n_words", F.lit(1))))
    rows = rows.withColumns({"base_failed": failed, "chars": _shares(F.col("chars"), F.greatest(n_chars, F.lit(1))), "common": words})
    rows = saved(rows, "features")
    means = [F.avg(F.get(c, F.lit(i))).alias(f"{c}{i}") for c, n in (("chars", len(CLASSES) + 3), ("common", len(WORDS) + 1)) for i in range(n)]
    refs = rows.where(~F.col("base_failed") & F.col("lang").isin(list(COMMON))).groupBy("lang").agg(*means).orderBy("lang").collect()  # a row for each known language
    if not refs:
        far = F.lit(None).cast("double")
        return rows.select(*rows.columns, far.alias("char_distance"), far.alias("word_distance"), (~F.col("base_failed")).alias("kept"))
    of = lambda r, c: [r[k] for k in r.asDict() if k.startswith(c)]
    near = F.array_min(F.array(*(F.struct((c := js_distance(F.col("common"), of(r, "common"))).alias("word"), js_distance(F.col("chars"), of(r, "chars")).alias("char")) for r in refs)))
    rows = rows.withColumn("near", F.when(~F.col("base_failed"), near)).withColumns({"char_distance": F.col("near.char"), "word_distance": F.col("near.word")})
    other = F.col("lang").isNotNull() & ~F.col("lang").isin([r["lang"] for r in refs])
    near_words = F.col("word_distance") <= max_word_distance + short_slack / F.sqrt(F.greatest("n_words", F.lit(1)))
    kept = ~F.col("base_failed") & (F.coalesce(other, F.lit(False)) | ((F.col("char_distance") <= max_char_distance) & near_words))
    return rows.drop("near").withColumn("kept", kept)
