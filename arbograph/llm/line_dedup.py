"""Line deduplication by an exact set-similarity join, with DataFrame functions only.

A line is a set of words; a later line goes if an earlier one, kept or not, has a Jaccard similarity of at least the
threshold. Lines with equal sets are one class first. The words of a class are ordered by rarity, from counts over the
whole corpus in a table of fixed size (words that share a cell share its count; any order gives the same matches). Two
classes at the threshold share a word of their prefixes; length, position and bitmap filters drop pairs inside the join,
and what is left is verified on the words themselves.

A word that is too common to be a key alone is one with each common word behind it: sets that share l words share l words
of prefixes that are l - 1 words longer; keys of two words that are still crowded get a third. Before the join, each line is
compared with a few of the first lines of about its length that have the same rare words; what that settles is not the later
line of a pair again, so large groups of copies don't make a pair for each two of them.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

from .batches import columns, discard, release, saved, small

#: log2 of the cells of the table of word counts (a byte each).
CELL_BITS = 21
#: Occurrences from which a word is no key alone, and lines from which a key of two words is crowded. Estimated, not
#: measured apart: a row more in the join takes some 2 microseconds and a pair tested 0.01, and a word more makes five to ten rows.
HOT = 4096
#: Lines of a rare key that later lines of about their length are compared with before the join: the first of each of so many parts.
LEADERS = 8
#: Places, in the order of rarity, of the first of the two words of such a key.
LEADING = (1, 3, 5, 7)
#: Leaders whose words a line is held against before the join; what they don't settle, the join does.
TRIED = 8
#: Sets with fewer words get a bitmap of 64 bits, others of 128.
WIDE = 64
_NULL_ID = -(1 << 63)
_DOC = ["did", "th", "th2"]
_KEY = ["node", "key2"]
#: What a row of the join carries beside its key.
_ROW = ["node", "x", "y", "did", "po"]


def _text() -> Column:
    return F.coalesce(F.col("text").cast("string"), F.lit(""))


def _keyed() -> dict[str, Column]:
    """did (null: the least number) and 128 bits of the text, which tell rows apart that share a doc_id or have none."""
    return {"did": F.coalesce(F.col("doc_id").cast("long"), F.lit(_NULL_ID)), "th": F.xxhash64(_text()), "th2": F.xxhash64(F.lit(1), _text())}


def _worded(line: Column, min_words: int) -> Column:
    """Has min_words words or more."""
    return line.rlike(f"^[ \\t-\\r]*+(?:[^ \\t-\\r]++[ \\t-\\r]++){{{min_words - 1}}}[^ \\t-\\r]")


def _split(line: Column) -> Column:
    """Words, and empty strings between separators."""
    return F.when(line.rlike("[\\t-\\r]"), F.split(line, "[ \\t-\\r]+")).otherwise(F.split(line, " "))  # one character splits fast


def _words(line: Column) -> Column:
    return F.array_remove(_split(line), "")


def _class(n: int) -> int:
    return math.floor(math.log2(n) * 4 + 1e-9)


def word_classes(docs: DataFrame) -> DataFrame:
    """One row with an array: of each cell the rarity class, the logarithm of how often its words are in all texts."""
    spark, mask, low = docs.sparkSession, (1 << CELL_BITS) - 1, CELL_BITS // 2
    words = docs.select(F.explode(_split(F.replace(F.lower(_text()), F.lit("\n"), F.lit(" ")))).alias("w")).where("w <> ''")
    cells = words.select(F.xxhash64("w").bitwiseAND(mask).cast("int").alias("cell"))
    cells = cells.union(spark.range(1 << CELL_BITS).select(F.col("id").cast("int"))).groupBy("cell").agg(F.count("*").alias("n"))  # each cell once
    rows = cells.select(F.shiftright("cell", low).alias("hi"), F.struct("cell", F.least(F.floor(F.log2(F.greatest(F.col("n") - 1, F.lit(1))) * 4 + 1e-9), F.lit(126)).cast("tinyint").alias("class")).alias("c"))
    rows = rows.groupBy("hi").agg(F.transform(F.sort_array(F.collect_list("c")), lambda c: c["class"]).alias("part"))  # 2 ** low cells in each
    return saved(rows.agg(F.flatten(F.transform(F.sort_array(F.collect_list(F.struct("hi", "part"))), lambda c: c["part"])).alias("table")), "rarity")


def _lines(docs: DataFrame, min_words: int) -> DataFrame:
    """(did, th, th2, pos, line) of every line with min_words words or more, in lower case."""
    rows = docs.select(*(v.alias(k) for k, v in _keyed().items()), _text().alias("text"))  # hashed once for a text, not for a line
    rows = rows.select(*_DOC, F.posexplode(F.split("text", "\n")).alias("pos", "line"))
    return rows.where(_worded(F.col("line"), min_words)).withColumn("line", F.lower("line"))


def line_classes(docs: DataFrame, threshold: float, min_words: int, levels: int) -> DataFrame:
    """(node, key2, did, pos, th, th2, n, x, y, prefix, heads) of the first line of each class of equal sets.

    node and key2 are 128 bits of the set, of n words; x a bitmap of it, y the half of
    its words that a larger bitmap of WIDE sets has apart; prefix its rarest words as numbers, rarity
    class in the high bits; heads the keys by which it finds leaders; lines are ordered by doc_id (null first), line number and a hash of the text.
    """
    table, mask = word_classes(docs), (1 << CELL_BITS) - 1
    rows = _lines(docs, min_words).withColumn("hashes", F.array_distinct(F.transform(_words(F.col("line")), lambda w: F.xxhash64(w)))).withColumn("table", table.scalar())
    # The table has one use, so the optimizer puts the subquery there and no row carries it.
    # An array that can't hold null is sorted as plain numbers.
    known = lambda h: F.coalesce(F.get("table", h.bitwiseAND(mask).cast("int")).cast("long"), F.lit(0).cast("long"))
    number = F.transform("hashes", lambda h: F.shiftleft(known(h), 56).bitwiseOR(F.shiftrightunsigned(h, 8)))
    rows = rows.select(*_DOC, "pos", F.sort_array(number).alias("set"))
    n = F.size("set")
    bitmap = lambda one: F.expr(f"aggregate(set, 0L, (a, w) -> a ^ shiftleft({one}, cast(w & 63 as int)))")
    prefix = F.slice("set", F.lit(1), F.when(n >= _least_shared(threshold), _prefix(n, threshold) + levels - 1).otherwise(0))
    wide = F.struct("did", "pos", "th", "th2", n.alias("n"), bitmap("1L").alias("x"), F.when(n >= WIDE, bitmap("shiftright(w, 6) & 1L")).otherwise(F.lit(0).cast("long")).alias("y"), prefix.alias("prefix"))
    rows = rows.select(F.xxhash64("set").alias("node"), F.xxhash64(F.lit(1), "set").alias("key2"), wide.alias("c"))
    out = rows.groupBy(*_KEY).agg(F.min("c").alias("c")).select(*_KEY, "c.*")
    out = saved(out.withColumn("heads", _heads(threshold)), "classes")
    discard(table)
    return out


def _least_shared(threshold: float) -> int:
    """Words that two different sets at the threshold share at least."""
    return math.ceil(threshold / max(1 - threshold, 1e-9) - 1e-6)


def _prefix(n: Column, threshold: float) -> Column:
    """Any two sets at the threshold share one of so many of their first words."""
    return n - F.ceil(n * threshold - 1e-9).cast("int") + 1


def _heads(threshold: float) -> Column:
    """Keys of two rare words each, at LEADING; a word that no other line has finds nothing."""
    known = F.filter(F.slice("prefix", F.lit(1), _prefix(F.col("n"), threshold)), lambda w: F.shiftright(w, 56) > 0)
    keys = F.transform(F.array(known), lambda q: F.array_compact(F.array(*(F.when(F.size(q) >= i, F.xxhash64(F.slice(q, i, 2))) for i in LEADING))))[0]
    return F.when(F.col("n") >= 4, keys).otherwise(F.array().cast("array<bigint>"))


def _behind(rows: DataFrame, threshold: float, level: int) -> DataFrame:
    """Keys of level words from rows (key k of one word less, its last word's place at, prefix): one for each word behind it."""
    size = _prefix(F.col("n"), threshold) + level - 2 - F.col("at")
    rows = rows.select(*_ROW, "n", "k", "at", F.posexplode(F.slice("prefix", F.col("at") + 2, size)).alias("more", "v"))
    return rows.select(*_ROW, "n", F.xxhash64("k", "v").alias("k"), (F.col("at") + 1 + F.col("more")).alias("at"))


def _packed(rows: DataFrame, level: int) -> DataFrame:
    """(k, _ROW, nd): nd holds n, and how many of the words up to the key's last one are not in the key."""
    return rows.select("k", *_ROW, F.shiftleft(F.col("n").cast("long"), 32).bitwiseOR((F.col("at") + 1 - level).cast("long")).alias("nd"))


def _apart() -> Column:
    """In how many bits the bitmaps of a pair differ: no more than the sets in words, as a word turns one bit."""
    low, high = F.col("a.x").bitwiseXOR(F.col("b.x")), F.col("a.y").bitwiseXOR(F.col("b.y"))
    return F.when(F.least("a.nd", "b.nd") >= WIDE << 32, F.bit_count(high) + F.bit_count(low.bitwiseXOR(high))).otherwise(F.bit_count(low))


def _possible(threshold: float, placed: bool = True) -> Column:
    """Line b of the same key is earlier than a, which isn't settled, and may match it. Bitmaps, cheap and sharp, come before the length and
    position filters; none drops a pair at the threshold whose first shared words are the key."""
    m, n, i, j = F.shiftright("a.nd", 32), F.shiftright("b.nd", 32), F.col("a.nd").bitwiseAND((1 << 32) - 1), F.col("b.nd").bitwiseAND((1 << 32) - 1)
    most = (m + n) * ((1 - threshold) / (1 + threshold)) + 1e-6
    near = (F.bit_count(F.col("a.x").bitwiseXOR(F.col("b.x"))) <= most) & (_apart() <= most)
    length = F.least(m, n) >= F.greatest(m, n) * threshold - 1e-9
    behind = (F.least(m - i, n - j) >= (m + n) * (threshold / (1 + threshold)) - 1e-9) if placed else F.lit(True)
    unsettled = F.least(F.col("a.po").bitwiseAND(1), F.col("b.nd")) == 0  # nd is over 0: the test needs both sides, so they are the same rows, shuffled once
    return (F.col("a.k") == F.col("b.k")) & (F.col("b.did") <= F.col("a.did")) & unsettled & near & length & behind & (_place("b") < _place("a"))


def _place(side: str) -> Column:
    return F.struct(F.col(f"{side}.did"), F.shiftright(f"{side}.po", 1), F.col(f"{side}.node"))


def _spread(crowd: DataFrame, prefixes: DataFrame) -> DataFrame:
    """Packed rows of keys of two words with their parts and the prefix, for ``_behind``."""
    at = (F.col("nd").bitwiseAND((1 << 32) - 1) + 1).cast("int").alias("at")
    return crowd.join(prefixes, "node").select("k", *_ROW, F.shiftright("nd", 32).cast("int").alias("n"), at, "prefix")


def _texts(docs: DataFrame, classes: DataFrame, pairs: DataFrame, min_words: int) -> DataFrame:
    """(node, key2, id, set) of the lines in pairs(later, earlier), read again: so no table holds the words of all lines."""
    nodes = saved(pairs.select(F.col("later").alias("node")).union(pairs.select("earlier")).distinct(), "nodes")
    places = saved(classes.join(small(nodes), "node", "left_semi").select(*_KEY, *_DOC, "pos"), "places")
    holders = small(saved(places.select(F.col("did").alias("holder")).distinct(), "holders"))
    found = _lines(docs.join(holders, _keyed()["did"] == F.col("holder"), "left_semi"), min_words)
    found = found.join(small(places), [*_DOC, "pos"]).dropDuplicates([*_KEY, *_DOC, "pos"])
    out = saved(found.select(*_KEY, F.struct("did", "pos", "node").alias("id"), F.array_distinct(_words(F.col("line"))).alias("set")), "texts")
    discard(nodes)
    discard(places)
    return out


def _verified(pairs: DataFrame, texts: DataFrame, threshold: float) -> DataFrame:
    """(node, key2) of the later lines of pairs(later, earlier) that reach the threshold, judged by their words."""
    one = texts.select(F.col("node").alias("later"), "key2", F.col("id").alias("ia"), "set")
    two = texts.select(F.col("node").alias("earlier"), F.col("id").alias("ib"), F.col("set").alias("set2"))
    both = pairs.join(one, "later").join(two, "earlier").where("ib < ia").withColumn("shared", F.size(F.array_intersect("set", "set2")))
    near = both.where(F.col("shared") >= (F.size("set") + F.size("set2") - F.col("shared")) * threshold - 1e-9)
    return saved(near.select(F.col("later").alias("node"), "key2").distinct(), "verified")


def _nearest(pairs: DataFrame) -> DataFrame:
    """Of each later line the pair whose bitmaps differ least."""
    return saved(pairs.groupBy("later").agg(F.min(F.struct("far", "earlier")).alias("b")).select("later", "b.earlier"), "nearest")


def _nearest_leaders(pairs: DataFrame) -> DataFrame:
    """Of each later line the TRIED pairs with a leader whose bitmaps differ least; it has LEADERS for each of LEADING at most."""
    near = F.slice(F.sort_array(F.collect_set(F.struct("far", "earlier"))), 1, TRIED)
    return saved(pairs.groupBy("later").agg(near.alias("near")).select("later", F.explode("near").alias("b")).select("later", "b.earlier"), "nearest")


def removed_lines(docs: DataFrame, threshold: float = 0.8, min_words: int = 5, hot: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(first, matched) for the lines of docs(doc_id, text): first has (node, key2) and (did, pos, th, th2), the first line
    of each class; matched the (node, key2) of classes whose first line matches an earlier line of another class."""
    docs, hot = docs.select("doc_id", "text"), HOT if hot is None else hot
    levels = max(1, min(3, _least_shared(threshold)))
    classes = line_classes(docs, threshold, min_words, levels)
    pair, ends = _possible(threshold), [F.col("a.node").alias("later"), F.col("b.node").alias("earlier"), _apart().alias("far")]

    def spread(rows: DataFrame, words: Column) -> DataFrame:
        return rows.select(*_ROW, "n", "prefix", F.posexplode(words).alias("at", "k"))

    rows = classes.withColumn("po", F.shiftleft(F.col("pos").cast("long"), 1))
    own = F.slice("prefix", F.lit(1), _prefix(F.col("n"), threshold))
    repeated = saved(classes.select(F.explode("heads").alias("k")).groupBy("k").agg(F.count("*").alias("m")).where("m > 1").select("k"), "repeated")
    heads = saved(_packed(spread(rows, F.col("heads")), 1).join(small(repeated), "k", "left_semi"), "heads")  # few keys lead from one line to another
    band = lambda nd: F.floor(F.log(F.shiftright(nd, 32).cast("double")) * 5)
    lead = heads.groupBy("k", band("nd").alias("band"), F.pmod("node", F.lit(LEADERS))).agg(F.min(F.struct("did", "po", "node", "x", "y", "nd")).alias("c")).select("k", "c.*")
    unplaced = _possible(threshold, placed=False) & (band("a.nd") == band("b.nd"))
    lead_pairs = saved(heads.alias("a").join(lead.alias("b"), unplaced).select(*ends), "led")
    first_pairs = _nearest_leaders(lead_pairs)
    texts = _texts(docs, classes, first_pairs, min_words)
    settled = _verified(first_pairs, texts, threshold)
    discard(texts)
    release(docs.sparkSession)

    gone = small(saved(settled.select("node").distinct(), "settled"))
    rows = classes.join(gone.withColumn("gone", F.lit(1)), "node", "left").withColumn("po", F.shiftleft(F.col("pos").cast("long"), 1).bitwiseOR(F.coalesce(F.col("gone"), F.lit(0)).cast("long")))
    single = spread(rows, own).where(F.shiftright("k", 56) > 0)
    common = F.shiftright("k", 56) >= _class(hot)
    keys = _packed(single.where(~common), 1)
    several = _packed(_behind(single.where(common), threshold, 2), 2) if levels > 1 else _packed(single.where(common), 1)
    several = saved(several, "keys")
    crowded = saved(several.groupBy("k").agg(F.count("*").alias("m")).where(F.col("m") > hot).select("k"), "crowded")
    quiet, deep = several, None
    if not crowded.isEmpty():
        known = small(crowded)
        quiet, deep = several.join(known, "k", "left_anti"), saved(several.join(known, "k", "left_semi"), "crowd")
        if levels > 2:
            mine = classes.select("node", "prefix").join(small(saved(deep.select("node").distinct(), "nodes")), "node", "left_semi")
            deep = _packed(_behind(_spread(deep, mine), threshold, 3), 3)
    mine = keys.union(quiet)
    mine = mine.select(*(F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in mine.columns))  # none is null; a test of a pair needn't ask
    found = [saved(mine.alias("a").join(mine.alias("b"), pair).select(*ends).distinct(), "pairs")]
    if deep is not None:
        found.append(saved(deep.alias("a").join(deep.alias("b"), pair).select(*ends).distinct(), "pairs"))
    pairs = reduce(DataFrame.union, found)

    # Of each later line first the pair whose bitmaps differ least; then all pairs of the lines which that does not settle.
    texts, closest = _texts(docs, classes, pairs, min_words), _nearest(pairs)
    near = _verified(closest, texts, threshold)
    release(docs.sparkSession)
    rest = pairs.select("later", "earlier").distinct().join(small(saved(near.select(F.col("node").alias("later")).distinct(), "settled")), "later", "left_anti")
    rest = saved(rest, "rest")
    matched = saved(settled.union(near).union(_verified(rest, texts, threshold)).select(*_KEY).distinct(), "matched")
    for used in (repeated, heads, lead_pairs, first_pairs, several, crowded, *found, texts, closest, rest):
        discard(used)
    release(docs.sparkSession)
    return classes.select(*_KEY, *_DOC, "pos"), matched


def _kept(docs: DataFrame, threshold: float, min_words: int) -> DataFrame:
    """(did, th, th2, kept): the numbers of the kept lines with min_words words or more, of every text that has one."""
    first, matched = removed_lines(docs, threshold, min_words)
    return first.join(small(matched), _KEY, "left_anti").groupBy(*_DOC).agg(F.sort_array(F.collect_list("pos")).alias("kept"))


def _with_kept(rows: DataFrame, docs: DataFrame, threshold: float, min_words: int) -> DataFrame:
    """rows, with the keys of documents under names that no table is likely to have, and the numbers of their kept lines."""
    names = [f"__{k}" for k in _DOC]
    kept = _kept(docs, threshold, min_words).toDF(*names, "__kept")
    return rows.join(kept, names, "left")


def line_report(docs: DataFrame, threshold: float = 0.8, min_words: int = 5) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, n_lines, n_compared, n_removed, kept_lines string), a row for each row of docs.

    n_compared counts the lines with min_words words or more; kept_lines are the numbers, from 0, of those that stay.
    Shorter lines are never removed. Repeated rows (equal doc_id and text) are one document and get equal results; the
    lines of rows with an equal doc_id and another text are ordered by number, then by a hash. A null text is empty.
    """
    sizes = lambda lines: F.struct(F.size(lines).cast("long").alias("n_lines"), F.size(F.filter(lines, lambda x: _worded(x, min_words))).cast("long").alias("n_compared"))
    sized = docs.select(F.col("doc_id").cast("long").alias("doc_id"), *(v.alias(f"__{k}") for k, v in _keyed().items()), F.transform(F.array(F.split(_text(), "\n")), sizes)[0].alias("__sizes"))
    sized = sized.select("doc_id", *(f"__{k}" for k in _DOC), F.col("__sizes.n_lines").alias("n_lines"), F.col("__sizes.n_compared").alias("n_compared"))  # split once
    out = _with_kept(sized, docs, threshold, min_words)
    return out.select("doc_id", "n_lines", "n_compared", (F.col("n_compared") - F.coalesce(F.size("__kept"), F.lit(0))).alias("n_removed"), F.coalesce(F.array_join("__kept", ","), F.lit("")).alias("kept_lines"))


def dedup_lines(docs: DataFrame, threshold: float = 0.8, min_words: int = 5) -> DataFrame:
    """docs without their removed lines, n_chars (if there) brought up to date; a document goes if it had words and every
    line of words was removed. Texts from which no line goes stay as they are, null ones too."""
    rows = _with_kept(docs.withColumns({f"__{k}": v for k, v in _keyed().items()}), docs, threshold, min_words)
    text, kept = _text(), F.coalesce("__kept", F.array().cast("array<int>"))

    def left(lines: Column) -> Column:
        places = F.sequence(F.lit(0), F.size(lines) - 1)
        gone = F.array_except(F.filter(places, lambda i: _worded(F.get(lines, i), min_words)), kept)
        return F.array_join(F.transform(F.array_except(places, gone), lambda i: F.get(lines, i)), "\n")

    rows = rows.withColumn("__new", F.transform(F.array(F.split(text, "\n")), left)[0])  # the text is split once, not for each line
    rows = rows.where(F.col("__new").rlike("[^ \\t-\\r]") | ~text.rlike("[^ \\t-\\r]"))
    changed = F.col("__new") != text
    new = {"text": F.when(changed, F.col("__new")).otherwise(F.col("text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(changed, F.length("__new").cast("long")).otherwise(F.col("n_chars"))
    return rows.select(*(new[c].alias(c) if c in new else old for c, old in zip(docs.columns, columns(docs))))
