"""SQL of the queries that DuckDB can express, by plain definitions and none of the operators' methods."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _item_words(text: str) -> str:
    return rf"regexp_extract_all(translate(coalesce({text}, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"


#: Every window of every length that an item has is compared with every stretch of as many words of every document.
OP5 = f"""
WITH items AS (SELECT cast(item_id AS varchar) AS item_id, {_item_words("text")} AS w FROM benchmark),
item_windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[i : i + least(len(w), 10) - 1], ' ') AS span
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS i FROM items WHERE len(w) > 0)),
texts AS (SELECT row_number() OVER () AS rid, doc_id, {_item_words("text")} AS w FROM documents),
stretches AS (
  SELECT rid, i, size, array_to_string(w[i : i + size - 1], ' ') AS span
  FROM (SELECT rid, w, size, unnest(range(1, len(w) - size + 2)) AS i
        FROM texts, (SELECT DISTINCT size FROM item_windows) WHERE len(w) >= size)),
found AS (SELECT rid, i, size, item_id FROM stretches JOIN item_windows USING (size, span)),
hit_words AS (SELECT rid, count(DISTINCT place) AS n_hit FROM (SELECT rid, unnest(range(i, i + size)) AS place FROM found) GROUP BY rid),
hit_items AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS listed FROM (SELECT DISTINCT rid, item_id FROM found) GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(listed, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM texts LEFT JOIN hit_words USING (rid) LEFT JOIN hit_items USING (rid)
"""

#: Rows with equal doc_id and text are one document. Sets of words that share no word of their first n - ceil(0.8 n) + 1, in one
#: order for all, can't reach 0.8; the others are compared whole.
OP8 = r"""
WITH texts AS (SELECT DISTINCT doc_id, coalesce(text, '') AS text FROM documents),
split AS (SELECT doc_id, text, string_split(text, chr(10)) AS ls FROM texts),
lines AS (SELECT doc_id, text, unnest(range(len(ls))) AS pos, unnest(ls) AS line FROM split),
sets AS (
  SELECT doc_id, text, pos, list_sort(list_distinct(list_filter(regexp_split_to_array(lower(line), '[ \t-\r]+'), lambda x: x <> ''))) AS s FROM lines),
compared AS (SELECT *, row_number() OVER (ORDER BY doc_id NULLS FIRST, pos, text) AS place FROM sets WHERE len(s) > 0),
classes AS (SELECT s, len(s) AS n, min(place) AS place FROM compared GROUP BY s),
words AS (SELECT place, n, unnest(s) AS word FROM classes),
ranked AS (
  SELECT place, n, word, row_number() OVER (PARTITION BY place ORDER BY often, word) AS rank
  FROM words JOIN (SELECT word, count(*) AS often FROM words GROUP BY word) USING (word)),
prefixes AS (SELECT * FROM ranked WHERE rank <= n - cast(ceil(n * 0.8 - 1e-9) AS bigint) + 1),
pairs AS (
  SELECT DISTINCT a.place AS later, b.place AS earlier FROM prefixes a JOIN prefixes b ON a.word = b.word AND b.place < a.place
  WHERE least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9),
matched AS (
  SELECT DISTINCT later FROM (
    SELECT later, a.n AS m, b.n AS n, len(list_intersect(a.s, b.s)) AS shared
    FROM pairs JOIN classes a ON a.place = later JOIN classes b ON b.place = earlier)
  WHERE shared >= 0.8 * (m + n - shared) - 1e-9),
kept AS (
  SELECT c.doc_id, c.text, count(*) AS n_compared, count(*) FILTER (WHERE stays) AS n_kept,
    string_agg(cast(c.pos AS varchar), ',' ORDER BY c.pos) FILTER (WHERE stays) AS listed
  FROM (SELECT compared.*, place IN (SELECT place FROM classes) AND place NOT IN (SELECT later FROM matched) AS stays FROM compared) c
  GROUP BY c.doc_id, c.text)
SELECT d.doc_id, len(string_split(coalesce(d.text, ''), chr(10))) AS n_lines, coalesce(n_compared, 0) AS n_compared,
  coalesce(n_compared - n_kept, 0) AS n_removed, coalesce(listed, '') AS kept_lines
FROM documents d LEFT JOIN kept k ON k.doc_id IS NOT DISTINCT FROM d.doc_id AND k.text = coalesce(d.text, '')
"""


def _crc(value: int) -> int:
    """CRC-32 (reflected polynomial) of a byte, without the inversions."""
    for _ in range(8):
        value = value >> 1 ^ 0xEDB88320 * (value & 1)
    return value


def _crc_step() -> str:
    """The state c after byte b: CRC is linear, so each bit of the low byte adds its own constant."""
    terms = (f"((xor(c, b) >> {k}) & 1) * {_crc(1 << k)}" for k in range(8))
    out = "c >> 8"
    for term in terms:
        out = f"xor({out}, {term})"
    return out


#: The hash that decides is md5 of "key:shard"; the crc32 of a text goes over its bytes, written as pairs of digits.
OP10 = f"""
WITH texts AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS t, coalesce(cast(doc_id AS varchar), '') AS key FROM documents),
scores AS (SELECT rid, s, md5(key || ':' || s) AS score FROM texts, (SELECT unnest(range(25)) AS s)),
best AS (SELECT rid, arg_max(s, score) FILTER (WHERE s < 24) AS shard, arg_max(s, score) AS grown_shard FROM scores GROUP BY rid),
bytes AS (
  SELECT rid, list_transform(regexp_extract_all(hex(t), '..'),
    lambda x: cast(16 * (instr('0123456789ABCDEF', x[1]) - 1) + instr('0123456789ABCDEF', x[2]) - 1 AS bigint)) AS bs FROM texts),
sums AS (SELECT rid, xor(list_reduce(bs, lambda c, b: {_crc_step()}, 4294967295::bigint), 4294967295::bigint) AS text_crc32 FROM bytes)
SELECT doc_id, octet_length(t) + 8 AS size, text_crc32, 'key' AS law, cast(shard AS integer) AS shard,
  row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST) - 1 AS slot, cast(grown_shard AS integer) AS grown_shard
FROM texts JOIN best USING (rid) JOIN sums USING (rid)
"""

ORACLE = {"op5_decontamination": OP5, "op8_line_dedup": OP8, "op10_sharding": OP10}
