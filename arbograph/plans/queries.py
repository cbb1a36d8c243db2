"""The registered queries over an inventory derived from the test tables, and the same in SQL for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.lines import lone_surrogate
from ..operators import ranked, usage
from . import convert

ROOT = "/data"
TABLES = ("documents", "part", "region", "supplier")

#: An inventory of ROOT and of a neighbour: files of documents, some folders listed, some only implied, some unreadable.
INVENTORY = """
SELECT concat('/data/', source, '/', lang, '/doc-', CAST(doc_id AS VARCHAR(20)), '.txt') AS path, n_chars AS st_size, CAST(0 AS BIGINT) AS code FROM documents
UNION ALL SELECT DISTINCT concat('/data/', source, '/', lang), CAST(4096 AS BIGINT), CAST(0 AS BIGINT) FROM documents WHERE lang <> 'en' AND source < 'src5'
UNION ALL SELECT DISTINCT concat('/data/', source), CAST(4096 AS BIGINT), CAST(0 AS BIGINT) FROM documents WHERE source >= 'src3'
UNION ALL SELECT '/data', CAST(4096 AS BIGINT), CAST(0 AS BIGINT)
UNION ALL SELECT concat('/data-other/p', CAST(p_partkey AS VARCHAR(20))), CAST(p_size AS BIGINT), CAST(0 AS BIGINT) FROM part
UNION ALL SELECT concat('/data/locked-', CAST(r_regionkey AS VARCHAR(20))), CAST(4096 AS BIGINT), CAST(13 AS BIGINT) FROM region"""

#: The same with rows that must not be published.
RAW = (
    INVENTORY
    + """
UNION ALL SELECT concat('/data/bad-', CAST(s_suppkey AS VARCHAR(20)), CASE WHEN s_nationkey < 3 THEN '/' WHEN s_nationkey < 6 THEN '//x' WHEN s_nationkey < 9 THEN '/./x' WHEN s_nationkey < 12 THEN '/../x' WHEN s_nationkey = 12 THEN '/..' WHEN s_nationkey = 13 THEN '/.' ELSE '/x' END),
 CASE WHEN s_nationkey = 14 THEN NULL WHEN s_nationkey = 15 THEN CAST(-1 AS BIGINT) ELSE CAST(10 AS BIGINT) END, CASE WHEN s_nationkey = 16 THEN CAST(1 AS BIGINT) WHEN s_nationkey = 17 THEN NULL ELSE CAST(0 AS BIGINT) END FROM supplier"""
)

#: Raw scanner lines of every kind.
LINES = """
SELECT concat('{"name":"doc-', CAST(doc_id AS VARCHAR(20)), '.txt","path":"/data/', source, '/doc-', CAST(doc_id AS VARCHAR(20)), '.txt",',
 CASE WHEN lang = 'de' THEN '"code":13,"error":"denied"' WHEN lang = 'fr' AND source < 'src2' THEN '"code":-3' WHEN lang = 'fr' THEN '"code":"0"' WHEN source = 'src4' THEN '"nocode":0' WHEN source = 'src5' THEN '"code":99999999999999999999' ELSE '"code":0' END,
 CASE WHEN source = 'src6' THEN ',"st_size":"oops"' WHEN source = 'src7' THEN '' ELSE concat(',"st_size":', CAST(n_chars AS VARCHAR(20))) END,
 ',"st_atime":1.5,"st_mtime":2.25,"st_ctime":3.0}', CASE WHEN source = 'src8' THEN '  ' WHEN source = 'src9' THEN ' x' ELSE '' END) AS value FROM documents
UNION ALL SELECT concat('not json ', r_name) FROM region
UNION ALL SELECT '   ' FROM region"""


def _view(spark: SparkSession, sf_dir: str, sql: str) -> DataFrame:
    tables = {t: spark.read.parquet(f"{sf_dir}/{t}.parquet") for t in TABLES}
    return spark.sql(_named(sql), **tables)


def _named(sql: str) -> str:
    for t in TABLES:
        sql = sql.replace(f"FROM {t}", f"FROM {{{t}}}")
    return sql.replace('\'{"name"', '\'{{"name"').replace('3.0}\'', '3.0}}\'')


def _selected(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.select_root(_view(spark, sf_dir, INVENTORY), ROOT)


def _raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.select_root(_view(spark, sf_dir, RAW), ROOT)


def _folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return usage.subtree_rollup(_selected(spark, sf_dir), ROOT)


def _routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return convert.routed(_view(spark, sf_dir, LINES))


def _metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The keys of a report that depend on the inventory alone."""
    counts = usage.validation_counts(_selected(spark, sf_dir))
    whole = F.col("unreadable_directories") == 0
    pairs = {"schema_version": F.lit("1"), "root": F.lit(ROOT), "status": F.when(whole, "complete").otherwise("partial"), "complete_input": F.when(whole, "true").otherwise("false"), "unreadable_directories": F.col("unreadable_directories").cast("string"), "entries": F.col("entries").cast("string"), "apparent_bytes": F.col("apparent_bytes").cast("string")}
    return counts.select(F.explode(F.array(*(F.struct(F.lit(k).alias("key"), v.alias("value")) for k, v in pairs.items()))).alias("p")).select("p.*")


def _jsonl_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    from ..functions.lines import record

    rows = _view(spark, sf_dir, INVENTORY)
    back = rows.select(F.to_json(F.struct("path", "st_size", "code")).alias("value")).select(record(F.col("value")).alias("r"))
    return back.select("r.path", "r.st_size", "r.code")


def _surrogate_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Names with escapes of half, whole and no surrogate pairs, and which of them no text can carry."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tail = F.when(F.col("lang") == "de", F.lit("\\udcff")).when(F.col("lang") == "fr", F.lit("\\ud83d\\ude00")).when(F.col("lang") == "es", F.lit("\\\\udcff")).otherwise(F.lit("\\u00e9"))
    lines = docs.select("doc_id", "lang", F.concat(F.lit('{"name":"'), F.col("source"), tail, F.lit('"}')).alias("value"))
    return lines.select("doc_id", "lang", lone_surrogate(F.col("value")).alias("lone"))


def _scan_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The tree of this package's own sources, which is on every executor that can run it."""
    import os
    import tempfile

    from ..sources.tree import scan_tree

    scratch = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.mkdtemp()
    return scan_tree(spark, os.path.dirname(os.path.dirname(os.path.abspath(__file__))), f"{scratch}/scan-{os.urandom(8).hex()}").select("name", "path", "code", "st_size")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "root_select": _selected,
    "validation_counts": lambda s, d: usage.validation_counts(_raw(s, d)),
    "invalid_rows": lambda s, d: _raw(s, d).where(usage.invalid()),
    "direct_parents": lambda s, d: usage.direct_parents(_selected(s, d), ROOT),
    "moved_directories": lambda s, d: usage.moved_directories(_selected(s, d), ROOT),
    "directory_metadata_move": lambda s, d: usage.direct_totals(_selected(s, d), ROOT).select("dir", F.col("size").cast("bigint").alias("size"), F.col("entries").cast("bigint").alias("entries")),
    "inferred_ancestors": lambda s, d: usage.inferred_ancestors(_selected(s, d), ROOT),
    "subtree_rollup": _folders,
    "rollup_reconciliation": lambda s, d: usage.reconciliation(_selected(s, d), _folders(s, d)),
    "ranked_children": lambda s, d: ranked.ranked_children(_folders(s, d), ".", 10),
    "top_k_folders": lambda s, d: ranked.top_folders(_folders(s, d), 20),
    "depth_limited_report": lambda s, d: ranked.depth_report(_folders(s, d), 4, 20),
    "longest_paths_first": lambda s, d: ranked.longest_first(_folders(s, d)),
    "report_metadata": _metadata,
    "metadata_key_lookup": lambda s, d: _metadata(s, d).where(F.col("key").isin("entries", "apparent_bytes", "status")),
    "convert_code0": lambda s, d: convert.code0_rows(_routes(s, d)),
    "convert_side_lines": lambda s, d: convert.side_lines(_routes(s, d)),
    "convert_code_counts": lambda s, d: convert.code_counts(_routes(s, d)),
    "jsonl_round_trip": _jsonl_round_trip,
    "surrogate_lines": _surrogate_lines,
    "scan_tree": _scan_tree,
}

_SELECTED = f"WITH inv AS ({INVENTORY}), sel AS (SELECT * FROM inv WHERE path = '/data' OR starts_with(path, '/data/'))"
_RAW_SELECTED = f"WITH inv AS ({RAW}), sel AS (SELECT * FROM inv WHERE path = '/data' OR starts_with(path, '/data/'))"
_PARENT = "CASE WHEN path = '/data' THEN path ELSE regexp_replace(path, '/[^/]*$', '') END"
_INVALID = "(code IS NULL OR code NOT IN (0, 13) OR st_size IS NULL OR st_size < 0 OR contains(path, '//') OR contains(path, '/./') OR contains(path, '/../') OR ends_with(path, '/.') OR ends_with(path, '/..') OR ends_with(path, '/'))"
_DIRECT = f"""{_SELECTED}, p AS (SELECT DISTINCT {_PARENT} AS path FROM sel),
own AS (SELECT CASE WHEN path = '/data' OR path IN (SELECT path FROM p) THEN path ELSE {_PARENT} END AS dir, st_size FROM sel),
direct AS (SELECT dir, CAST(sum(st_size) AS BIGINT) AS size, count(*) AS entries FROM own GROUP BY dir)"""
_UP = "CASE WHEN path = '.' THEN '' WHEN NOT contains(path, '/') THEN '.' ELSE regexp_replace(path, '/[^/]*$', '') END AS parent_path"
_FOLDERS = f"""{_DIRECT}, rel AS (SELECT CASE WHEN dir = '/data' THEN '.' ELSE substr(dir, 7) END AS r, size, entries FROM direct),
anc AS (SELECT '.' AS path, size, entries FROM rel UNION ALL
 SELECT array_to_string(list_slice(string_split(r, '/'), 1, i), '/'), size, entries FROM (SELECT r, size, entries, unnest(range(1, len(string_split(r, '/')) + 1)) AS i FROM rel WHERE r <> '.')),
folders AS (SELECT path, {_UP}, CAST(sum(size) AS BIGINT) AS apparent_bytes, CAST(sum(entries) AS BIGINT) AS entries FROM anc GROUP BY path)"""
_COUNTS = "SELECT count(*) AS entries, CAST(coalesce(sum(st_size), 0) AS BIGINT) AS apparent_bytes, count(*) FILTER (code = 13) AS unreadable_directories"
_META = f"""{_SELECTED}, c AS ({_COUNTS} FROM sel), meta AS (SELECT 'schema_version' AS key, '1' AS value UNION ALL SELECT 'root', '/data'
UNION ALL SELECT 'status', CASE WHEN unreadable_directories = 0 THEN 'complete' ELSE 'partial' END FROM c UNION ALL SELECT 'complete_input', CASE WHEN unreadable_directories = 0 THEN 'true' ELSE 'false' END FROM c
UNION ALL SELECT 'unreadable_directories', CAST(unreadable_directories AS VARCHAR) FROM c UNION ALL SELECT 'entries', CAST(entries AS VARCHAR) FROM c UNION ALL SELECT 'apparent_bytes', CAST(apparent_bytes AS VARCHAR) FROM c)"""
_ROUTES = f"""WITH l AS ({LINES}), t AS (SELECT regexp_replace(value, '[ \\r]+$', '') AS value FROM l), n AS (SELECT value, json_valid(value) AS ok FROM t WHERE value <> ''),
c AS (SELECT value, ok, CASE WHEN ok AND regexp_matches(json_extract(value, '$.code')::VARCHAR, '^-?[0-9]+$') THEN TRY_CAST(json_extract(value, '$.code')::VARCHAR AS BIGINT) END AS code FROM n),
routes AS (SELECT value, CASE WHEN code IS NULL THEN 'unparsed' WHEN code <> 0 THEN concat('code_', CAST(code AS VARCHAR)) WHEN json_type(value, '$.st_size') IN ('UBIGINT', 'BIGINT') THEN 'code_0' ELSE 'unparsed' END AS sink FROM c)"""

ORACLE: dict[str, str] = {
    "root_select": f"{_SELECTED} SELECT path, st_size, code FROM sel",
    "validation_counts": f"{_RAW_SELECTED} {_COUNTS}, count(*) FILTER {_INVALID} AS invalid_rows FROM sel",
    "invalid_rows": f"{_RAW_SELECTED} SELECT path, st_size, code FROM sel WHERE {_INVALID}",
    "direct_parents": f"{_SELECTED} SELECT {_PARENT} AS path, CAST(sum(st_size) AS BIGINT) AS size, count(*) AS entries FROM sel GROUP BY 1",
    "moved_directories": f"{_SELECTED}, p AS (SELECT DISTINCT {_PARENT} AS path FROM sel) SELECT sel.path, st_size FROM sel JOIN p ON sel.path = p.path WHERE sel.path <> '/data'",
    "directory_metadata_move": f"{_DIRECT} SELECT dir, size, entries FROM direct",
    "inferred_ancestors": f"{_FOLDERS} SELECT path, parent_path FROM folders",
    "subtree_rollup": f"{_FOLDERS} SELECT path, parent_path, apparent_bytes, entries FROM folders",
    "rollup_reconciliation": f"{_FOLDERS}, s AS (SELECT count(*) AS source_entries, CAST(sum(st_size) AS BIGINT) AS source_bytes FROM sel) SELECT source_entries, source_bytes, entries AS root_entries, apparent_bytes AS root_bytes, source_entries = entries AND source_bytes = apparent_bytes AS reconciles FROM s, folders WHERE path = '.'",
    "ranked_children": f"{_FOLDERS} SELECT path, apparent_bytes, entries FROM folders WHERE parent_path = '.' ORDER BY apparent_bytes DESC, path LIMIT 10",
    "top_k_folders": f"{_FOLDERS} SELECT path, apparent_bytes, entries FROM folders WHERE path <> '.' ORDER BY apparent_bytes DESC, path LIMIT 20",
    "depth_limited_report": f"{_FOLDERS} SELECT path, apparent_bytes, entries FROM folders WHERE path <> '.' AND len(string_split(path, '/')) <= 4 ORDER BY apparent_bytes DESC, path LIMIT 20",
    "longest_paths_first": f"{_FOLDERS} SELECT path, CAST(length(path) AS INTEGER) AS path_length FROM folders WHERE path <> '.' ORDER BY length(path) DESC, path",
    "report_metadata": f"{_META} SELECT key, value FROM meta",
    "metadata_key_lookup": f"{_META} SELECT key, value FROM meta WHERE key IN ('entries', 'apparent_bytes', 'status')",
    "convert_code0": f"{_ROUTES} SELECT json_extract_string(value, '$.name') AS name, json_extract_string(value, '$.path') AS path, CAST(json_extract(value, '$.st_size') AS BIGINT) AS st_size, CAST(json_extract(value, '$.st_atime') AS DOUBLE) AS st_atime, CAST(json_extract(value, '$.st_mtime') AS DOUBLE) AS st_mtime, CAST(json_extract(value, '$.st_ctime') AS DOUBLE) AS st_ctime, CAST(0 AS BIGINT) AS code FROM routes WHERE sink = 'code_0'",
    "convert_side_lines": f"{_ROUTES} SELECT value, sink FROM routes WHERE sink <> 'code_0'",
    "convert_code_counts": f"{_ROUTES} SELECT sink, count(*) AS n_lines FROM routes GROUP BY sink",
    "jsonl_round_trip": f"WITH inv AS ({INVENTORY}) SELECT path, st_size, code FROM inv",
}
