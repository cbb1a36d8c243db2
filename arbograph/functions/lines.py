"""Column functions over raw scanner lines."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

RECORD = "name string, path string, code bigint, st_size bigint, st_atime double, st_mtime double, st_ctime double"
_PAIRED = r"^(?:[^\\]++|\\(?!u[dD][89abcdefABCDEF]..)[\s\S]|\\u[dD][89abAB]..\\u[dD][c-fC-F]..)*+$"


def trimmed(line: Column) -> Column:
    """Without the blanks and carriage returns at its end."""
    return F.regexp_replace(line, r"[ \r]+$", "")


def lone_surrogate(line: Column) -> Column:
    """Holds an escape of half a surrogate pair, which no text can carry."""
    return ~line.rlike(_PAIRED)


def record(line: Column) -> Column:
    """The line as RECORD and _corrupt; text that is no such object is kept in _corrupt."""
    return F.from_json(line, RECORD + ", _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowNonNumericNumbers": "false"})


def well_formed(line: Column) -> Column:
    """One JSON value and nothing behind it, which the reader of records alone would let pass."""
    return F.coalesce(F.json_array_length(F.concat(F.lit("["), line, F.lit("]"))) == 1, F.lit(False))


def code_of(line: Column) -> Column:
    """The line's code as a bigint, null where it is missing, no integer token, out of range, or the line is no JSON object."""
    whole = F.from_json(line, "code string, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowNonNumericNumbers": "false"})
    quoted = F.coalesce(F.get_json_object(line, "$.code"), F.lit(""))
    # from_json gives the text of a number and of a string alike; only a number also reads as bigint.
    number = F.from_json(line, "code bigint, _corrupt string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "allowNonNumericNumbers": "false"})
    return F.when(well_formed(line) & whole["_corrupt"].isNull() & number["_corrupt"].isNull() & quoted.rlike("^-?(0|[1-9][0-9]*)$"), number["code"])


def sink_of(line: Column) -> Column:
    """Where a trimmed line goes: code_0 (a complete record), code_N (another code, as it is) or unparsed."""
    row, code = record(line), code_of(line)
    fields = [row[f] for f in ("name", "path", "st_size", "st_atime", "st_mtime", "st_ctime")]
    complete = row["_corrupt"].isNull() & ~lone_surrogate(line)
    for f in fields:
        complete = complete & f.isNotNull()
    return F.when(code.isNull(), "unparsed").when(code != 0, F.concat(F.lit("code_"), code.cast("string"))).when(complete, "code_0").otherwise("unparsed")
