"""Column functions over POSIX paths. A root is always a literal, never a pattern."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def under_root(path: Column, root: str) -> Column:
    """The root itself or anything below it; both halves are pushed down to Parquet."""
    return (path == F.lit(root)) | path.startswith(F.lit(root + "/"))


def direct_parent(path: Column, root: str) -> Column:
    """The path without its last part; the root is its own parent."""
    return F.when(path == F.lit(root), path).otherwise(F.regexp_replace(path, "/[^/]*$", ""))


def relative(path: Column, root: str) -> Column:
    """The path below the root, '.' for the root."""
    return F.when(path == F.lit(root), F.lit(".")).otherwise(F.substring(path, F.lit(len(root) + 2), F.length(path)))


def relative_parent(path: Column) -> Column:
    """The parent of a relative path: '' for '.', '.' for a folder right below the root."""
    return F.when(path == ".", F.lit("")).when(~path.contains("/"), F.lit(".")).otherwise(F.regexp_replace(path, "/[^/]*$", ""))


def ancestors(path: Column) -> Column:
    """All folders from '.' down to the relative path itself."""
    parts = F.split(path, "/")
    below = F.transform(F.sequence(F.lit(1), F.size(parts)), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))
    return F.when(path == ".", F.array(F.lit("."))).otherwise(F.concat(F.array(F.lit(".")), below))


def irregular(path: Column) -> Column:
    """Not in normal form: an empty, '.' or '..' part, or a slash at the end."""
    return path.contains("//") | path.contains("/./") | path.contains("/../") | path.endswith("/.") | path.endswith("/..") | path.endswith("/")


def basename(path: Column) -> Column:
    return F.substring_index(path, "/", -1)
