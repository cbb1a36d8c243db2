"""Queries over the folder table of a report. Ties are broken by path."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def _ranked(folders: DataFrame) -> DataFrame:
    return folders.orderBy(F.desc("apparent_bytes"), "path")


def ranked_children(folders: DataFrame, parent: str, k: int) -> DataFrame:
    """The k largest folders right below a folder."""
    return _ranked(folders.where(F.col("parent_path") == F.lit(parent))).limit(k).select("path", "apparent_bytes", "entries")


def top_folders(folders: DataFrame, k: int) -> DataFrame:
    """The k largest folders but the root."""
    return _ranked(folders.where("path <> '.'")).limit(k).select("path", "apparent_bytes", "entries")


def depth_report(folders: DataFrame, depth: int, k: int) -> DataFrame:
    """The k largest folders of at most a depth; those right below the root have depth 1."""
    level = F.size(F.split("path", "/"))
    return _ranked(folders.where((F.col("path") != ".") & (level <= depth))).limit(k).select("path", "apparent_bytes", "entries")


def longest_first(folders: DataFrame) -> DataFrame:
    """Folders below the root, children before their parents."""
    return folders.where("path <> '.'").orderBy(F.length("path").desc(), "path").select("path", F.length("path").alias("path_length"))
