"""Selection, validation and the subtree rollup. All sums are decimals cast back to bigint, so an overflow fails."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.paths import ancestors, direct_parent, irregular, relative, relative_parent, under_root

DENIED = 13


def total(column: str) -> Column:
    return F.coalesce(F.sum(F.col(column).cast("decimal(38,0)")), F.lit(0)).cast("bigint")


def select_root(inventory: DataFrame, root: str) -> DataFrame:
    """(path, st_size, code) of the root's subtree; lazy, and pushed down to the scan."""
    return inventory.where(under_root(F.col("path"), root)).select("path", "st_size", "code")


def invalid() -> Column:
    """A row that must not be published: another code than 0 and 13, no or a negative size, or an irregular path."""
    code, size, path = F.col("code"), F.col("st_size"), F.col("path")
    return code.isNull() | ~code.isin(0, DENIED) | size.isNull() | (size < 0) | irregular(path)


@dataclass(frozen=True)
class Totals:
    entries: int
    apparent_bytes: int
    denied: int
    invalid: int


def validation_counts(selected: DataFrame) -> DataFrame:
    """One row, in one pass: entries, apparent_bytes, unreadable_directories, invalid_rows."""
    return selected.agg(F.count("*").alias("entries"), total("st_size").alias("apparent_bytes"), F.count_if(F.col("code") == DENIED).alias("unreadable_directories"), F.count_if(invalid()).alias("invalid_rows"))


def direct_parents(selected: DataFrame, root: str) -> DataFrame:
    """(path, size, entries) of each folder that is the direct parent of a row."""
    return selected.groupBy(direct_parent(F.col("path"), root).alias("path")).agg(total("st_size").alias("size"), F.count("*").alias("entries"))


def moved_directories(selected: DataFrame, root: str) -> DataFrame:
    """Rows of folders that are direct parents themselves: their own size moves into them. The root's is there already."""
    parents = selected.select(direct_parent(F.col("path"), root).alias("path")).distinct()
    return selected.where(F.col("path") != F.lit(root)).join(parents, "path", "left_semi").select("path", "st_size")


def direct_totals(selected: DataFrame, root: str) -> DataFrame:
    """(dir, size, entries): each row counted in the folder that owns it, which is itself if it is a direct parent.

    Rows are summed by folder first, which combines before the shuffle; paths of files are never shuffled for it. The rows
    of folders that are direct parents, found by one join, are then moved from the folder above to the folder itself.
    """
    sums = lambda size, entries: (F.sum(size).alias("size"), F.sum(entries).alias("entries"))
    sized = selected.select("path", direct_parent(F.col("path"), root).alias("dir"), F.col("st_size").cast("decimal(38,0)").alias("size"))
    above = sized.groupBy("dir").agg(*sums("size", F.lit(1)))
    moved = sized.where("path <> dir").join(above.select(F.col("dir").alias("path")), "path", "left_semi")
    moved = moved.groupBy("path", "dir").agg(*sums("size", F.lit(1)))
    into = moved.select(F.explode(F.array(F.struct(F.col("path").alias("dir"), "size", "entries"), F.struct("dir", (-F.col("size")).alias("size"), (-F.col("entries")).alias("entries")))).alias("m")).select("m.*")
    return above.unionByName(into).groupBy("dir").agg(*sums("size", "entries")).where("entries > 0")


def subtree_rollup(selected: DataFrame, root: str) -> DataFrame:
    """(path, parent_path, apparent_bytes, entries) of every folder, also those only implied by what lies below them.

    Paths are relative. Only folders with direct totals are exploded to their ancestors, never files.
    """
    direct = direct_totals(selected, root)
    spread = direct.select(F.explode(ancestors(relative(F.col("dir"), root))).alias("path"), "size", "entries")
    summed = spread.groupBy("path").agg(F.sum("size").cast("bigint").alias("apparent_bytes"), F.sum("entries").cast("bigint").alias("entries"))
    return summed.select("path", relative_parent(F.col("path")).alias("parent_path"), "apparent_bytes", "entries")


def inferred_ancestors(selected: DataFrame, root: str) -> DataFrame:
    """(path, parent_path) of all folders, listed or implied."""
    parents = selected.select(direct_parent(F.col("path"), root).alias("d")).distinct()
    return parents.select(F.explode(ancestors(relative(F.col("d"), root))).alias("path")).distinct().select("path", relative_parent(F.col("path")).alias("parent_path"))


def reconciliation(selected: DataFrame, folders: DataFrame) -> DataFrame:
    """One row: totals of the source, totals of the root folder, and whether they are equal."""
    source = selected.agg(F.count("*").alias("source_entries"), total("st_size").alias("source_bytes"), F.lit(".").alias("path"))
    root = folders.where("path = '.'").select("path", F.col("entries").alias("root_entries"), F.col("apparent_bytes").alias("root_bytes"))
    return source.join(root, "path", "left").select("source_entries", "source_bytes", "root_entries", "root_bytes", F.coalesce((F.col("source_entries") == F.col("root_entries")) & (F.col("source_bytes") == F.col("root_bytes")), F.lit(False)).alias("reconciles"))
