"""A directory tree as a table: levels of directories are listed by executors, so the tree must be mounted on all."""

from __future__ import annotations

import contextlib
import errno
import os
from collections.abc import Iterator
from itertools import batched

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F

RECORD = "name string, path string, code bigint, st_size bigint, st_atime double, st_mtime double, st_ctime double"
_FOUND = RECORD + ", is_child boolean"
_STAT = ("st_size", "st_atime", "st_mtime", "st_ctime")


def _row(path: str, code: int, stat: os.stat_result | None = None, child: bool = False) -> tuple:
    return (os.path.basename(path), path, code, *(getattr(stat, f) if stat else None for f in _STAT), child)


def list_directory(path: str) -> Iterator[tuple]:
    """Rows of one directory: its entries, subdirectories as children to list, and last the directory itself.

    What vanishes meanwhile is left out. A directory that may not be opened is one row of code EACCES; an entry that
    can't be read otherwise is a row of code 1 without numbers; any other error of the listing fails the task. Rows come
    as they are read, so a directory of any size is never held whole.
    """
    code = 0
    try:
        entries = os.scandir(path)
    except FileNotFoundError:
        return
    except PermissionError:
        code = errno.EACCES
    else:
        with entries:
            yield from filter(None, map(_entry, entries))
    with contextlib.suppress(FileNotFoundError):
        yield _row(path, code, os.lstat(path))


def _entry(entry: os.DirEntry) -> tuple | None:
    try:
        child = entry.is_dir(follow_symlinks=False)
        return _row(entry.path, 0, None if child else entry.stat(follow_symlinks=False), child)
    except FileNotFoundError:
        return None
    except OSError:
        return _row(entry.path, 1)


def scan_tree(spark: SparkSession, root: str, scratch: str, tasks: int = 64) -> DataFrame:
    """The records of a tree. Each level's rows are written once below ``scratch``, a shared folder, so a task that is run
    again can't add rows twice; the next level's directories are read from there, never gathered on the driver."""
    frontier, level, written = spark.createDataFrame([(root,)], "path string"), 0, []

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        names = [c.split()[0] for c in _FOUND.split(", ")]
        for batch in batches:
            for path in batch["path"]:
                for rows in batched(list_directory(path), 10_000):
                    yield pd.DataFrame(rows, columns=names).astype({"st_size": "Int64"})

    while True:
        place = f"{scratch.rstrip('/')}/level-{level}"
        frontier.repartition(tasks, "path").mapInPandas(run, _FOUND).write.mode("overwrite").parquet(place)
        written.append(place)
        frontier = spark.read.parquet(place).where("is_child").select("path").dropDuplicates(["path"])
        if frontier.isEmpty():
            return spark.read.parquet(*written).where(~F.col("is_child")).drop("is_child")
        level += 1
