"""Convert scanner lines: complete records of code 0 to typed columns, all other lines as they are to side files."""

from __future__ import annotations

import os
import re
import shutil
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions.lines import record, sink_of, trimmed

COLUMNS = ("name", "path", "st_size", "st_atime", "st_mtime", "st_ctime")


def routed(lines: DataFrame) -> DataFrame:
    """lines(value) -> (value trimmed, sink); blank lines are skipped."""
    rows = lines.select(trimmed(F.col("value")).alias("value")).where("value <> ''")
    return rows.select("value", sink_of(F.col("value")).alias("sink"))


def code0_rows(routes: DataFrame) -> DataFrame:
    """The typed columns of the lines of code 0, and the code, which a reader of inventories needs."""
    row = record(F.col("value"))
    return routes.where("sink = 'code_0'").select(row.alias("r")).select(*(f"r.{c}" for c in COLUMNS), "r.code")


def side_lines(routes: DataFrame) -> DataFrame:
    return routes.where("sink <> 'code_0'")


def code_counts(routes: DataFrame) -> DataFrame:
    return routes.groupBy("sink").agg(F.count("*").alias("n_lines"))


def convert_file(spark: SparkSession, source: str | Path, folder: str | Path, arrow: bool = False) -> dict[str, int]:
    """Write ``folder``/code_0.parquet (zstd) and one file of raw lines for each other sink; the number of lines of each.

    Only outputs of an earlier run are removed. With ``arrow``, code_0.arrow (Arrow IPC, zstd, a batch at a time) is
    written beside; a source of no lines still gives a file of no rows.
    """
    source, folder = Path(source), Path(folder)
    if not source.is_file():
        raise ValueError(f"{source} is no regular file")
    if source.resolve().parent == folder.resolve() and re.fullmatch(r"code_0\.arrow|unparsed\.jsonl|code_-?\d+\.jsonl", source.name):
        raise ValueError(f"{source} is what would be written")
    folder.mkdir(parents=True, exist_ok=True)
    for p in folder.iterdir():
        if re.fullmatch(r"code_0\.(arrow|arrow\.partial|parquet)|unparsed\.jsonl|code_-?\d+\.jsonl|\.sides", p.name):
            shutil.rmtree(p) if p.is_dir() else p.unlink()
    routes = routed(spark.read.option("lineSep", "\n").text(str(source)))
    rows = code0_rows(routes)
    rows.write.option("compression", "zstd").parquet(str(folder / "code_0.parquet"))
    parts = folder / ".sides"
    side_lines(routes).write.partitionBy("sink").text(str(parts))
    counts = {r["sink"]: r["n_lines"] for r in code_counts(routes).collect()}  # a row for each code
    for d in sorted(parts.glob("sink=*")):
        with open(folder / f"{d.name.removeprefix('sink=')}.jsonl", "wb") as out:
            for part in sorted(d.glob("part-*")):
                with part.open("rb") as given:
                    shutil.copyfileobj(given, out, 1 << 20)
    shutil.rmtree(parts)
    if arrow:
        write_arrow(spark.read.parquet(str(folder / "code_0.parquet")).select(*COLUMNS), folder / "code_0.arrow")
    return counts


def write_arrow(rows: DataFrame, path: Path) -> None:
    """One Arrow IPC file, row groups streamed through the driver one partition at a time."""
    import pyarrow as pa

    kinds = {"string": pa.string(), "bigint": pa.int64(), "double": pa.float64()}
    schema = pa.schema([pa.field(n, kinds[t]) for n, t in rows.dtypes])
    partial = path.with_name(path.name + ".partial")
    with pa.ipc.new_file(partial, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        batch: list = []
        for r in rows.toLocalIterator():
            batch.append(r.asDict())
            if len(batch) == 50_000:
                out.write_batch(pa.RecordBatch.from_pylist(batch, schema=schema))
                batch = []
        if batch:
            out.write_batch(pa.RecordBatch.from_pylist(batch, schema=schema))
    os.replace(partial, path)
