"""Sharding by rendezvous hashing: a record goes to the shard with the best score of (key, shard), by weight.

The score of a shard depends on the key and that shard alone, so one more shard takes records only into itself, and a
record keeps its shard whatever other rows there are. Only DataFrame functions are used.
"""

from __future__ import annotations

import operator
from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F

from .batches import saved


def shard_of(key: Column, shards: int, weights: list[float] | None = None) -> Column:
    """The shard from 0 to shards - 1 for a key column (its text counts; null is ''). With equal weights the largest
    md5 of "key:shard" wins; else the least -ln(u) / weight, with u in (0, 1) from the first 52 bits of that md5."""
    text = F.coalesce(key.cast("string"), F.lit(""))
    digest = lambda s: F.md5(F.concat(text, F.lit(f":{s}")))
    if weights is None or len(set(weights)) == 1:
        return F.greatest(*(F.struct(digest(s).alias("score"), F.lit(s).alias("shard")) for s in range(shards)))["shard"] if shards > 1 else F.lit(0)
    if len(weights) != shards or min(weights) <= 0:
        raise ValueError("one positive weight for each shard")
    unit = lambda s: (F.conv(F.substring(digest(s), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)
    return F.least(*(F.struct((-F.log(unit(s)) / weights[s]).alias("score"), F.lit(s).alias("shard")) for s in range(shards)))["shard"] if shards > 1 else F.lit(0)


def assign_shards(docs: DataFrame, shards: int = 24, weights: list[float] | None = None, ranges: int = 64, salts: int = 16) -> DataFrame:
    """docs(doc_id, text) -> (doc_id, size, text_crc32, law, shard, slot, grown_shard), a row for each row.

    size is the UTF-8 bytes of the text (null: none) plus 8. slot counts the rows of a shard from 0 without a gap, by
    doc_id (nulls first; rows with an equal doc_id in any order): rows are numbered within ranges of doc_id, and the
    counts of the ranges before are added. A doc_id that fills a range alone, and null, is spread over salts. Equal
    texts are not held together: the key decides alone. grown_shard is the shard with one more shard of weight 1 (of
    the last weight where weights are given).
    """
    more = None if weights is None else [*weights, weights[-1]]
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 8).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"), F.lit("key").alias("law"),
        shard_of(F.col("doc_id"), shards, weights).cast("int").alias("shard"), shard_of(F.col("doc_id"), shards + 1, more).cast("int").alias("grown_shard"), F.pmod(F.monotonically_increasing_id(), F.lit(salts)).alias("salt"),
    )
    rows = saved(rows, "shards")
    cuts = rows.agg(F.percentile_approx("doc_id", [i / ranges for i in range(1, ranges)], 10_000)).first()[0] or []
    hot = sorted({c for c, d in zip(cuts, cuts[1:]) if c == d})
    above = reduce(operator.add, [(F.col("doc_id") > c).cast("int") for c in sorted(set(cuts))], F.lit(0))
    alone = F.col("doc_id").isNull() | F.coalesce(F.col("doc_id").isin(hot), F.lit(False))
    rows = rows.withColumns({"range": F.coalesce(above, F.lit(-1)), "sub": F.when(alone, F.col("salt") + 1).otherwise(0)})
    part = ["shard", "range", "sub"]
    counts = rows.groupBy(*part).agg(F.count("*").alias("n"))  # shards * ranges * salts rows at most
    before = counts.withColumn("before", F.sum("n").over(Window.partitionBy("shard").orderBy("range", "sub")) - F.col("n")).drop("n")
    numbered = rows.withColumn("own", F.row_number().over(Window.partitionBy(*part).orderBy("doc_id")) - 1)
    return numbered.join(F.broadcast(before), part).select("doc_id", "size", "text_crc32", "law", "shard", (F.col("before") + F.col("own")).cast("long").alias("slot"), "grown_shard")
