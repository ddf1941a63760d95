"""Shards balanced by bytes, tokens and rows at once: vector bin packing.

What is packed are groups of equal texts. Groups are hashed into a fixed number of bundles; a group
that holds a large share of any dimension is packed by itself, whole as long as it fits into a shard, and else cut into chunks
(so a group with a third of all rows spreads over shards). Bundles, groups and chunks are placed
from largest to smallest, each on the shard where the dot product of its vector with what the shard
still has room for is highest. Only the bundles' sums reach the driver: their number is set by
``bundles`` and ``shards``, not by the data.

Defined results: a null text counts one byte, no token, one row; rows without doc_id and repeated rows are rows
like others; an empty table gives no rows. Equal texts share a shard unless they are more than a shard of any dimension.
"""
from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

SHARDS = 16
BUNDLES = 16_384
GRAIN = 4  # a group above 1 / (shards * GRAIN) of a dimension is packed by itself; chunks are of that size


def size_of(text: Column) -> Column:
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 1


def tokens_of(text: Column) -> Column:
    """Words between white space."""
    return F.coalesce(F.size(F.filter(F.split(text, r"\s+"), lambda w: w != "")), F.lit(0)).cast("long")


def crc_of(text: Column) -> Column:
    return F.crc32(F.coalesce(text, F.lit("")).cast("binary"))


def place(vectors: np.ndarray, shards: int) -> np.ndarray:
    """Shard of each vector (dimensions as shares of the whole), largest first."""
    room = np.full((shards, vectors.shape[1]), 1.0 / shards)
    out = np.zeros(len(vectors), dtype=np.int64)
    for i in np.lexsort((np.arange(len(vectors)), -vectors.max(axis=1, initial=0))):
        fit = room @ vectors[i]
        out[i] = int(np.argmax(fit))
        room[out[i]] -= vectors[i]
    return out


def _large(rows: DataFrame, shards: int) -> DataFrame | None:
    """(_large, _chunks) of groups that are packed by themselves: at most 3 * shards * GRAIN, by arithmetic. None without rows."""
    groups = rows.groupBy("_key").agg(
        F.sum("_bytes").alias("b"), F.sum("_tokens").alias("t"), F.count(F.lit(1)).alias("r"))
    total = groups.agg(F.sum("b").alias("tb"), F.sum("t").alias("tt"), F.sum("r").alias("tr")).first()
    if not total["tr"]:
        return None
    share = F.greatest(*(F.col(c) / F.lit(float(max(total[t], 1)))
                         for c, t in (("b", "tb"), ("t", "tt"), ("r", "tr"))))
    chunks = F.when(share * shards > 1, F.ceil(share * shards * GRAIN)).otherwise(1).cast("long")
    return common.landed(groups.where(share * shards * GRAIN > 1).select(F.col("_key").alias("_large"), chunks.alias("_chunks")))


def _items(rows: DataFrame, large: DataFrame | None, bundles: int) -> DataFrame:
    """Add ``_item``, the bundle, group or chunk of a row with ``_key``, ``_chunk``."""
    if large is None:
        return rows.withColumn("_item", F.lit(0).cast("long"))
    marked = rows.join(F.broadcast(large), F.col("_key") == F.col("_large"), "left")
    own = F.xxhash64("_key", F.pmod("_chunk", "_chunks"))
    return marked.withColumn(
        "_item", F.when(F.col("_large").isNull(), F.pmod(F.xxhash64("_key"), F.lit(bundles))).otherwise(
            F.when(own >= 0, -own - 1).otherwise(own))).drop("_large", "_chunks")


def _key(text: Column) -> Column:
    return F.xxhash64(text, size_of(text), crc_of(text))


def _measured(docs: DataFrame) -> DataFrame:
    """Narrow rows, measured and written once; ``_uid`` tells equal ones apart."""
    text = F.col("text")
    return common.numbered(docs.select(
        F.col("doc_id").alias("_id"), _key(text).alias("_key"), size_of(text).alias("_bytes"), tokens_of(text).alias("_tokens"),
        crc_of(text).alias("_crc"), F.xxhash64("doc_id", F.lit(1)).alias("_chunk")), "_uid")


def _placed(rows: DataFrame, shards: int, bundles: int) -> DataFrame:
    """One row per item: _item, _shard. There are at most bundles + 6 * shards * GRAIN items."""
    sums = rows.groupBy("_item").agg(
        F.sum("_bytes").alias("b"), F.sum("_tokens").alias("t"), F.count(F.lit(1)).alias("r")).orderBy("_item").toPandas()
    counts = sums[["b", "t", "r"]].to_numpy(float).reshape(-1, 3)
    shard = place(counts / np.maximum(counts.sum(axis=0), 1), shards)
    return rows.sparkSession.createDataFrame(
        [(int(i), int(s)) for i, s in zip(sums["_item"], shard, strict=True)], "_item long, _shard int")


def assign(docs: DataFrame, shards: int = SHARDS, bundles: int = BUNDLES) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot (0, 1, ... within the shard) of every row of ``docs``."""
    measured = _measured(docs.select("doc_id", "text"))
    # A cut group is dealt by row: rows without an id, or of one id, are spread as well.
    rows = _items(measured.withColumn("_chunk", F.col("_uid")), _large(measured, shards), bundles)
    placed = rows.join(F.broadcast(_placed(rows, shards, bundles)), "_item")
    return common.positions(placed, "_shard", [F.col("_id"), F.col("_uid")], "slot").select(
        F.col("_id").alias("doc_id"), F.col("_bytes").alias("size"), F.col("_crc").alias("text_crc32"),
        F.col("_shard").alias("shard"), "slot")


def sharded(docs: DataFrame, shards: int = SHARDS, bundles: int = BUNDLES) -> DataFrame:
    """All rows and columns of ``docs`` with their ``shard``; texts are not shuffled. The chunk of a cut group's row
    follows from its doc_id."""
    measured = _measured(docs.select("doc_id", "text"))
    large = _large(measured, shards)
    placed = _placed(_items(measured, large, bundles), shards, bundles)
    whole = docs.select(
        F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("_doc"), _key(F.col("text")).alias("_key"),
        F.xxhash64("doc_id", F.lit(1)).alias("_chunk"))
    return _items(whole, large, bundles).join(F.broadcast(placed), "_item").select(
        *(F.col(f"_doc.`{c}`").alias(c) for c in docs.columns if c != "shard"), F.col("_shard").alias("shard"))


def write_shards(docs: DataFrame, folder: str, **options) -> None:
    """Write ``docs`` as Parquet, one folder per shard."""
    sharded(docs, **options).write.partitionBy("shard").parquet(folder)
