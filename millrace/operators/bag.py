"""Replicas without a key: rows matched as a whole, duplicates counted."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .registry import TableShape

COPIES = "_copies"

# Copies one task writes out for one row value.
CHUNK = 1 << 16


def counted(rows: DataFrame, shape: TableShape) -> DataFrame:
    """Rows that count once each; they are added up where the weights are applied."""
    return rows.select(*[c.name for c in shape.columns], F.lit(1).cast("bigint").alias(COPIES))


def row_weights(changes: DataFrame, shape: TableShape) -> DataFrame:
    """Signed rows: -1 for the old tuple, +1 for the new one.

    A value that the new tuple leaves out as unchanged is taken from the old one.
    """
    names = [c.name for c in shape.columns]
    if "unchanged" in changes.columns and any(c.may_be_unchanged for c in shape.columns):
        filled = F.struct(*[
            F.when(F.get("unchanged", F.lit(i)), F.col(f"old.{n}")).otherwise(F.col(f"new.{n}")).alias(n)
            for i, n in enumerate(names)
        ])
        changes = changes.withColumn("new", F.when(F.col("new").isNotNull(), filled))
    sides = F.array(
        F.struct(F.col("old").alias("row"), F.lit(-1).cast("bigint").alias(COPIES)),
        F.struct(F.col("new").alias("row"), F.lit(1).cast("bigint").alias(COPIES)),
    )
    rows = changes.select(F.explode(sides).alias("s")).where("s.row is not null")
    return rows.select(*[F.col(f"s.row.{n}").alias(n) for n in names], f"s.{COPIES}")


def apply_weights(base: DataFrame, weights: DataFrame, shape: TableShape) -> DataFrame:
    """Distinct rows and copies after the changes; added up before and after one shuffle."""
    names = [c.name for c in shape.columns]
    both = base.select(*names, COPIES).unionByName(weights.select(*names, COPIES))
    return both.groupBy(*names).agg(F.sum(COPIES).alias(COPIES)).where(F.col(COPIES) > 0)


def expand(rows: DataFrame) -> DataFrame:
    """Write every copy out as a row.

    Rows stay in their tasks, but for those with more than ``CHUNK`` copies: these are cut into chunks that are
    spread over the cluster, so the copies of a very frequent row do not come from one task.
    """
    chunks = F.sequence(F.lit(0).cast("bigint"), F.floor((F.col(COPIES) - 1) / CHUNK))
    cut = rows.where(F.col(COPIES) > CHUNK).withColumn("_chunk", F.explode(chunks)).withColumn(
        COPIES, F.least(F.lit(CHUNK), F.col(COPIES) - F.col("_chunk") * CHUNK)
    )
    cut = cut.repartition("_chunk", *[c for c in rows.columns if c != COPIES]).drop("_chunk")
    both = rows.where(F.col(COPIES) <= CHUNK).unionByName(cut)
    return both.withColumn("_copy", F.explode(F.sequence(F.lit(1).cast("bigint"), COPIES))).drop(
        "_copy", COPIES
    )
