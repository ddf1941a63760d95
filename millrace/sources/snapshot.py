"""Initial table contents, taken at one log position."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.names import normalize_text
from ..functions.positions import position_number

SNAPSHOT_SEQ = -1


def read_snapshot(
    spark: SparkSession,
    table: str,
    location: str | None = None,
    fmt: str = "parquet",
    position: str | None = None,
    **options: str,
) -> DataFrame:
    """Rows of one table, marked with ``seq = -1`` and the snapshot position.

    ``fmt="jdbc"`` reads the table's own rows (``ONLY``) through the options
    given (``url``, ``driver``, ``partitionColumn``, ...); any other format
    reads ``location``.
    """
    reader = spark.read.format(fmt).options(**options)
    if fmt == "jdbc":
        rows = reader.option("dbtable", f"ONLY {table}").load()
    else:
        rows = reader.load(location)
    mark = F.lit(None).cast("string") if position is None else F.lit(position)
    return rows.withColumns(
        {"seq": F.lit(SNAPSHOT_SEQ).cast("bigint"), "lsn_n": position_number(mark)}
    )


def read_snapshots(
    spark: SparkSession, locations: dict[str, str], position: str | None = None, **options: str
) -> dict[str, DataFrame]:
    """Lazy snapshots of several tables by qualified name, all at the same position."""
    return {
        normalize_text(table): read_snapshot(spark, table, location, position=position, **options)
        for table, location in locations.items()
    }
