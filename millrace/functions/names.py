"""Table names, always handled as ``schema.table``."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

DEFAULT_SCHEMA = "public"


def qualify(schema: Column, table: Column) -> Column:
    filled = F.when(F.length(schema) > 0, schema).otherwise(F.lit(DEFAULT_SCHEMA))
    return F.concat_ws(".", filled, table)


def name_parts(name: Column) -> tuple[Column, Column]:
    """Schema and table of a name as a user types it; only the first dot separates."""
    dot = F.instr(name, ".")
    schema = F.when(dot > 1, F.substring(name, F.lit(1), dot - 1)).otherwise(F.lit(DEFAULT_SCHEMA))
    table = F.when(dot > 0, F.substring(name, dot + 1, F.length(name))).otherwise(name)
    return schema, table


def normalize(name: Column) -> Column:
    return F.concat_ws(".", *name_parts(name))


def normalize_text(name: str) -> str:
    schema, dot, table = name.partition(".")
    return f"{schema or DEFAULT_SCHEMA}.{table}" if dot else f"{DEFAULT_SCHEMA}.{name}"
