"""From raw log rows to decoded changes."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import wire
from .tuples import decode_batches, text_batches

VALUES = "array<struct<k:tinyint,v:binary>>"

# How a tuple says what it holds for a column.
KIND_NULL, KIND_TEXT, KIND_UNCHANGED, KIND_BINARY = (ord(c) for c in "ntub")


def with_header(log: DataFrame) -> DataFrame:
    """Add message type and relation id, read straight from the hex text."""
    kind = wire.message_type(F.col("data"))
    return log.withColumns(
        {
            "op": kind,
            "relid": F.when(
                kind.isin(*wire.CHANGES, wire.RELATION), wire.relation_id(F.col("data"))
            ),
        }
    )


def decode_changes(
    log: DataFrame,
    relids: list[int] | None = None,
    keep: Column | None = None,
    carry: Sequence[str] = (),
) -> DataFrame:
    """Decode inserts, updates and deletes.

    ``relids`` and ``keep`` are applied to the header columns, so rows they drop
    are never turned into bytes or sent to a Python worker. A message that cannot be
    read comes back with its reason in ``err`` and no tuples. ``carry`` names string columns
    of the log to pass along.
    """
    rows = with_header(log).where(F.col("op").isin(*wire.CHANGES))
    if relids is not None:
        rows = rows.where(F.col("relid").isin(*relids) if relids else F.lit(False))
    if keep is not None:
        rows = rows.where(keep)
    rows = rows.select("seq", "lsn", "op", "relid", *carry, wire.body(F.col("data")).alias("body"))
    return _decode(rows, list(carry)).drop("raw")


def decode_texts(log: DataFrame, relids: list[int]) -> DataFrame:
    """Decode the changes of some relations as far as a table needs them: ``old`` and ``new`` as arrays of text, the
    ``kinds`` of the new values, and ``err``. Half as many bytes as ``decode_changes`` go through the Python worker.

    Messages that can be read are those that ``decode_changes`` reads; of others, some come back with ``err``.
    """
    kind, relid = wire.field_hex(F.col("data"), 0, 1), F.upper(wire.field_hex(F.col("data"), 1, 4))
    codes = {f"{ord(op):02X}": op for op in wire.CHANGES}
    # Both are compared as hex; only the rows that stay have them converted.
    rows = log.where(kind.isin(*codes)).where(relid.isin(*[f"{r:08X}" for r in relids]) if relids else F.lit(False))
    op = F.lit(None).cast("string")
    for code, letter in codes.items():
        op = F.when(kind == code, letter).otherwise(op)
    number = F.lit(relids[0]).cast("bigint") if len(relids) == 1 else wire.relation_id(F.col("data"))
    rows = rows.select("seq", op.alias("op"), number.alias("relid"), wire.body(F.col("data")).alias("body"))
    return rows.mapInArrow(
        text_batches, "seq bigint, op string, relid bigint, old array<string>, new array<string>, kinds array<tinyint>, err string"
    )


def stage_changes(log: DataFrame) -> DataFrame:
    """Decode a log once for all tables, keeping what later steps need of the rest.

    ``part`` is ``change`` for decoded changes, ``bad`` for messages to be set
    aside, and ``control`` for everything else. ``data`` is kept for bad messages and relations.
    """
    rows = with_header(log)
    wrong = wire.header_error(F.col("data"))
    is_change = wrong.isNull() & F.col("op").isin(*wire.CHANGES)
    body = F.when(is_change, wire.body(F.col("data")))
    text = F.when(wrong.isNotNull() | body.isNull(), F.col("data"))
    rows = rows.select("seq", "lsn", "op", "relid", text.alias("data"), wrong.alias("wrong"), body.alias("body"))
    reason = F.coalesce("wrong", F.when(F.col("op").isin(*wire.CHANGES), F.col("err")))
    data = F.coalesce("data", F.concat(F.lit("\\x"), F.lower(F.hex("raw"))))
    return _decode(rows, ["data", "wrong"]).select(
        "seq", "lsn", "op", "relid", "tag", "old", "new", "err",
        F.when(reason.isNotNull() | (F.col("op") == wire.RELATION), data).alias("data"),
        reason.alias("reason"),
        F.when(reason.isNotNull(), "bad").when(F.col("op").isin(*wire.CHANGES), "change")
        .otherwise("control").alias("part"),
    )


def _decode(rows: DataFrame, carry: list[str]) -> DataFrame:
    return rows.mapInArrow(
        decode_batches,
        "seq bigint, lsn string, op string, relid bigint, "
        + "".join(f"{name} string, " for name in carry)
        + f"tag string, old {VALUES}, new {VALUES}, err string, raw binary",
    )


def value_text(values: Column, slot: Column | int) -> Column:
    """Text of the value at a 0-based slot; null for null, unchanged or missing."""
    return F.get(values, F.lit(slot) if isinstance(slot, int) else slot)["v"].cast("string")


def value_kind(values: Column, slot: Column | int) -> Column:
    return F.get(values, F.lit(slot) if isinstance(slot, int) else slot)["k"]


def message_text(op: Column, relid: Column, tag: Column, old: Column, new: Column) -> Column:
    """The hex text of a decoded change, put together from its parts again."""

    def number(value: Column, digits: int) -> Column:
        return F.lpad(F.hex(value.cast("bigint")), digits, "0")

    def item(x: Column) -> Column:
        held = F.concat(number(F.octet_length(x["v"]), 8), F.hex(x["v"]))
        sent = x["k"].isin(KIND_TEXT, KIND_BINARY)
        return F.concat(number(x["k"], 2), F.when(sent, F.coalesce(held, F.lit("00000000"))).otherwise(""))

    def side(mark: Column, values: Column) -> Column:
        items = F.array_join(F.transform(values, item), "")
        return F.when(values.isNotNull(), F.concat(F.hex(mark), number(F.size(values), 4), items)).otherwise("")

    parts = F.concat(F.hex(op), number(relid, 8), side(tag, old), side(F.lit("N"), new))
    return F.concat(F.lit("\\x"), F.lower(parts))
