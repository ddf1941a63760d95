"""Native expressions over the text of one replication message.

A message arrives as ``\\x`` followed by two hex digits per byte. The fields up
to the first variable-length part sit at fixed offsets, so they are cut out of
the text without decoding the rest: rows can be dropped before any real work.
"""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Message type bytes of protocol version 1.
BEGIN, COMMIT, RELATION = "B", "C", "R"
INSERT, UPDATE, DELETE = "I", "U", "D"
ORIGIN, TYPE, TRUNCATE = "O", "Y", "T"
CHANGES = (INSERT, UPDATE, DELETE)
CONTROL = (BEGIN, COMMIT, RELATION, ORIGIN, TYPE, TRUNCATE)

# Shortest readable message in bytes, type byte included.
SHORTEST = {"B": 17, "R": 10, "I": 8, "U": 8, "D": 8}

_POSTGRES_EPOCH = "timestamp_ntz'2000-01-01 00:00:00'"


def field_hex(data: Column, start: int, width: int) -> Column:
    """Hex digits of ``width`` bytes from byte ``start`` (0 is the type byte)."""
    return F.substring(data, 3 + 2 * start, 2 * width)


def unsigned(data: Column, start: int, width: int) -> Column:
    number = F.conv(field_hex(data, start, width), 16, 10)
    return number.cast("decimal(20,0)") if width == 8 else number.cast("bigint")


def signed64(data: Column, start: int) -> Column:
    return F.conv(field_hex(data, start, 8), 16, -10).cast("bigint")


def _code(op: str) -> str:
    return f"{ord(op):02X}"


def message_type(data: Column) -> Column:
    """The type byte as a letter."""
    return F.unhex(F.upper(field_hex(data, 0, 1))).cast("string")


def is_type(data: Column, op: str) -> Column:
    """Whether a message is of one type, as a prefix test that a file scan can use."""
    assert _code(op).isdigit(), "hex letters may come in either case"
    return data.startswith("\\x" + _code(op))


def relation_id(data: Column) -> Column:
    return unsigned(data, 1, 4)


def tuple_marker(data: Column) -> Column:
    """``N``, ``K`` or ``O``: which tuple comes first in a change message."""
    return F.unhex(field_hex(data, 5, 1)).cast("string")


def byte_count(data: Column) -> Column:
    return ((F.length(data) - 2) / 2).cast("int")


def body(data: Column) -> Column:
    """All bytes of the message; null when the text is not whole hex pairs."""
    # Behind the usual mark bytes are cut, not characters. Digits that are not one byte each are no hex in either count.
    cut = F.substring(data.cast("binary"), 3, 2**31 - 1).cast("string")
    digits = F.when(data.startswith("\\x"), cut).otherwise(F.substring(data, 3, 2**31 - 1))
    return F.when(F.octet_length(digits) % 2 == 0, F.unhex(digits))


def commit_time(data: Column, start: int) -> Column:
    micros = signed64(data, start)
    return F.expr(_POSTGRES_EPOCH) + F.make_dt_interval(secs=(micros / 1e6).cast("decimal(18,6)"))


def header_error(data: Column) -> Column:
    """Why a message cannot be dispatched, or null."""
    kind = message_type(data)
    short = F.lit(False)
    for op, least in SHORTEST.items():
        short = short | ((kind == op) & (byte_count(data) < least))
    return (
        F.when(data.isNull() | kind.isNull() | (F.length(data) < 4), "bad_hex")
        .when(~kind.isin(*CHANGES, *CONTROL), "unknown_type")
        .when(short, "short_message")
    )
