"""Write replication messages with column expressions: the inverse of decoding.

Used to turn tables into change logs for tests, benchmarks and demos. Every
function returns the hex text of (part of) one message.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.pgtypes import SourceColumn


_HEADS = [f"{ord('t'):02X}{size:08X}" for size in range(64)]


def integer(value: Column | int, width: int) -> Column:
    number = F.lit(value) if isinstance(value, int) else value
    digits = F.lpad(F.hex(number.cast("bigint")), 16, "0")
    return F.substring(digits, 17 - 2 * width, 2 * width)


def _byte(char: str) -> Column:
    return F.lit(f"{ord(char):02X}")


def _name(text: Column | str) -> Column:
    if isinstance(text, str):
        return F.lit(text.encode().hex().upper() + "00")
    return F.concat(F.hex(text.cast("binary")), F.lit("00"))


def _message(char: str, *parts: Column) -> Column:
    return F.concat(F.lit("\\x"), _byte(char), *parts)


def text_value(value: Column) -> Column:
    """A column value sent as text, or the null mark."""
    text = value.cast("string")
    size = F.octet_length(text)
    # The mark and size of a short text are looked up.
    head = F.when(size < len(_HEADS), F.get(F.lit(_HEADS), size)).otherwise(
        F.concat(_byte("t"), F.lpad(F.hex(size), 8, "0")))
    sent = F.concat(head, F.hex(text))
    return F.coalesce(sent, _byte("n"))


def null_value() -> Column:
    return _byte("n")


def unchanged_value() -> Column:
    return _byte("u")


def row(values: Sequence[Column]) -> Column:
    """A tuple; values are built with the ``*_value`` functions."""
    return F.concat(integer(len(values), 2), *values)


def begin(final_position: Column, micros: Column | int = 0, xid: Column | int = 0) -> Column:
    return _message("B", integer(final_position, 8), integer(micros, 8), integer(xid, 4))


def commit(position: Column, micros: Column | int = 0) -> Column:
    return _message(
        "C", integer(0, 1), integer(position, 8), integer(position, 8), integer(micros, 8)
    )


def relation(
    relid: Column | int, schema: Column | str, table: Column | str, identity: str, columns: Sequence[SourceColumn]
) -> Column:
    described = [
        part
        for c in columns
        for part in (integer(int(c.is_key), 1), _name(c.name), integer(c.oid, 4), integer(c.typmod, 4))
    ]
    return _message(
        "R", integer(relid, 4), _name(schema), _name(table), _byte(identity),
        integer(len(columns), 2), *described,
    )


def insert(relid: Column | int, values: Sequence[Column]) -> Column:
    return _message("I", integer(relid, 4), _byte("N"), row(values))


def update(
    relid: int, values: Sequence[Column], old: Sequence[Column] | None = None, tag: str = "K"
) -> Column:
    before = [] if old is None else [_byte(tag), row(old)]
    return _message("U", integer(relid, 4), *before, _byte("N"), row(values))


def delete(relid: int, old: Sequence[Column], tag: str = "K") -> Column:
    return _message("D", integer(relid, 4), _byte(tag), row(old))
