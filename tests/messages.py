"""Messages built byte by byte, independent of the column-expression encoder."""
from __future__ import annotations

import struct

U = object()  # unchanged
PUBLIC = "public"


def _name(text):
    return text.encode() + b"\0"


def tuple_bytes(values):
    out = struct.pack(">h", len(values))
    for v in values:
        if v is None:
            out += b"n"
        elif v is U:
            out += b"u"
        elif isinstance(v, bytes):
            out += b"b" + struct.pack(">i", len(v)) + v
        else:
            raw = str(v).encode()
            out += b"t" + struct.pack(">i", len(raw)) + raw
    return out


def text(message: bytes) -> str:
    return "\\x" + message.hex()


def begin(final=0, micros=0, xid=0):
    return text(b"B" + struct.pack(">qqi", final, micros, xid))


def commit(position=0):
    return text(b"C" + struct.pack(">bqqq", 0, position, position, 0))


def relation(relid, table, columns, identity="d", schema=PUBLIC):
    """``columns``: (name, oid, is_key) or (name, oid, is_key, typmod)."""
    out = b"R" + struct.pack(">i", relid) + _name(schema) + _name(table) + identity.encode()
    out += struct.pack(">h", len(columns))
    for name, oid, is_key, *mod in columns:
        out += struct.pack(">b", is_key) + _name(name) + struct.pack(">ii", oid, mod[0] if mod else -1)
    return text(out)


def insert(relid, new):
    return text(b"I" + struct.pack(">i", relid) + b"N" + tuple_bytes(new))


def update(relid, new, old=None, tag="K"):
    before = b"" if old is None else tag.encode() + tuple_bytes(old)
    return text(b"U" + struct.pack(">i", relid) + before + b"N" + tuple_bytes(new))


def delete(relid, old, tag="K"):
    return text(b"D" + struct.pack(">i", relid) + tag.encode() + tuple_bytes(old))


def log(spark, messages, first=0, step=1, lsn=None):
    """A log DataFrame of the messages in order; ``lsn`` maps a place to a position number."""
    place = lsn or (lambda seq: 1000 + 8 * seq)
    rows = [
        (first + i * step, "%X/%X" % divmod(place(first + i * step), 2**32), m)
        for i, m in enumerate(messages)
    ]
    return spark.createDataFrame(rows, "seq bigint, lsn string, data string")
