"""Snapshot plus change log to table contents, in one batch."""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import wire
from ..functions.pgtypes import NATIVE
from ..operators import bag, links, merge
from ..operators.decode import decode_texts
from ..operators.project import (
    conform, digits_of_changes, digits_of_rows, open_numerics, settled, table_changes, with_digits,
)
from ..operators.registry import IDENTITY_FULL, Registry, TableShape
from ..operators.transactions import after_position, committed_only
from ..shared import shared_folder


def replica(
    log: DataFrame,
    snapshot: DataFrame,
    table: str,
    registry: Registry | None = None,
    start: Column | None = None,
    toast: str = merge.KEEP,
    profile: str = NATIVE,
    key: Sequence[str] | None = None,
) -> DataFrame:
    """Contents of a table: its snapshot with every committed change applied, in runs of versions that
    are matched in one way.

    ``start`` is the position of the snapshot; earlier changes are left out. ``key``
    overrides the replica identity, for a table whose primary key is known from the catalog. Net changes are
    written before they are merged, so Spark knows their size: few of them leave the table where it is.
    """
    registry = registry or Registry.load(log)
    shape = registry.shape(table)
    if key is not None:
        shape = with_key(shape, key)
    rows = committed_only(log)
    if start is not None:
        rows = after_position(rows, start)
    runs = [(shape.first_seq, None, shape)] if key is not None else registry.runs(shape)

    open_ = open_numerics(shape, profile)
    changes = None
    if open_:
        # The values tell the type, so they are read before they are merged: decode them once.
        changes = _stored(table_changes(decode_texts(rows, shape.relids), registry, shape, profile))
        found = digits_of_changes(changes, shape)
        for name, need in digits_of_rows(snapshot, shape).items():
            found[name] = found[name].with_(need)
        shape = with_digits(shape, found)
        changes = settled(changes, shape)
        runs = [(first, end, replace(run, columns=shape.columns)) for first, end, run in runs]

    base = conform(snapshot, shape, profile)
    for turn, (first, end, run) in enumerate(runs):
        if turn:
            # Every run reads what the one before left: compute it once.
            base = _stored(base)
        low = first if turn else None

        def typed(run: TableShape = run, low: int | None = low, end: int | None = end) -> DataFrame:
            source = rows if changes is None else changes
            if low is not None:
                source = source.where(F.col("seq") >= low)
            if end is not None:
                source = source.where(F.col("seq") < end)
            if changes is not None:
                return source
            return table_changes(decode_texts(source, run.relids), registry, run, profile)

        base = _applied(typed, base, run, toast)
    return base


def _stored(rows: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read back."""
    path = shared_folder(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _applied(typed: Callable[[], DataFrame], base: DataFrame, shape: TableShape, toast: str) -> DataFrame:
    """The table after changes that are all matched in the way of ``shape``."""
    if shape.identity == IDENTITY_FULL:
        # Copies are read twice when they are written out: the sums are computed once.
        return bag.expand(_stored(
            bag.apply_weights(bag.counted(base, shape), bag.row_weights(typed(), shape), shape)
        ))
    if not shape.key:
        return base.unionByName(typed().where(F.col("op") == wire.INSERT).select("new.*"))

    net = _stored(merge.net_changes(merge.keyed_events(typed(), shape), shape, toast))
    linked = merge.linked(net, shape)
    if linked is not None and not net.where(linked).isEmpty():
        # Some row changed its key and left a value out: it is found among the events, which are read several times.
        events = _stored(merge.keyed_events(typed(), shape))
        net = _stored(links.resolve_links(net, events, base, shape))
    return merge.merge_stored(base, net, shape)


def with_key(shape: TableShape, key: Sequence[str]) -> TableShape:
    """The same table matched by other key columns."""
    return TableShape(
        shape.name, shape.columns, list(key), "d", shape.relids, shape.versions, shape.first_seq, shape.end_seq
    )
