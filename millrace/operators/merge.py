"""Keyed replicas: net effect per key, merged into the table."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import wire
from .registry import TableShape

KEEP, NULL = "keep", "null"


def key_columns(shape: TableShape) -> list[str]:
    """Names under which key values travel next to a row."""
    return [f"_k_{k}" for k in shape.key]


def held_columns(shape: TableShape, toast: str = KEEP) -> list[int]:
    """Columns that carry a value of their own because updates may leave them out."""
    return [i for i, c in enumerate(shape.columns) if toast == KEEP and c.may_be_unchanged]


def keyed_events(changes: DataFrame, shape: TableShape) -> DataFrame:
    """One row per effect on a key: key columns, ``ord``, ``live``, ``doc``.

    A change of key is a tombstone for the old key and a live row for the new
    one; ``ord`` puts the tombstone first. An update matches by its old tuple
    when it has one and by the key of the new row otherwise. ``from_key`` is the key a moved
    row had before. Changes whose key does not fit its type have no effect; they are set
    aside as bad values.
    """
    if not shape.key:
        raise ValueError(f"{shape.name} has no key; use the bag operators")

    def key_of(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{k}").alias(k) for k in shape.key])

    old, new = key_of("old"), key_of("new")
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    moved = has_old & has_new & ~old.eqNullSafe(new)

    def effect(which: Column, live: bool) -> Column:
        return F.struct(which.alias("key"), F.lit(live).alias("live"))

    effects = (
        F.when(moved, F.array(effect(old, False), effect(new, True)))
        .when(has_new, F.array(effect(new, True)))
        .otherwise(F.array(effect(old, False)))
    )
    rows = changes.select(
        "seq", "op", "new", "unchanged",
        F.when(moved, old).alias("from_key"), F.explode(effects).alias("e"),
    )
    for k in shape.key:
        rows = rows.where(F.col(f"e.key.{k}").isNotNull())
    live = F.col("e.live")
    complete = F.array(*[F.lit(False)] * len(shape.columns))
    return rows.select(
        *[F.col(f"e.key.{k}").alias(name) for k, name in zip(shape.key, key_columns(shape))],
        (F.col("seq") * 2 + live.cast("int")).alias("ord"),
        live.alias("live"),
        F.when(live, F.col("new")).alias("doc"),
        F.when(live & (F.col("op") == wire.UPDATE), F.col("unchanged"))
        .otherwise(complete)
        .alias("unchanged"),
        F.when(live, F.col("from_key")).alias("from_key"),
    )


def matched(base: DataFrame, changes: DataFrame, shape: TableShape) -> DataFrame:
    """Rows of the table that updates and deletes refer to.

    The old tuple's key is compared when there is one, else the key of the new row; both sides are typed.
    """
    wanted = changes.where(F.col("op") != wire.INSERT)
    keys = [
        F.when(F.col("old").isNotNull(), F.col(f"old.{k}")).otherwise(F.col(f"new.{k}")).alias(n)
        for k, n in zip(shape.key, key_columns(shape))
    ]
    hits = wanted.select("seq", "op", *keys).join(base, _same_key(shape, ""))
    return hits.drop(*key_columns(shape))


def held_value(shape: TableShape, index: int) -> Column:
    """What an event says about a column: its value, a link to the row it was moved from, or nothing.

    The struct tells a real null from "no value here".
    """
    left_out = F.get("unchanged", F.lit(index))
    link = F.when(left_out & F.col("from_key").isNotNull(), F.col("ord"))
    value = F.struct(F.col(f"doc.{shape.columns[index].name}").alias("v"), link.alias("link"))
    return F.when(~left_out | link.isNotNull(), value)


def net_changes(events: DataFrame, shape: TableShape, toast: str = KEEP) -> DataFrame:
    """Last writer wins per key, reduced before the shuffle.

    With ``toast="keep"`` every column that may arrive as unchanged carries its
    own last real value in ``c_<i>``; null there means the table's value stays.
    """
    held = held_columns(shape, toast)
    plain = [c.name for i, c in enumerate(shape.columns) if i not in held]
    last = F.struct("live", *[F.col(f"doc.{name}").alias(name) for name in plain])
    outputs = [F.max_by(last, F.col("ord")).alias("last")]
    for i in held:
        value = held_value(shape, i)
        outputs.append(F.max_by(value, F.when(value.isNotNull(), F.col("ord"))).alias(f"c_{i}"))
    return events.groupBy(*key_columns(shape)).agg(*outputs)


def merged_column(shape: TableShape, index: int, net: DataFrame, base: Column) -> Column:
    """Value of a column after the merge; ``base`` is what the table held."""
    if f"c_{index}" not in net.columns:
        return F.col(f"last.{shape.columns[index].name}")
    return F.when(F.col(f"c_{index}").isNull(), base).otherwise(F.col(f"c_{index}.v"))


def live_rows(net: DataFrame, shape: TableShape) -> DataFrame:
    """Rows the changes leave behind, as far as the changes alone tell."""
    return net.where("last.live").select(
        *[
            merged_column(shape, i, net, F.lit(None)).alias(c.name)
            for i, c in enumerate(shape.columns)
        ]
    )


def _same_key(shape: TableShape, side: str) -> list[Column]:
    return [F.col(f"{side}{k}") == F.col(n) for k, n in zip(shape.key, key_columns(shape))]


def linked(net: DataFrame, shape: TableShape) -> Column | None:
    """Whether a live key lacks a value that lies under a key its row had before; None when no column can."""
    places = [F.col(f"c_{i}.link") for i in held_columns(shape) if f"c_{i}" in net.columns]
    return F.col("last.live") & F.coalesce(*places).isNotNull() if places else None


def merge_stored(base: DataFrame, net: DataFrame, shape: TableShape) -> DataFrame:
    """Apply net changes that lie in a written table, which is read more than once.

    Rows no change touches pass through; when Spark finds the changes small
    enough to broadcast, the table is not shuffled at all.
    """
    names = [c.name for c in shape.columns]
    keys = net.select(*key_columns(shape))
    survivors = base.join(keys, _same_key(shape, ""), "left_anti").select(*names)
    missing = F.lit(False)
    for i in held_columns(shape):
        if f"c_{i}" in net.columns:
            missing = missing | F.col(f"c_{i}").isNull()
    live = net.where("last.live")
    partial = live.where(missing)
    before = base.join(
        partial.select(*key_columns(shape)), _same_key(shape, ""), "left_semi"
    ).select(F.struct(*names).alias("b"))
    filled = partial.join(before, _same_key(shape, "b."), "left").select(
        *[merged_column(shape, i, net, F.col(f"b.{n}")).alias(n) for i, n in enumerate(names)]
    )
    whole = live_rows(net.where(~missing), shape)
    return survivors.unionByName(whole).unionByName(filled)
