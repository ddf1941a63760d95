"""Typed rows from decoded tuples."""
from __future__ import annotations

from collections.abc import Sequence
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.pgtypes import (
    ARRAYS, MOST_DIGITS, NATIVE, Digits, SourceColumn, array_items, cast_text, digit_counts, most_digits,
    open_numeric, schema_of,
)
from .decode import KIND_UNCHANGED, value_kind, value_text
from .registry import Registry, TableShape, bind


def table_changes(
    decoded: DataFrame,
    registry: Registry,
    shape: TableShape,
    profile: str = NATIVE,
) -> DataFrame:
    """Changes of one table with typed ``old`` and ``new`` structs.

    ``unchanged`` tells per column whether the new tuple left it out as
    unchanged; ``bad`` names columns whose text does not fit the type (their value is
    null). Both cost nothing when not selected.
    """
    apart = "kinds" in decoded.columns  # as ``decode_texts`` gives them
    rows = decoded.where(F.col("relid").isin(*shape.relids)).where("err is null")
    if shape.versions == 1:
        rows = rows.where(F.col("seq") >= shape.first_seq)
        if shape.end_seq is not None:
            rows = rows.where(F.col("seq") < shape.end_seq)
        slots: list[Column | int] = list(range(len(shape.columns)))
    else:
        order = F.array(*[F.lit(c.name) for c in shape.columns])
        mine = registry.replicated().where(F.col("name") == shape.name).select(
            "relid", "from_seq", "to_seq",
            F.transform(
                order, lambda name: (F.array_position(F.col("columns.name"), name) - 1).cast("int")
            ).alias("slots"),
        )
        rows = bind(rows, mine)
        slots = [F.get(F.col("_v_slots"), F.lit(i)) for i in range(len(shape.columns))]

    def text_of(values: str, slot: Column | int) -> Column:
        if not apart:
            return value_text(F.col(values), slot)
        return F.get(F.col(values), F.lit(slot) if isinstance(slot, int) else slot)

    def kind_of(slot: Column | int) -> Column:
        if not apart:
            return value_kind(F.col("new"), slot)
        return F.get(F.col("kinds"), F.lit(slot) if isinstance(slot, int) else slot)

    def typed(values: str) -> Column:
        fields = [
            cast_text(text_of(values, slot), c, profile).alias(c.name)
            for c, slot in zip(shape.columns, slots)
        ]
        return F.when(F.col(values).isNotNull(), F.struct(*fields))

    def misfit(values: str, c: SourceColumn, slot: Column | int) -> Column:
        text = text_of(values, slot)
        return F.when(text.isNotNull() & ~_fits(text, c, profile), F.lit(c.name))

    sent = F.when(F.col("new").isNotNull(), F.lit("new")).otherwise(F.lit("old"))
    bad = F.array_compact(
        F.when(sent == "new", F.array(*[misfit("new", c, s) for c, s in zip(shape.columns, slots)]))
        .otherwise(F.array(*[misfit("old", c, s) for c, s in zip(shape.columns, slots)]))
    )
    unchanged = F.array(
        *[
            F.coalesce(kind_of(slot) == KIND_UNCHANGED, F.lit(False))
            for slot in slots
        ]
    )
    return rows.select(
        *[c for c in decoded.columns if c not in ("relid", "old", "new", "kinds", "err")],
        typed("old").alias("old"), typed("new").alias("new"),
        unchanged.alias("unchanged"), bad.alias("bad"),
    )


def _fits(text: Column, column: SourceColumn, profile: str) -> Column:
    value = cast_text(text, column, profile)
    if column.type_name.endswith("[]"):
        lost = F.exists(
            F.arrays_zip(array_items(text).alias("t"), value.alias("v")),
            lambda pair: pair["t"].isNotNull() & pair["v"].isNull(),
        )
        return value.isNotNull() & ~lost
    return value.isNotNull()


# Numerics without a modifier: their values tell which type holds them


def open_numerics(shape: TableShape, profile: str = NATIVE) -> list[SourceColumn]:
    return [c for c in shape.columns if profile == NATIVE and c.is_open_numeric]


def with_digits(shape: TableShape, found: dict[str, Digits]) -> TableShape:
    return replace(shape, columns=[replace(c, digits=found.get(c.name, c.digits)) for c in shape.columns])


def _needs(rows: DataFrame, counts: dict[str, list[Column]]) -> dict[str, Digits]:
    """Most digits per name; several columns may count for a name. One row comes back."""
    if not counts:
        return {}
    each = rows.select(*[most_digits(F.array(*found)).alias(f"d{i}") for i, found in enumerate(counts.values())])
    most = [F.max(f"d{i}.{n}").alias(f"{n}{i}") for i in range(len(counts)) for n in Digits._fields]
    row = each.agg(*most).first()
    return {
        name: Digits(row[f"whole{i}"] or 0, row[f"fraction{i}"] or 0, bool(row[f"not_finite{i}"]))
        for i, name in enumerate(counts)
    }


def digits_of_changes(changes: DataFrame, shape: TableShape) -> dict[str, Digits]:
    """Digits that the open numerics of typed changes need; ``changes`` hold them as text."""
    counts = {}
    for c in open_numerics(shape):
        one = SourceColumn("", ARRAYS.get(c.oid, c.oid))
        counts[c.name] = [
            _digits_of_texts(F.col(f"{side}.{c.name}"), one) if c.oid in ARRAYS else digit_counts(F.col(f"{side}.{c.name}"), one)
            for side in ("old", "new")
        ]
    return _needs(changes, counts)


def _digits_of_texts(items: Column, one: SourceColumn) -> Column:
    return most_digits(F.transform(items, lambda item: digit_counts(item, one)))


def digits_of_rows(rows: DataFrame, shape: TableShape) -> dict[str, Digits]:
    """The same for rows as a snapshot holds them. Whole numbers and decimals tell by their type."""
    known, counts = {}, {}
    types = {f.name: f.dataType for f in rows.schema.fields}
    for c in open_numerics(shape):
        kind = types.get(c.name)
        if kind is None:
            continue
        if isinstance(kind, T.DecimalType) and kind.precision < MOST_DIGITS:
            known[c.name] = Digits(kind.precision - kind.scale, kind.scale)
        elif isinstance(kind, T.IntegralType):
            known[c.name] = Digits(19, 0)
        elif isinstance(kind, T.ArrayType):
            one = SourceColumn("", ARRAYS.get(c.oid, c.oid))
            counts[c.name] = [_digits_of_texts(F.transform(c.name, lambda v: _plain_text(v, kind.elementType)), one)]
        else:
            counts[c.name] = [digit_counts(_plain_text(F.col(c.name), kind), c)]
    return {**known, **_needs(rows, counts)}


def _plain_text(value: Column, kind: T.DataType) -> Column:
    """Text of a number, without an exponent as far as a decimal can hold it."""
    if isinstance(kind, T.FractionalType) and not isinstance(kind, T.DecimalType):
        return F.coalesce(value.cast("string").try_cast("decimal(38,18)").cast("string"), value.cast("string"))
    return value.cast("string")


def settled(changes: DataFrame, shape: TableShape) -> DataFrame:
    """Typed changes whose open numerics are still text, in the types that ``shape`` gives them."""
    targets = {c.name: c.spark_type() for c in open_numerics(shape)}
    if not targets:
        return changes

    def side(name: str) -> Column:
        fields = [
            F.col(f"{name}.{c.name}").try_cast(targets[c.name]).alias(c.name) if c.name in targets else F.col(f"{name}.{c.name}")
            for c in shape.columns
        ]
        return F.when(F.col(name).isNotNull(), F.struct(*fields)).alias(name)

    return changes.select(*[side(c) if c in ("old", "new") else c for c in changes.columns])


def change_feed(changes: DataFrame, shape: TableShape) -> DataFrame:
    """``seq, op``, the old key and the new columns of every change, flat."""
    return changes.select(
        "seq", "op",
        *[F.col(f"old.{k}").alias(f"old_{k}") for k in shape.key],
        *[F.col(f"new.{c.name}").alias(c.name) for c in shape.columns],
    )


def conform(
    rows: DataFrame, shape: TableShape, profile: str = NATIVE, keep: Sequence[str] = ()
) -> DataFrame:
    """Snapshot rows in the table's types and column order; missing columns are null.

    A value that does not fit becomes null; ``snapshot_misfits`` lists those rows. ``keep``
    names further columns to pass along.
    """
    return rows.select(*[v.alias(n) for n, v in _conformed(rows, shape, profile).items()], *keep)


def _conformed(rows: DataFrame, shape: TableShape, profile: str) -> dict[str, Column]:
    have = {f.name: f.dataType for f in rows.schema.fields}
    open_ = {c.name for c in open_numerics(shape, profile)}

    def value(name: str, kind: T.DataType) -> Column:
        if name not in have:
            return F.lit(None).cast(kind)
        if name not in open_ or have[name] == kind and not isinstance(kind, T.StringType):
            return F.col(name).try_cast(kind)
        if isinstance(kind, T.ArrayType) and isinstance(have[name], T.ArrayType):
            item = have[name].elementType
            return F.transform(name, lambda v: open_numeric(_plain_text(v, item), kind.elementType))
        return open_numeric(_plain_text(F.col(name), have[name]), kind)

    return {f.name: value(f.name, f.dataType) for f in schema_of(shape.columns, profile).fields}


def snapshot_misfits(rows: DataFrame, shape: TableShape, profile: str = NATIVE) -> DataFrame:
    """Snapshot rows with values that do not fit the table's types: ``reason``, ``bad`` (names of
    the columns) and ``data`` (the row as JSON). One scan, no shuffle."""
    bad = F.array_compact(F.array(*[
        F.when(F.col(n).isNotNull() & value.isNull(), F.lit(n))
        for n, value in _conformed(rows, shape, profile).items() if n in rows.columns
    ]))
    marked = rows.select(F.struct(*[F.col(c) for c in rows.columns]).alias("row"), bad.alias("bad"))
    return marked.where(F.size("bad") > 0).select(
        F.lit("bad_value").alias("reason"), "bad", F.to_json("row").alias("data"))


def union_rows(frames: list[DataFrame]) -> DataFrame:
    """Union by name over differing column sets; a column keeps the type it has first."""
    types: dict = {}
    for frame in frames:
        for field in frame.schema.fields:
            types.setdefault(field.name, field.dataType)
    cast = [f.select(*[F.col(c).try_cast(types[c]).alias(c) for c in f.columns]) for f in frames]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), cast)
