"""Relation messages as a table of versions, and binding changes to them."""
from __future__ import annotations

from dataclasses import dataclass, replace

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import names, wire
from ..functions.pgtypes import SourceColumn, widest
from ..shared import shared_folder
from .decode import with_header

COLUMNS = "array<struct<name:string,oid:int,typmod:int,is_key:boolean>>"
VERSIONS = (
    "relid bigint, from_seq bigint, to_seq bigint, schema_name string, table_name string, "
    f"identity string, columns {COLUMNS}, err string"
)
END = 2**63 - 1

# Places of the log per span, as a power of two, when a long ordered group is
# reduced in two steps.
SPAN_BITS = 20

# Replica identities.
IDENTITY_NONE, IDENTITY_FULL = "n", "f"


def relation_runs(log: DataFrame, span_bits: int = SPAN_BITS) -> DataFrame:
    """Change points of every relation's definition.

    The source repeats a definition in every session. Repeats are dropped on the raw
    text, first inside spans of the log and then across them, so no task sorts
    all messages of a relation that is announced very often.
    """
    found = with_header(log.where(wire.is_type(F.col("data"), wire.RELATION)))
    found = found.where(wire.header_error(F.col("data")).isNull()).select("relid", "seq", "data")

    def changed(window) -> Column:
        return ~F.coalesce(F.lag("data").over(window) == F.col("data"), F.lit(False))

    near = Window.partitionBy("relid", F.shiftright("seq", span_bits)).orderBy("seq")
    far = Window.partitionBy("relid").orderBy("seq")
    points = found.withColumn("_new", changed(near)).where("_new")
    points = points.withColumn("_new", changed(far)).where("_new")
    following = F.coalesce(F.lead("seq").over(far), F.lit(END))
    return points.select("relid", F.col("seq").alias("from_seq"), following.alias("to_seq"), "data")


_HEAD = r"(?s)^R.{4}([^\x00]*)\x00([^\x00]*)\x00(.)(..)"
_EACH = r"(?s)(.[^\x00]*\x00.{8})"


def parse_relations(runs: DataFrame) -> DataFrame:
    """Read the definitions, with one character per byte; one row per version, ``err`` set when unreadable."""
    text = F.decode(wire.body(F.col("data")), "ISO-8859-1")
    rows = runs.select("relid", "from_seq", "to_seq", text.alias("t"))

    def raw(part: Column) -> Column:
        return F.encode(part, "ISO-8859-1")

    def signed(part: Column, bits: int) -> Column:
        number = F.conv(F.hex(raw(part)), 16, 10).cast("bigint")
        return F.when(number >= 1 << bits - 1, number - (1 << bits)).otherwise(number).cast("int")

    def column(part: Column) -> Column:
        n = F.length(part)
        return F.struct(
            raw(F.substring(part, F.lit(2), n - 10)).alias("name"), signed(F.substring(part, n - 7, F.lit(4)), 32).alias("oid"),
            signed(F.substring(part, n - 3, F.lit(4)), 32).alias("typmod"), (F.ascii(part) == 1).alias("is_key"))

    def head(k: int) -> Column:
        return F.regexp_extract("t", _HEAD, k)

    each = F.regexp_extract_all(F.regexp_replace("t", _HEAD, ""), F.lit(_EACH), F.lit(1))
    rows = rows.select(
        "relid", "from_seq", "to_seq", F.col("t").rlike(_HEAD).alias("whole"), raw(head(1)).alias("schema_name"),
        raw(head(2)).alias("table_name"), head(3).alias("identity"), F.greatest(signed(head(4), 16), F.lit(0)).alias("n"), each.alias("each"))
    rows = rows.withColumn("columns", F.transform(F.slice("each", F.lit(1), F.col("n")), column))
    readable = F.col("whole") & (F.size("each") >= F.col("n")) & F.is_valid_utf8(F.col("schema_name").cast("string")) & F.is_valid_utf8(
        F.col("table_name").cast("string")) & F.forall("columns", lambda c: F.is_valid_utf8(c["name"].cast("string")))
    ok = F.coalesce(readable, F.lit(False))
    named = F.transform("columns", lambda c: c.withField("name", c["name"].cast("string")))
    return rows.select(
        "relid", "from_seq", "to_seq",
        *[F.when(ok, F.col(c).cast("string")).alias(c) for c in ("schema_name", "table_name", "identity")],
        F.when(ok, named).alias("columns"), F.when(~ok, "bad_relation").alias("err"))


def changed_runs(runs: DataFrame, known: DataFrame) -> DataFrame:
    """Runs (as ``relation_runs`` gives them) of the relations of which they say anything that is not in force at the end of
    ``known``, a log of relation messages."""
    last = with_header(known).groupBy("relid").agg(F.max_by("data", "seq").alias("_last"))
    said = runs.join(last, "relid", "left").groupBy("relid").agg(
        F.bool_or(~F.col("data").eqNullSafe(F.col("_last"))).alias("new")).where("new")
    return runs.join(said, "relid", "left_semi")


@dataclass(frozen=True)
class TableShape:
    """Union of a table's column lists over its versions: by name, in the widest of its types."""

    name: str
    columns: list[SourceColumn]
    key: list[str]
    identity: str
    relids: list[int]
    versions: int
    first_seq: int
    end_seq: int | None = None  # from here on the relation has another name


class Registry:
    """All relation versions of a log: a table of definitions that is written once and joined like any other.

    Only the definitions of a table that is asked for reach the driver, where they are needed to name and type its columns.
    """

    def __init__(self, versions: DataFrame):
        named = names.qualify(F.col("schema_name"), F.col("table_name"))
        versions = versions.withColumn("name", named)
        self.versions = versions.where(F.col("err").isNull()).drop("err")
        self.damaged = versions.where(F.col("err").isNotNull()).select("relid", "from_seq", "err")
        self._known: dict[str, list[dict]] = {}
        self._effective: DataFrame | None = None

    @classmethod
    def load(cls, log: DataFrame) -> "Registry":
        """Read the relation messages of a log once."""
        return cls(_written(parse_relations(relation_runs(log))))

    def published(self, tables: list[str]) -> DataFrame:
        """Versions of the listed tables only."""
        return self.versions.where(F.col("name").isin([names.normalize_text(t) for t in tables]))

    def publishes(self, table: str) -> bool:
        """Whether the log ever announced a table."""
        return not self.published([table]).isEmpty()

    def replicated(self) -> DataFrame:
        """Versions whose changes can be matched: identity ``n`` is left out."""
        return self.versions.where(F.col("identity") != IDENTITY_NONE)

    def table_names(self) -> list[str]:
        return sorted(r.name for r in self.replicated().select("name").distinct().collect())

    def effective(self) -> DataFrame:
        """All versions with their columns in the types their table has over all versions: what a change's
        values must fit. A relation that is not replicated keeps its own types. The versions of a table meet in one task."""
        if self._effective is None:
            fields = "relid bigint, from_seq bigint, to_seq bigint, schema_name string, table_name string, " \
                f"identity string, columns {COLUMNS}"
            counted = self.versions.withColumn("_n", F.count(F.lit(1)).over(Window.partitionBy("name")))
            several = counted.where("_n > 1").drop("_n").groupBy("name").applyInArrow(_widen_versions, fields)
            alone = counted.where("_n = 1").select(*several.columns)
            self._effective = _written(alone.unionByName(several))
        return self._effective

    def shapes(self, changes: DataFrame) -> list[TableShape]:
        """Replicated tables that ever had one of the relation ids (``relid``) of some rows; one job."""
        hit = self.replicated().join(changes.select("relid").distinct(), "relid", "left_semi").select("name").distinct()
        found: dict[str, list[dict]] = {}
        for r in self.versions.join(hit, "name", "left_semi").collect():
            found.setdefault(r["name"], []).append(r.asDict(recursive=True))
        self._known |= {name: sorted(rows, key=_place) for name, rows in found.items()}
        return [self.shape(name) for name in sorted(found)]

    def _of(self, name: str) -> list[dict]:
        if name not in self._known:
            rows = self.versions.where(F.col("name") == name).collect()
            self._known[name] = sorted((r.asDict(recursive=True) for r in rows), key=_place)
        return self._known[name]

    def shape(self, table: str) -> TableShape:
        """Columns, key and relation ids of a table; reads its definitions only."""
        name = names.normalize_text(table)
        facts = _facts(self._of(name))
        if facts is None:
            raise ValueError(f"no relation message for table {name}")
        return TableShape(name, *facts)

    def runs(self, shape: TableShape) -> list[tuple[int, int | None, TableShape]]:
        """(from_seq, to_seq, shape) of the stretches of the log in which a table is matched in one way: full rows,
        one key, or none. Versions of identity ``n`` lie inside or between them; their changes are skipped."""
        found: list[tuple[int, str, list[str]]] = []
        for v in self._of(shape.name):
            identity, key = v["identity"], [c["name"] for c in v["columns"] if c["is_key"]]
            if identity == IDENTITY_NONE:
                continue
            full = identity == IDENTITY_FULL
            if not found or (found[-1][1] == IDENTITY_FULL) != full or not full and found[-1][2] != key:
                found.append((v["from_seq"], identity, key))
        ends = [seq for seq, *_ in found[1:]] + [None]
        return [(seq, end, replace(shape, identity=identity, key=key)) for (seq, identity, key), end in zip(found, ends)]


def _place(version: dict) -> int:
    return version["from_seq"]


def _written(rows: DataFrame) -> DataFrame:
    path = shared_folder(rows.sparkSession)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _widened(columns: list[dict], shape: "TableShape | None") -> list[dict]:
    wide = {c.name: c for c in shape.columns} if shape else {}
    return [{**c, "oid": wide[c["name"]].oid, "typmod": wide[c["name"]].typmod} if c["name"] in wide else c for c in columns]


def _widen_versions(versions: pa.Table) -> pa.Table:
    names_of = ["relid", "from_seq", "to_seq", "schema_name", "table_name", "identity", "columns"]
    versions = versions.select(names_of)
    rows = sorted(versions.to_pylist(), key=lambda v: v["from_seq"])
    facts = _facts([v for v in rows if v["identity"] != IDENTITY_NONE])
    shape = TableShape("", *facts) if facts else None
    for v in rows:
        v["columns"] = _widened(v["columns"], shape)
    return pa.Table.from_pylist(rows, versions.schema)


def _facts(versions: list[dict]) -> tuple | None:
    if not versions:
        return None
    union: dict[str, SourceColumn] = {}
    for version in versions:
        for c in version["columns"]:
            column = SourceColumn(**c)
            union[c["name"]] = widest(union.get(c["name"], column), column)
    last = versions[-1]
    return (
        list(union.values()), [c["name"] for c in last["columns"] if c["is_key"]], last["identity"],
        sorted({v["relid"] for v in versions}), len(versions), versions[0]["from_seq"],
        max(v["to_seq"] for v in versions),
    )


def merge_columns(versions: DataFrame) -> DataFrame:
    """Schema union per table: every column name once, with its first type."""
    each = versions.select("name", "from_seq", F.posexplode("columns").alias("pos", "col"))
    first = F.min_by(F.struct("from_seq", "pos", "col"), F.struct("from_seq", "pos"))
    merged = each.groupBy(F.col("name").alias("table"), "col.name").agg(first.alias("f"))
    return merged.select(
        "table", "name", "f.from_seq", "f.pos", "f.col.oid", "f.col.typmod", "f.col.is_key"
    )


def column_report(registry: Registry, types: DataFrame) -> DataFrame:
    """(table, pos, column_name, oid, typmod, and the columns of ``types``) of all replicated tables: the union of each
    table's columns, in the order of their first appearance, joined to a table of types by type number."""
    each = registry.effective().where(F.col("identity") != IDENTITY_NONE).select(
        names.qualify(F.col("schema_name"), F.col("table_name")).alias("table"), "from_seq", F.posexplode("columns").alias("at", "c"))
    place = F.struct("from_seq", "at")
    found = each.groupBy("table", F.col("c.name").alias("column_name")).agg(
        F.min(place).alias("place"), F.first("c.oid").alias("oid"), F.first("c.typmod").alias("typmod"))
    in_table = Window.partitionBy("table").orderBy("place")  # columns of one table
    return found.withColumn("pos", F.row_number().over(in_table) - 1).drop("place").join(F.broadcast(types), "oid", "left")


def key_positions(versions: DataFrame, keys: DataFrame | None = None) -> DataFrame:
    """Key columns of every version with their positions in table order.

    Without ``keys`` the key mark of the relation message decides; with it
    (``name``, ``column_name``) the catalog does.
    """
    each = versions.select(
        "relid", "name", "from_seq", F.posexplode("columns").alias("position", "col")
    ).select("relid", "name", "from_seq", "position", F.col("col.name").alias("column_name"), "col.is_key")
    if keys is None:
        return each.where("is_key").drop("is_key")
    return each.drop("is_key").join(keys, ["name", "column_name"], "left_semi")


def primary_keys(
    constraints: DataFrame, usage: DataFrame, tables: DataFrame | None = None
) -> DataFrame:
    """Primary-key columns from the catalog's constraint and key-column tables.

    Joined on constraint schema, name and table: equal constraint names
    elsewhere do not leak in. ``tables`` (``table_schema``, ``table_name``) restricts the answer.
    """
    wanted = constraints.where(F.col("constraint_type") == "PRIMARY KEY")
    if tables is not None:
        wanted = wanted.join(tables, ["table_schema", "table_name"], "left_semi")
    on = ["constraint_schema", "constraint_name", "table_schema", "table_name"]
    return (
        wanted.select(*on)
        .join(usage.select(*on, "column_name"), on)
        .select("table_schema", "table_name", "column_name")
        .distinct()
    )


def bind(changes: DataFrame, versions: DataFrame, how: str = "inner") -> DataFrame:
    """Join every change with the relation version in force at its position.

    An equality of relation ids and a range: Spark sends the definitions to the changes when it finds them small, and
    else splits a relation with very many changes by itself.
    """
    right = versions.select([F.col(c).alias(f"_v_{c}") for c in versions.columns])
    inside = (
        (F.col("relid") == F.col("_v_relid"))
        & (F.col("seq") >= F.col("_v_from_seq"))
        & (F.col("seq") < F.col("_v_to_seq"))
    )
    return changes.join(right, inside, how).drop("_v_relid", "_v_from_seq", "_v_to_seq")


def published_rows(log: DataFrame, registry: Registry, tables: list[str]) -> DataFrame:
    """Log rows of the listed tables, with their table name; decided on headers alone."""
    rows = with_header(log).where(F.col("op").isin(*wire.CHANGES))
    versions = registry.published(tables).select("relid", "from_seq", "to_seq", "name")
    return bind(rows, versions).withColumnRenamed("_v_name", "table")


def replicated_rows(log: DataFrame, registry: Registry) -> DataFrame:
    """Changes without those of relations that have no replica identity in force."""
    rows = with_header(log).where(F.col("op").isin(*wire.CHANGES))
    versions = registry.versions.where(F.col("identity") == IDENTITY_NONE)
    skipped = bind(rows, versions.select("relid", "from_seq", "to_seq"), how="left_anti")
    return skipped
