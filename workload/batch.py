"""Registered batch queries: one per operator, each over whole tables."""
from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.functions import names, pgtypes, wire
from millrace.functions.pgtypes import NARROW, SourceColumn
from millrace.functions.positions import position_number
from millrace.operators import bag, merge, registry as reg, report, transactions as txn
from millrace.operators.decode import (
    KIND_NULL, decode_changes, value_kind, value_text, with_header,
)
from millrace.operators.project import change_feed, conform, table_changes, union_rows
from millrace.operators.registry import Registry
from millrace.plans.replicate import replica
from millrace.shared import shared_folder
from millrace.sources import encoder as enc
from millrace.sources.changelog import read_log
from millrace.sources.snapshot import read_snapshot, read_snapshots

from . import logs

QUERIES: dict = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def _typed_orders(log: DataFrame, **options) -> tuple[DataFrame, reg.TableShape]:
    log = logs.landed(log)
    registry = Registry.load(log)
    shape = registry.shape("orders")
    return table_changes(decode_changes(log, shape.relids, **options), registry, shape), shape


def _inserted(log: DataFrame, table: str, profile: str = pgtypes.NATIVE) -> DataFrame:
    log = logs.landed(log)
    registry = Registry.load(log)
    shape = registry.shape(table)
    return table_changes(decode_changes(log, shape.relids), registry, shape, profile).select("new.*")


def _bigint(name: str) -> Column:
    return F.col(name).cast("bigint").alias(name)


# Scans


@query
def snapshot_scan(spark: SparkSession, sf: str) -> DataFrame:
    rows = read_snapshot(spark, "orders", f"{sf}/orders.parquet", position="1/0")
    return rows.withColumn("lsn_n", _bigint("lsn_n"))


@query
def snapshot_multi(spark: SparkSession, sf: str) -> DataFrame:
    keys = {"orders": "o_orderkey", "customer": "c_custkey", "nation": "n_nationkey"}
    found = read_snapshots(spark, {t: f"{sf}/{t}.parquet" for t in keys})
    parts = [
        found[f"public.{t}"].agg(
            F.lit(f"public.{t}").alias("table_name"),
            F.count("*").alias("n"),
            F.sum(F.col(k).cast("bigint")).alias("key_sum"),
        )
        for t, k in keys.items()
    ]
    return functools.reduce(DataFrame.unionByName, parts)


@query
def log_scan(spark: SparkSession, sf: str) -> DataFrame:
    path = shared_folder(spark)
    logs.orders_log(spark, sf).repartitionByRange("seq").write.parquet(path)
    rows = read_log(spark, path)
    return rows.select("seq", wire.message_type(F.col("data")).alias("op"))


@query
def bounded_poll(spark: SparkSession, sf: str) -> DataFrame:
    rows = txn.bounded_poll(logs.landed(logs.orders_log(spark, sf)), 500)
    return rows.select("seq", wire.message_type(F.col("data")).alias("op"))


@query
def publication_filter(spark: SparkSession, sf: str) -> DataFrame:
    log = logs.landed(logs.combined_log(spark, sf))
    rows = reg.published_rows(log, Registry.load(log), ["orders", "public.customer"])
    return rows.select("seq", "op", "table")


@query
def skip_identity(spark: SparkSession, sf: str) -> DataFrame:
    log = logs.landed(logs.combined_log(spark, sf))
    return reg.replicated_rows(log, Registry.load(log)).select("seq", "op", "relid")


# Decoding


@query
def decode_header(spark: SparkSession, sf: str) -> DataFrame:
    log = logs.landed(logs.orders_log(spark, sf))
    rows = with_header(log).where(~F.col("op").isin(wire.BEGIN, wire.COMMIT))
    ends = txn.transaction_bounds(log).select(
        "seq", "op", _bigint("commit_lsn"), _bigint("end_lsn"), "commit_time", _bigint("xid")
    )
    return rows.select("seq", "op", "relid").unionByName(ends, allowMissingColumns=True)


@query
def message_type_counts(spark: SparkSession, sf: str) -> DataFrame:
    return report.operation_counts(logs.orders_log(spark, sf))


@query
def decode_insert(spark: SparkSession, sf: str) -> DataFrame:
    rows = decode_changes(logs.orders_log(spark, sf), keep=F.col("op") == wire.INSERT)
    return rows.select(
        "seq", "relid", F.size("new").alias("n_values"),
        *[value_text(F.col("new"), i).alias(f"v{i}") for i in (0, 1, 2, 5)],
    )


@query
def decode_update(spark: SparkSession, sf: str) -> DataFrame:
    rows = decode_changes(logs.orders_log(spark, sf), keep=F.col("op") == wire.UPDATE)
    return rows.select(
        "seq", "tag", value_text(F.col("old"), 0).alias("old_key"),
        value_text(F.col("new"), 0).alias("new_key"), value_text(F.col("new"), 2).alias("status"),
    )


@query
def decode_delete(spark: SparkSession, sf: str) -> DataFrame:
    rows = decode_changes(logs.orders_log(spark, sf), keep=F.col("op") == wire.DELETE)
    nulls = F.size(F.filter("old", lambda v: v["k"] == KIND_NULL))
    return rows.select(
        "seq", "tag", value_text(F.col("old"), 0).alias("old_key"), nulls.alias("nulls"),
        F.col("new").isNull().alias("no_new"),
    )


@query
def relation_registry(spark: SparkSession, sf: str) -> DataFrame:
    versions = Registry.load(logs.combined_log(spark, sf)).versions
    return versions.select(
        "relid", "from_seq", "name", "identity", F.posexplode("columns").alias("pos", "c")
    ).select(
        "relid", "from_seq", "name", "identity", "pos",
        F.col("c.name").alias("column_name"), "c.oid", "c.typmod", "c.is_key",
    )


@query
def txn_summary(spark: SparkSession, sf: str) -> DataFrame:
    return report.transaction_summary(logs.orders_log(spark, sf))


@query
def committed_only(spark: SparkSession, sf: str) -> DataFrame:
    rows = txn.committed_only(logs.orders_log(spark, sf))
    return rows.select("seq", wire.message_type(F.col("data")).alias("op"))


@query
def quarantine(spark: SparkSession, sf: str) -> DataFrame:
    log = logs.landed(logs.orders_log(spark, sf, damaged=True))
    rows = report.quarantine(log, Registry.load(log))
    return rows.select("seq", "lsn", "reason", F.length("data").isNotNull().alias("has_data"))


@query
def error_counts(spark: SparkSession, sf: str) -> DataFrame:
    log = logs.landed(logs.orders_log(spark, sf, damaged=True))
    return report.error_counts(report.quarantine(log, Registry.load(log)))


@query
def lsn_order(spark: SparkSession, sf: str) -> DataFrame:
    rows = logs.orders_log(spark, sf)
    return rows.select("seq", "lsn", position_number(F.col("lsn")).cast("bigint").alias("lsn_n"))


@query
def lsn_progress(spark: SparkSession, sf: str) -> DataFrame:
    row = txn.progress(logs.orders_log(spark, sf))
    return row.select(*[_bigint(c) for c in row.columns])


@query
def op_counts(spark: SparkSession, sf: str) -> DataFrame:
    log = logs.landed(logs.combined_log(spark, sf))
    return report.operation_counts(log, Registry.load(log))


# Binding and typing


@query
def asof_binding(spark: SparkSession, sf: str) -> DataFrame:
    log = logs.landed(logs.customer_log(spark, sf))
    registry = Registry.load(log)
    versions = registry.versions.select("relid", "from_seq", "to_seq", F.size("columns").alias("width"))
    changes = with_header(log).where(F.col("op") == wire.INSERT)
    return reg.bind(changes, versions).select("seq", F.col("_v_width").alias("width"))


@query
def qualified_name(spark: SparkSession, sf: str) -> DataFrame:
    k = F.col("p_partkey")
    typed = F.when(k % 3 == 0, F.col("p_type")).when(
        k % 3 == 1, F.concat_ws(".", "p_brand", "p_name")
    ).otherwise(F.concat(F.lit("."), F.col("p_name")))
    rows = logs.table(spark, sf, "part").select("p_partkey", typed.alias("typed"))
    schema, table = names.name_parts(F.col("typed"))
    return rows.select(
        "p_partkey", schema.alias("schema_name"), table.alias("table_name"),
        names.normalize(F.col("typed")).alias("name"),
    )


@query
def typed_projection(spark: SparkSession, sf: str) -> DataFrame:
    changes, _ = _typed_orders(logs.orders_log(spark, sf), keep=F.col("op") == wire.INSERT)
    return changes.select("new.*")


@query
def snapshot_typed(spark: SparkSession, sf: str) -> DataFrame:
    shape = Registry.load(logs.customer_log(spark, sf)).shape("customer")
    rows = conform(logs.table(spark, sf, "customer"), shape)
    return rows.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query
def schema_report(spark: SparkSession, sf: str) -> DataFrame:
    """Per column: source type, document type and Spark type, for the tables of a log and one table per part."""
    log = logs.landed(logs.combined_log(spark, sf).unionByName(logs.catalog_log(spark, sf)))
    rows = reg.column_report(Registry.load(log), pgtypes.type_table(spark))
    return rows.select(
        F.col("table").alias("table_name"), "pos", "column_name", F.coalesce("source_type", F.lit("other")).alias("source_type"),
        "reported_type", pgtypes.spark_type_text(F.col("spark_type"), F.col("oid"), F.col("typmod")).alias("spark_type"))


@query
def cast_integers(spark: SparkSession, sf: str) -> DataFrame:
    columns = [
        SourceColumn("p_partkey", 20, is_key=True), SourceColumn("p_size", 21),
        SourceColumn("as_int4", 23), SourceColumn("too_wide", 21),
    ]
    k, size = F.col("p_partkey"), F.col("p_size")
    values = [enc.text_value(v) for v in (k, size, -k, size * 10_000)]
    log = logs.insert_log(logs.table(spark, sf, "part"), "p_partkey", logs.PART, "part", columns, values)
    return _inserted(log, "part").withColumns(
        {c: F.col(c).cast("int") for c in ("p_size", "too_wide")}
    )


@query
def narrow_profile(spark: SparkSession, sf: str) -> DataFrame:
    columns = [
        SourceColumn("p_partkey", 1043, is_key=True), SourceColumn("narrow", 20),
        SourceColumn("size8", 23), SourceColumn("price", 1700),
    ]
    values = [
        enc.text_value(F.col(c)) for c in ("p_partkey", "p_partkey", "p_size", "p_retailprice")
    ]
    log = logs.insert_log(logs.table(spark, sf, "part"), "p_partkey", logs.PART, "part", columns, values)
    return _inserted(log, "part", NARROW).withColumns(
        {c: F.col(c).cast("int") for c in ("narrow", "size8")}
    )


@query
def cast_floats(spark: SparkSession, sf: str) -> DataFrame:
    columns = [
        SourceColumn("c_custkey", 20, is_key=True), SourceColumn("single", 700),
        SourceColumn("whole", 701), SourceColumn("huge", 701),
    ]
    rows = logs.table(spark, sf, "customer")
    bal = F.col("c_acctbal")
    huge = F.when(F.col("c_custkey") % 2 == 0, F.lit("1.5e300")).otherwise(F.lit("-0.25"))
    values = [enc.text_value(v) for v in (F.col("c_custkey"), bal.cast("float"), bal, huge)]
    log = logs.insert_log(rows, "c_custkey", logs.CUSTOMER, "customer", columns, values)
    return _inserted(log, "customer").withColumn("single", F.col("single").cast("double"))


@query
def cast_boolean(spark: SparkSession, sf: str) -> DataFrame:
    columns = [
        SourceColumn("p_partkey", 20, is_key=True), SourceColumn("big", 16),
        SourceColumn("flag", 1560), SourceColumn("word", 16), SourceColumn("odd", 1560),
    ]
    big = F.col("p_size") > 25
    values = [enc.text_value(v) for v in (
        F.col("p_partkey"), F.when(big, "t").otherwise("f"), F.when(big, "1").otherwise("0"),
        F.when(big, "true").otherwise("false"), F.when(big, "1").otherwise("maybe"),
    )]
    log = logs.insert_log(logs.table(spark, sf, "part"), "p_partkey", logs.PART, "part", columns, values)
    return _inserted(log, "part")


@query
def cast_numeric(spark: SparkSession, sf: str) -> DataFrame:
    columns = [
        SourceColumn("c_custkey", 20, is_key=True),
        SourceColumn("money", 1700, ((15 << 16) | 2) + 4),
        SourceColumn("tenths", 1700, ((15 << 16) | 1) + 4),
        SourceColumn("free", 1700), SourceColumn("long_fraction", 1700), SourceColumn("long_whole", 1700),
    ]
    k = F.col("c_custkey").cast("string")
    values = [enc.text_value(F.col(c)) for c in ("c_custkey", "c_acctbal", "c_acctbal", "c_acctbal")] + [
        enc.text_value(F.concat(k, F.lit(".12345678912345"))),
        enc.text_value(F.when(F.col("c_custkey") % 3 == 0, "NaN").otherwise(F.concat(F.lit("9" * 34), k))),
    ]
    log = logs.insert_log(
        logs.table(spark, sf, "customer"), "c_custkey", logs.CUSTOMER, "customer", columns, values
    )
    return _inserted(log, "customer").withColumns(
        {c: F.col(c).cast("double") for c in ("money", "tenths", "free")}
    )


@query
def cast_strings(spark: SparkSession, sf: str) -> DataFrame:
    columns = [
        SourceColumn("conv_id", 20, is_key=True), SourceColumn("turn", 20, is_key=True),
        SourceColumn("text", 25), SourceColumn("word", 1043), SourceColumn("id", 2950),
    ]
    rows = logs.table(spark, sf, "conversations").withColumn("place", F.col("conv_id") * 1000 + F.col("turn"))
    word = F.when(F.col("turn") % 2 == 0, F.lit("NULL")).when(F.col("turn") % 3 == 0, F.lit(""))
    values = [
        *[enc.text_value(F.col(c)) for c in ("conv_id", "turn", "text")],
        enc.text_value(word), enc.text_value(F.md5("text")),
    ]
    log = logs.insert_log(rows, "place", logs.CONVERSATIONS, "conversations", columns, values)
    return _inserted(log, "conversations")


@query
def cast_arrays(spark: SparkSession, sf: str) -> DataFrame:
    """One row per element of three kinds of arrays; an empty array gives one row without element."""
    columns = [
        SourceColumn("vec_id", 20, is_key=True), SourceColumn("floats", 1021),
        SourceColumn("ints", 1007), SourceColumn("words", 1009),
    ]
    k = F.col("vec_id")
    floats = F.concat(F.lit("{"), F.array_join(F.col("embedding").cast("array<string>"), ","), F.lit("}"))
    ints = F.when(k % 3 == 0, F.lit("{}")).otherwise(
        F.concat(F.lit("{"), k, F.lit(",NULL,"), F.col("label"), F.lit("}"))
    )
    words = F.concat(F.lit('{"a,'), k, F.lit('","say \\"hi\\"",NULL,"NULL",plain,""}'))
    values = [enc.text_value(v) for v in (k, floats, ints, words)]
    log = logs.insert_log(
        logs.table(spark, sf, "embeddings"), "vec_id", logs.EMBEDDINGS, "embeddings", columns, values
    )
    rows = _inserted(log, "embeddings")

    def elements(name: str, value: Column) -> DataFrame:
        return rows.select(
            "vec_id", F.lit(name).alias("kind"), F.posexplode_outer(name).alias("pos", "e")
        ).select("vec_id", "kind", "pos", value.alias("value"))

    number = F.col("e").cast("double").cast("string")
    return (
        elements("floats", F.round(F.col("e").cast("double") * 1_000_000).cast("bigint").cast("string"))
        .unionByName(elements("ints", F.col("e").cast("string")))
        .unionByName(elements("words", F.col("e")))
    )


@query
def cast_temporal(spark: SparkSession, sf: str) -> DataFrame:
    columns = [
        SourceColumn("event_id", 20, is_key=True), SourceColumn("ts", 1114), SourceColumn("day", 1082),
        SourceColumn("clock", 1083), SourceColumn("props", 705), SourceColumn("raw", 17),
        SourceColumn("kind", 99999), SourceColumn("label", 19),
    ]
    ts = F.col("ts")
    values = [enc.text_value(v) for v in (
        F.col("event_id"), ts, F.to_date(ts), F.date_format(ts, "HH:mm:ss"), F.col("props"),
        F.concat(F.lit("\\x"), F.lower(F.hex(F.col("event_type").cast("binary")))),
        F.col("event_type"), F.col("event_type"),
    )]
    log = logs.insert_log(
        logs.table(spark, sf, "events"), "event_id", logs.EVENTS, "events", columns, values
    )
    rows = _inserted(log, "events")
    return rows.withColumns({"raw": F.col("raw").cast("string"), "day": F.col("day").cast("string")})


@query
def null_columns(spark: SparkSession, sf: str) -> DataFrame:
    columns = logs.CUSTOMER_V2
    k = F.col("c_custkey")
    values = [enc.text_value(F.col(c.name)) for c in columns]
    values[2] = F.when(k % 7 == 0, enc.null_value()).otherwise(values[2])
    values[4] = F.when(k % 5 == 0, enc.null_value()).otherwise(values[4])
    log = logs.insert_log(
        logs.table(spark, sf, "customer"), "c_custkey", logs.CUSTOMER, "customer", columns, values
    )
    return _inserted(log, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")


@query
def schema_merge(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of both schema versions under the union schema, plus a later frame with one more column."""
    rows = _inserted(logs.customer_log(spark, sf), "customer")
    later = logs.table(spark, sf, "supplier").select(
        F.col("s_suppkey").alias("c_custkey"), F.col("s_nationkey").cast("string").alias("c_nationkey"),
        F.lit("supplier").alias("origin"),
    )
    merged = union_rows([rows, later])
    return merged.withColumn("c_acctbal", F.col("c_acctbal").cast("double"))


@query
def change_feed_orders(spark: SparkSession, sf: str) -> DataFrame:
    return change_feed(*_typed_orders(logs.orders_log(spark, sf)))


QUERIES["change_feed"] = QUERIES.pop("change_feed_orders")


# Keys and matching


@query
def primary_key_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Catalog tables drawn from the data: one table per part, in a schema per brand.

    Constraint names are reused across schemas on purpose.
    """
    parts = logs.table(spark, sf, "part")
    named = parts.select(
        F.col("p_brand").alias("table_schema"),
        F.concat(F.lit("t"), F.col("p_partkey")).alias("table_name"),
        F.col("p_brand").alias("constraint_schema"),
        F.concat(F.lit("pk_"), (F.col("p_partkey") % 50).cast("string")).alias("constraint_name"),
        F.when(F.col("p_size") % 4 == 0, "UNIQUE").otherwise("PRIMARY KEY").alias("constraint_type"),
        "p_partkey",
    )
    used = logs.table(spark, sf, "lineitem").join(
        named, F.col("l_partkey") == F.col("p_partkey")
    ).withColumn("column_name", F.concat(F.lit("c"), F.col("l_linenumber")))
    return reg.primary_keys(named.drop("p_partkey"), used)


@query
def key_positions(spark: SparkSession, sf: str) -> DataFrame:
    """Keys as the relation messages mark them, and as the catalog of ``primary_key_lookup`` tells."""
    registry = Registry.load(logs.landed(logs.catalog_log(spark, sf)))
    marked = reg.key_positions(registry.versions).withColumn("by", F.lit("message"))
    catalog = primary_key_lookup(spark, sf).select(
        F.concat_ws(".", "table_schema", "table_name").alias("name"), "column_name")
    looked_up = reg.key_positions(registry.versions, catalog).withColumn("by", F.lit("catalog"))
    return marked.unionByName(looked_up)


@query
def match_single_key(spark: SparkSession, sf: str) -> DataFrame:
    changes, shape = _typed_orders(logs.orders_log(spark, sf))
    base = conform(logs.orders_snapshot(spark, sf), shape)
    return merge.matched(base, changes, shape).select("seq", "op", "o_orderkey", "o_custkey")


@query
def match_composite_key(spark: SparkSession, sf: str) -> DataFrame:
    log = logs.landed(logs.conversations_log(spark, sf, moved=True))
    registry = Registry.load(log)
    shape = registry.shape("conversations")
    changes = table_changes(decode_changes(log, shape.relids), registry, shape)
    base = conform(logs.table(spark, sf, "conversations"), shape)
    return merge.matched(base, changes, shape).select("seq", "op", "conv_id", "turn", "role")


@query
def match_old_or_new(spark: SparkSession, sf: str) -> DataFrame:
    changes, shape = _typed_orders(logs.orders_log(spark, sf))
    events = merge.keyed_events(changes, shape)
    return events.select(F.col("_k_o_orderkey").alias("match_key"), "ord", "live")


@query
def full_row_match(spark: SparkSession, sf: str) -> DataFrame:
    log = logs.landed(logs.lineitem_log(spark, sf), in_order=True)
    registry = Registry.load(log)
    shape = registry.shape("lineitem")
    changes = table_changes(decode_changes(log, shape.relids), registry, shape)
    weights = bag.row_weights(changes, shape)
    rows = weights.groupBy(*[c.name for c in shape.columns]).agg(F.sum(bag.COPIES).alias("weight"))
    return rows


# Applying


def _only(log: DataFrame, *ops: str) -> DataFrame:
    return log.where(wire.message_type(F.col("data")).isin("B", "R", "C", *ops))


def _apply(spark: SparkSession, sf: str, *ops: str) -> DataFrame:
    return replica(_only(logs.landed(logs.orders_log(spark, sf)), *ops), logs.orders_snapshot(spark, sf), "orders")


@query
def apply_changes(spark: SparkSession, sf: str) -> DataFrame:
    return replica(logs.landed(logs.orders_log(spark, sf)), logs.orders_snapshot(spark, sf), "orders")


@query
def apply_inserts(spark: SparkSession, sf: str) -> DataFrame:
    return _apply(spark, sf, "I")


@query
def apply_updates(spark: SparkSession, sf: str) -> DataFrame:
    log = _only(logs.landed(logs.orders_log(spark, sf)), "I", "U")
    same_key = log.where((wire.message_type(F.col("data")) != "U") | (wire.tuple_marker(F.col("data")) == "N"))
    return replica(same_key, logs.orders_snapshot(spark, sf), "orders")


@query
def apply_deletes(spark: SparkSession, sf: str) -> DataFrame:
    return _apply(spark, sf, "D")


@query
def key_change(spark: SparkSession, sf: str) -> DataFrame:
    return _apply(spark, sf, "I", "U")


@query
def identity_change(spark: SparkSession, sf: str) -> DataFrame:
    return replica(logs.landed(logs.identity_log(spark, sf)), logs.table(spark, sf, "orders"), "orders")


@query
def exact_numeric(spark: SparkSession, sf: str) -> DataFrame:
    """Rows matched by numerics of 14 fractional digits; decimals are given as text."""
    base = logs.numeric_rows(spark, sf).drop("c_custkey")
    found = replica(logs.landed(logs.numeric_log(spark, sf)), base, "customer")
    return found.select(*[F.col(c).cast("string").alias(c) for c in found.columns])


@query
def widened_types(spark: SparkSession, sf: str) -> DataFrame:
    log = logs.landed(logs.widening_log(spark, sf))
    return replica(log, logs.table(spark, sf, "part").limit(0).select("p_partkey", "p_size", "p_name"), "part")


@query
def renamed_table(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of one relation id under two names."""
    log = logs.landed(logs.renaming_log(spark, sf))
    registry = Registry.load(log)
    empty = logs.table(spark, sf, "supplier").limit(0).select("s_suppkey", "s_nationkey")
    parts = [replica(log, empty, t, registry).withColumn("name", F.lit(t)) for t in ("supplier", "vendor")]
    return parts[0].unionByName(parts[1])


@query
def net_changes(spark: SparkSession, sf: str) -> DataFrame:
    log = logs.landed(logs.orders_log(spark, sf))
    registry = Registry.load(log)
    shape = registry.shape("orders")
    changes = table_changes(decode_changes(txn.committed_only(log), shape.relids), registry, shape)
    net = merge.net_changes(merge.keyed_events(changes, shape), shape)
    return net.select(
        F.col("_k_o_orderkey").alias("o_orderkey"), "last.live", F.col("last.o_custkey").alias("o_custkey"),
        F.col("c_2.v").alias("o_orderstatus"),
    )


@query
def aligned_start(spark: SparkSession, sf: str) -> DataFrame:
    start = position_number(F.lit("1/1F6C0"))  # inside the second transaction
    return replica(
        logs.landed(logs.orders_log(spark, sf)), logs.orders_snapshot(spark, sf), "orders", start=start
    )


@query
def apply_bag(spark: SparkSession, sf: str) -> DataFrame:
    return replica(logs.landed(logs.lineitem_log(spark, sf), in_order=True), logs.table(spark, sf, "lineitem"), "lineitem")


@query
def bag_toast(spark: SparkSession, sf: str) -> DataFrame:
    """Rows matched as a whole whose updates leave a value out."""
    log = logs.landed(logs.lineitem_log(spark, sf, left_out=True), in_order=True)
    return replica(log, logs.table(spark, sf, "lineitem"), "lineitem")


def _conversations(spark: SparkSession, sf: str, toast: str, moved: bool = False) -> DataFrame:
    log = logs.landed(logs.conversations_log(spark, sf, moved))
    return replica(log, logs.table(spark, sf, "conversations"), "conversations", toast=toast)


@query
def toast_keep(spark: SparkSession, sf: str) -> DataFrame:
    return _conversations(spark, sf, merge.KEEP)


@query
def toast_null(spark: SparkSession, sf: str) -> DataFrame:
    return _conversations(spark, sf, merge.NULL)


@query
def toast_moved(spark: SparkSession, sf: str) -> DataFrame:
    return _conversations(spark, sf, merge.KEEP, moved=True)
