"""Monitoring tables."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import wire
from ..functions.pgtypes import fits
from .decode import message_text, stage_changes, with_header
from .registry import IDENTITY_FULL, IDENTITY_NONE, Registry, bind
from .transactions import in_bracket, transaction_brackets

QUARANTINE = ["seq", "lsn", "reason", "data"]


def operation_counts(log: DataFrame, registry: Registry | None = None) -> DataFrame:
    """Messages per type, or per table and type when a registry is given."""
    if registry is None:
        kinds = log.select(wire.message_type(F.col("data")).alias("op"))
        return kinds.groupBy("op").agg(F.count("*").alias("messages"))
    rows = with_header(log).select("seq", "op", "relid")
    changes = rows.where(F.col("op").isin(*wire.CHANGES))
    bound = bind(changes, registry.versions.select("relid", "from_seq", "to_seq", "name"))
    counts = bound.groupBy(F.col("_v_name").alias("table"), "op")
    return counts.agg(F.count("*").alias("messages"))


def transaction_summary(log: DataFrame) -> DataFrame:
    """Rows changed and position range per transaction.

    Only Begin rows are put in order. The rows between them are looked up in the brackets by step of the log and added up
    where they stand, so that one row per transaction and task is shuffled. The brackets go to the tasks when Spark
    finds them small; else both sides meet by step.
    """
    slim = with_header(log).select("seq", "op")
    brackets = transaction_brackets(slim)
    rows = in_bracket(slim, brackets)
    newest = slim.where(F.col("op") == wire.COMMIT).agg(F.max("seq")).scalar()
    return rows.groupBy("txn_id").agg(
        F.min("seq").alias("first_seq"),
        F.max("seq").alias("last_seq"),
        F.count_if(F.col("op") == wire.INSERT).alias("inserts"),
        F.count_if(F.col("op") == wire.UPDATE).alias("updates"),
        F.count_if(F.col("op") == wire.DELETE).alias("deletes"),
        F.bool_or(F.coalesce(F.col("seq") <= newest, F.lit(False))).alias("committed"),
    )


def quarantine(log: DataFrame, registry: Registry) -> DataFrame:
    """Messages that cannot be applied, with the reason nearest to the wire.

    A value that does not fit its type is listed too, although the rest of its
    row is applied. One scan and one decoding, whatever the number of tables: every change is bound to its version, which brings
    the types its values are checked against. Nothing is shuffled.
    """
    found = set_aside(stage_changes(log), registry).unionByName(damaged_relations(log, registry))
    return found.select(*QUARANTINE)


def set_aside(staged: DataFrame, registry: Registry) -> DataFrame:
    """QUARANTINE rows among decoded messages (``part`` as ``stage_changes`` says), in one pass."""
    versions = registry.effective().select("relid", "from_seq", "to_seq", "identity", "columns")
    bound = bind(staged.where("part <> 'control'"), versions, how="left")
    reason = F.when(F.col("part") == "bad", _bad_reason()).otherwise(_change_reason())
    message = message_text(*[F.col(c) for c in ("op", "relid", "tag", "old", "new")])
    return bound.withColumn("reason", reason).where("reason is not null").select(
        "seq", "lsn", "reason", F.coalesce("data", message).alias("data"))


def _bad_reason() -> Column:
    """A change of a relation that nothing is known of is unmapped, whatever else is wrong with its tuples."""
    unmapped = F.col("op").isin(*wire.CHANGES) & (F.col("reason") == F.col("err")) & F.col("_v_identity").isNull()
    return F.when(unmapped, "unmapped_relation").otherwise(F.col("reason"))


def _change_reason() -> Column:
    identity, columns = F.col("_v_identity"), F.col("_v_columns")
    sent = F.coalesce("new", "old")
    # A null list of values has no misfits; a value beyond the known columns has nothing to fit.
    pairs = F.arrays_zip(columns.alias("c"), sent.alias("v"))
    misfit = F.exists(pairs, lambda p: p["v"]["v"].isNotNull() & ~fits(
        p["v"]["v"].cast("string"), p["c"]["oid"], p["c"]["typmod"]))
    keyed = F.exists(columns, lambda c: c["is_key"])
    unmatched = (F.col("op") != wire.INSERT) & (identity != IDENTITY_FULL) & ~keyed
    return F.when(identity.isNull(), "unmapped_relation").when(identity == IDENTITY_NONE, None).when(
        unmatched, "no_key").when(misfit, "bad_value")


def damaged_relations(log: DataFrame, registry: Registry) -> DataFrame:
    """Relation messages that could not be read."""
    rows = with_header(log).where(F.col("op") == wire.RELATION)
    hit = rows.join(registry.damaged, "relid")
    return hit.where("seq = from_seq").select("seq", "lsn", F.col("err").alias("reason"), "data")


def error_counts(quarantined: DataFrame) -> DataFrame:
    return quarantined.groupBy("reason").agg(F.count("*").alias("messages"))
