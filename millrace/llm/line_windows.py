"""Repeated passages of three lines.

Lines are stripped of white space at both ends; lines without anything left take no part. Every three
consecutive lines of a text are a window. Windows with equal lines are found over all texts; the first,
by doc_id and place, stays, and the lines covered by any later one are removed. Covered places of
overlapping windows are merged, so a repeated passage of any length goes as a whole.

Defined results: null text gives null text; texts with fewer than three lines are left as they are; doc_id null sorts
first; rows with one doc_id and equal text have the same places and are treated alike.
"""
from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

LINES = 3


def _lines(text: Column) -> Column:
    """Non-empty lines as structs (line, at), at being the place among all lines."""
    split = F.split(text, "\n")
    numbered = F.transform(split, lambda x, i: F.struct(F.trim(F.regexp_replace(x, r"^\s+|\s+$", "")).alias("line"), i.alias("at")))
    return F.filter(numbered, lambda x: x["line"] != "")


def windows(docs: DataFrame) -> DataFrame:
    """(doc_id, _key, start, end, h1, h2) of every window; start and end are places among all lines."""
    lined = docs.select("doc_id", F.xxhash64("doc_id", "text").alias("_key"), _lines(F.col("text")).alias("lines"))
    lined = lined.where(F.size("lines") >= LINES)
    each = lined.select("doc_id", "_key", "lines", F.posexplode("lines").alias("i", "one")).where(F.col("i") + LINES <= F.size("lines"))
    line = [F.get(F.col("lines"), F.col("i") + k)["line"] for k in range(LINES)]
    return each.select(
        "doc_id", "_key", F.col("one.at").alias("start"), F.get(F.col("lines"), F.col("i") + LINES - 1)["at"].alias("end"),
        F.xxhash64(*line).alias("h1"), F.xxhash64(F.lit(1), *reversed(line)).alias("h2"))


def _rewrite(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, counts = [], []
        for text, spans in zip(batch["_text"].to_pylist(), batch["_spans"].to_pylist(), strict=True):
            lines = text.split("\n")
            gone = {at for span in spans or () for at in range(span["start"], span["end"] + 1)}
            texts.append("\n".join(x for i, x in enumerate(lines) if i not in gone))
            counts.append((len(lines), len(gone)))
        yield pa.RecordBatch.from_arrays(
            [batch["doc_id"], pa.array(texts, pa.string()), pa.array([c[0] for c in counts], pa.int64()),
             pa.array([c[1] for c in counts], pa.int64())], names=["doc_id", "text", "n_lines", "n_removed"])


def without_repeats(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_lines, n_removed, text (what is left)."""
    each = windows(docs)
    place = F.struct("doc_id", "start", "_key")
    firsts = each.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("times")).where("times > 1")
    later = each.alias("w").join(
        common.landed(firsts).alias("f"), (F.col("w.h1") == F.col("f.h1")) & (F.col("w.h2") == F.col("f.h2"))).where(
        ~F.struct("w.doc_id", "w.start", "w._key").eqNullSafe(F.col("f.first")))
    spans = later.groupBy("w._key").agg(F.collect_set(F.struct("w.start", "w.end")).alias("_spans"))
    spans = common.landed(spans.select(F.col("_key").alias("_of"), "_spans"))
    rows = docs.select("doc_id", F.col("text").alias("_text"), F.xxhash64("doc_id", "text").alias("_key"))
    # Spans grow with the texts, so they are shuffled at every size and never broadcast.
    joined = rows.join(spans.hint("merge"), F.col("_key") == F.col("_of"), "left").select("doc_id", "_text", "_spans")
    plain = joined.where("_spans IS NULL").select(
        "doc_id", F.col("_text").alias("text"), F.size(F.split("_text", "\n")).cast("long").alias("n_lines"),
        F.when(F.col("_text").isNotNull(), F.lit(0).cast("long")).alias("n_removed"))
    cut = joined.where("_spans IS NOT NULL").mapInArrow(_rewrite, "doc_id long, text string, n_lines long, n_removed long")
    return plain.unionByName(cut).select("doc_id", F.when(F.col("text").isNotNull(), F.col("n_lines")).alias("n_lines"), "n_removed", "text")
