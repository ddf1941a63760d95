"""Quality score: random Fourier features, ridge regression, isotonic calibration.

Statistics of a text (sizes, word lengths, shares of kinds of characters, repetition, function words) are
mapped to random Fourier features, so that a linear model of them approximates a Gaussian kernel. Ridge
weights come from normal equations that every task sums up for its rows. A fifth of the training rows is left out of the fit
and calibrates the raw scores: an isotonic step function over a fixed number of score bins.

Defined results: null, empty and wordless texts have zeros for statistics and are scored like others; labels that
are null or whose doc_id is null teach nothing; several labels of one doc_id count each; without any
training row every score is 0.5; rows with equal text get equal scores.
"""
from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common, words
from .lang_pieces import remainder
from .main_text import STOP_WORDS

FEATURES = 384  # random Fourier features
WIDTH, RIDGE = 4.0, 1e-3  # width of the kernel in standard deviations; ridge per training row
BINS = 512  # of raw scores, for calibration
STATISTICS = 18

_STOPS = np.sort(words.hashed_words(pa.array(sorted(STOP_WORDS))).hashes)
_B = np.arange(256)


def _kind(chars: str) -> np.ndarray:
    return np.isin(_B, [ord(c) for c in chars])


_KINDS = [
    ((_B >= 65) & (_B <= 90)), ((_B >= 97) & (_B <= 122)), ((_B >= 48) & (_B <= 57)), _kind(" \t"), _kind("\n\r"),
    _kind(".,;:?'\"()-"), _kind("!"), _kind("#$%&*+<=>@[\\]^_`{|}~/"), _B >= 128,
]


def _log_ratio(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return np.log((a + 1.0) / (b + 1.0))


def statistics(column) -> np.ndarray:
    """[text, STATISTICS] of a text column."""
    raw, offsets = words.text_bytes(column)
    found = words.hashed_words(column)
    n_bytes, n_words = np.diff(offsets).astype(float), np.diff(found.first).astype(float)
    out = np.zeros((len(n_bytes), STATISTICS))
    out[:, 0], out[:, 1] = np.log1p(n_bytes), np.log1p(n_words)

    some = np.flatnonzero(n_bytes)
    starts = offsets[some]
    for k, kind in enumerate(_KINDS):
        if len(some):
            out[some, 2 + k] = np.sqrt(np.add.reduceat(kind[raw].astype(np.int32), starts) / n_bytes[some])
    some = np.flatnonzero(n_words)
    if len(some):
        at = found.first[some]
        lengths = np.diff(found.spans, axis=0)[0].astype(float)
        mean = np.add.reduceat(lengths, at) / n_words[some]
        out[some, 11] = np.log1p(mean)
        out[some, 12] = np.log1p(np.sqrt(np.maximum(np.add.reduceat(lengths**2, at) / n_words[some] - mean**2, 0)))
        stops = _STOPS[np.minimum(np.searchsorted(_STOPS, found.hashes), len(_STOPS) - 1)] == found.hashes
        out[some, 13] = np.add.reduceat(stops.astype(np.int32), at) / n_words[some]
        out[some, 14] = _different(found)[some] / n_words[some]
        pairs = words.windows(found, 3)
        count = np.diff(pairs.first)[some]
        out[some, 15] = _different(pairs)[some] / np.maximum(count, 1)
        out[some, 16] = np.add.reduceat((lengths > 12).astype(np.int32), at) / n_words[some]
        out[some, 17] = _log_ratio(n_bytes[some] - np.add.reduceat(lengths, at), n_words[some])
    return out


def _different(items: words.Words) -> np.ndarray:
    """How many different items each text has."""
    owner = np.repeat(np.arange(len(items.first) - 1), np.diff(items.first))
    order = np.lexsort((items.hashes, owner))
    h, o = items.hashes[order], owner[order]
    new = np.ones(len(h), dtype=bool)
    new[1:] = (h[1:] != h[:-1]) | (o[1:] != o[:-1])
    return np.bincount(o[new], minlength=len(items.first) - 1).astype(float)


def _statistic_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for lo in range(0, whole.num_rows, 1000):
            batch = whole.slice(lo, 1000)
            flat = statistics(batch["text"]).ravel()
            first = np.arange(0, len(flat) + 1, STATISTICS, dtype=np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.ListArray.from_arrays(pa.array(first), pa.array(flat))], names=["doc_id", "x"])


def measured(docs: DataFrame) -> DataFrame:
    """(doc_id, x) of every row of ``docs``, written once."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return common.landed(rows.mapInArrow(_statistic_batches, "doc_id long, x array<double>"))


class Model(NamedTuple):
    centre: np.ndarray
    scale: np.ndarray
    directions: np.ndarray
    phases: np.ndarray
    weights: np.ndarray
    knots: np.ndarray  # raw scores of the calibration
    levels: np.ndarray  # calibrated scores at the knots


def fourier(x: np.ndarray, model: Model) -> np.ndarray:
    z = np.clip((x - model.centre) / model.scale, -8, 8)
    waves = np.cos(z @ model.directions + model.phases) * np.sqrt(2.0 / len(model.phases))
    return np.column_stack([waves, z, np.ones(len(z))])


def _x(batch) -> np.ndarray:
    column = batch["x"]
    return column.flatten().to_numpy().reshape(len(column), STATISTICS)


def _sum_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = FEATURES + STATISTICS + 1
        total = np.zeros((width, width + 1))
        for batch in batches:
            z, y = fourier(_x(batch), model), batch["y"].to_numpy().astype(float)
            total[:, :width] += z.T @ z
            total[:, width] += z.T @ y
        if total.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.arange(width, dtype=np.int32)), pa.array(list(total), pa.list_(pa.float64()))], names=["i", "sums"])
    return run


def _add_up(table: pa.Table) -> pa.Table:
    sums = table["sums"].combine_chunks()
    total = sums.flatten().to_numpy().reshape(len(sums), -1).sum(axis=0)
    return pa.table({"i": table["i"].slice(0, 1), "sums": pa.array([total], pa.list_(pa.float64()))})


def isotonic(x: np.ndarray, positive: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Non-decreasing levels for bins sorted by ``x`` (pool adjacent violators)."""
    pools: list[list[float]] = []
    for p, m in zip(positive.tolist(), n.tolist(), strict=True):
        pools.append([p, m, 1])
        while len(pools) > 1 and pools[-2][0] * pools[-1][1] >= pools[-1][0] * pools[-2][1]:
            p2, m2, k2 = pools.pop()
            pools[-1] = [pools[-1][0] + p2, pools[-1][1] + m2, pools[-1][2] + k2]
    # one made-up row of each label per pool keeps levels off 0 and 1
    return np.repeat([(p + 1) / (m + 2) for p, m, _ in pools], [k for _, _, k in pools])


def train(data: DataFrame, labels: DataFrame, seed: int = 7) -> Model | None:
    """Fit on labelled rows whose crc32(doc_id) mod 3 is not 1. data: ``measured``. The driver gets the
    normal equations and bin counts only."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").where(remainder(F.col("doc_id")) != 1).select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col("quality") > 0).cast("int").alias("y"))
    rows = common.landed(data.join(known, "doc_id").select(
        "x", "y", (F.pmod(F.xxhash64("doc_id"), F.lit(5)) == 0).alias("calibrates")))
    facts = rows.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum((~F.col("calibrates")).cast("int")), F.lit(0)).alias("fit"),
        *(F.avg(F.get("x", F.lit(i))).alias(f"m{i}") for i in range(STATISTICS)),
        *(F.stddev_pop(F.get("x", F.lit(i))).alias(f"s{i}") for i in range(STATISTICS))).first()
    if not facts["n"]:
        return None
    fit_rows = rows.where("NOT calibrates") if 0 < facts["fit"] < facts["n"] else rows
    check_rows = rows.where("calibrates") if 0 < facts["fit"] < facts["n"] else rows
    rng = np.random.default_rng(seed)
    scale = np.array([facts[f"s{i}"] for i in range(STATISTICS)])
    model = Model(
        np.array([facts[f"m{i}"] for i in range(STATISTICS)]), np.where(scale > 1e-9, scale, 1.0),
        rng.standard_normal((STATISTICS, FEATURES)) / WIDTH, rng.uniform(0, 2 * np.pi, FEATURES),
        np.zeros(FEATURES + STATISTICS + 1), np.zeros(1), np.full(1, 0.5))
    width = len(model.weights)
    parts = fit_rows.mapInArrow(_sum_batches(model), "i int, sums array<double>")
    sums = parts.groupBy("i").applyInArrow(_add_up, "i int, sums array<double>").toPandas().sort_values("i")
    both = np.stack(sums["sums"].to_numpy()).reshape(width, width + 1)
    ridge = RIDGE * max(facts["fit"], 1) * np.eye(width) / FEATURES
    ridge[-1, -1] = 0
    model = model._replace(weights=np.linalg.lstsq(both[:, :width] + ridge, both[:, width], rcond=None)[0])
    binned = check_rows.mapInArrow(_raw_batches(model), "bin int, y int").groupBy("bin").agg(
        F.sum("y").alias("positive"), F.count(F.lit(1)).alias("n")).toPandas().sort_values("bin")
    x = (binned["bin"].to_numpy() + 0.5) / BINS * 2 - 0.5
    return model._replace(knots=x, levels=isotonic(x, binned["positive"].to_numpy(float), binned["n"].to_numpy(float)))


def _raw_batches(model: Model):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw = fourier(_x(batch), model) @ model.weights
            bins = np.clip((raw + 0.5) / 2 * BINS, 0, BINS - 1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([pa.array(bins), batch["y"]], names=["bin", "y"])
    return run


def _score_batches(model: Model | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if model is None:
                score = np.full(batch.num_rows, 0.5)
            else:
                raw = fourier(_x(batch), model) @ model.weights
                # a hint of the raw score orders texts within one level
                score = np.clip(np.interp(raw, model.knots, model.levels), 0.0005, 0.9995) + 0.0005 * np.tanh(raw - 0.5)
            yield pa.RecordBatch.from_arrays([batch["doc_id"], pa.array(score)], names=["doc_id", "score"])
    return run


def scored(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted."""
    data = measured(docs)
    model = train(data, labels)
    out = data.mapInArrow(_score_batches(model), "doc_id long, score double")
    return out.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == 1, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))
