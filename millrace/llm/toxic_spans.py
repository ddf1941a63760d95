"""Toxic spans: a linear-chain conditional random field over words, its marginals summed up per document.

Labels exist per document, so words are labelled first. A word, or the letters it begins with, is evidence if the share of toxic
documents among those that use it is high (``PRIOR_ROWS`` rows at the base rate temper rare ones), as strong as the number of
toxic documents with it. Words of a toxic document with at least ``RELATIVE`` of its strongest evidence are toxic, so
that words which only accompany a known one, as in copies of a document, are not. All words of other documents are clean. From these labelled words a two-state chain (clean, toxic) is trained: a word's weight
is the sum of hashed features (the word, its first and last bytes, its neighbours), and four transition weights join
neighbouring states. Gradients are expected minus labelled counts: every task sums them for its rows, and the driver gets the
added-up sums only and takes quasi-Newton steps.

Forward-backward gives each word's marginal. A document's raw score is the expected number of toxic words and the largest
marginal, mapped to a probability by a logistic curve that is fitted on training rows which the chain has not seen. Offending
offsets are the words of marginal 0.5 or more, neighbours joined.

Chains of all texts of a batch are handled together: a text's first word is a transition that forgets the state before it, so one long chain
holds them all. It is cut into lanes of equal length; lanes are summed up as 2 x 2 products, joined, and then
walked again side by side. Working memory follows a part of about a megabyte of text; a longer text is a part by itself.

Fit on at most ``FIT_ROWS`` labelled rows, chosen by a hash of doc_id (documented bound); every row is scored, whole.

Defined results: null, empty and wordless texts have no spans and are scored like texts without toxic words; labels that are
null, or whose doc_id is null, teach nothing; several labels of one doc_id count each; without training rows of both kinds
every score is the share of toxic ones among training rows (0 without any); equal texts get equal scores.
"""
from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import words
from .common import landed

FIT_ROWS = 16_384  # labelled rows at most that the chain and its calibration are fitted on
PRIOR_ROWS, LEAST_SHARE, RELATIVE = 8.0, 0.6, 0.2  # when a word of a toxic document is labelled toxic
BITS = 16  # hashed features: 2 ** BITS weights
STEPS = 24  # quasi-Newton steps at most
RIDGE = 2.0
LANE = 256  # words of one lane
CHUNK = 4096  # weights per row of summed gradients
WIDTH = (1 << BITS) + CHUNK  # the last chunk holds the chain's own weights first
BIAS, TRANSITIONS = 1 << BITS, (1 << BITS) + 1  # bias; score of staying clean, clean-toxic, toxic-clean, toxic-toxic
START = (1 << BITS) + 5  # score of starting toxic
HEADS, TAIL = (4, 5, 6), 4  # bytes at the start and at the end of a word
FEATURES = len(HEADS) + 4
SAID = len(HEADS) + 1  # features that can be evidence: the word and its heads


def remainder(doc_id: Column) -> Column:
    return F.crc32(doc_id.cast("string").cast("binary")) % 5


class Tokens(NamedTuple):
    features: np.ndarray  # [word, FEATURES] numbers of weights
    first: np.ndarray  # of each text: place of its first word (one more at the end)
    spans: np.ndarray  # bytes where each word starts and ends
    raw: np.ndarray
    said: np.ndarray  # [word, SAID] hashes of the word and its heads


def _bucket(h: np.ndarray, salt: int) -> np.ndarray:
    return (words.mix(h + np.uint64(salt)) & np.uint64((1 << BITS) - 1)).astype(np.int32)


def _ends(raw: np.ndarray, spans: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """Hashes of the ``HEADS`` first and of the ``TAIL`` last bytes of each word (all of a shorter one)."""
    low, last = words.LOWER[raw].astype(np.uint64), max(len(raw) - 1, 0)
    heads, head, tail = [], np.zeros(spans.shape[1], np.uint64), np.zeros(spans.shape[1], np.uint64)
    for k in range(max(*HEADS, TAIL)):
        inside = spans[0] + k < spans[1]
        head = head * np.uint64(257) + np.where(inside, low[np.minimum(spans[0] + k, last)] + np.uint64(1), np.uint64(0))
        if k < TAIL:
            tail = tail * np.uint64(257) + np.where(
                inside, low[np.maximum(spans[1] - 1 - k, 0)] + np.uint64(1), np.uint64(0))
        if k + 1 in HEADS:
            heads.append(words.mix(head + np.uint64((k + 1) << 56)))
    return heads, tail


def tokens(column) -> Tokens:
    found = words.hashed_words(column)
    h, first = found.hashes, found.first
    n = len(h)
    features, said = np.empty((n, FEATURES), np.int32), np.empty((n, SAID), np.uint64)
    if n:
        edge = np.zeros(n, bool)
        edge[first[:-1][np.diff(first) > 0]] = True
        before, after = np.roll(h, 1), np.roll(h, -1)
        before[edge] = 1
        after[np.roll(edge, -1)] = 2  # the word before an edge, and the very last one
        heads, tail = _ends(found.raw, found.spans)
        for k, value in enumerate((h, *heads)):
            said[:, k] = value
        for k, value in enumerate((h, *heads, tail, before, after)):
            features[:, k] = _bucket(value, k + 1)
    return Tokens(features, first, found.spans, found.raw, said)


class Chain(NamedTuple):
    marginal: np.ndarray  # of being toxic, per word
    pairs: np.ndarray  # [4] expected transitions
    starts: float  # expected number of texts that start toxic
    log_total: float  # log of the sum over all taggings


def _emissions(found: Tokens, weights: np.ndarray) -> np.ndarray:
    return np.clip(weights[found.features].sum(axis=1) + weights[BIAS], -30, 30)


def forward_backward(emission: np.ndarray, first: np.ndarray, weights: np.ndarray) -> Chain:
    """Marginals of chains that stand one after another. ``emission``: score of toxic over clean per word."""
    n = len(emission)
    if not n:
        return Chain(np.zeros(0), np.zeros(4), 0.0, 0.0)
    lanes = -(-n // LANE)
    starts = np.unique(first[:-1][np.diff(first) > 0])
    # Step into word t from state i to state j: move[i][j] * out[j]. Padding words keep the state.
    move = np.exp(np.clip(weights[TRANSITIONS : TRANSITIONS + 4], -20, 20)).reshape(2, 2)
    steps = np.empty((2, 2, lanes * LANE))
    toxic = np.exp(emission)
    for i in range(2):
        steps[i, 0, :n], steps[i, 1, :n] = move[i, 0], move[i, 1] * toxic
        steps[i, 0, starts] = 1.0
        steps[i, 1, starts] = np.exp(np.clip(weights[START], -20, 20)) * toxic[starts]
    steps[:, :, n:] = np.eye(2)[:, :, None]
    scale = steps.max(axis=(0, 1))
    steps /= scale
    m = np.ascontiguousarray(steps.reshape(2, 2, lanes, LANE).transpose(3, 0, 1, 2))  # [LANE, 2, 2, lanes]

    # Products of whole lanes, then the state in front of and behind every lane.
    product = np.broadcast_to(np.eye(2)[:, :, None], (2, 2, lanes)).copy()
    lane_log = np.zeros(lanes)
    for t in range(LANE):
        product = np.einsum("ijk,jlk->ilk", product, m[t]) if lanes < 8 else np.stack([
            product[0, 0] * m[t, 0] + product[0, 1] * m[t, 1], product[1, 0] * m[t, 0] + product[1, 1] * m[t, 1]])
        if t % 32 == 31:
            top = product.max(axis=(0, 1))
            product /= top
            lane_log += np.log(top)
    enter, leave = np.empty((2, lanes)), np.empty((2, lanes))
    state, log_total = np.array([1.0, 0.0]), float(np.log(scale).sum() + lane_log.sum())
    for k in range(lanes):
        enter[:, k] = state
        state = state @ product[:, :, k]
        total = state.sum()
        log_total += float(np.log(total))
        state = state / total
    state = np.array([1.0, 1.0])
    for k in reversed(range(lanes)):
        leave[:, k] = state
        state = product[:, :, k] @ state
        state = state / state.sum()

    alpha, beta = np.empty((LANE, 2, lanes)), np.empty((LANE, 2, lanes))
    state = enter
    for t in range(LANE):
        state = state[0] * m[t, 0] + state[1] * m[t, 1]
        state = state / (state[0] + state[1])
        alpha[t] = state
    state = leave
    for t in reversed(range(LANE)):
        beta[t] = state
        state = m[t, :, 0] * state[0] + m[t, :, 1] * state[1]
        state = state / (state[0] + state[1])

    both = alpha * beta
    marginal = (both[:, 1] / (both[:, 0] + both[:, 1])).T.reshape(-1)[:n]
    # Expected transitions: state before a word, the step into it, what follows.
    prior = np.empty_like(alpha)
    prior[0], prior[1:] = enter, alpha[:-1]
    joint = prior[:, :, None, :] * m * beta[:, None, :, :]
    joint /= joint.sum(axis=(1, 2), keepdims=True)
    inner = np.ones(lanes * LANE, bool)
    inner[starts] = inner[n:] = False
    inner = inner.reshape(lanes, LANE).T
    pairs = (joint * inner[:, None, None, :]).sum(axis=(0, 3)).reshape(-1)
    return Chain(marginal, pairs, float(marginal[starts].sum()), log_total)


class Model(NamedTuple):
    weights: np.ndarray
    curve: np.ndarray  # bias and weights of the summaries
    base: float  # score without a usable model


# Labelled words


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, text, y) of training rows: labelled rows whose crc32(doc_id) mod 5 is not 0."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(remainder(F.col("doc_id")) != 0).select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.col("toxic") > 0).cast("int").alias("y"))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(known, "doc_id")


def _said_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in words.parts(batches):
        found = tokens(batch["text"])
        y = batch["y"].to_numpy()
        owner = np.repeat(np.arange(batch.num_rows), np.diff(found.first) * SAID)
        said = found.said.reshape(-1)
        order = np.lexsort((said, owner))
        said, owner = said[order], owner[order]
        new = np.ones(len(said), bool)
        new[1:] = (said[1:] != said[:-1]) | (owner[1:] != owner[:-1])
        toxic = y[owner[new]]
        h, back = np.unique(said[new], return_inverse=True)
        yield pa.RecordBatch.from_arrays(
            [pa.array(h.view(np.int64)), pa.array(np.bincount(back, toxic, len(h)).astype(np.int64)),
             pa.array(np.bincount(back, 1 - toxic, len(h)).astype(np.int64))], names=["h", "toxic", "clean"])


class Evidence(NamedTuple):
    hashes: np.ndarray  # sorted
    strength: np.ndarray


def evidence(rows: DataFrame, base: float) -> Evidence:
    """Words and heads that mark toxic documents. Bounded by the words of ``FIT_ROWS`` rows."""
    counts = rows.select("text", "y").mapInArrow(_said_counts, "h long, toxic long, clean long")
    summed = counts.groupBy("h").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))
    share = (F.col("toxic") + base * PRIOR_ROWS) / (F.col("toxic") + F.col("clean") + PRIOR_ROWS)
    found = summed.where((share >= LEAST_SHARE) & (F.col("toxic") >= 2)).select("h", "toxic").toPandas()
    h = found["h"].to_numpy(np.int64).view(np.uint64)
    order = np.argsort(h)
    return Evidence(h[order], found["toxic"].to_numpy(float)[order])


def _tags(found: Tokens, y: np.ndarray, known: Evidence) -> np.ndarray:
    """1 for the words of toxic documents that are labelled toxic."""
    out = np.zeros(len(found.said))
    if not len(known.hashes) or not len(out):
        return out
    at = np.minimum(np.searchsorted(known.hashes, found.said), len(known.hashes) - 1)
    strength = np.where(known.hashes[at] == found.said, known.strength[at], 0).max(axis=1)
    strength *= np.repeat(y > 0, np.diff(found.first))
    some = np.diff(found.first) > 0
    best = np.zeros(len(y))
    best[some] = np.maximum.reduceat(strength, found.first[:-1][some])
    return ((strength > 0) & (strength >= RELATIVE * np.repeat(best, np.diff(found.first)))).astype(float)


# Training


def _gradient_batches(weights: np.ndarray, known: Evidence):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, loss = np.zeros(WIDTH), 0.0
        for batch in words.parts(batches):
            found = tokens(batch["text"])
            if not len(found.said):
                continue
            tags = _tags(found, batch["y"].to_numpy(), known)
            emission = _emissions(found, weights)
            chain = forward_backward(emission, found.first, weights)
            gap = chain.marginal - tags
            for k in range(FEATURES):
                total += np.bincount(found.features[:, k], gap, WIDTH)
            total[BIAS] += gap.sum()
            starts = np.unique(found.first[:-1][np.diff(found.first) > 0])
            inner = np.ones(len(tags), bool)
            inner[starts] = False
            at = np.flatnonzero(inner)
            kinds = np.bincount((2 * tags[at - 1] + tags[at]).astype(np.int64), minlength=4)
            total[TRANSITIONS : TRANSITIONS + 4] += chain.pairs - kinds
            total[START] += chain.starts - tags[starts].sum()
            chosen = emission @ tags + weights[TRANSITIONS : TRANSITIONS + 4] @ kinds + weights[START] * tags[starts].sum()
            loss += chain.log_total - chosen
        total[START + 1] = loss
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(WIDTH // CHUNK, dtype=np.int32)),
             pa.array(list(total.reshape(-1, CHUNK)), pa.list_(pa.float64()))], names=["chunk", "sums"])
    return run


def _add_up(table: pa.Table) -> pa.Table:
    sums = table["sums"].combine_chunks()
    total = sums.flatten().to_numpy().reshape(len(sums), -1).sum(axis=0)
    return pa.table({"chunk": table["chunk"].slice(0, 1), "sums": pa.array([total], pa.list_(pa.float64()))})


def _loss_and_gradient(rows: DataFrame, weights: np.ndarray, known: Evidence) -> tuple[float, np.ndarray]:
    parts = rows.mapInArrow(_gradient_batches(weights, known), "chunk int, sums array<double>")
    sums = parts.groupBy("chunk").applyInArrow(_add_up, "chunk int, sums array<double>").toPandas().sort_values("chunk")
    total = np.concatenate(sums["sums"].to_numpy()) if len(sums) else np.zeros(WIDTH)
    loss = float(total[START + 1]) + RIDGE / 2 * float(weights @ weights)
    total[START + 1 :] = 0
    return loss, total + RIDGE * weights


def minimised(evaluate, start: np.ndarray, steps: int = STEPS, memory: int = 8) -> np.ndarray:
    """Quasi-Newton steps from the last ``memory`` gradients; a step that does not lower the loss is halved."""
    x, (loss, gradient) = start, evaluate(start)
    moves: list[tuple[np.ndarray, np.ndarray]] = []
    used = 1
    while used < steps and np.abs(gradient).max() > 1e-3 * max(1.0, loss):
        way = gradient.copy()
        factors = []
        for s, d in reversed(moves):
            a = (s @ way) / (s @ d)
            factors.append(a)
            way -= a * d
        if moves:
            s, d = moves[-1]
            way *= (s @ d) / (d @ d)
        else:
            way /= max(1.0, float(np.linalg.norm(way)))
        for (s, d), a in zip(moves, reversed(factors), strict=True):
            way += (a - (d @ way) / (s @ d)) * s
        length = 1.0
        while used < steps:
            at = x - length * way
            then, slope = evaluate(at)
            used += 1
            if then < loss:
                break
            length /= 4
        else:
            break
        if (at - x) @ (slope - gradient) > 1e-10:
            moves = (moves + [(at - x, slope - gradient)])[-memory:]
        x, loss, gradient = at, then, slope
    return x


def _summaries(marginal: np.ndarray, first: np.ndarray) -> np.ndarray:
    """[text, 2]: log of the expected number of toxic words, and log odds of the likeliest one."""
    n = np.diff(first)
    out = np.tile([np.log(1e-4), np.log(1e-4)], (len(n), 1))
    some = np.flatnonzero(n)
    if len(some):
        at = first[some]
        most = np.clip(np.maximum.reduceat(marginal, at), 1e-6, 1 - 1e-6)
        out[some, 0] = np.log(np.add.reduceat(marginal, at) + 1e-4)
        out[some, 1] = np.maximum(np.log(most / (1 - most)), np.log(1e-4))
    return out


def _summary_batches(weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.parts(batches):
            found = tokens(batch["text"])
            chain = forward_backward(_emissions(found, weights), found.first, weights)
            s = _summaries(chain.marginal, found.first)
            yield pa.RecordBatch.from_arrays(
                [pa.array(s[:, 0]), pa.array(s[:, 1]), batch["y"]], names=["expected", "most", "y"])
    return run


def _curve(s: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Logistic regression by Newton steps; slopes are kept from falling below zero."""
    x = np.column_stack([np.ones(len(s)), s])
    w = np.array([0.0, 0.1, 0.1])
    ridge = np.diag([1e-3, 0.05, 0.05])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + ridge, x.T @ (p - y) + ridge @ w)
        w = w - np.clip(step, -1, 1)
        w[1:] = np.maximum(w[1:], 0)
        if np.abs(step).max() < 1e-6:
            break
    return w


def train(docs: DataFrame, labels: DataFrame) -> Model:
    """Fit on at most about ``FIT_ROWS`` training rows, a fourth of which calibrates the scores."""
    rows = labelled(docs, labels)
    facts = rows.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum("y"), F.lit(0)).alias("toxic")).first()
    base = facts["toxic"] / facts["n"] if facts["n"] else 0.0
    if not 0 < facts["toxic"] < facts["n"]:
        return Model(np.zeros(WIDTH), np.zeros(3), base)
    spread = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(min(1.0, FIT_ROWS / facts["n"]) * (1 << 20))
    chosen = landed(rows.where(spread).withColumn("calibrates", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(4)) == 0))
    fit = chosen.where("NOT calibrates").select("text", "y")
    known = evidence(fit, base)
    start = np.zeros(WIDTH)
    start[BIAS] = -4.0
    weights = minimised(lambda w: _loss_and_gradient(fit, w, known), start) if len(known.hashes) else start
    check = chosen.where("calibrates").select("text", "y")
    seen = check.mapInArrow(_summary_batches(weights), "expected double, most double, y int").toPandas()
    if seen["y"].nunique() < 2:
        seen = fit.mapInArrow(_summary_batches(weights), "expected double, most double, y int").toPandas()
    if seen["y"].nunique() < 2:
        return Model(weights, np.zeros(3), base)
    return Model(weights, _curve(seen[["expected", "most"]].to_numpy(), seen["y"].to_numpy(float)), base)


# Scores


def _code_points(raw: np.ndarray) -> np.ndarray:
    """Code points in front of each byte (one more at the end)."""
    out = np.zeros(len(raw) + 1, np.int64)
    np.cumsum((raw & 0xC0) != 0x80, out=out[1:])
    return out


def _spans(found: Tokens, marginal: np.ndarray, offsets: np.ndarray, least: float) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, end) of runs of toxic words; start and end in code points of the text."""
    at = np.flatnonzero(marginal >= least)
    if not len(at):
        return at, at, at
    owner = np.searchsorted(found.first, at, "right") - 1
    new = np.ones(len(at), bool)
    new[1:] = (np.diff(at) > 1) | (np.diff(owner) > 0)
    head = np.flatnonzero(new)
    tail = np.append(head[1:], len(at)) - 1
    chars = _code_points(found.raw)
    text = owner[head]
    zero = chars[offsets[text]]
    return text, chars[found.spans[0, at[head]]] - zero, chars[found.spans[1, at[tail]]] - zero


def _score_batches(model: Model, least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in words.parts(batches):
            found = tokens(batch["text"])
            if model.curve.any():
                marginal = forward_backward(_emissions(found, model.weights), found.first, model.weights).marginal
                s = _summaries(marginal, found.first)
                score = 1 / (1 + np.exp(-np.clip(model.curve[0] + s @ model.curve[1:], -30, 30)))
            else:
                marginal, score = np.zeros(len(found.said)), np.full(batch.num_rows, model.base)
            offsets = words.text_bytes(batch["text"])[1]
            text, start, end = _spans(found, marginal, offsets, least)
            at = np.searchsorted(text, np.arange(batch.num_rows + 1)).astype(np.int32)
            spans = pa.StructArray.from_arrays(
                [pa.array(start.astype(np.int64)), pa.array(end.astype(np.int64))], names=["start", "end"])
            yield pa.RecordBatch.from_arrays(
                [batch["doc_id"], pa.array(score), pa.ListArray.from_arrays(pa.array(at), spans)],
                names=["doc_id", "score", "spans"])
    return run


def scored(docs: DataFrame, labels: DataFrame, least: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: doc_id, held_out, score, predicted, and ``spans``: offsets (code points, end
    behind the last one) of words whose marginal is ``least`` or more."""
    model = train(docs, labels)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    out = rows.mapInArrow(
        _score_batches(model, least), "doc_id long, score double, spans array<struct<start:long,end:long>>")
    return out.select(
        "doc_id", F.coalesce(remainder(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "spans")
