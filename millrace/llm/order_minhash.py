"""Near-duplicate texts by Order MinHash.

Items of a text are its windows of five words (lower-cased, see ``words``), each labelled with how
often it stood before. A sketch takes the ``picks`` items with the smallest hashes and keeps them in
text order, so texts share it only where the same passages stand in the same order. Texts that share
one of ``sketches`` sketches are candidates. A candidate pair is verified by aligning the two
window sequences: the longest chain of common windows that runs forward in both texts, inside the
band that the threshold allows. Similarity is chain / (windows of a + windows of b - chain).

Defined results: null texts, empty texts and texts without a word link with nothing. A text of 1-4
words has one window. Texts with equal word sequences are one class and are compared once.
Rows without ``doc_id`` link with nothing. Of repeated rows of one ``doc_id`` one is kept.
"""
from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common, words

SIMILARITY, SKETCHES, PICKS = 0.8, 16, 3
# Finer sketches, by the size of a text in windows; sizes in both ranges get both, so that two texts of similar size always
# have one kind in common. Two texts of similarity 0.8 share one of them with probability 0.9999 at least.
FINE = ((0, 30, 32, 3), (24, 2**31, 64, 8))  # least and most windows, sketches, picks
HUBS = 3  # of a finer bucket
TILE = 512  # rows of one side of a block of signature comparisons
SIGNATURE = 1024  # bytes of a signature
SLACK = 0.06  # an estimate from SIGNATURE places errs by less than this with 4.5 standard deviations

_SKETCHED = "doc long, text_key binary, n int, sketches array<long>"
_ITEMS = "doc long, text_key binary, items binary"


def sketch(items: np.ndarray, sketches: int, picks: int) -> np.ndarray:
    """Order MinHash sketches of one text; fewer items than ``picks`` give one sketch of all."""
    n = len(items)
    if n <= picks:
        at = np.arange(n)[None, :]
    else:
        salts = words.mix(np.arange(1, sketches + 1, dtype=np.uint64) * np.uint64(words._BASE)) | np.uint64(1)
        at = np.empty((sketches, picks), dtype=np.int64)
        step = max(1, 400_000 // n)
        for lo in range(0, sketches, step):
            h = items[None, :] * salts[lo : lo + step, None]
            h ^= h >> np.uint64(29)
            h *= salts[lo : lo + step, None]
            at[lo : lo + step] = np.argpartition(h, picks - 1, axis=1)[:, :picks]
        at.sort(axis=1)
    out = np.arange(len(at), dtype=np.uint64)
    for k in range(at.shape[1]):
        out = words.mix(out * np.uint64(words._BASE) + items[at[:, k]])
    return out.view(np.int64)


def _tokenised(batches: Iterator[pa.RecordBatch]):
    """(batch, word hashes, labelled windows, first window of each text, text keys) of small parts."""
    for batch in words.parts(batches):
        found = words.hashed_words(batch["text"])
        wins = words.windows(found)
        keys = [
            hashlib.blake2b(found.hashes[a:b].tobytes(), digest_size=16).digest() if b > a else None
            for a, b in zip(found.first[:-1], found.first[1:], strict=True)]
        yield batch, words.labelled(wins), wins.first, keys


def _sketch_batches(sketches: int, picks: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, items, first, keys in _tokenised(batches):
            drawn = [sketch(items[a:b], sketches, picks) if b > a else np.zeros(0, np.int64)
                     for a, b in zip(first[:-1], first[1:], strict=True)]
            ends = np.concatenate([[0], np.cumsum([len(x) for x in drawn])]).astype(np.int32)
            flat = pa.array(np.concatenate(drawn) if drawn else [], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [batch["doc"], pa.array(keys, pa.binary()), pa.array(np.diff(first).astype(np.int32)),
                 pa.ListArray.from_arrays(pa.array(ends), flat)], names=["doc", "text_key", "n", "sketches"])
    return run


def _item_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch, items, first, keys in _tokenised(batches):
        short = items.astype(np.uint32)
        blobs = [short[a:b].tobytes() for a, b in zip(first[:-1], first[1:], strict=True)]
        yield pa.RecordBatch.from_arrays(
            [batch["doc"], pa.array(keys, pa.binary()), pa.array(blobs, pa.binary())], names=["doc", "text_key", "items"])


def similarity(a: np.ndarray, b: np.ndarray, least: float = 0.0) -> float:
    """Share of windows in the best forward chain; 0 where it cannot reach ``least``."""
    if not len(a) or not len(b):
        return 0.0
    _, i, j = np.intersect1d(a, b, return_indices=True)
    reach = len(i) / (len(a) + len(b) - len(i))
    if reach < least or not len(i):
        return 0.0
    band = (1.0 - least) * (len(a) + len(b)) + 1
    near = np.abs(i - j) <= band
    i, j = i[near], j[near]
    steps = j[np.argsort(i, kind="stable")]
    if len(steps) and (np.diff(steps) <= 0).any():
        tails: list[int] = []
        for x in steps.tolist():
            k = bisect_left(tails, x)
            tails[k : k + 1] = [x]
        chain = len(tails)
    else:
        chain = len(steps)
    return chain / (len(a) + len(b) - chain)


def _verify_batches(least: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sims = [
                similarity(np.frombuffer(x, np.uint32), np.frombuffer(y, np.uint32), least)
                for x, y in zip(batch["left_items"].to_pylist(), batch["right_items"].to_pylist(), strict=True)
            ]
            keep = np.array([s >= least for s in sims], dtype=bool)
            yield pa.RecordBatch.from_arrays(
                [batch["a"].filter(pa.array(keep)), batch["b"].filter(pa.array(keep)),
                 pa.array(np.array(sims, dtype=float)[keep])], names=["a", "b", "similarity"])
    return run


def _verified(pairs: DataFrame, texts: DataFrame, least: float) -> DataFrame:
    """Pairs (a, b) with similarity of at least ``least``. Items travel only for texts in a pair."""
    left = texts.select(F.col("doc").alias("a"), F.col("items").alias("left_items"))
    right = texts.select(F.col("doc").alias("b"), F.col("items").alias("right_items"))
    joined = pairs.join(left, "a").join(right, "b").select("a", "b", "left_items", "right_items")
    return common.landed(joined.mapInArrow(common.released(_verify_batches(least)), "a long, b long, similarity double"))


def _mixed(members: DataFrame) -> DataFrame:
    """(bucket, size, largest) of buckets with several components; ``largest`` is the component with most members."""
    sizes = members.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("k"))
    per_bucket = sizes.groupBy("bucket").agg(
        F.sum("k").alias("size"), F.count(F.lit(1)).alias("parts"), F.max_by("component", F.struct("k", "component")).alias("largest"))
    return per_bucket.where("parts > 1").drop("parts")


def _hub_pairs(members: DataFrame, least: float, order: Column, more: int = 0) -> DataFrame:
    """Each member of a mixed bucket with the bucket's hubs: the member that comes first by ``order`` and ``more`` others from
    outside of the largest component, by hash. One row per member and hub."""
    mixed = _mixed(members).select("bucket", "largest")
    rows = members.join(mixed, "bucket")

    def first(by: Column) -> Column:
        return F.struct(by.alias("order"), "doc", "n", "component")

    outside = [
        F.min(F.when(F.col("component") != F.col("largest"), first(F.xxhash64("doc", F.lit(i))))) for i in range(more)]
    found = rows.groupBy("bucket").agg(F.array(F.min(first(order.cast("long"))), *outside).alias("hubs"))
    hubs = found.select("bucket", F.explode(F.array_compact("hubs")).alias("hub")).select(
        "bucket", F.col("hub.doc").alias("hub"), F.col("hub.n").alias("hub_n"), F.col("hub.component").alias("hub_component"))
    near = F.least("n", "hub_n") >= F.lit(least) * F.greatest("n", "hub_n")
    return members.join(hubs, "bucket").where("component <> hub_component").where(near).select(
        F.least("doc", "hub").alias("a"), F.greatest("doc", "hub").alias("b")).distinct()


def signature(items: np.ndarray) -> np.ndarray:
    """One byte for each of SIGNATURE groups of items: from the group's smallest hash; 0 for none."""
    h = words.mix(items.astype(np.uint64) + np.uint64(0x5851F42D4C957F2D))
    place = (h & np.uint64(SIGNATURE - 1)).astype(np.int64)
    rest = h >> np.uint64(10)
    least = np.full(SIGNATURE, np.iinfo(np.uint64).max, dtype=np.uint64)
    np.minimum.at(least, place, rest)
    out = (words.mix(least) % np.uint64(255)).astype(np.uint8) + np.uint8(1)
    out[least == np.iinfo(np.uint64).max] = 0
    return out


def _fine_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Finer sketches and signatures of texts in shared buckets."""
    for batch in batches:
        drawn, signed = [], []
        for x in batch["items"].to_pylist():
            items = np.frombuffer(x, np.uint32)
            wide = words.mix(items.astype(np.uint64))
            kinds = [sketch(wide, count, picks) ^ picks for lo, hi, count, picks in FINE if lo <= len(items) <= hi]
            drawn.append(np.unique(np.concatenate(kinds)))
            signed.append(signature(items).tobytes())
        ends = np.concatenate([[0], np.cumsum([len(x) for x in drawn])]).astype(np.int32)
        flat = pa.array(np.concatenate(drawn) if drawn else [], pa.int64())
        yield pa.RecordBatch.from_arrays(
            [batch["doc"], batch["n"], pa.ListArray.from_arrays(pa.array(ends), flat), pa.array(signed, pa.binary())],
            names=["doc", "n", "sketches", "signature"])


def _drawn(sketches: list[list[int]], doc: np.ndarray) -> np.ndarray:
    """Sketches (sorted) as a matrix; places that a text with fewer lacks hold values no other text has."""
    width = max(map(len, sketches), default=1)
    out = -(doc[:, None] * width + np.arange(width)[None, :]) - 1
    for i, x in enumerate(sketches):
        out[i, : len(x)] = x
    return out


def _tile_pairs(least: float):
    floor = least - SLACK

    def run(table: pa.Table) -> pa.Table:
        doc, comp = table["doc"].to_numpy(), table["component"].to_numpy()
        n, side = table["n"].to_numpy(), table["side"].to_numpy()
        sig = np.frombuffer(b"".join(table["signature"].to_pylist()), np.uint8).reshape(-1, SIGNATURE)
        drawn = _drawn(table["sketches"].to_pylist(), doc)
        bucket = table["bucket"][0].as_py() if len(doc) else 0
        left = np.flatnonzero(side < 2)  # side 0: both, 1: left only, 2: right only
        right = np.flatnonzero(side != 1)
        filled = sig[right] > 0
        a, b = [], []
        for x in left:
            fit = (comp[right] != comp[x]) & (np.minimum(n[right], n[x]) >= least * np.maximum(n[right], n[x]))
            at = np.flatnonzero(fit)
            # a pair is looked at in the smallest bucket that it shares only
            if len(at):
                shared = np.isin(drawn[right[at]], drawn[x])
                at = at[np.where(shared, drawn[right[at]], np.iinfo(np.int64).max).min(axis=1) == bucket]
            if not len(at):
                continue
            same = ((sig[right[at]] == sig[x]) & filled[at]).sum(axis=1)
            either = (filled[at] | (sig[x] > 0)).sum(axis=1)
            ok = same >= floor * either
            hit = right[at[ok]]
            a.append(np.minimum(doc[hit], doc[x]))
            b.append(np.maximum(doc[hit], doc[x]))
        ab = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0) if a else np.zeros((0, 2), np.int64)
        return pa.table({"a": pa.array(ab[:, 0], pa.int64()), "b": pa.array(ab[:, 1], pa.int64())})
    return run


def _tiled_pairs(members: DataFrame, fine: DataFrame, least: float) -> DataFrame:
    """All pairs of a bucket between different components whose signatures do not rule them out.

    Only members outside of the largest component ask; a pair of different components has such a member. A bucket is cut into tiles
    of about ``TILE`` members, which stay where they are, and those who ask are sent to all tiles, ``TILE`` at a time.
    """
    rows = members.join(_mixed(members), "bucket").withColumn("asks", F.col("component") != F.col("largest"))
    asking = rows.where("asks").groupBy("bucket").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("shifts"))
    rows = common.landed(rows.join(asking, "bucket").withColumn("tiles", F.ceil(F.col("size") / TILE).cast("int")))
    tile = F.pmod(F.xxhash64("doc", F.lit(7)), "tiles").cast("int")
    shift = F.pmod(F.xxhash64("doc", F.lit(8)), "shifts").cast("int")
    zero = F.lit(0)
    stay = rows.select("bucket", "doc", "component", tile.alias("i"), F.explode(F.sequence(zero, F.col("shifts") - 1)).alias("j"), F.lit(2).alias("side"))
    ask = rows.where("asks").select(
        "bucket", "doc", "component", F.explode(F.sequence(zero, F.col("tiles") - 1)).alias("i"), shift.alias("j"), F.lit(1).alias("side"))
    tiles = stay.unionByName(ask).join(fine, "doc")
    return tiles.groupBy("bucket", "i", "j").applyInArrow(_tile_pairs(least), "a long, b long").distinct()


def _rejoined(component: DataFrame, found: DataFrame) -> DataFrame:
    """Components after further links (a, b): only links between components are followed."""
    def side(name: str) -> DataFrame:
        return component.select(F.col("doc").alias(name), F.col("component").alias(f"c{name}"))

    between = found.select("a", "b").join(side("a"), "a").join(side("b"), "b").where("ca <> cb")
    joined = common.components(between.select(F.col("ca").alias("a"), F.col("cb").alias("b")).distinct())
    moved = joined.select(F.col("node").alias("component"), F.col("component").alias("onto"))
    return common.landed(component.join(moved, "component", "left").select("doc", F.coalesce("onto", "component").alias("component")))


def near_duplicates(
    docs: DataFrame, similarity: float = SIMILARITY, sketches: int = SKETCHES, picks: int = PICKS,
) -> DataFrame:
    """One row per row of ``docs`` (``doc_id``, ``text``): doc_id, class_id (smallest doc_id with the
    same words), component_id (smallest doc_id reachable by links), kept (one row per component).

    Buckets of any size are handled. Members are compared with the smallest of their bucket. Texts that are still in a bucket
    with others are sketched again, finer, so that texts which merely share a passage part; there they are compared with ``HUBS``
    hubs: the text that shares most, and others from outside of the largest component. What is still apart afterwards is compared with all others of its finer bucket.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc"), "text")
    sketched = common.landed(rows.mapInArrow(common.released(_sketch_batches(sketches, picks)), _SKETCHED))
    known = sketched.where("doc IS NOT NULL")
    classes = common.landed(known.where("text_key IS NOT NULL").groupBy("text_key").agg(F.min("doc").alias("class_id")))
    # A doc_id with several texts is compared by the first of them that it stands for.
    reps = common.landed(known.join(classes, "text_key").where("doc = class_id").groupBy("doc").agg(
        F.min("text_key").alias("text_key"), F.min_by("n", "text_key").alias("n"), F.min_by("sketches", "text_key").alias("sketches")))
    drawn = reps.select("doc", "n", F.explode("sketches").alias("bucket"))
    shared = drawn.groupBy("bucket").count().where("count > 1").select("bucket")
    members = common.landed(drawn.join(shared, "bucket"))
    # Windows are needed for texts in a shared bucket only: those texts are read again.
    needed = common.landed(reps.select("doc", "text_key").join(members, "doc", "left_semi"))
    texts = common.landed(
        rows.join(needed.select("doc"), "doc", "left_semi").mapInArrow(common.released(_item_batches), _ITEMS)
        .join(needed, ["doc", "text_key"], "left_semi").dropDuplicates(["doc"]).select("doc", "items"))

    component = common.landed(members.select("doc").distinct().withColumn("component", F.col("doc")))

    def after(pairs: DataFrame) -> DataFrame:
        return _rejoined(component, _verified(common.landed(pairs), texts, similarity))

    component = after(_hub_pairs(members.join(component, "doc"), similarity, F.lit(0)))
    apart = members.join(component, "doc")
    apart = apart.join(_mixed(apart).select("bucket"), "bucket", "left_semi").select("doc", "n").distinct()
    fine = common.landed(texts.join(apart, "doc").select("doc", "n", "items").mapInArrow(
        common.released(_fine_batches), "doc long, n int, sketches array<long>, signature binary"))
    drawn = common.landed(fine.select("doc", "n", F.explode("sketches").alias("bucket")))
    sizes = drawn.groupBy("bucket").agg(F.count(F.lit(1)).alias("size")).where("size > 1")
    shares = drawn.join(sizes, "bucket").groupBy("doc").agg(F.sum("size").alias("share"))
    closer = common.landed(drawn.join(sizes.select("bucket"), "bucket", "left_semi").join(shares, "doc"))
    component = after(_hub_pairs(closer.join(component, "doc"), similarity, -F.col("share"), HUBS - 1))
    component = after(_tiled_pairs(closer.drop("share").join(component, "doc"), fine, similarity))

    own = known.select("doc", "text_key").join(classes, "text_key", "left")
    placed = own.join(component.withColumnRenamed("doc", "class_id"), "class_id", "left").select(
        F.col("doc").alias("doc_id"), F.coalesce("class_id", "doc").alias("class_id"),
        F.coalesce("component", "class_id", "doc").alias("component_id"))
    turn = F.row_number().over(Window.partitionBy("doc_id").orderBy("component_id", "class_id"))
    return placed.select("*", ((F.col("doc_id") == F.col("component_id")) & (turn == 1)).alias("kept")).unionByName(
        sketched.where("doc IS NULL").select(
            F.col("doc").alias("doc_id"), F.col("doc").alias("class_id"), F.col("doc").alias("component_id"),
            F.lit(True).alias("kept")))


def one_of_each(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs`` that near_duplicates keeps, with all their columns."""
    verdict = near_duplicates(docs, **options).where("doc_id IS NOT NULL")
    by_id = verdict.groupBy("doc_id").agg(F.max("kept").alias("kept"), F.count(F.lit(1)).alias("times"))
    marked = common.landed(by_id.where("NOT kept OR times > 1").select(F.col("doc_id").alias("_id"), "kept"))
    def own(rows: DataFrame, how: str) -> DataFrame:
        return docs.alias("d").join(rows.alias("m"), F.col("d.doc_id") == F.col("m._id"), how)

    single = own(marked, "left_anti")
    repeated = own(marked.where("kept"), "left_semi")
    return single.unionByName(repeated.dropDuplicates(["doc_id"]))
