"""Benchmark passages in texts, found by spaced seeds, in DataFrame operations only.

A seed hashes the words of a window at fixed places and ignores the others. The masks below are such that any 13
words of which at most two were substituted hold a window of one mask that was not touched. Windows
of texts and of benchmark items with equal hashes are hits. Around a hit, text and item are compared word by word on
the same diagonal: they overlap if some 13 consecutive places agree in at least 80 %. For an item of fewer words all of
its places take the part of the 13. Up to four words none may differ, and the item is its own seed; from 5 to 12 words seeds are four words, under masks that for each length leave some window
untouched wherever the allowed fifth of its words was substituted.

Words are runs of ASCII letters, digits and all non-ASCII characters, after lower().
Defined results: null and empty texts overlap with nothing; items that are null or have no word are
matched by nothing; rows without doc_id and repeated rows are judged by their text like others.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

MASKS = ("100101111", "111011001")
# Masks of short items and the lengths that need them.
SHORT_MASKS = {"1": (1,), "11": (2,), "111": (3,), "1111": (4, 5, 6, 7, 8, 9, 10, 11, 12), "11011": (5, 6, 7, 10, 11), "10111": (5,), "11101": (5,)}
OVERLAP, SHARE = 13, 0.8
ITEM_WINDOWS = 1_000_000  # benchmark windows broadcast at once; a larger benchmark is taken in several turns
ITEMS = 50_000  # items (and 50 times as many words) up to which their words are broadcast


def words_of(text: Column) -> Column:
    parts = F.split(F.lower(F.coalesce(text, F.lit(""))), r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    return F.filter(parts, lambda w: w != "")


def _hash(words: Column, at: Column, number: int, mask: str) -> Column:
    """Hash of the window at ``at``; null where it does not fit."""
    picked = [F.get(words, at + k) for k, bit in enumerate(mask) if bit == "1"]
    return F.when((at >= 0) & (at + len(mask) <= F.size(words)), F.xxhash64(F.lit(number), *picked))


def _windows(words: Column, at: Column, masks: tuple[str, ...]) -> Column:
    made = [F.struct(F.lit(m).alias("mask"), _hash(words, at, m, mask).alias("h")) for m, mask in enumerate(masks)]
    return F.explode(F.array(*made)).alias("w")


def _previous(words: Column, at: Column, mask: Column, masks: tuple[str, ...]) -> Column:
    return reduce(lambda e, m: e.when(mask == m[0], _hash(words, at - 1, m[0], m[1])), enumerate(masks), F.when(F.lit(False), F.lit(0).cast("long")))


def _item_windows(items: DataFrame, masks: tuple[str, ...]) -> DataFrame:
    fits = reduce(
        lambda e, m: e.when(F.col("w.mask") == m[0], F.size("words").isin(*SHORT_MASKS[m[1]]) if m[1] in SHORT_MASKS else F.size("words") >= OVERLAP),
        enumerate(masks), F.when(F.lit(False), F.lit(False)))
    return (
        items.select("item_id", "words", F.posexplode("words").alias("at", "word"))
        .select("item_id", "words", "at", _windows(F.col("words"), F.col("at"), masks))
        .select("item_id", "at", F.col("w.mask").alias("mask"), F.col("w.h").alias("h"),
                _previous(F.col("words"), F.col("at"), F.col("w.mask"), masks).alias("previous"),
                fits.alias("fits"))
        .where("h IS NOT NULL AND fits").drop("fits"))


def _agrees() -> Column:
    """Whether text words ``words`` and item words ``theirs`` overlap around ``pos`` and ``at``."""
    before = F.least(F.col("pos"), F.col("at"), F.lit(OVERLAP))
    after = F.least(F.size("words") - F.col("pos"), F.size("theirs") - F.col("at"), F.lit(2 * OVERLAP + len(MASKS[0])))
    same = F.zip_with(
        F.slice("words", F.col("pos") - before + 1, before + after),
        F.slice("theirs", F.col("at") - before + 1, before + after), lambda x, y: (x == y).cast("int"))
    length = F.least(F.size("theirs"), F.lit(OVERLAP))
    starts = F.when(before + after >= length, F.sequence(F.lit(1), before + after - length + 1)).otherwise(F.array().cast("array<int>"))

    def enough(at: Column) -> Column:
        agreed = F.aggregate(F.slice("same", at, F.col("length")), F.lit(0), lambda s, x: s + x)
        return agreed >= F.ceil(F.col("length") * SHARE)

    return same, length, starts, enough


def overlaps(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """(_key, item_id, pos) of verified overlaps, several per pair possible. ``_key`` is ``row_key``."""
    items = benchmark.select("item_id", words_of(F.col("text")).alias("words")).where(F.size("words") > 0)
    items = common.landed(items)
    facts = items.agg(
        F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.size("words")), F.lit(0)).alias("words"),
        F.collect_set(F.when(F.size("words") < OVERLAP, F.size("words"))).alias("short")).first()
    masks = (*MASKS, *(mask for mask, lengths in SHORT_MASKS.items() if not set(lengths).isdisjoint(facts["short"])))
    theirs = items.select("item_id", F.col("words").alias("theirs"))
    small = facts["n"] <= ITEMS and facts["words"] <= 50 * ITEMS
    seeds = _item_windows(items, masks)
    turns = max(1, -(-facts["words"] * len(masks) // ITEM_WINDOWS))
    texts = docs.select(row_key(), words_of(F.col("text")).alias("words"))
    windows = (
        texts.select("_key", "words", F.posexplode("words").alias("pos", "word"))
        .select("_key", "words", "pos", _windows(F.col("words"), F.col("pos"), masks))
        .select("_key", "words", "pos", F.col("w.mask").alias("mask"), F.col("w.h").alias("h")).where("h IS NOT NULL"))
    found = None
    for turn in range(turns):
        part = seeds.where(F.pmod("h", F.lit(turns)) == turn).select("item_id", "at", "h", "previous")
        hits = windows.join(F.broadcast(part), "h")
        # In a run of hits on one diagonal the first is enough: all words of a longer run agree.
        mine = _previous(F.col("words"), F.col("pos"), F.col("mask"), masks)
        hits = hits.where((mine != F.col("previous")) | mine.isNull() | F.col("previous").isNull())
        joined = hits.join(F.broadcast(theirs) if small else theirs, "item_id")
        same, length, starts, enough = _agrees()
        tested = joined.select("_key", "item_id", "pos", same.alias("same"), length.alias("length"), starts.alias("starts"))
        good = tested.where(F.exists("starts", enough)).select("_key", "item_id", "pos")
        found = good if found is None else found.unionByName(good)
    return found


def row_key() -> Column:
    return F.xxhash64("doc_id", "text").alias("_key")


def contaminated(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, contaminated, items (sorted item_ids), first_word (place of the first
    verified hit; null for none)."""
    found = overlaps(docs, benchmark).groupBy("_key").agg(
        F.sort_array(F.collect_set("item_id")).alias("items"), F.min("pos").alias("first_word"))
    return docs.select("doc_id", row_key()).join(common.landed(found), "_key", "left").select(
        "doc_id", F.col("items").isNotNull().alias("contaminated"),
        F.coalesce("items", F.array().cast("array<long>")).alias("items"), "first_word")


def clean(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that overlap with no benchmark item, with all their columns."""
    bad = common.landed(overlaps(docs, benchmark).select("_key").distinct())
    return docs.alias("d").join(bad.alias("b"), F.xxhash64("d.doc_id", "d.text") == F.col("b._key"), "left_anti")
