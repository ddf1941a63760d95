"""Mixing sources to target weights by Pfair scheduling, in DataFrame operations only.

Rows of a source are cut into blocks. With weight w, block k of a source may go out from slot
floor(k / w) on (release) and must go out before slot ceil((k + 1) / w) (deadline). In every slot the
released block with the earliest deadline goes out, so after any number of slots t each source has
sent between w t - 1 and w t + 1 blocks, exclusively. Weights are whole parts of ``period`` slots; the schedule repeats
after a period, so it is computed once per period from the weights alone and joined to the blocks.

Every block of a weighted source has a slot. A source that is used up leaves the schedule: its later slots are passed
over, and the others go on at their weights to one another, so slots order all rows and drop none (``ordered``). The column ``in_mix``
marks the rows before the first slot that is passed over: up to there the weights of all sources hold.

Defined results: a null source is a source of its own; a source without a positive weight has no slot; a weighted source
without rows is left out; rows without doc_id and repeated rows count as rows; an empty table gives no rows.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from . import common

BLOCK_ROWS, PERIOD, TEMPERATURE = 64, 4096, 0.7
SOURCES = 100_000  # up to so many sources their small table is broadcast; beyond, it is joined by shuffle


def tempered(docs: DataFrame, temperature: float = TEMPERATURE) -> DataFrame:
    """Target weights (source, weight): row counts to a power, so that large sources weigh less than their share."""
    return docs.groupBy("source").agg(F.pow(F.count(F.lit(1)).cast("double"), F.lit(temperature)).alias("weight"))


def parts_of_period(weights: DataFrame, period: int) -> DataFrame:
    """(source, place, parts): whole parts that add up to the period. One row per source meets in one task:
    sources, not rows. A source gets at least one part; the period grows to hold them."""
    kept = weights.where("weight > 0")
    by_name = Window.orderBy(F.col("source").asc_nulls_first())
    everything = Window.partitionBy()
    up_to = by_name.rowsBetween(Window.unboundedPreceding, 0)
    # One part is set aside for each source, the rest is dealt by rounded running sums.
    rest = F.greatest(F.lit(period), 4 * F.count(F.lit(1)).over(everything)) - F.count(F.lit(1)).over(everything)
    share = F.col("weight") / F.sum("weight").over(everything)
    spare = F.greatest(share * (rest + F.count(F.lit(1)).over(everything)) - 1, F.lit(0.0))
    dealt = kept.select("source", (F.row_number().over(by_name) - 1).alias("place"), rest.alias("rest"), spare.alias("spare"))
    run = F.round(F.col("rest") * F.sum("spare").over(up_to) / F.sum("spare").over(everything)).cast("long")
    return dealt.withColumn("_run", run).select(
        "source", "place", (1 + F.col("_run") - F.coalesce(F.lag("_run").over(by_name), F.lit(0))).alias("parts"))


def schedule(parts: DataFrame) -> DataFrame:
    """(place, turn, slot, length): slot of each source's blocks within one period.

    Releases and deadlines come from the weights by arithmetic, in parallel. What has to be done in order is the
    choice per slot: the waiting blocks are kept as a sorted list of (deadline, place), packed into one number; every slot merges in what
    it releases and takes the first. The list holds one block per source at most.
    """
    everything = Window.partitionBy()  # one row per source
    sized = parts.select(
        "place", "parts", F.sum("parts").over(everything).alias("length"), F.count(F.lit(1)).over(everything).alias("sources"))
    jobs = sized.select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("turn"))
    jobs = jobs.select(
        "length", "sources", F.expr("turn * length div parts").alias("release"),
        F.expr("((turn + 1) * length + parts - 1) div parts * sources + place").alias("due"))
    released = jobs.groupBy("length", "sources", "release").agg(F.collect_list("due").alias("due"))
    slots = sized.select("length", "sources").distinct().select("length", "sources", F.explode(F.sequence(F.lit(0).cast("long"), F.col("length") - 1)).alias("slot"))
    per_slot = slots.join(released.select(F.col("release").alias("slot"), "due"), "slot", "left").groupBy("length", "sources").agg(
        F.transform(F.sort_array(F.collect_list(F.struct("slot", "due"))), lambda s: F.coalesce(
            s["due"], F.array().cast("array<bigint>"))).alias("x"))
    step = (
        "transform(array(sort_array(acc.waiting || due)), "
        "w -> named_struct('waiting', slice(w, 2, size(w)), 'out', acc.out || array(w[0])))[0]")
    nothing = "cast(array() AS array<bigint>)"
    folded = per_slot.select("length", "sources", F.expr(
        f"aggregate(x, named_struct('waiting', {nothing}, 'out', {nothing}), (acc, due) -> {step}, acc -> acc.out)").alias("out"))
    taken = folded.select("length", "sources", F.posexplode("out").alias("slot", "due"))
    taken = taken.select(F.expr("cast(due % sources AS int)").alias("place"), F.col("slot").cast("long").alias("slot"), "length")
    return taken.select(
        "place", (F.row_number().over(Window.partitionBy("place").orderBy("slot")) - 1).alias("turn"), "slot", "length")


def _plan(docs: DataFrame, weights: DataFrame | None, block_rows: int, period: int, temperature: float):
    """Per source with rows: its rows, parts and slot of the end of the mix; and the schedule."""
    counts = docs.groupBy("source").agg(F.count(F.lit(1)).alias("rows"))
    if weights is None:
        weights = counts.select("source", F.pow(F.col("rows").cast("double"), F.lit(temperature)).alias("weight"))
    present = weights.alias("w").join(counts.alias("c"), F.col("w.source").eqNullSafe(F.col("c.source"))).select("w.source", "w.weight")
    parts = common.landed(parts_of_period(present, period))
    slots = common.landed(schedule(parts))
    sized = counts.alias("c").join(parts.alias("p"), F.col("c.source").eqNullSafe(F.col("p.source"))).select(
        "c.source", "rows", "place", "parts", F.ceil(F.col("rows") / block_rows).cast("long").alias("blocks"))
    missing = _slot(sized.withColumn("block", F.col("blocks")), slots)
    ends = missing.agg(F.min("slot").alias("ends"))
    return common.landed(sized.withColumn("ends", F.lit(ends.first()["ends"]).cast("long"))), slots


def _blocks(ranked: DataFrame, sized: DataFrame, block_rows: int) -> DataFrame:
    """Add parts, place, ends, block and row (within the block) to rows with their rank in the source."""
    columns = [F.col(f"r.{c}") for c in ranked.columns if c != "rank"]
    return ranked.alias("r").join(
        common.bounded(sized, SOURCES).alias("z"), F.col("r.source").eqNullSafe(F.col("z.source")), "left").select(
        *columns, "z.parts", "z.place", "z.ends",
        F.floor(F.col("r.rank") / block_rows).alias("block"), (F.col("r.rank") % block_rows).cast("int").alias("row"))


def _slot(blocks: DataFrame, slots: DataFrame) -> DataFrame:
    """Add ``slot`` to rows with place, parts, block. The schedule has a row per slot of the period, at least four per
    source; beyond ``SOURCES`` sources it is joined by shuffle, on (source, turn)."""
    turn = F.col("l.block") % F.col("l.parts")
    joined = blocks.alias("l").join(
        common.bounded(slots, 4 * SOURCES).alias("s"), (F.col("l.place") == F.col("s.place")) & (turn == F.col("s.turn")))
    return joined.select(
        "l.*", (F.floor(F.col("l.block") / F.col("l.parts")) * F.col("s.length") + F.col("s.slot")).alias("slot"), "s.length")


def mixed(
    docs: DataFrame, weights: DataFrame | None = None, block_rows: int = BLOCK_ROWS,
    period: int = PERIOD, temperature: float = TEMPERATURE,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, source, weight (as scheduled), block, release, deadline,
    slot, place (within the block), in_mix. ``weights``: source, weight; else ``tempered``."""
    rows = common.numbered(docs.select("doc_id", "source"), "_uid")
    sized, slots = _plan(rows, weights, block_rows, period, temperature)
    ranked = common.positions(rows, "source", [F.col("doc_id"), F.col("_uid")], "rank")
    blocks = _blocks(ranked, sized, block_rows)
    dealt = _slot(blocks.where("place IS NOT NULL"), slots)
    first = F.floor(F.col("block") * F.col("length") / F.col("parts"))
    last = F.ceil((F.col("block") + 1) * F.col("length") / F.col("parts"))
    out = dealt.select(
        "doc_id", "source", (F.col("parts") / F.col("length")).alias("weight"), "block", first.alias("release"),
        last.alias("deadline"), "slot", F.col("row").alias("place"), (F.col("slot") < F.col("ends")).alias("in_mix"))
    none = F.lit(None)
    return out.unionByName(blocks.where("place IS NULL").select(
        "doc_id", "source", F.lit(0.0).alias("weight"), "block", none.cast("long").alias("release"),
        none.cast("long").alias("deadline"), none.cast("long").alias("slot"), F.col("row").alias("place"),
        F.lit(False).alias("in_mix")))


def ordered(
    docs: DataFrame, weights: DataFrame | None = None, block_rows: int = BLOCK_ROWS,
    period: int = PERIOD, temperature: float = TEMPERATURE,
) -> DataFrame:
    """All rows of ``docs`` with a weighted source, with all their columns, and ``mix_slot`` and ``mix_row``: their place in
    the order of the mix (columns of these names are replaced). Only sources that are given no positive weight are left out.

    The order is found on numbered narrow rows; texts are shuffled once, by row number, to meet it."""
    plain = [c for c in docs.columns if c not in ("mix_slot", "mix_row")]
    whole = common.numbered(docs.select(F.struct(*(F.col(f"`{c}`") for c in plain)).alias("doc")), "_uid")
    rows = whole.select("_uid", "doc.doc_id", "doc.source")
    sized, slots = _plan(rows, weights, block_rows, period, temperature)
    ranked = common.positions(rows, "source", [F.col("doc_id"), F.col("_uid")], "rank")
    dealt = _slot(_blocks(ranked, sized, block_rows).where("place IS NOT NULL"), slots)
    return whole.join(dealt.select("_uid", F.col("slot").alias("mix_slot"), F.col("row").alias("mix_row")), "_uid").select(
        *(F.col(f"doc.`{c}`").alias(c) for c in plain), "mix_slot", "mix_row")
