"""Merkle manifest of a table: leaves, subroots per language, one root, and a proof per row.

Every row is a leaf. Leaves of one language ascend by doc_id; two consecutive nodes at a time become the hash of
their digests, a last one without partner the hash of itself, until one node is left. The subroots, in
order of the language, go on in the same way.

Levels are built by windows. A block of ``2 ** LEVELS`` consecutive nodes of a run is one window partition, so a
language with a third of all rows is spread over as many partitions as it has blocks. Inside a block, lag and
lead columns with the fixed offset of a level, masked by the node's slot and by the run's length, supply the sibling;
the first-child row hashes the parent, which is handed on to the rows behind it. The blocks' tops are the
nodes of the next tier, a ``2 ** LEVELS``-th as many rows. Paths are joined downwards by (run, block): no key of
these joins has more rows than a block.

Defined results: rows without doc_id come first in their run and are never tampered with; rows of equal doc_id are
ordered by their leaf (equal leaves are interchangeable); no language is a run of its own, before all others; a run of one leaf
is its own subroot; a proof without siblings is the hash of the empty text; an empty table gives no rows. Only
doc_id, source, lang, n_chars and text are read.
"""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import landed

LEVELS = 8  # levels that one window partition builds: blocks of 256 nodes
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


def digest(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_text(fields: Sequence[Column]) -> Column:
    """What is hashed for a row: per field ``-`` for null, else its bytes' count, a colon and the value."""
    texts = [f.cast("string") for f in fields]
    return F.concat(*[
        F.when(t.isNull(), "-").otherwise(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t)) for t in texts])


def is_tampered(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 7 == 0, F.lit(False))


def leaves(docs: DataFrame) -> DataFrame:
    """(doc_id, run, node, tampered): ``tampered`` is the leaf with n_chars + 1, where the row is tampered with."""
    fields = [F.col(name) for name in FIELDS]
    wrong = [F.col("n_chars").cast("long") + 1 if name == "n_chars" else F.col(name) for name in FIELDS]
    changed = is_tampered(F.col("doc_id")) & F.col("n_chars").isNotNull()
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.concat(F.lit("+"), "lang"), F.lit("")).alias("run"),  # no language sorts first
        digest(leaf_text(fields)).alias("node"),
        F.when(changed, digest(leaf_text(wrong))).alias("tampered"))


def ranked(rows: DataFrame, order: Sequence[str]) -> DataFrame:
    """Add ``place`` (0, 1, ... within each ``run`` by ``order``) and ``size`` (rows of the run).

    Rows are dealt to tasks by range and numbered there; only counts per task and run are added up across tasks.
    """
    spread = rows.repartitionByRange("run", *order).sortWithinPartitions("run", *order)
    numbered = landed(spread.withColumn("at", F.monotonically_increasing_id()))
    numbered = numbered.withColumn("part", F.shiftright("at", 33))
    parts = numbered.groupBy("run", "part").agg(F.min("at").alias("start"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("run").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select(
        "run", "part", "start", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
        F.sum("n").over(Window.partitionBy("run")).alias("size"))
    found = numbered.join(parts, ["run", "part"])
    return found.withColumn("place", F.col("at") - F.col("start") + F.col("before")).drop("at", "part", "start", "before")


def tier(nodes: DataFrame) -> DataFrame:
    """Build up to ``LEVELS`` levels over (run, place, size, node). Adds ``block``, ``top`` (the block's node after these
    levels) and ``path`` (the sibling at every level, null where there is none). Other columns pass through."""
    ordered = Window.partitionBy("run", "block").orderBy("place")
    so_far = ordered.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    place, size, top = F.col("place"), F.col("size"), F.col("top")
    rows = nodes.withColumns({"block": F.shiftright("place", LEVELS), "top": F.col("node")})
    for level in range(LEVELS):
        width = 1 << level
        number = F.shiftright("place", level)
        # The partner's leaf of the same rank may lie behind the run's end; the run's last leaf is the partner's then.
        after = F.coalesce(F.lead("top", width).over(ordered), F.last("top").over(whole))
        partner = F.when(number % 2 == 1, F.lag("top", width).over(ordered)).when((number + 1) * width < size, after)
        rows = rows.withColumn(f"s{level}", F.when(size > width, partner))
        first = (place % (2 * width) == 0) & (size > width)
        rows = rows.withColumn("parent", F.when(first, digest(F.concat(top, F.coalesce(F.col(f"s{level}"), F.lit(""))))))
        rows = rows.withColumn(
            "top", F.when(size > width, F.last("parent", ignorenulls=True).over(so_far)).otherwise(top))
    siblings = [f"s{level}" for level in range(LEVELS)]
    return rows.withColumn("path", F.array(*siblings)).drop("parent", *siblings)


def climb(nodes: DataFrame) -> list[DataFrame]:
    """Tiers from the leaves to one top per run. The tops of a tier are written; its rows are made
    anew where paths are joined, which moves narrow rows instead of whole paths."""
    tiers = [tier(nodes)]
    longest = nodes.agg(F.max("size")).first()[0] or 0
    while longest > 1 << LEVELS:
        tops = tiers[-1].where(F.col("place") % (1 << LEVELS) == 0)
        tops = landed(tops.select(
            "run", F.col("block").alias("place"),
            F.ceil(F.col("size") / F.lit(1 << LEVELS)).cast("long").alias("size"), F.col("top").alias("node")))
        tiers.append(tier(tops))
        longest = -(-longest // (1 << LEVELS))
    return tiers


def tops(tiers: list[DataFrame]) -> DataFrame:
    """(run, node): what remains of every run."""
    return tiers[-1].where("place = 0").select("run", F.col("top").alias("node"))


def descend(tiers: list[DataFrame], above: DataFrame) -> DataFrame:
    """Rows of the first tier with whole paths; ``above`` has one row per run, whose columns every row gets."""
    facts = [c for c in above.columns if c != "run"]
    up = tiers[-1].join(above, "run")
    for below in reversed(tiers[:-1]):
        higher = up.select("run", F.col("place").alias("block"), F.col("path").alias("onward"), *facts)
        up = below.join(higher, ["run", "block"]).withColumn("path", F.concat("path", "onward")).drop("onward")
    return up.drop("block", "top")


def folded(node: Column, place: Column, size: Column, path: Column) -> Column:
    """The top that a node and its siblings lead to."""
    def step(at: Column, sibling: Column) -> Column:
        pair = F.when(at["place"] % 2 == 1, F.concat(sibling, at["node"])).otherwise(
            F.concat(at["node"], F.coalesce(sibling, F.lit(""))))
        return F.struct(
            F.when(at["size"] > 1, digest(pair)).otherwise(at["node"]).alias("node"),
            F.shiftright(at["place"], 1).alias("place"), F.shiftright(at["size"] + 1, 1).alias("size"))

    start = F.struct(node.alias("node"), place.alias("place"), size.alias("size"))
    return F.aggregate(path, start, step)["node"]


def manifest(docs: DataFrame) -> DataFrame:
    """One row per row of ``docs``: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified, and the siblings
    themselves as ``proof`` (in the order of levels, without the levels that have none)."""
    of_rows = climb(ranked(leaves(docs), ["doc_id", "node"]))
    subroots = tops(of_rows).select(F.lit("").alias("run"), F.col("run").alias("name"), "node")
    of_runs = climb(ranked(subroots, ["name"]))
    roots = descend(of_runs, tops(of_runs).withColumnRenamed("node", "root"))
    above = landed(roots.select(
        F.col("name").alias("run"), F.col("node").alias("subroot"), F.col("place").alias("r_place"),
        F.col("size").alias("r_size"), F.col("path").alias("r_path"), "root"))
    rows = descend(of_rows, above)
    start = F.coalesce("tampered", "node")
    back = folded(start, F.col("place"), F.col("size"), F.col("path"))
    back = folded(back, F.col("r_place"), F.col("r_size"), F.col("r_path"))
    proof = F.array_compact(F.concat("path", "r_path"))
    out = rows.select(
        "doc_id", F.col("node").alias("leaf"), "subroot", "root", proof.alias("proof"), back.alias("folded_root"))
    return out.select(
        "doc_id", "leaf", "subroot", "root", digest(F.array_join("proof", "")).alias("proof_sha256"), "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"), "proof")
