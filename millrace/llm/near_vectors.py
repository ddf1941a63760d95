"""Near-duplicate vectors by NN-descent.

Equal vectors of a label are one class and compared once. A first neighbour graph comes from several random
orders: vectors sorted by the signs of random projections are compared within stretches of neighbours
in the order. Each round then joins the neighbours of every vector, and a sample of those that list it, with one
another, and keeps the best ``neighbours`` of each vector. A vector whose whole list is above the threshold is
saturated: its list is too short. For these the list is enlarged to all saturated vectors of the same
label, compared tile by tile; of that enlarged list only the number of links is written, never the pairs, and between tiles
of two components one bond for each linked vector. A tile is the ball around its mean; tiles of two components whose balls are too far apart
for a link are passed over.
A sample of vectors, which grows with the root of their number, is compared with all others to audit recall: the links of a sampled
vector count up to the number that it really has, so a surplus of one hides no loss of another. Below ``recall`` the graph is refined by
another round, and after the last round nothing rests on the lists any more: the tiles of all components are compared, inside of a
component all with all, between components where their balls are close enough for a link.
All links are confirmed in double precision.

Defined results: a vector that is null or empty, has null or non-finite components or zero length, or has a null label
links with nothing; vectors of different length do not link; rows without vec_id link like others but name no component (a component of such rows
only has null); repeated rows are vectors of their own, linked by cosine 1.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from . import common

THRESHOLD, NEIGHBOURS, REVERSE = 0.98, 10, 8
ORDERS, STRETCH, BITS = 4, 128, 24
ROUNDS, MOST_ROUNDS, RECALL = 2, 6, 1.0
BEST = 4  # new neighbours that one local join proposes for a member
TILE = 256
AUDITED = 256, 4096  # least and most sampled vectors of the audit; between them the root of the number of vectors
MARGIN = 1e-5  # single precision is trusted to this; links are confirmed in double precision


def _classes(vectors: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(row, vec_id, node) of all rows, and one row per class: node, grp, weight, unit (float64 bytes)."""
    rows = common.landed(vectors.select(
        F.monotonically_increasing_id().alias("row"), F.col("vec_id").cast("long").alias("vec_id"), "label",
        F.col("embedding").cast("array<double>").alias("vec")))
    inf = F.lit(float("inf"))
    sound = F.forall("vec", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < inf)) & F.exists("vec", lambda x: x != 0)
    usable = rows.where("label IS NOT NULL AND vec IS NOT NULL").where(sound)
    # -0.0 + 0.0 is 0.0, so that equal vectors have equal bytes
    key = F.transform("vec", lambda x: x + F.lit(0.0))
    same = usable.groupBy(F.xxhash64("label", F.size("vec")).alias("grp"), F.col("label"), key.alias("vec")).agg(
        F.min("row").alias("node"), F.count(F.lit(1)).alias("weight"))
    unit = same.select("node", "grp", "weight", "vec").mapInArrow(
        _unit_batches, "node long, grp long, weight long, unit binary")
    classes = common.landed(unit)
    own = usable.select("row", "vec_id", "label", key.alias("vec")).join(
        same.select("label", "vec", "node"), ["label", "vec"]).select("row", "vec_id", "node")
    rest = rows.select("row", "vec_id").join(own.select("row"), "row", "left_anti").withColumn("node", F.lit(None).cast("long"))
    return common.landed(own.unionByName(rest)), classes


def _unit_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        units = []
        for v in batch["vec"]:
            x = np.array(v.as_py(), float)
            x = x / np.abs(x).max()
            units.append((x / np.sqrt(x @ x)).tobytes())
        yield pa.RecordBatch.from_arrays(
            [batch["node"], batch["grp"], batch["weight"], pa.array(units, pa.binary())], names=["node", "grp", "weight", "unit"])


def _matrix(column, dtype) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), dtype).reshape(len(column), -1)


def _code_batches(turn: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = np.zeros(batch.num_rows, np.int64)
            small = []
            for i, raw in enumerate(batch["unit"].to_pylist()):
                x = np.frombuffer(raw, np.float64)
                small.append(x.astype(np.float32).tobytes())
                signs = _directions(turn, len(x)) @ x > 0
                codes[i] = int(signs @ (1 << np.arange(BITS)[::-1]))
            yield pa.RecordBatch.from_arrays(
                [batch["node"], batch["grp"], pa.array(codes), pa.array(small, pa.binary())], names=["node", "grp", "code", "unit"])
    return run


_DIRECTIONS: dict[tuple[int, int], np.ndarray] = {}


def _directions(turn: int, length: int) -> np.ndarray:
    if (turn, length) not in _DIRECTIONS:
        _DIRECTIONS[turn, length] = np.random.default_rng([turn, length]).standard_normal((BITS, length))
    return _DIRECTIONS[turn, length]


def _best(sims: np.ndarray, node: np.ndarray, most: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For each row of ``sims`` its ``most`` best columns above the row's floor."""
    most = min(most, sims.shape[1])
    at = np.argpartition(-sims, most - 1, axis=1)[:, :most]
    got = np.take_along_axis(sims, at, axis=1)
    i, k = np.nonzero(got > floor[:, None])
    return node[i], node[at[i, k]], got[i, k]


def _edges(a: np.ndarray, b: np.ndarray, s: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array(a.astype(np.int64)), pa.array(b.astype(np.int64)), pa.array(s.astype(np.float32))], names=["a", "b", "s"])


def _stretch_batches(most: int):
    def one(rows: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        grp, node = rows["grp"].to_numpy(), rows["node"].to_numpy()
        for g in np.unique(grp):
            at = np.flatnonzero(grp == g)
            if len(at) > 1:
                x = _matrix(rows["unit"].take(pa.array(at)), np.float32)
                sims = x @ x.T
                np.fill_diagonal(sims, -2)
                yield _edges(*_best(sims, node[at], most, np.full(len(at), -1.5)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, STRETCH):
                yield from one(batch.slice(lo, STRETCH))
    return run


def _top(edges: DataFrame, most: int) -> DataFrame:
    """The best ``most`` neighbours of each vector: a, near (array of s, b; best first)."""
    best = F.row_number().over(Window.partitionBy("a").orderBy(F.desc("s"), "b"))
    kept = edges.groupBy("a", "b").agg(F.max("s").alias("s")).withColumn("_r", best).where(F.col("_r") <= most)
    return common.landed(kept.select("a", "b", "s"))


def _join_members(table: pa.Table) -> pa.Table:
    node = table["member"].to_numpy()
    x = _matrix(table["unit"], np.float32)
    sims = x @ x.T
    np.fill_diagonal(sims, -2)
    batch = _edges(*_best(sims, node, BEST, table["floor"].to_numpy()))
    return pa.Table.from_batches([batch])


def _round(graph: DataFrame, classes32: DataFrame, most: int) -> DataFrame:
    """One round: neighbours of a vector, and some that list it, meet one another."""
    floors = graph.groupBy("a").agg(F.when(F.count(F.lit(1)) >= most, F.min("s")).otherwise(-1.5).cast("float").alias("floor"))
    drawn = F.row_number().over(Window.partitionBy("b").orderBy(F.xxhash64("a", "b")))
    back = graph.withColumn("_r", drawn).where(F.col("_r") <= REVERSE).select(F.col("b").alias("at"), F.col("a").alias("member"))
    pairs = graph.select(F.col("a").alias("at"), F.col("b").alias("member")).union(back).union(
        graph.select(F.col("a").alias("at"), F.col("a").alias("member"))).distinct()
    state = classes32.join(floors, F.col("node") == F.col("a"), "left").select(
        F.col("node").alias("member"), "unit", F.coalesce("floor", F.lit(-1.5).cast("float")).alias("floor"))
    found = pairs.join(state, "member").groupBy("at").applyInArrow(_join_members, "a long, b long, s float")
    return _top(graph.unionByName(found), most)


def _confirmed(pairs: DataFrame, classes: DataFrame, threshold: float) -> DataFrame:
    x = classes.select(F.col("node").alias("a"), F.col("unit").alias("x"))
    y = classes.select(F.col("node").alias("b"), F.col("unit").alias("y"))
    joined = pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y")
    return common.landed(joined.mapInArrow(_confirm_rows(threshold), "a long, b long, cosine double"))


def _confirm_rows(threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cos = np.array([
                float(np.frombuffer(x, np.float64) @ np.frombuffer(y, np.float64))
                for x, y in zip(batch["x"].to_pylist(), batch["y"].to_pylist(), strict=True)], float)
            keep = pa.array(cos >= threshold)
            yield pa.RecordBatch.from_arrays([batch["a"].filter(keep), batch["b"].filter(keep), pa.array(cos).filter(keep)], names=["a", "b", "cosine"])
    return run


def _tile_counts(threshold: float):
    def run(table: pa.Table) -> pa.Table:
        node, weight, side = (table[c].to_numpy() for c in ("node", "weight", "side"))
        x = _matrix(table["unit"], np.float64)
        left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
        linked = x[left] @ x[right].T >= threshold
        linked &= node[left][:, None] != node[right][None, :]
        n_left = linked @ weight[right]
        bond_left, bond_right = _bonds(linked, node[left], node[right])
        out_node, out_n, out_bond = node[left], n_left, bond_left
        if (side != 0).any():  # two different tiles: count both ways
            out_node = np.concatenate([node[left], node[right]])
            out_n = np.concatenate([n_left, weight[left] @ linked])
            out_bond = np.concatenate([bond_left, bond_right])
        return pa.table({"node": pa.array(out_node), "n": pa.array(out_n.astype(np.int64)), "bond": pa.array(out_bond)})
    return run


def _bonds(linked: np.ndarray, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each vector of two tiles the smallest node that links of these tiles reach."""
    far = np.iinfo(np.int64).max
    while True:
        low = np.minimum(left, np.where(linked, right[None, :], far).min(axis=1, initial=far))
        high = np.minimum(right, np.where(linked, low[:, None], far).min(axis=0, initial=far))
        if (low == left).all() and (high == right).all():
            return low, high
        left, right = low, high


def _ball(table: pa.Table) -> pa.Table:
    """Mean direction of a tile and the largest angle to it."""
    x = _matrix(table["unit"], np.float64)
    mean = x.sum(axis=0)
    size = np.sqrt(mean @ mean)
    centre = mean / size if size > 1e-9 else x[0]
    radius = float(np.arccos(np.clip(x @ centre, -1, 1)).max())
    return pa.table({**{c: table[c][:1] for c in ("grp", "component", "own")}, "centre": pa.array([centre.tobytes()], pa.binary()), "radius": [radius]})


def _close_tiles(threshold: float):
    """Pairs of tiles of different components whose balls may hold a link."""
    def run(table: pa.Table) -> pa.Table:
        component, own, radius, side = (table[c].to_numpy() for c in ("component", "own", "radius", "side"))
        x = _matrix(table["centre"], np.float64)
        left, right = np.flatnonzero(side != 2), np.flatnonzero(side != 1)
        angle = np.arccos(np.clip(x[left] @ x[right].T, -1, 1))
        near = angle <= radius[left][:, None] + radius[right][None, :] + np.arccos(np.clip(threshold, -1, 1)) + MARGIN
        one, two = component[left][:, None], component[right][None, :]
        near &= one < two if not (side != 0).any() else one != two
        i, j = np.nonzero(near)
        i, j = left[i], right[j]
        return pa.table({"c1": component[i], "o1": own[i], "c2": component[j], "o2": own[j]})
    return run


def _paired(rows: DataFrame, group: list[str], own: Column) -> DataFrame:
    """Rows dealt to all pairs (i, j) of tiles of their group: side 0 in the tile itself, else 1 or 2. Rows have ``tiles``."""
    return rows.withColumn("_own", own).withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        *group, F.least("_own", "_other").alias("i"), F.greatest("_own", "_other").alias("j"),
        F.when(F.col("_own") == F.col("_other"), 0).when(F.col("_own") < F.col("_other"), 1).otherwise(2).alias("side"),
        *[c for c in rows.columns if c not in (*group, "tiles")])


def _placed(members: DataFrame, classes: DataFrame) -> DataFrame:
    """Members (node, component) with their class and tile (``own`` of ``tiles`` of the component)."""
    sizes = members.groupBy("component").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    return members.join(sizes, "component").withColumn("own", F.pmod(F.xxhash64("node"), "tiles").cast("int")).join(
        classes.select("node", "grp", "weight", "unit"), "node")


def _inside(placed: DataFrame, threshold: float) -> DataFrame:
    """(node, n, bond): links of vectors inside their component."""
    full = _paired(placed.select("component", "tiles", "own", "node", "weight", "unit"), ["component"], F.col("own"))
    return full.groupBy("component", "i", "j").applyInArrow(_tile_counts(threshold), "node long, n long, bond long")


def _across(placed: DataFrame, threshold: float) -> DataFrame | None:
    """(node, n, bond): links between components of one label; None if no two can be linked."""
    if placed.select("grp", "component").distinct().groupBy("grp").count().where("count > 1").isEmpty():
        return None
    tile = ["grp", "component", "own"]
    tiles = common.landed(placed.groupBy(*tile).agg(F.count(F.lit(1)).alias("k"), F.first("unit").alias("centre")))
    full = placed.join(tiles.where("k > 1").select(*tile), tile, "left_semi").groupBy(*tile).applyInArrow(
        _ball, "grp long, component long, own int, centre binary, radius double")
    balls = common.landed(full.unionByName(tiles.where("k = 1").select(*tile, "centre", F.lit(0.0).alias("radius"))))
    sizes = balls.groupBy("grp").agg(F.ceil(F.count(F.lit(1)) / TILE).cast("int").alias("tiles"))
    dealt = _paired(balls.join(sizes, "grp"), ["grp"], F.pmod(F.xxhash64("component", "own"), "tiles").cast("int"))
    close = common.landed(dealt.groupBy("grp", "i", "j").applyInArrow(
        _close_tiles(threshold), "c1 long, o1 int, c2 long, o2 int"))
    sides = close.select("*", F.explode(F.array(
        F.struct(F.lit(1).alias("side"), F.col("c1").alias("component"), F.col("o1").alias("own")),
        F.struct(F.lit(2).alias("side"), F.col("c2").alias("component"), F.col("o2").alias("own")))).alias("s"))
    full = sides.select("c1", "o1", "c2", "o2", "s.*").join(
        placed.select("component", "own", "node", "weight", "unit"), ["component", "own"])
    return common.landed(full.select("c1", "o1", "c2", "o2", "side", "node", "weight", "unit").groupBy("c1", "o1", "c2", "o2").applyInArrow(
        _tile_counts(threshold), "node long, n long, bond long").where("n > 0"))


def _exact(classes: DataFrame, links: DataFrame, threshold: float) -> DataFrame:
    """(node, n_links, component) of every class, by comparing all vectors of a label. The components of ``links``
    only say which vectors share tiles: balls of tiles that are too far apart for a link are passed over."""
    placed = common.landed(_placed(links.select("node", "component"), classes))
    several = placed.groupBy("component").count().where("count > 1").select("component")
    counts = _inside(placed.join(several, "component", "left_semi"), threshold).select("node", "n")
    joined = links.select(F.col("node").alias("a"), F.col("component").alias("b"))
    across = _across(placed, threshold)
    if across is not None:
        counts = counts.unionByName(across.select("node", "n"))
        joined = joined.union(across.select("node", "bond"))
    return _named(classes, counts.groupBy("node").agg(F.sum("n").alias("n")), common.components(joined.where("a <> b")))


def _named(classes: DataFrame, counts: DataFrame, joined: DataFrame) -> DataFrame:
    out = classes.select("node", "weight").join(counts, "node", "left").join(joined, "node", "left")
    return common.landed(out.select(
        "node", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component")))


def _links(graph: DataFrame, classes: DataFrame, threshold: float, most: int) -> DataFrame:
    """(node, n_links, component) of every class."""
    pairs = graph.where(F.col("s") >= threshold - MARGIN).select(
        F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    found = _confirmed(pairs, classes, threshold)
    joined = common.components(found.select("a", "b"))
    full = graph.groupBy("a").agg(F.count(F.lit(1)).alias("k"), F.min("s").alias("least")).where(
        (F.col("k") >= most) & (F.col("least") >= threshold - MARGIN)).select(F.col("a").alias("node"))
    saturated = common.landed(full.join(joined, "node"))
    both = found.select("a", "b").union(found.select("b", "a"))
    is_full = saturated.select("node", F.lit(True).alias("full"))
    # pairs of two saturated vectors are counted in the tiles
    marked = both.join(is_full.withColumnRenamed("node", "a").withColumnRenamed("full", "fa"), "a", "left").join(
        is_full.withColumnRenamed("node", "b").withColumnRenamed("full", "fb"), "b", "left")
    listed = marked.where("NOT (coalesce(fa, false) AND coalesce(fb, false))").join(
        classes.select(F.col("node").alias("b"), "weight"), "b").groupBy(F.col("a").alias("node")).agg(F.sum("weight").alias("n"))
    placed = _placed(saturated, classes)
    counts = listed.unionByName(_inside(placed, threshold).select("node", "n"))
    across = _across(placed, threshold)
    if across is not None:
        counts = counts.unionByName(across.select("node", "n"))
        bonds = across.select(F.col("node").alias("a"), F.col("bond").alias("b")).where("a <> b")
        if not bonds.isEmpty():
            joined = common.components(found.select("a", "b").union(bonds))
    return _named(classes, counts.groupBy("node").agg(F.sum("n").alias("n")), joined)


def audit(classes: DataFrame, links: DataFrame, threshold: float = THRESHOLD, audited: int | None = None) -> float:
    """Share of the links of a sample of ``audited`` vectors that were found; the sample meets all vectors."""
    if audited is None:
        audited = min(max(int(classes.count() ** 0.5), AUDITED[0]), AUDITED[1])
    order = F.xxhash64("node", F.lit(3))
    sample = classes.orderBy(order).limit(audited).join(links.select("node", "n_links"), "node").select(
        "node", "grp", "weight", "unit", "n_links").collect()
    if not sample:
        return 1.0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(sample), np.int64)
        for batch in batches:
            grp, node, weight = batch["grp"].to_numpy(), batch["node"].to_numpy(), batch["weight"].to_numpy()
            for g in np.unique(grp):
                at = np.flatnonzero(grp == g)
                mine = [i for i, r in enumerate(sample) if r["grp"] == g]
                if mine:
                    x = _matrix(batch["unit"].take(pa.array(at)), np.float64)
                    y = np.stack([np.frombuffer(sample[i]["unit"], np.float64) for i in mine])
                    total[mine] += ((y @ x.T >= threshold) & (node[at][None, :] != np.array([sample[i]["node"] for i in mine])[:, None])) @ weight[at]
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sample))), pa.array(total)], names=["i", "n"])

    seen = classes.select("node", "grp", "weight", "unit").mapInArrow(run, "i long, n long").groupBy("i").agg(F.sum("n").alias("n")).collect()
    true = {r["i"]: r["n"] + sample[r["i"]]["weight"] - 1 for r in seen}
    total = sum(true.values())
    return sum(min(sample[i]["n_links"], n) for i, n in true.items()) / total if total else 1.0


def near_duplicates(
    vectors: DataFrame, threshold: float = THRESHOLD, neighbours: int = NEIGHBOURS,
    rounds: int = ROUNDS, recall: float = RECALL,
) -> DataFrame:
    """One row per row of ``vectors`` (vec_id, embedding, label): vec_id, n_links, component_id, kept."""
    rows, classes = _classes(vectors)
    tasks = int(vectors.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    graph = None
    for turn in range(ORDERS):
        coded = classes.select("node", "grp", "unit").mapInArrow(_code_batches(turn), "node long, grp long, code long, unit binary")
        ordered = coded.repartitionByRange(tasks, "grp", "code", "node").sortWithinPartitions("grp", "code", "node")
        found = ordered.mapInArrow(_stretch_batches(neighbours), "a long, b long, s float")
        graph = found if graph is None else graph.unionByName(found)
    graph = _top(graph, neighbours)
    classes32 = common.landed(classes.select("node", "unit").mapInArrow(_narrow_batches, "node long, unit binary"))
    for done in range(1, max(rounds, MOST_ROUNDS) + 1):
        graph = _round(graph, classes32, neighbours)
        if done < rounds:
            continue
        links = _links(graph, classes, threshold, neighbours)
        if audit(classes, links, threshold) >= recall:
            break
    else:
        links = _exact(classes, links, threshold)
    named = rows.join(links, "node", "left")
    smallest = named.where("component IS NOT NULL").groupBy("component").agg(F.min("vec_id").alias("component_id"))
    out = named.join(smallest, "component", "left").select(
        "vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        F.when(F.col("component").isNull(), F.col("vec_id")).otherwise(F.col("component_id")).alias("component_id"))
    return out.select("*", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)).alias("kept"))


def _narrow_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        small = [np.frombuffer(x, np.float64).astype(np.float32).tobytes() for x in batch["unit"].to_pylist()]
        yield pa.RecordBatch.from_arrays([batch["node"], pa.array(small, pa.binary())], names=["node", "unit"])
