"""Small helpers shared by the operators: tables, hashes, positions within groups, components."""
from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession) -> str:
    """The folder all executors share. Only a local master may do without the setting."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if folder is None and spark.sparkContext.master.startswith("local["):
        folder = "/tmp/millrace-checkpoints"
    if folder is None:
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    return folder


def landed(df: DataFrame) -> DataFrame:
    """The rows, written to the shared folder and read back: later steps survive lost executors and
    do not compute them again."""
    path = f"{shared_folder(df.sparkSession)}/landed-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


Batches = Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]


def released(run: Batches) -> Batches:
    """``run``, giving freed memory back to the system at the end of a task: Python workers outlive their task, and
    what they keep is missing in the stages that follow."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
        if trim is not None:
            trim(0)
    return task


def row_hash(*cols: Column | str) -> Column:
    return F.xxhash64(*cols)


PER_BUCKET = 4_000  # rows of a group that are sorted together, about


def positions(df: DataFrame, group: str, order: Sequence[Column], name: str, per: int = PER_BUCKET) -> DataFrame:
    """Add ``name``: 0, 1, 2, ... within each value of ``group``, gapless, in the order of hash
    buckets and ``order`` inside them.

    No group is sorted in one task: a group of n rows is cut into about n / ``per`` buckets by hash
    of ``order``, buckets are counted, and the running counts are added to the
    positions inside the buckets. Null is a group of its own. ``order`` should tell rows apart (see ``numbered``): rows that are
    equal in it share a bucket.
    """
    sizes = df.groupBy(group).agg(F.ceil(F.count(F.lit(1)) / F.lit(per)).cast("long").alias("_parts"))
    keyed = df.alias("l").join(sizes.alias("r"), F.col(f"l.{group}").eqNullSafe(F.col(f"r.{group}")))
    keyed = keyed.select("l.*", F.pmod(F.xxhash64(*order), "_parts").alias("_part"))
    before = (
        keyed.groupBy(group, "_part").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_before", F.sum("_n").over(
            Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)))
    )
    inside = Window.partitionBy(group, "_part").orderBy(*order)
    ranked = keyed.withColumn("_row", F.row_number().over(inside) - 1)
    joined = ranked.alias("l").join(
        before.alias("r"),
        F.col(f"l.{group}").eqNullSafe(F.col(f"r.{group}")) & (F.col("l._part") == F.col("r._part")))
    return joined.select(
        "l.*", (F.coalesce(F.col("r._before"), F.lit(0)) + F.col("l._row")).alias(name)
    ).drop("_part", "_row")


def numbered(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once, with a number of their own in ``name``: equal rows and rows without an id can be told apart,
    and a later step that reads them again finds the same numbers."""
    return landed(df.withColumn(name, F.monotonically_increasing_id()))


def components(links: DataFrame, rounds: int = 64) -> DataFrame:
    """Connected components of links (``a`` long, ``b`` long): (``node``, ``component``), the
    smallest node reachable.

    Large-star and small-star rounds: every node's larger neighbours, then its smaller ones, are hung on the
    smallest neighbour. A round keeps at most as many links as it got, so a hub never yields pairs
    of its neighbours, and its neighbours meet only in a minimum, which is reduced before the shuffle.
    Each round is written to the shared folder.
    """
    spark = links.sparkSession
    cur = landed(links.where("a <> b").select(
        F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    for _ in range(rounds):
        # All hang on a smallest node when no such node hangs on another.
        roots = cur.select(F.col("b").alias("a"))
        if cur.join(roots, "a", "left_semi").isEmpty():
            break
        both = cur.union(cur.select("b", "a"))
        low = both.groupBy("a").agg(F.min("b").alias("m")).withColumn("m", F.least("a", "m"))
        large = both.join(low, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        joined = large.join(least, "a")
        cur = landed(
            joined.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
            .union(joined.select("a", F.col("m").alias("b"))).where("a <> b").distinct())
    else:
        raise RuntimeError(f"components did not settle in {rounds} rounds")
    return cur.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        cur.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())


def bounded(df: DataFrame, rows: int) -> DataFrame:
    """``df``, marked for broadcast if it has at most ``rows`` rows; else left to shuffled joins."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df
