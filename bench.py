"""Headline queries at ``$BENCH_SF_DIR`` on ``local[$BENCH_CPUS]``; prints one JSON line.

Logs are landed as files first and that is not timed: the timed work starts
from log files and snapshots, as a replication job does. Every query runs once to warm up,
then three times; the median counts.
"""
from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from millrace.functions import wire  # noqa: E402
from millrace.operators import merge, report, transactions as txn  # noqa: E402
from millrace.operators.decode import decode_changes  # noqa: E402
from millrace.operators.project import table_changes  # noqa: E402
from millrace.operators.registry import Registry  # noqa: E402
from millrace.plans.replicate import replica  # noqa: E402
from millrace.shared import shared_folder  # noqa: E402
from millrace.streaming.job import Replication  # noqa: E402
from workload import logs  # noqa: E402

RUNS = 3


def session() -> SparkSession:
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("millrace-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(frame: DataFrame) -> None:
    frame.write.format("noop").mode("overwrite").save()


def workloads(spark: SparkSession, sf: str) -> dict:
    orders, snapshot = logs.landed(logs.orders_log(spark, sf)), logs.orders_snapshot(spark, sf)
    items, lineitem = logs.landed(logs.lineitem_log(spark, sf)), logs.table(spark, sf, "lineitem")
    talk = logs.landed(logs.conversations_log(spark, sf, moved=True))
    conversations = logs.table(spark, sf, "conversations")
    registry = Registry.load(orders)
    shape = registry.shape("orders")

    def typed(log: DataFrame) -> DataFrame:
        return table_changes(decode_changes(log, shape.relids), registry, shape)

    def poll() -> None:
        job = Replication(spark, shared_folder(spark), buckets=8)
        job.bootstrap({"orders": snapshot})
        job.apply(orders)

    def changes(log: DataFrame) -> int:
        return log.where(wire.message_type(F.col("data")).isin(*wire.CHANGES)).count()

    n, m, t = changes(orders), changes(items), changes(talk)
    return {
        "registry": (n, lambda: Registry.load(orders)),
        "decode": (n, lambda: run(decode_changes(orders))),
        "typed_projection": (n, lambda: run(typed(orders))),
        "net_changes": (n, lambda: run(merge.net_changes(
            merge.keyed_events(typed(txn.committed_only(orders)), shape), shape))),
        "apply_changes": (n, lambda: run(replica(orders, snapshot, "orders", registry))),
        "apply_bag": (m, lambda: run(replica(items, lineitem, "lineitem"))),
        "toast_moved": (t, lambda: run(replica(talk, conversations, "conversations"))),
        "txn_summary": (n, lambda: run(report.transaction_summary(orders))),
        "bounded_poll": (n, lambda: run(txn.bounded_poll(orders, 10_000))),
        "quarantine": (n, lambda: run(report.quarantine(orders, registry))),
        "stream_poll": (n, poll),
    }


def polls(spark: SparkSession, sf: str) -> dict:
    """The job over more polls and more tables than one: run once each, not part of the total."""
    orders, snapshot = logs.landed(logs.orders_log(spark, sf)), logs.orders_snapshot(spark, sf)
    last = orders.agg(F.max("seq")).first()[0]
    parts = logs.landed(logs.many_tables_log(spark, sf, 50))

    def ten_polls() -> None:
        job = Replication(spark, shared_folder(spark), buckets=8)
        job.bootstrap({"orders": snapshot})
        for i in range(10):
            low, high = last * i // 10, last * (i + 1) // 10
            job.apply(orders.where((F.col("seq") > (low if i else -1)) & (F.col("seq") <= high)))

    def fifty_tables() -> None:
        Replication(spark, shared_folder(spark), buckets=4, tables_at_once=8).apply(parts)

    return {"stream_ten_polls": ten_polls, "stream_fifty_tables": fifty_tables}


def main() -> None:
    sf = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = session()
    seconds, rates = {}, {}
    for name, (rows, work) in workloads(spark, sf).items():
        work()
        taken = []
        for _ in range(RUNS):
            began = time.perf_counter()
            work()
            taken.append(time.perf_counter() - began)
        seconds[name] = round(statistics.median(taken), 3)
        rates[name] = round(rows / seconds[name])
    scaling = {}
    for name, work in polls(spark, sf).items():
        began = time.perf_counter()
        work()
        scaling[name] = round(time.perf_counter() - began, 3)
    print(json.dumps({
        "metric": "total_median_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "changes_per_second": rates, "sf": os.path.basename(sf.rstrip("/")),
        "cpus": int(os.environ.get("BENCH_CPUS", "8")), "runs": RUNS,
        "scaling": scaling,
    }))


if __name__ == "__main__":
    main()
