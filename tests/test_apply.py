from decimal import Decimal

import pytest
from pyspark.sql import functions as F

import messages as m
import replay
from millrace.operators import bag, links, merge
from millrace.operators.decode import decode_changes
from millrace.operators.project import conform, table_changes
from millrace.operators.registry import Registry
from millrace.plans.replicate import replica
from millrace.streaming.job import Replication
from workload import logs

ROW = "id bigint, n int, body string"


def rows(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.mark.parametrize("seed, steps", [(1, 40), (2, 200), (3, 400)])
def test_random_history(spark, seed, steps):
    snapshot, texts, want = replay.history(seed, steps)
    found = replica(m.log(spark, texts), spark.createDataFrame(snapshot, ROW), "t")
    assert rows(found) == sorted(want, key=str)


@pytest.mark.parametrize("seed", [5])
def test_stored_changes_give_the_same(spark, seed, tmp_path):
    """The merge reads written changes, with links resolved beforehand."""
    snapshot, texts, want = replay.history(seed, 150)
    log = m.log(spark, texts[: max(i for i, t in enumerate(texts) if t == m.commit()) + 1])
    registry = Registry.load(log)
    shape = registry.shape("t")
    base = conform(spark.createDataFrame(snapshot, ROW), shape)
    events = merge.keyed_events(table_changes(decode_changes(log), registry, shape), shape)
    events.write.parquet(str(tmp_path / "events"))
    events = spark.read.parquet(str(tmp_path / "events"))
    merge.net_changes(events, shape).write.parquet(str(tmp_path / "net"))
    net = links.resolve_links(spark.read.parquet(str(tmp_path / "net")), events, base, shape)
    net.write.parquet(str(tmp_path / "whole"))
    found = merge.merge_stored(base, spark.read.parquet(str(tmp_path / "whole")), shape)
    assert rows(found) == sorted(want, key=str)


def test_long_chain_of_key_changes(spark):
    """A value left out through many key changes, back and forth, is found again."""
    texts = [m.begin(), m.relation(7, "t", replay.COLUMNS), m.update(7, [1, 0, "far"], None)]
    key = 1
    for step in range(1, 41):
        to = (key * 7 + 3) % 11 if (key * 7 + 3) % 11 != key else key + 20
        texts.append(m.update(7, [to, step, m.U], [key, None, None]))
        key = to
    texts.append(m.commit())
    base = spark.createDataFrame([(1, 0, "start"), (50, 0, "other")], ROW)
    found = rows(replica(m.log(spark, texts), base, "t"))
    assert found == sorted([(key, 40, "far"), (50, 0, "other")], key=str)


def test_far_apart_messages(spark):
    """Places far apart fall into different spans of the log."""
    texts = [
        m.begin(), m.relation(7, "t", replay.COLUMNS), m.update(7, [1, 1, "one"]),
        m.update(7, [2, 2, m.U], [1, None, None]), m.insert(7, [1, 9, "new"]),
        m.update(7, [3, 3, m.U], [2, None, None]), m.commit(),
    ]
    log = m.log(spark, texts, first=5, step=3_000_000)
    found = rows(replica(log, spark.createDataFrame([(1, 0, "start")], ROW), "t"))
    assert found == [(1, 9, "new"), (3, 3, "one")]


def test_students_scenario(spark):
    columns = [
        ("first_name", 1043, False), ("last_name", 1043, False), ("id", 23, True), ("age", 23, False),
        ("email", 1043, False),
    ]
    start = [
        ("John", "Doe", 1, 20, "john.doe@example.com"), ("Jane", "Smith", 2, 22, "jane.smith@example.com"),
        ("Alice", "Johnson", 3, 19, "alice.johnson@example.com"), ("Bob", "Brown", 4, 21, "bob.brown@example.com"),
    ]
    added = [
        ("John", "Doe", 5, 21, "john.doe2@example.com"), ("Lui", "Doe", 6, 21, "lui.doe2@example.com"),
        ("Lui", "Brown", 7, 27, "lui.brown2@example.com"),
    ]

    def key(k):
        return [None, None, k, None, None]

    texts = [
        m.begin(), m.relation(7, "students", columns), *[m.insert(7, r) for r in added],
        m.update(7, ("John", "Doe", 1, 50, "john.doe@example.com")),
        m.update(7, ("John", "Doe", 25, 21, "john.doe2@example.com"), key(5)),
        m.delete(7, key(6)), m.delete(7, key(7)), m.delete(7, key(25)), m.commit(),
    ]
    ddl = "first_name string, last_name string, id int, age int, email string"
    found = rows(replica(m.log(spark, texts), spark.createDataFrame(start, ddl), "students"))
    assert found == sorted([("John", "Doe", 1, 50, "john.doe@example.com"), *start[1:]], key=str)


def test_full_identity_without_and_with_key(spark):
    columns = [("a", 25, True), ("b", 23, True)]
    texts = [
        m.begin(), m.relation(7, "t", columns, "f"), m.insert(7, ["x", 1]), m.insert(7, ["x", 1]),
        m.insert(7, ["x", 1]), m.delete(7, ["x", 1], "O"), m.delete(7, ["y", None], "O"),
        m.update(7, ["z", 3], ["y", 2], "O"), m.commit(),
    ]
    base = spark.createDataFrame([("y", None), ("y", 2), ("k", 5), ("k", 5)], "a string, b int")
    found = rows(replica(m.log(spark, texts), base, "t"))
    assert found == sorted([("x", 1), ("x", 1), ("z", 3), ("k", 5), ("k", 5)], key=str)

    keyed = [
        m.begin(), m.relation(7, "t", columns, "f"), m.update(7, ["y", 9], ["y", 2], "O"),
        m.update(7, ["q", 5], ["k", 5], "O"), m.commit(),
    ]
    base = spark.createDataFrame([("y", 2), ("k", 5)], "a string, b int")
    assert rows(replica(m.log(spark, keyed), base, "t", key=["a"])) == [("q", 5), ("y", 9)]


def test_many_copies_are_written_out_in_chunks(spark, monkeypatch):
    monkeypatch.setattr(bag, "CHUNK", 3)
    frame = spark.createDataFrame([("a", 8), ("b", 3), ("c", 1), ("d", 10)], f"v string, {bag.COPIES} bigint")
    got = bag.expand(frame).groupBy("v").count().collect()
    assert sorted(tuple(r) for r in got) == [("a", 8), ("b", 3), ("c", 1), ("d", 10)]


def test_identities(spark):
    columns = [("id", 20, False)]
    base = spark.createDataFrame([(1,)], "id bigint")
    append = [m.begin(), m.relation(7, "t", columns), m.insert(7, [2]), m.insert(7, [2]), m.commit()]
    assert rows(replica(m.log(spark, append), base, "t")) == [(1,), (2,), (2,)]
    none = [m.begin(), m.relation(7, "t", columns, "n"), m.insert(7, [2]), m.commit()]
    assert rows(replica(m.log(spark, none), base, "t")) == [(1,)]


def test_toast_null(spark):
    texts = [m.begin(), m.relation(7, "t", replay.COLUMNS), m.update(7, [1, 5, m.U]), m.commit()]
    base = spark.createDataFrame([(1, 0, "long")], ROW)
    assert rows(replica(m.log(spark, texts), base, "t", toast="null")) == [(1, 5, None)]
    assert rows(replica(m.log(spark, texts), base, "t")) == [(1, 5, "long")]


def test_transactions_before_the_snapshot_are_left_out(spark):
    """A transaction counts by its commit, also when its rows lie before the snapshot."""
    texts = [
        m.begin(), m.relation(7, "t", replay.COLUMNS), m.insert(7, [1, 1, "in snapshot"]), m.commit(),
        m.begin(), m.insert(7, [2, 2, "spans it"]), m.commit(),
    ]
    log = m.log(spark, texts, lsn=lambda i: 16 * i)
    start = F.lit(16 * 5).cast("decimal(20,0)")
    base = spark.createDataFrame([(1, 7, "kept")], ROW)
    assert rows(replica(log, base, "t", start=start)) == [(1, 7, "kept"), (2, 2, "spans it")]


def test_bad_value_keeps_the_row(spark):
    texts = [m.begin(), m.relation(7, "t", replay.COLUMNS), m.insert(7, [1, "many", "x"]), m.commit()]
    log = m.log(spark, texts)
    assert rows(replica(log, spark.createDataFrame([], ROW), "t")) == [(1, None, "x")]


def test_bad_key_has_no_effect(spark):
    texts = [m.begin(), m.relation(7, "t", replay.COLUMNS), m.insert(7, ["one", 1, "x"]), m.commit()]
    assert rows(replica(m.log(spark, texts), spark.createDataFrame([(1, 1, "y")], ROW), "t")) == [(1, 1, "y")]


def test_identity_comes_and_goes(spark):
    """Changes sent while a table had no identity are skipped, others are not."""
    texts = [
        m.begin(), m.relation(7, "t", replay.COLUMNS, "n"), m.insert(7, [1, 1, "skipped"]),
        m.relation(7, "t", replay.COLUMNS, "d"), m.insert(7, [2, 2, "kept"]), m.commit(),
    ]
    assert rows(replica(m.log(spark, texts), spark.createDataFrame([], ROW), "t")) == [(2, 2, "kept")]


def test_identity_changes_in_a_log(spark):
    """Each change is matched as its own version says."""
    other = [(n, o, not k, *x) if n in ("id", "n") else (n, o, k, *x) for n, o, k, *x in replay.COLUMNS]
    steps = [
        [m.relation(7, "t", replay.COLUMNS, "d"), m.update(7, [1, 5, "a"]), m.insert(7, [3, 3, "c"])],
        [m.relation(7, "t", replay.COLUMNS, "f"), m.update(7, [1, 6, "a"], [1, 5, "a"], "O"), m.insert(7, [3, 3, "c"])],
        [m.relation(7, "t", replay.COLUMNS, "n"), m.insert(7, [9, 9, "skipped"])],
        [m.relation(7, "t", other, "d"), m.update(7, [4, 6, "z"]), m.delete(7, [None, 2, None])],
        [m.relation(7, "t", replay.COLUMNS, "n"), m.insert(7, [9, 9, "skipped"])],
    ]
    base = spark.createDataFrame([(1, 0, "long"), (2, 2, "b")], ROW)
    want = [
        [(1, 5, "a"), (2, 2, "b"), (3, 3, "c")], [(1, 6, "a"), (2, 2, "b"), (3, 3, "c"), (3, 3, "c")],
        [(1, 6, "a"), (2, 2, "b"), (3, 3, "c"), (3, 3, "c")], [(3, 3, "c"), (3, 3, "c"), (4, 6, "z")],
        [(3, 3, "c"), (3, 3, "c"), (4, 6, "z")],
    ]
    for n in range(1, 6):
        log = m.log(spark, [m.begin(), *sum(steps[:n], []), m.commit()])
        assert rows(replica(log, base, "t", Registry.load(log))) == sorted(want[n - 1], key=str)


def test_key_types_are_compared_as_typed(spark):
    """The text of a key may be written differently from the stored value."""
    columns = [("id", 1700, True, ((10 << 16) | 2) + 4), ("n", 23, False)]
    texts = [m.begin(), m.relation(7, "t", columns), m.update(7, ["1.50", 9]), m.delete(7, ["2", None]), m.commit()]
    base = spark.createDataFrame([("1.5", 1), ("2.00", 2)], "id string, n int")
    assert [(str(a), b) for a, b in rows(replica(m.log(spark, texts), base, "t"))] == [("1.50", 9)]


def test_changes_are_reduced_before_their_shuffle(spark):
    """Changes reach the key shuffle already reduced, and no window touches them."""
    snapshot, texts, _ = replay.history(1, 40)
    log = m.log(spark, texts)
    registry = Registry.load(log)
    shape = registry.shape("t")
    net = merge.net_changes(merge.keyed_events(table_changes(decode_changes(log), registry, shape), shape), shape)
    plan = net._jdf.queryExecution().executedPlan().toString()
    assert "partial_max_by" in plan and "Window" not in plan and "CartesianProduct" not in plan


def test_few_changes_leave_a_large_table_where_it_is(spark, tmp_path):
    """One change on three million rows: the table is not shuffled."""
    spark.range(3_000_000).select("id", F.lit(1).alias("n"), F.lit("x").alias("body")).write.parquet(str(tmp_path / "t"))
    texts = [m.begin(), m.relation(7, "t", replay.COLUMNS), m.update(7, [5, 2, "y"], None), m.commit()]
    table = spark.read.parquet(str(tmp_path / "t"))
    plain = replica(m.log(spark, texts), table, "t", toast="null")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plain and "LeftAnti" in plain
    assert "FullOuter" not in plain and "Exchange hashpartitioning" not in plain
    found = replica(m.log(spark, texts), table, "t")
    assert [tuple(r) for r in found.where("n = 2").collect()] == [(5, 2, "y")] and found.count() == 3_000_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "FullOuter" not in plan and "LeftAnti" in plan


def test_numerics_are_exact(spark):
    """Many fractional digits, many whole digits and NaN, as values and as keys, in the log and in the snapshot."""
    columns = [("id", 1700, True), ("v", 1700, False), ("w", 1700, False)]
    whole = "1234567890123456789012345678901234"
    texts = [
        m.begin(), m.relation(7, "t", columns), m.insert(7, ["0.12345678912345", "1.50", "NaN"]),
        m.update(7, ["2.00", "-0.12345678912345", "5"]), m.delete(7, ["3.10", None, None]), m.commit()]
    base = spark.createDataFrame([("2", "1", whole), ("3.1", "1", "1"), ("4", "2", "3")], "id string, v string, w string")
    found = replica(m.log(spark, texts), base, "t")
    assert [t for _, t in found.dtypes] == ["decimal(38,18)", "decimal(38,18)", "string"]
    assert rows(found) == sorted([
        (Decimal("0.123456789123450000"), Decimal("1.500000000000000000"), "NaN"),
        (Decimal("2.000000000000000000"), Decimal("-0.123456789123450000"), "5"),
        (Decimal("4.000000000000000000"), Decimal("2.000000000000000000"), "3")], key=str)
    keys = [m.begin(), m.relation(7, "t", columns), m.update(7, [whole, "7", "1"]), m.update(7, ["NaN", "8", "1"]), m.commit()]
    base = spark.createDataFrame([(whole, "1", "1"), ("NaN", "1", "1"), ("1.0", "1", "1")], "id string, v string, w string")
    by_key = {r.id: r.v for r in replica(m.log(spark, keys), base, "t").collect()}
    assert by_key == {whole: Decimal(7), "NaN": Decimal(8), "1": Decimal(1)}


def test_full_identity_keeps_unchanged_values(spark):
    columns = [("id", 23, True), ("n", 23, True), ("note", 25, True)]
    texts = [
        m.begin(), m.relation(7, "t", columns, "f"),
        m.update(7, [1, 5, m.U], [1, 0, "long"], "O"), m.update(7, [2, 6, None], [2, 0, "gone"], "O"), m.commit(),
    ]
    base = spark.createDataFrame([(1, 0, "long"), (2, 0, "gone")], "id int, n int, note string")
    assert rows(replica(m.log(spark, texts), base, "t")) == [(1, 5, "long"), (2, 6, None)]


def test_renamed_table_gets_no_later_rows(spark):
    columns = [("id", 23, True), ("n", 23, False)]
    texts = [
        m.begin(), m.relation(7, "a", columns), m.insert(7, [1, 1]), m.relation(7, "b", columns),
        m.insert(7, [2, 2]), m.update(7, [1, 9]), m.commit(),
    ]
    empty = spark.createDataFrame([], "id int, n int")
    assert rows(replica(m.log(spark, texts), empty, "a")) == [(1, 1)]
    assert rows(replica(m.log(spark, texts), empty, "b")) == [(1, 9), (2, 2)]


def test_shared_folder_needs_a_setting_on_a_cluster():
    from types import SimpleNamespace

    from millrace.shared import shared_folder

    def session(master, setting=None, given=None):
        context = SimpleNamespace(master=master, getCheckpointDir=lambda: given)
        return SimpleNamespace(conf=SimpleNamespace(get=lambda k, d: setting), sparkContext=context)

    assert shared_folder(session("yarn", "hdfs:///c/")).startswith("hdfs:///c/millrace-")
    assert shared_folder(session("yarn", None, "hdfs:///d")).startswith("hdfs:///d/")
    assert shared_folder(session("local[4]")).startswith("/")
    for master in ("yarn", "spark://x", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError):
            shared_folder(session(master))


def test_a_bag_is_merged_in_one_shuffle(spark, tmp_path):
    """Signed rows are not written or added up before they meet the table; rows that cancel leave it as it is."""
    columns = [("id", 20, True), ("n", 23, True)]
    job = Replication(spark, str(tmp_path), buckets=2)
    job.bootstrap({"t": spark.createDataFrame([(1, 1), (1, 1), (2, 2)], "id bigint, n int")})
    job.apply(m.log(spark, [
        m.begin(), m.relation(7, "t", columns, identity="f"), m.update(7, [1, 9], [1, 1], tag="O"),
        m.update(7, [2, 2], [2, 2], tag="O"), m.commit()]))
    assert sorted(tuple(r) for r in job.table("t").collect()) == [(1, 1), (1, 9), (2, 2)]
    assert not (tmp_path / "net").exists()


def test_a_log_made_in_order_is_written_as_it_comes(spark, tmp_path):
    rows = [(i, i % 3, 1, i % 4, 1.0, 2.0, 0.0, 0.0, "RAN"[i % 3], "OF"[i % 2]) for i in range(40)]
    names = [c.name for c in logs.LINEITEM_COLUMNS[:-1]]
    table = spark.createDataFrame(rows, names).withColumn("l_shipdate", F.timestamp_seconds(F.lit(0)))
    table.repartition(3).write.parquet(str(tmp_path / "lineitem.parquet"))
    log = logs.lineitem_log(spark, str(tmp_path))
    found = spark.read.parquet(logs.landed_files(log, [], in_order=True))
    assert sorted(map(tuple, found.collect())) == sorted(map(tuple, logs.landed(log).collect()))
    ends = found.groupBy(F.input_file_name()).agg(F.min("seq").alias("a"), F.max("seq").alias("b")).orderBy("a").collect()
    assert all(x.b < y.a for x, y in zip(ends, ends[1:]))


def test_messages_are_made_in_generated_code_and_each_text_once(spark, tmp_path):
    """No lambda over the messages of a row; a value's text serves the delete, the old and the new row."""
    rows = [(i, i, 1, i, 1.5, 2.0, 0.0, 0.0, flag, status) for i, (flag, status) in enumerate([
        ("R", "F"), ("R", "O"), ("N", "O"), ("N", "O"), ("A", "F"), (None, "O"), ("N", None), ("R", None), (None, None)])]
    rows.append(rows[2])
    kinds = "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, " \
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string"
    table = spark.createDataFrame(rows, kinds).withColumn("l_shipdate", F.lit(None).cast("timestamp_ntz"))
    table.coalesce(1).write.parquet(str(tmp_path / "lineitem.parquet"))
    for left_out in (False, True):
        log = logs.lineitem_log(spark, str(tmp_path), left_out)
        plan = log._jdf.queryExecution().optimizedPlan().toString()
        assert "lambdafunction" not in plan
        assert plan.count("cast(l_extendedprice") <= 2
        kinds_of = sorted(chr(int(r.data[2:4], 16)) for r in log.collect())
        assert "".join(kinds_of) == "BCDDDRUUU"
        found = replica(logs.landed(log, in_order=True), logs.table(spark, str(tmp_path), "lineitem"), "lineitem")
        left = sorted(str((r.l_orderkey, r.l_returnflag, r.l_linestatus)) for r in found.collect())
        assert left == sorted(map(str, [
            (2, "N", "X"), (2, "N", "X"), (3, "N", "X"), (4, "A", "F"), (5, None, "O"), (6, "N", None), (8, None, None)]))
