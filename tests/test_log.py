import pytest
from pyspark.sql import functions as F

import messages as m
from millrace.operators import registry as reg, report, transactions as txn
from millrace.operators.decode import decode_changes
from millrace.operators.project import table_changes, union_rows
from millrace.operators.registry import Registry
from millrace.sources.changelog import read_log

A, B = [("id", 20, True), ("a", 25, False)], [("id", 23, True), ("b", 23, False), ("a", 25, False)]


def collect(frame):
    return sorted((tuple(r) for r in frame.collect()), key=str)


@pytest.fixture
def versions_log(spark):
    texts = [
        m.insert(7, [0, "early"]), m.relation(7, "t", A), m.insert(7, [1, "x"]), m.relation(7, "t", A),
        m.relation(9, "u", A), m.insert(9, [5, "u"]), m.insert(7, [2, "y"]), m.relation(7, "t", B),
        m.insert(7, [3, 30, "z"]), m.relation(7, "t", B), m.relation(7, "renamed", B), m.insert(7, [4, 40, "w"]),
        m.relation(8, "odd", A)[:-6],
    ]
    return m.log(spark, texts)


def test_repeated_definitions_collapse(versions_log):
    registry = Registry.load(versions_log)
    got = collect(registry.versions.select("relid", "from_seq", "to_seq", "name"))
    assert got == sorted(
        [(7, 1, 7, "public.t"), (7, 7, 10, "public.t"), (7, 10, reg.END, "public.renamed"), (9, 4, reg.END, "public.u")],
        key=str,
    )
    assert registry.table_names() == ["public.renamed", "public.t", "public.u"]
    assert registry.damaged.count() == 1


def test_definitions_of_asked_tables(versions_log):
    """One job for the tables of some relation ids; the same shapes as asked for one by one."""
    registry = Registry.load(versions_log)
    found = registry.shapes(versions_log.sparkSession.createDataFrame([(7,), (8,), (9,), (9,)], "relid bigint"))
    assert [s.name for s in found] == ["public.renamed", "public.t", "public.u"]
    assert found == [Registry.load(versions_log).shape(s.name) for s in found]


def test_odd_definitions(spark):
    """Names beyond ASCII, no columns, a negative count, bytes behind the end, cut and broken text."""
    wide = [("größe", 23, True), ("naïve \U0001f600", 1700, False, ((5 << 16) | 2) + 4)]
    whole = m.relation(11, "tâble", wide, "f", "schéma")
    none = m.relation(12, "none", [])
    texts = [
        whole, none, m.relation(13, "more", A) + "ff", m.relation(14, "cut", A)[:-2], whole.replace("b6", "ff").replace("0b", "0f", 1),
        none[:-4] + "ffff", "\\x52" + "00" * 20,
    ]
    registry = Registry.load(m.log(spark, texts))
    got = {r.table_name: r for r in registry.versions.collect()}
    one = got["tâble"]
    assert (one.schema_name, one.identity, one.name) == ("schéma", "f", "schéma.tâble")
    assert [tuple(c) for c in one.columns] == [("größe", 23, -1, True), ("naïve \U0001f600", 1700, ((5 << 16) | 2) + 4, False)]
    assert got["none"].columns == [] and [c.name for c in got["more"].columns] == ["id", "a"]
    assert {r.relid for r in registry.damaged.collect()} >= {14}
    assert "cut" not in got


def test_rows_follow_the_version_in_force(versions_log):
    registry = Registry.load(versions_log)
    shape = registry.shape("t")
    assert [(c.name, c.oid) for c in shape.columns] == [("id", 20), ("a", 25), ("b", 23)]
    got = collect(table_changes(decode_changes(versions_log), registry, shape).select("new.*"))
    assert got == [(1, "x", None), (2, "y", None), (3, "z", 30)]
    renamed = registry.shape("renamed")
    assert collect(table_changes(decode_changes(versions_log), registry, renamed).select("new.*")) == [(4, 40, "w")]


def test_union_of_frames(spark):
    one = spark.createDataFrame([(1, "x")], "id bigint, a string")
    two = spark.createDataFrame([("2", 5)], "id string, b int")
    got = union_rows([one, two])
    assert got.columns == ["id", "a", "b"] and got.schema["id"].dataType.simpleString() == "bigint"
    assert collect(got) == [(1, "x", None), (2, None, 5)]


def test_primary_keys_do_not_leak_between_schemas(spark):
    constraints = spark.createDataFrame(
        [("s1", "pk", "s1", "t", "PRIMARY KEY"), ("s2", "pk", "s2", "t", "PRIMARY KEY"), ("s1", "u", "s1", "t", "UNIQUE")],
        "constraint_schema string, constraint_name string, table_schema string, table_name string, constraint_type string",
    )
    usage = spark.createDataFrame(
        [("s1", "pk", "s1", "t", "b"), ("s1", "pk", "s1", "t", "a"), ("s2", "pk", "s2", "t", "z"), ("s1", "u", "s1", "t", "q")],
        "constraint_schema string, constraint_name string, table_schema string, table_name string, column_name string",
    )
    only = spark.createDataFrame([("s1", "t")], "table_schema string, table_name string")
    assert collect(reg.primary_keys(constraints, usage, only)) == [("s1", "t", "a"), ("s1", "t", "b")]
    assert reg.primary_keys(constraints, usage).count() == 3


def test_running_count_over_all_levels(spark, monkeypatch):
    monkeypatch.setattr(txn, "STEP_BITS", 2)
    monkeypatch.setattr(txn, "FAN_BITS", 1)
    places = [i * 3 % 64 + i // 64 * 64 for i in range(64)]
    frame = spark.createDataFrame([(p, p % 3 == 0) for p in sorted(set(places))], "seq bigint, hit boolean")
    got = txn.running_count(frame, F.col("hit"), "n").orderBy("seq").collect()
    n = 0
    for row in got:
        n += row.hit
        assert row.n == n


@pytest.mark.parametrize("bits", [1, 2, 16])
def test_poll_never_splits_a_transaction(spark, monkeypatch, bits):
    monkeypatch.setattr(txn, "STEP_BITS", bits)
    one = [m.begin(), m.insert(7, ["1"]), m.insert(7, ["2"]), m.commit()]
    log = m.log(spark, one * 3 + [m.begin(), m.insert(7, ["3"])])
    sizes = [txn.bounded_poll(log, n).count() for n in (1, 4, 5, 8, 12, 13, 100)]
    assert sizes == [4, 4, 8, 8, 12, 12, 12]


def test_log_after_a_place(spark, tmp_path):
    m.log(spark, [m.begin(), m.insert(7, ["1"]), m.commit()]).write.parquet(str(tmp_path / "log"))
    assert read_log(spark, str(tmp_path / "log"), after_seq=0).count() == 2
    assert read_log(spark, str(tmp_path / "log")).count() == 3


def test_published_tables(versions_log):
    registry = Registry.load(versions_log)
    assert registry.publishes("u") and registry.publishes("public.t") and not registry.publishes("s.t")


def test_nothing_committed(spark):
    log = m.log(spark, [m.begin(), m.insert(7, ["1"])])
    assert txn.committed_only(log).count() == 0
    assert txn.bounded_poll(log, 1).count() == 0
    row = txn.progress(log).first()
    assert row.confirmed_seq is None and row.messages == 2 and row.lag == row.latest_lsn


def test_transaction_summary(spark):
    log = m.log(
        spark,
        [m.begin(), m.insert(7, ["1"]), m.commit(), m.begin(), m.delete(7, ["1"]), m.update(7, ["1"])],
        first=3, step=40_000,
    )
    assert collect(report.transaction_summary(log)) == [
        (1, 3, 80_003, 1, 0, 0, True), (2, 120_003, 200_003, 0, 1, 1, False),
    ]


def test_quarantine_reasons(spark):
    texts = [
        m.insert(7, ["early", "x"]), m.relation(7, "t", A), m.insert(7, [1, "x"]), m.insert(7, ["x", "x"]),
        m.insert(99, [1]), "\\x5A", "\\x4", m.insert(7, [1, "xyz"])[:-4], m.relation(8, "nokey", [("v", 23, False)]),
        m.insert(8, [1]), m.delete(8, [1]), m.relation(9, "cut", A)[:-4], m.commit(), m.insert(7, [1, "y"]) + "z",
        m.begin()[:20],
    ]
    log = m.log(spark, texts)
    found = report.quarantine(log, Registry.load(log)).select("seq", "reason", "data").collect()
    assert {r.seq: r.reason for r in found} == {
        0: "unmapped_relation", 3: "bad_value", 4: "unmapped_relation", 5: "unknown_type", 6: "bad_hex",
        7: "cut_tuple", 10: "no_key", 11: "bad_relation", 13: "bad_hex", 14: "short_message",
    }
    assert all(r.data == texts[r.seq] for r in found) and len(found) == 10
    assert dict(collect(report.error_counts(report.quarantine(log, Registry.load(log)))))["bad_hex"] == 2
