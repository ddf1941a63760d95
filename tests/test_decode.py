import struct

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

import messages as m
from millrace.functions import positions, wire
from millrace.operators import tuples
from millrace.operators.decode import decode_changes, decode_texts, stage_changes
from millrace.operators.project import table_changes
from millrace.operators.registry import Registry
from millrace.sources import encoder as enc


def decode(*texts):
    bodies = [None if t is None else bytes.fromhex(t[2:]) for t in texts]
    batch = pa.RecordBatch.from_pydict({"n": list(range(len(bodies))), "body": pa.array(bodies, pa.binary())})
    return [row for out in tuples.decode_batches([batch]) for row in out.to_pylist()]


def side(values):
    if values is None:
        return None
    return [
        (chr(v["k"]), v["v"]) for v in values
    ]


def expected(values):
    def one(v):
        if v is None:
            return ("n", None)
        if v is m.U:
            return ("u", None)
        return ("b", v) if isinstance(v, bytes) else ("t", str(v).encode())

    return None if values is None else [one(v) for v in values]


cells = st.one_of(st.none(), st.just(m.U), st.text(max_size=12), st.binary(max_size=12))
rows = st.lists(cells, max_size=6)
change = st.one_of(
    st.tuples(st.just("I"), st.none(), rows, st.none()),
    st.tuples(st.just("U"), st.one_of(st.none(), rows), rows, st.sampled_from("KO")),
    st.tuples(st.just("D"), rows, st.none(), st.sampled_from("KO")),
)


def message(op, old, new, tag):
    if op == "I":
        return m.insert(7, new)
    return m.update(7, new, old, tag) if op == "U" else m.delete(7, old, tag)


@settings(max_examples=150, deadline=None)
@given(st.lists(change, min_size=1, max_size=12), st.integers(1, 64))
def test_round_trip(changes, slice_bytes):
    before, tuples.SLICE_BYTES = tuples.SLICE_BYTES, slice_bytes
    try:
        found = decode(*[message(*c) for c in changes])
    finally:
        tuples.SLICE_BYTES = before
    for (op, old, new, tag), row in zip(changes, found, strict=True):
        assert row["err"] is None
        assert side(row["old"]) == expected(old)
        assert side(row["new"]) == expected(new)
        assert row["tag"] == (tag if old is not None else None)


@settings(max_examples=150, deadline=None)
@given(change, st.data())
def test_every_cut_is_reported_and_leaves_its_neighbours_alone(c, data):
    whole = bytes.fromhex(message(*c)[2:])
    cut = whole[: data.draw(st.integers(0, len(whole) - 1))]
    good = m.insert(7, ["a", None])
    first, broken, last = decode(good, m.text(cut), good)
    assert broken["err"] in ("short_message", "cut_tuple", "unknown_marker")
    assert broken["old"] is None and broken["new"] is None and broken["raw"] == cut
    for row in (first, last):
        assert side(row["new"]) == [("t", b"a"), ("n", None)] and row["raw"] is None


def test_reasons():
    head = b"I" + struct.pack(">i", 7) + b"N"
    kinds = m.text(head + struct.pack(">h", 1) + b"q")
    negative = m.text(head + struct.pack(">h", 1) + b"t" + struct.pack(">i", -5))
    minus = m.text(head + struct.pack(">h", -1))
    marker = m.text(b"U" + struct.pack(">i", 7) + b"X" + m.tuple_bytes(["a"]))
    found = decode(kinds, negative, minus, marker, None)
    assert [r["err"] for r in found] == [
        "unknown_value_kind", "cut_tuple", "cut_tuple", "unknown_marker", "bad_hex",
    ]


def test_wide_and_long_values():
    wide = [str(i) * (i % 5) for i in range(1600)]
    found = decode(m.insert(7, wide), m.insert(7, ["x" * 300_000, "é" * 1000]))
    assert side(found[0]["new"]) == expected(wide)
    assert side(found[1]["new"]) == expected(["x" * 300_000, "é" * 1000])


def test_headers_in_both_letter_cases(spark):
    texts = [m.begin(final=2**40 + 5, xid=9), m.insert(3_000_000_000 - 2**32, ["1"]), m.commit(77)]
    log = m.log(spark, texts + [t[:2] + t[2:].upper() for t in texts] + ["\\x4f00", "\\x4F00"])
    data = F.col("data")
    got = log.orderBy("seq").select(
        wire.message_type(data), wire.relation_id(data), wire.unsigned(data, 1, 8), wire.is_type(data, "C")
    ).collect()
    assert [r[0] for r in got] == list("BICBICOO")
    assert got[1][1] == got[4][1] == 3_000_000_000
    assert got[0][2] == got[3][2] == 2**40 + 5
    assert [r[3] for r in got[:6]] == [False, False, True] * 2


def test_positions_are_numbers(spark):
    frame = spark.createDataFrame([("0/9",), ("0/10",), ("1/0",), ("FFFFFFFF/FFFFFFFF",)], "t string")
    got = [int(r[0]) for r in frame.select(positions.position_number(F.col("t"))).collect()]
    assert got == [9, 16, 2**32, 2**64 - 1]


def test_staging_keeps_what_is_needed(spark):
    texts = [
        m.begin(), m.relation(7, "t", [("a", 25, True)]), m.insert(7, ["x"]), "\\x5A00",
        m.insert(7, ["xyz"])[:-2], "\\x4900zz", m.commit(), m.insert(7, ["x"]) + "0",
    ]
    got = {r.seq: r for r in stage_changes(m.log(spark, texts)).collect()}
    assert [got[i].part for i in range(8)] == [
        "control", "control", "change", "bad", "bad", "bad", "control", "bad",
    ]
    assert [got[i].reason for i in (3, 4, 5, 7)] == ["unknown_type", "cut_tuple", "short_message", "bad_hex"]
    assert got[4].data.lower() == texts[4] and got[1].data == texts[1] and got[7].data == texts[7]
    assert got[0].data is None and got[2].data is None


def test_dropped_tables_are_not_decoded(spark):
    log = m.log(spark, [m.insert(7, ["x"]), m.insert(8, ["y"])])
    assert [r.relid for r in decode_changes(log, [8]).collect()] == [8]
    assert decode_changes(log, []).count() == 0


@pytest.mark.parametrize("text", ["", "\\x", "\\xZZ"])
def test_unreadable_type(spark, text):
    row = m.log(spark, [text]).select(wire.header_error(F.col("data")).alias("e")).first()
    assert row.e == "bad_hex"


def test_bodies_and_types_of_odd_texts(spark):
    texts = ["\\x4901ff", "\\x4901f", "\\x4901fé", "\\x49é", "é\\4901", "éx4901", "49", "\\", "", "\\x", "\\xzz01", "\\x69", None]
    frame = spark.createDataFrame([(t,) for t in texts], "data string")
    found = frame.select(wire.body(F.col("data")).alias("b"), wire.message_type(F.col("data")).alias("t")).collect()
    bodies = [None if r.b is None else bytes(r.b).hex() for r in found]
    assert bodies == ["4901ff", None, None, None, "4901", "4901", "", "", "", "", None, "69", None]
    assert [r.t for r in found] == ["I", "I", "I", "I", "I", "I", "", "", "", "", None, "i", None]


def test_texts_hold_what_values_hold(spark):
    """Old and new values of readable messages, kinds of the new ones; nothing of the rest that a table does not need."""
    messages = [
        m.insert(7, [1, None, "\u00e4"]), m.update(7, [1, m.U, ""], [1, None, "x" * 300], tag="O"), m.update(7, [2, b"\xff\xfe", m.U]),
        m.update(7, [3], [1, "k"]), m.delete(7, [1, "v", None]), m.delete(8, [1]), m.insert(7, [])]
    messages += ["\\x" + messages[0][2:].upper(), messages[1][:-6], messages[4][:12], messages[0] + "0", "\\x49", None,
                 messages[2].replace("4e", "51", 1), m.begin(), m.commit()]
    log = m.log(spark, messages)
    for relids in ([7], [7, 8], []):
        whole = decode_changes(log, relids).where("err is null").selectExpr(
            "seq", "op", "relid", "transform(old, x -> x.v) o", "transform(new, x -> x.v) n", "transform(new, x -> x.k) k")
        texts = decode_texts(log, relids)
        assert texts.columns == ["seq", "op", "relid", "old", "new", "kinds", "err"]
        lean = texts.where("err is null").selectExpr(
            "seq", "op", "relid", "transform(old, x -> cast(x as binary)) o", "transform(new, x -> cast(x as binary)) n", "kinds k")
        assert sorted(map(str, lean.collect())) == sorted(map(str, whole.collect()))
        assert lean.count() == {1: 7, 2: 8, 0: 0}[len(relids)]


def test_a_table_is_typed_from_texts_as_from_values(spark):
    one = [("id", 20, True), ("n", 23, False), ("t", 25, False)]
    two = [("t", 25, False), ("id", 20, True), ("n", 20, False)]
    for later in ([], [m.relation(7, "t", two, identity="f"), m.update(7, [m.U, 4, 5], ["a", 4, "no"], tag="O")]):
        log = m.log(spark, [m.begin(), m.relation(7, "t", one, identity="f"), m.insert(7, [1, "x", "a"]),
                            m.update(7, [1, m.U, "b"], [1, 2, "a"], tag="O"), m.delete(7, [1, None, "b"], tag="O"), *later, m.commit()])
        registry = Registry.load(log)
        shape = registry.shape("t")
        names = ["seq", "op", "old", "new", "unchanged", "bad"]
        found = [
            sorted(map(str, table_changes(f(log, shape.relids), registry, shape).select(*names).collect()))
            for f in (decode_changes, decode_texts)]
        assert found[0] == found[1] and len(found[0]) == 3 + len(later) // 2


def test_marks_and_sizes_of_texts_of_any_length(spark):
    values = [None, "", "\u00e4", "\U0001f600" * 16, *["y" * n for n in (1, 62, 63, 64, 65, 255, 256, 70000)]]
    rows = spark.createDataFrame([(v,) for v in values], "v string")
    found = [r.m for r in rows.select(enc.text_value(F.col("v")).alias("m")).collect()]
    assert found == ["6E" if v is None else f"74{len(v.encode()):08X}{v.encode().hex().upper()}" for v in values]
