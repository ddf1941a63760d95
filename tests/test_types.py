import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from millrace.functions import names
from millrace.functions.pgtypes import (
    NARROW, SCALARS, Digits, SourceColumn, cast_text, decimal_type, fits, numeric_type, widest,
)
from millrace.operators.project import _fits, conform, digits_of_rows, snapshot_misfits, with_digits
from millrace.operators.registry import TableShape

CASES = [
    (21, "-32768", -32768), (21, "40000", None), (23, "2147483647", 2147483647), (23, "1.5", None),
    (20, "-9223372036854775808", -(2**63)), (20, "x", None),
    (700, "0.5", 0.5), (701, "1e300", 1e300), (701, "-Infinity", float("-inf")), (701, "?", None),
    (16, "t", True), (16, "f", False), (16, "true", True), (16, "maybe", None),
    (1560, "1", True), (1560, "0", False),
    (1700, "12.9", "12.9"), (1700, "NaN", "NaN"), (1700, "0.12345678912345", "0.12345678912345"), (1700, "1.1000000000000", "1.1"),
    (1700, "-007.50", "-7.5"), (1700, "-0.00", "0"), (1700, "1" * 60, "1" * 60), (1700, "1e5", None), (1700, ".5", "0.5"),
    (25, "NULL", "NULL"), (18, "c", "c"), (1043, "", ""), (2950, "a-b", "a-b"), (19, "n", "n"), (705, "u", "u"),
    (17, "\\x00ff", b"\x00\xff"), (17, "00ff", None),
    (1082, "2024-02-29", dt.date(2024, 2, 29)), (1083, "10:00:00", "10:00:00"),
    (1114, "2024-02-29 10:11:12.5", dt.datetime(2024, 2, 29, 10, 11, 12, 500000)),
    (424242, "active", "active"),
    (1005, "{1,-2,NULL}", [1, -2, None]), (1007, "{}", []), (1016, "{5}", [5]),
    (1021, "{0.5,NULL}", [0.5, None]), (1022, "{1e10}", [1e10]),
    (1231, "{1.5,2}", ["1.5", "2"]),
    (1000, "{t,f,NULL}", [True, False, None]), (1561, "{1,0}", [True, False]),
    (1009, '{a,"b,c","d\\"e","NULL",NULL,""}', ["a", "b,c", 'd"e', "NULL", None, ""]),
    (1015, "{a,b}", ["a", "b"]), (1002, "{x}", ["x"]), (2951, "{p,q}", ["p", "q"]),
    (1009, "{a,,b}", ["a", "", "b"]), (1007, "[0:2]={1,NULL,3}", [1, None, 3]), (1009, "[-1:0][1:1]={a,b}", ["a", "b"]),
    (1007, "{{1,2},{3,4}}", None), (1009, "{{a,b},{c,d}}", None), (1009, '{"{a","b}"}', ["{a", "b}"]), (1007, "1,2", None),
    (1009, "{a\nb,c}", ["a\nb", "c"]), (1009, "[1:2][1:1]={{a},{b}}", None),
]


def test_every_type_is_covered():
    assert {oid for oid, _, _ in CASES} >= set(SCALARS)


def test_casts(spark):
    rows = spark.createDataFrame([(1,)], "i int").select(
        *[cast_text(F.lit(text), SourceColumn("c", oid)).alias(f"c{i}") for i, (oid, text, _) in enumerate(CASES)]
    ).first()
    for i, (oid, text, want) in enumerate(CASES):
        got = rows[i]
        if isinstance(got, bytearray):
            got = bytes(got)
        assert got == want, (oid, text)


def test_null_text_is_null(spark):
    null = F.lit(None).cast("string")
    row = spark.range(1).select(
        *[cast_text(null, SourceColumn("c", oid)).alias(f"c{oid}") for oid in (16, 17, 20, 25, 1114, 1007, 1009)]
    ).first()
    assert all(v is None for v in row)


def test_narrow_profile(spark):
    cases = [(23, "300", 44), (20, "127", 127), (21, "128", -128), (23, "-129", 127), (1700, "12.9", 12), (1700, "-12.9", -12)]
    row = spark.range(1).select(
        *[cast_text(F.lit(t), SourceColumn("c", oid), NARROW).alias(f"c{i}") for i, (oid, t, _) in enumerate(cases)]
    ).first()
    assert list(row) == [want for _, _, want in cases]
    array = spark.range(1).select(cast_text(F.lit("{300,NULL}"), SourceColumn("c", 1007), NARROW)).first()[0]
    assert array == [44, None]


def test_decimal_modifier():
    assert decimal_type(((15 << 16) | 2) + 4) == T.DecimalType(15, 2)
    for modifier in (-1, ((500 << 16) | 2) + 4):
        assert numeric_type(modifier, None) == T.StringType()
        assert numeric_type(modifier, Digits(5, 3)) == T.DecimalType(38, 9)
        assert numeric_type(modifier, Digits(5, 14)) == T.DecimalType(38, 18)
        assert numeric_type(modifier, Digits(34, 0)) == T.DecimalType(38, 0)
        assert numeric_type(modifier, Digits(30, 8)) == T.DecimalType(38, 8)
        assert numeric_type(modifier, Digits(30, 9)) == T.StringType()
        assert numeric_type(modifier, Digits(1, 1, True)) == T.StringType()


def test_fit_by_type_number_agrees_with_the_cast(spark):
    """One expression for all types against the cast of each type; numerics with a modifier at their edges."""
    money = ((5 << 16) | 2) + 4
    edges = [(1700, t, money) for t in ("999.99", "999.994", "999.995", "1000", "-999.995", "0.001", "x", "NaN", "12")]
    texts = [(oid, text, -1) for oid, text, _ in CASES] + edges + [
        (1007, "{1,x}", -1), (1231, "{1,NaN}", -1), (1231, "{1000}", money), (1021, "{NULL,?}", -1), (1009, "{x}", -1)]
    made = spark.createDataFrame([(i, *t) for i, t in enumerate(texts)], "i int, oid int, text string, typmod int")
    found = {r.i: r.ok for r in made.select("i", fits(F.col("text"), F.col("oid"), F.col("typmod")).alias("ok")).collect()}
    for i, (oid, text, typmod) in enumerate(texts):
        column = SourceColumn("c", oid, typmod)
        ok = spark.range(1).select(_fits(F.lit(text), column, "native")).first()[0]
        assert found[i] == ok, (oid, text, typmod)


def test_digits_of_snapshots(spark):
    columns = [SourceColumn(n, 1700) for n in ("a", "b", "c", "d", "e", "f")] + [SourceColumn("g", 1231)]
    shape = TableShape("public.t", columns, [], "f", [7], 1, 0)
    rows = spark.createDataFrame(
        [("1234567890123456789012345678901234", 0.125, 7, Decimal("1.5"), "NaN", None, ["1.25", None])],
        "a string, b double, c int, d decimal(20,14), e string, f string, g array<string>")
    found = digits_of_rows(rows, shape)
    assert found == {
        "a": (34, 0, False), "b": (0, 3, False), "c": (19, 0, False), "d": (6, 14, False), "e": (0, 0, True),
        "f": (0, 0, False), "g": (1, 2, False)}
    row = conform(rows, with_digits(shape, found)).first()
    assert row.a == Decimal("1234567890123456789012345678901234") and row.b == Decimal("0.125") and row.e == "NaN"
    assert row.d == Decimal("1.5") and row.g == [Decimal("1.25"), None] and row.f is None


def test_widest():
    def both(a, b, *mods):
        one, other = SourceColumn("c", a, *mods[:1]), SourceColumn("c", b, *mods[1:])
        found = {widest(one, other).spark_type(), widest(other, one).spark_type()}
        assert len(found) == 1
        return found.pop()

    assert both(21, 20) == T.LongType() and both(700, 701) == T.DoubleType()
    assert both(23, 1700, -1, ((12 << 16) | 2) + 4) == T.DecimalType(12, 2)
    assert both(20, 1700, -1, ((12 << 16) | 2) + 4) == T.DecimalType(21, 2)
    assert both(23, 701) == T.StringType() and both(1114, 25) == T.StringType()
    assert both(1007, 1016) == T.ArrayType(T.LongType())
    assert widest(SourceColumn("c", 19), SourceColumn("c", 25)).may_be_unchanged


def test_snapshot_misfits(spark):
    shape = TableShape("public.t", [SourceColumn("id", 23, -1, True), SourceColumn("n", 20)], ["id"], "d", [7], 1, 0)
    rows = spark.createDataFrame([(1, "5", "x"), (5_000_000_000, "?", "y"), (None, None, None)], "id bigint, n string, other string")
    found = snapshot_misfits(rows, shape).collect()
    assert [(r.reason, r.bad, r.data) for r in found] == [
        ("bad_value", ["id", "n"], '{"id":5000000000,"n":"?","other":"y"}')]
    assert snapshot_misfits(rows.select("other"), shape).count() == 0


def test_reported_types():
    assert SourceColumn("c", 21).reported_type == "INT8"
    assert SourceColumn("c", 1007).reported_type == "ARRAY"
    assert SourceColumn("c", 16).reported_type is None


@pytest.mark.parametrize("typed, want", [("t", "public.t"), ("s.t", "s.t"), (".t", "public.t"), ("s.t.u", "s.t.u")])
def test_names(spark, typed, want):
    assert names.normalize_text(typed) == want
    assert spark.range(1).select(names.normalize(F.lit(typed))).first()[0] == want
