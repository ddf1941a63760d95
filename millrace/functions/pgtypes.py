"""Source type numbers, the Spark types they become, and text-to-type casts."""
from __future__ import annotations

from dataclasses import dataclass, replace
from operator import itemgetter
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..shared import local_frame

# Type numbers of the source database, and what each is read as.
SCALARS = {
    16: ("bool", T.BooleanType()),
    17: ("bytea", T.BinaryType()),
    18: ("char", T.StringType()),
    19: ("name", T.StringType()),
    20: ("int8", T.LongType()),
    21: ("int2", T.ShortType()),
    23: ("int4", T.IntegerType()),
    25: ("text", T.StringType()),
    700: ("float4", T.FloatType()),
    701: ("float8", T.DoubleType()),
    705: ("unknown", T.StringType()),
    1043: ("varchar", T.StringType()),
    1082: ("date", T.DateType()),
    1083: ("time", T.StringType()),
    1114: ("timestamp", T.TimestampNTZType()),
    1560: ("bit", T.BooleanType()),
    1700: ("numeric", T.StringType()),  # unless its modifier or its values give a decimal
    2950: ("uuid", T.StringType()),
}

# Array type number -> element type number.
ARRAYS = {
    1000: 16, 1002: 18, 1005: 21, 1007: 23, 1009: 25, 1015: 1043,
    1016: 20, 1021: 700, 1022: 701, 1231: 1700, 1561: 1560, 2951: 2950,
}

# Document type reported for each source type; others report none.
REPORTED = {
    "int2": "INT8", "int4": "INT8", "int8": "INT8", "numeric": "INT64", "bit": "BOOL",
    "float4": "FLOAT", "float8": "DOUBLE", "text": "STRING", "char": "STRING",
    "varchar": "STRING", "uuid": "STRING",
}

# Types whose values may be stored out of line and then arrive as "unchanged".
_OUT_OF_LINE = {17, 25, 705, 1043, 1560, 1700}

_INTEGERS = (20, 21, 23)
_TRUE, _FALSE = ("t", "true", "1"), ("f", "false", "0")
_NUMERIC = 1700
_PLAIN_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)$"
_NOT_FINITE = ("NaN", "Infinity", "-Infinity")  # fixed values: numerics without digits
MOST_DIGITS = 38
_SCALES = (9, 18, 27)  # tried first, so that a column seldom changes its type as more values are seen

NATIVE, NARROW = "native", "narrow"


class Digits(NamedTuple):
    """The most digits seen before and behind the point of a numeric column, and whether some value has none."""

    whole: int = 0
    fraction: int = 0
    not_finite: bool = False

    def with_(self, other: "Digits") -> "Digits":
        return Digits(max(self.whole, other.whole), max(self.fraction, other.fraction), self.not_finite or other.not_finite)


@dataclass(frozen=True)
class SourceColumn:
    """One column as the source describes it. ``digits`` is what its values need, where the modifier does not tell."""

    name: str
    oid: int
    typmod: int = -1
    is_key: bool = False
    digits: Digits | None = None

    @property
    def type_name(self) -> str:
        if self.oid in ARRAYS:
            return SCALARS[ARRAYS[self.oid]][0] + "[]"
        return SCALARS[self.oid][0] if self.oid in SCALARS else "other"

    @property
    def reported_type(self) -> str | None:
        return "ARRAY" if self.oid in ARRAYS else REPORTED.get(self.type_name)

    @property
    def may_be_unchanged(self) -> bool:
        return self.oid in _OUT_OF_LINE or self.oid not in SCALARS

    @property
    def is_open_numeric(self) -> bool:
        """A numeric, or an array of them, whose modifier sets no precision that Spark can hold."""
        return ARRAYS.get(self.oid, self.oid) == _NUMERIC and not _bounded(self.typmod)

    def element(self) -> "SourceColumn":
        return SourceColumn("", ARRAYS[self.oid], self.typmod, digits=self.digits)

    def spark_type(self, profile: str = NATIVE) -> T.DataType:
        if self.oid in ARRAYS:
            return T.ArrayType(self.element().spark_type(profile))
        if profile == NARROW:
            if self.oid in _INTEGERS:
                return T.ByteType()
            if self.oid == 1700:
                return T.LongType()
        if self.oid == _NUMERIC:
            return numeric_type(self.typmod, self.digits)
        return SCALARS[self.oid][1] if self.oid in SCALARS else T.StringType()


def _bounded(typmod: int) -> bool:
    """Whether the type modifier gives a precision and scale that Spark can hold."""
    precision, scale = ((typmod - 4) >> 16) & 0xFFFF, (typmod - 4) & 0x7FF
    return typmod >= 4 and scale <= precision <= 38


def decimal_type(typmod: int) -> T.DecimalType:
    """Precision and scale from a bounded type modifier."""
    return T.DecimalType(((typmod - 4) >> 16) & 0xFFFF, (typmod - 4) & 0x7FF)


def numeric_type(typmod: int, digits: Digits | None) -> T.DataType:
    """The type that holds every value exactly: a decimal where one has room for all digits, else text.

    Text is in one normal form (no needless zeros), so that equal numbers are equal texts.
    """
    if _bounded(typmod):
        return decimal_type(typmod)
    if digits is None or digits.not_finite or digits.whole + digits.fraction > MOST_DIGITS:
        return T.StringType()
    scale = next((s for s in _SCALES if digits.fraction <= s <= MOST_DIGITS - digits.whole), digits.fraction)
    return T.DecimalType(MOST_DIGITS, scale)


def _whole(text: Column) -> Column:
    return F.regexp_extract(text, r"^[+-]?0*([0-9]*)", 1)


def _fraction(text: Column) -> Column:
    return F.regexp_extract(text, r"\.([0-9]*?)0*$", 1)


def number_text(text: Column) -> Column:
    """A numeric in its normal form; null when the text is no numeric."""
    whole, fraction = _whole(text), _fraction(text)
    size = F.concat(
        F.when(whole == "", "0").otherwise(whole), F.when(fraction == "", "").otherwise(F.concat(F.lit("."), fraction)))
    sign = F.when(text.startswith("-") & (size != "0"), "-").otherwise("")
    return F.when(text.rlike(_PLAIN_NUMBER), F.concat(sign, size)).when(text.isin(*_NOT_FINITE), text)


def digit_counts(text: Column, column: SourceColumn) -> Column:
    """(whole, fraction, not_finite) that the text of one value needs; null when it is no numeric."""
    if column.oid in ARRAYS:
        return most_digits(F.transform(array_items(text), lambda item: digit_counts(item, column.element())))
    found = F.struct(
        F.length(_whole(text)).alias("whole"), F.length(_fraction(text)).alias("fraction"),
        text.isin(*_NOT_FINITE).alias("not_finite"))
    return F.when(text.rlike(_PLAIN_NUMBER) | text.isin(*_NOT_FINITE), found)


def most_digits(each: Column) -> Column:
    """The largest (whole, fraction, not_finite) of an array of them; null when it holds none."""
    counts = F.array_compact(each)
    most = [F.array_max(F.transform(counts, itemgetter(n))).alias(n) for n in Digits._fields]
    return F.when(F.size(counts) > 0, F.struct(*most))


def fits(text: Column, oid: Column, typmod: Column) -> Column:
    """Whether a value's text fits the type of a number in ``oid`` and ``typmod``: one check for all types, by their numbers."""
    number = F.coalesce(*[F.when(oid == array, F.lit(item)) for array, item in ARRAYS.items()])
    lost = F.exists(array_items(text), lambda item: item.isNotNull() & ~_fits_scalar(item, number, typmod))
    return F.when(oid.isin(*ARRAYS), F.coalesce(~lost, F.lit(False))).otherwise(_fits_scalar(text, oid, typmod))


def _fits_scalar(text: Column, oid: Column, typmod: Column) -> Column:
    modifier = typmod - 4
    scale = modifier.bitwiseAND(0x7FF)
    room = F.shiftright(modifier, 16).bitwiseAND(0xFFFF) - scale
    bounded = (typmod >= 4) & (room >= 0) & (room + scale <= MOST_DIGITS)
    whole, fraction = _whole(text), _fraction(text)
    # Rounding to the scale carries into a new digit when all digits that stay are nines.
    carries = (F.concat(whole, F.substring(fraction, F.lit(1), scale)) == F.repeat(F.lit("9"), room + scale)) & (
        F.substring(fraction, scale + 1, F.lit(1)) >= "5")
    held = text.rlike(_PLAIN_NUMBER) & (F.length(whole) <= room) & ~carries
    numeric = F.when(bounded, held).otherwise(number_text(text).isNotNull())
    checks = {
        16: text.isin(*_TRUE, *_FALSE), 1560: text.isin(*_TRUE, *_FALSE),
        17: text.startswith("\\x") & F.unhex(F.substring(text, 3, 2**31 - 1)).isNotNull(),
        _NUMERIC: numeric,
    }
    for known, (_, kind) in SCALARS.items():
        if known not in checks and not isinstance(kind, T.StringType):
            checks[known] = text.try_cast(kind).isNotNull()
    chain = F
    for known, ok in checks.items():
        chain = chain.when(oid == known, ok)
    return chain.otherwise(F.lit(True))


def widest(one: SourceColumn, other: SourceColumn) -> SourceColumn:
    """A column that holds every value of both, which are versions of one column.

    Integers and floats widen among themselves, integers and numerics meet in a numeric that has
    room for both. What has no common type becomes text, which holds any value.
    """
    if (one.oid, one.typmod) == (other.oid, other.typmod):
        return one
    if one.oid in ARRAYS and other.oid in ARRAYS:
        items = [c.element() for c in (one, other)]
        wide = widest(*items)
        back = next((a for a, item in ARRAYS.items() if item == wide.oid), None)
        return replace(one, oid=25, typmod=-1) if back is None else replace(one, oid=back, typmod=wide.typmod)
    for order in ((21, 23, 20), (700, 701)):
        if one.oid in order and other.oid in order:
            return replace(one, oid=max(one.oid, other.oid, key=order.index), typmod=-1)
    whole = {21: 5, 23: 10, 20: 19}
    if {one.oid, other.oid} <= {*whole, 1700}:
        if all(c.oid in whole or _bounded(c.typmod) for c in (one, other)):
            kinds = [T.DecimalType(whole[c.oid], 0) if c.oid in whole else decimal_type(c.typmod) for c in (one, other)]
            scale = max(k.scale for k in kinds)
            precision = scale + max(k.precision - k.scale for k in kinds)
            if precision <= 38:
                return replace(one, oid=1700, typmod=(precision << 16 | scale) + 4)
        return replace(one, oid=1700, typmod=-1)
    if one.spark_type() != other.spark_type():
        return replace(one, oid=25, typmod=-1)
    return replace(one if one.may_be_unchanged else other, typmod=-1)


def type_table(spark: SparkSession) -> DataFrame:
    """All known type numbers: ``oid, source_type, reported_type, spark_type``, as fixed above."""
    known = [SourceColumn("", oid) for oid in (*SCALARS, *ARRAYS)]
    rows = [
        {"oid": c.oid, "source_type": c.type_name, "reported_type": c.reported_type, "spark_type": c.spark_type().simpleString()}
        for c in known
    ]
    return local_frame(spark, rows, "oid int, source_type string, reported_type string, spark_type string")


def spark_type_text(spark_type: Column, oid: Column, typmod: Column) -> Column:
    """Name of a column's Spark type: the precision of a numeric comes from its modifier."""
    modifier = typmod - 4
    precision, scale = F.shiftright(modifier, 16).bitwiseAND(0xFFFF), modifier.bitwiseAND(0x7FF)
    bounded = (typmod >= 4) & (scale <= precision) & (precision <= MOST_DIGITS)
    decimal = F.format_string("decimal(%d,%d)", precision, scale)
    return F.when(bounded & (oid == _NUMERIC), decimal).when(
        bounded & oid.isin(*[a for a, item in ARRAYS.items() if item == _NUMERIC]), F.format_string("array<%s>", decimal)
    ).otherwise(F.coalesce(spark_type, F.lit("string")))


def schema_of(columns: list[SourceColumn], profile: str = NATIVE) -> T.StructType:
    return T.StructType([T.StructField(c.name, c.spark_type(profile)) for c in columns])


def cast_text(text: Column, column: SourceColumn, profile: str = NATIVE) -> Column:
    """Typed value of one text value; null when the text does not fit the type."""
    if column.oid in ARRAYS:
        element = column.element()
        # NULL without quotes is a null element; with quotes it is a word.
        return F.transform(array_items(text), lambda item: cast_text(item, element, profile))
    if profile == NARROW and column.oid in _INTEGERS:
        value = text.try_cast("bigint")
        return (F.pmod(value + 128, F.lit(256)) - 128).cast("tinyint")
    if profile == NARROW and column.oid == _NUMERIC:
        whole = F.regexp_extract(number_text(text), r"^-?[0-9]+", 0)
        return whole.try_cast("bigint")
    if column.oid in (16, 1560):
        return F.when(text.isin(*_TRUE), True).when(text.isin(*_FALSE), False)
    if column.oid == 17:
        return F.when(text.startswith("\\x"), F.unhex(F.substring(text, 3, 2**31 - 1)))
    target = column.spark_type(profile)
    if column.is_open_numeric:
        return open_numeric(text, target)
    return text if isinstance(target, T.StringType) else text.try_cast(target)


def open_numeric(text: Column, target: T.DataType) -> Column:
    """A numeric that no modifier bounds: exact, or null; it is not rounded."""
    if isinstance(target, T.StringType):
        return number_text(text)
    return F.when(F.length(_fraction(text)) <= target.scale, text.try_cast(target))


def array_items(text: Column) -> Column:
    """Items of ``{a,b,"c,d"}`` as text, with null for a bare ``NULL``.

    Bounds in front, as in ``[0:2]={a,b,c}``, are dropped. Arrays of arrays do not fit a type of one
    dimension: they, and text without the outer braces, give null. Text without quotes is split on commas. Otherwise the items are matched one
    by one, so commas inside quotes do not split and escapes are undone.
    """
    text = F.regexp_replace(text, r"^(\[[-+0-9]+:[-+0-9]+\])+=", "")
    flat = text.rlike(r"^\{(?!\s*\{)(?s:.*)\}$")
    inner = F.regexp_replace(text, r"^\{|\}$", "")
    plain = F.transform(F.split(inner, ",", -1), lambda item: F.when(item != "NULL", item))
    # The leading comma makes every item, an empty quoted one too, match non-empty text.
    pieces = F.regexp_extract_all(
        F.concat(F.lit(","), inner), F.lit(r',("(?:[^"\\]|\\.)*"|[^,]*)'), F.lit(1)
    )
    quoted = F.transform(
        pieces,
        lambda item: F.when(
            item.startswith('"'),
            F.regexp_replace(F.regexp_replace(item, r'^"|"$', ""), r"\\(.)", "$1"),
        ).when(item != "NULL", item),
    )
    return (
        F.when(~flat | text.isNull(), None)
        .when(inner == "", F.array().cast("array<string>"))
        .when(F.contains(text, F.lit('"')), quoted)
        .otherwise(plain)
    )
