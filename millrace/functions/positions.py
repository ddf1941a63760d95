"""Log positions: ``high/low`` in hex, ordered by the 64-bit number they stand for."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

POSITION = "decimal(20,0)"


def position_number(text: Column) -> Column:
    def half(part: int) -> Column:
        return F.conv(F.split_part(text, F.lit("/"), F.lit(part)), 16, 10).cast(POSITION)

    return (half(1) * F.lit(2**32).cast("decimal(11,0)") + half(2)).cast(POSITION)


def position_text(number: Column) -> Column:
    """Inverse of :func:`position_number` for positions below 2**63."""
    n = number.cast("bigint")
    return F.concat_ws(
        "/", F.hex(F.shiftrightunsigned(n, 32)), F.hex(n.bitwiseAND(F.lit(2**32 - 1).cast("bigint")))
    )
