"""Number formats that round the exact binary value half to even, as C's printf does.

Spark's own ``format_string`` rounds the decimal text half up, so the last step
is an Arrow function over whole batches.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

DASH = "—"


#: (from, divisor, decimals, suffix), the largest first.
STEPS = ((10**6, 10**6, 1, "M"), (10**3, 10**3, 0, "K"), (float("-inf"), 1, 0, ""))
UNITS = ("B", "KB", "MB", "GB", "TB")


def abbrev_one(n: int | None) -> str:
    if n is None:
        return DASH
    _, divisor, decimals, suffix = next(s for s in STEPS if n >= s[0])
    return f"{n / divisor:.{decimals}f}{suffix}"


def size_one(n: int | None, units: tuple[str, ...] = UNITS) -> str:
    if not n:
        return DASH
    power = min(len(units) - 1, (n.bit_length() - 1) // 10)
    return f"{n / 1024**power:.{min(power, 1)}f} {units[power]}"


def abbrev(n: Column) -> Column:
    """12345 -> 12K, 1250000 -> 1.2M; null -> dash. Only what has to be rounded leaves generated code."""

    @F.arrow_udf("string")
    def of(x: pa.Array) -> pa.Array:
        return pa.array([None if v is None else abbrev_one(v) for v in x.to_pylist()], pa.string())

    n = n.cast("long")
    return F.when(n.isNull(), DASH).when(n < 1000, n.cast("string")).otherwise(of(F.when(n >= 1000, n)))


def human_size(n: Column, units: tuple[str, ...] = UNITS) -> Column:
    """Bytes in units of 1024, the last of which has no end; null and 0 -> dash. Only what has to be rounded leaves generated code."""

    @F.arrow_udf("string")
    def of(x: pa.Array) -> pa.Array:
        return pa.array([None if v is None else size_one(v, units) for v in x.to_pylist()], pa.string())

    n = n.cast("long")
    return F.when(F.coalesce(n, F.lit(0)) == 0, DASH).when(n.between(1, 1023), F.concat(n.cast("string"), F.lit(" B"))).otherwise(of(F.when(~n.between(0, 1023), n)))


def commafy(n: Column) -> Column:
    return F.coalesce(F.format_number(n.cast("long"), 0), F.lit(DASH))


def bar_percent(v: Column, top: Column) -> Column:
    """A bar's width in percent of the largest, 0.8 at least; a largest of 0 counts as 1."""
    return F.greatest(v / F.when(top == 0, F.lit(1)).otherwise(top) * 100, F.lit(0.8))


def two_decimals(x: Column) -> Column:
    """A number with two decimals, as text, of the exact binary value."""

    @F.arrow_udf("string")
    def of(v: pa.Array) -> pa.Array:
        return pa.array([None if y is None else f"{y:.2f}" for y in v.to_pylist()], pa.string())

    return of(x.cast("double"))


def segment_percent(n: Column, whole: Column) -> Column:
    """A segment's share in percent; null where it is empty and so left out."""
    return F.when(n > 0, n / F.greatest(whole, F.lit(1)) * 100)
