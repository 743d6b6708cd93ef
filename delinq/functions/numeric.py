"""Numeric helpers shared by all operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def np_round(x: Column, digits: int) -> Column:
    """Round half to even on the scaled double, as array libraries do.

    Spark's ``round``/``bround`` work on the decimal text of the value and differ on near-ties.
    """
    scale = F.lit(float(10**digits))
    return F.rint(x * scale) / scale


def clip(x: Column, low: float, high: float) -> Column:
    """Bound to [low, high]; NULL stays NULL (``least``/``greatest`` alone would skip it)."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def ratio(a: Column, b: Column) -> Column:
    """a / b with 0 for a missing value or a zero divisor."""
    return F.coalesce(F.try_divide(a, b), F.lit(0.0))


def scaled_sum(x: Column, digits: int) -> Column:
    """Sum of a double column in whole units of 10^-digits.

    Integers add up exactly, so partitioning and task order cannot change the result, and the
    sum stays in compiled primitive arithmetic (a decimal sum would not). A sum beyond 64 bits
    is an error, not a wrong number. NaN counts as missing.
    """
    scale = F.lit(float(10**digits))
    units = F.when(~F.isnan(x), F.rint(x * scale).cast("bigint"))
    return F.sum(units).cast("double") / scale


def money_sum(x: Column) -> Column:
    """Exact sum of amounts in cents."""
    return scaled_sum(x, 2)


def exact_avg(x: Column, digits: int = 6) -> Column:
    """Mean through an exact sum of values with up to ``digits`` decimals."""
    return F.try_divide(scaled_sum(x, digits), F.count(x).cast("double"))


def flag(condition: Column) -> Column:
    """0/1 integer; an unknown condition counts as 0."""
    return F.coalesce(condition, F.lit(False)).cast("int")


def uniform(key: Column, seed: int) -> Column:
    """Repeatable number in [0, 1) from a key: same value on every engine and partitioning."""
    digest = F.md5(F.concat_ws(":", key.cast("string"), F.lit(str(seed))))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("double") / F.lit(4294967296.0)


def nan_to_null(df: DataFrame) -> DataFrame:
    """Turn NaN into NULL in all floating columns (Spark orders NaN above every number)."""
    floats = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floats:
        return df
    return df.withColumns({c: F.when(~F.isnan(F.col(f"`{c}`")), F.col(f"`{c}`")) for c in floats})
