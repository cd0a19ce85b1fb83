"""Lenient numeric parsing: what cannot be read becomes NULL instead of an error."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Java's number parser takes more than plain numerals ("1d", "0x1p3"), so texts are checked first.
NUMERAL = r"(?i)^\s*[+-]?(\d+\.?\d*(e[+-]?\d+)?|\.\d+(e[+-]?\d+)?|inf|infinity|nan)\s*$"


def _numeral_sql(name: str, dtype: T.DataType) -> str:
    if isinstance(dtype, T.StringType):
        return f"if(`{name}` rlike r'{NUMERAL}', trim(`{name}`), null)"
    return f"`{name}`"


def _float_sql(name: str, dtype: T.DataType) -> str:
    return f"nullif(try_cast({_numeral_sql(name, dtype)} as double), double('NaN'))"


def to_float(name: str, dtype: T.DataType) -> Column:
    """The column as double, with NaN and unreadable values as NULL."""
    return F.expr(_float_sql(name, dtype))


def to_volume(name: str, dtype: T.DataType) -> Column:
    """The column as bigint, truncated towards zero; missing, unreadable and infinite values
    count as 0."""
    if isinstance(dtype, T.IntegralType):
        return F.expr(f"coalesce(cast(`{name}` as bigint), 0L)")
    return F.expr(
        f"coalesce(try_cast({_numeral_sql(name, dtype)} as bigint), "
        f"try_cast({_float_sql(name, dtype)} as bigint), 0L)"
    )


def nan_to_null(df: DataFrame) -> DataFrame:
    """NaN means "missing" in bar data, but Spark compares NaN as a large number: make it NULL."""
    floating = [f.name for f in df.schema if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    if not floating:
        return df
    return df.withColumns({c: F.expr(f"if(isnan(`{c}`), null, `{c}`)") for c in floating})
