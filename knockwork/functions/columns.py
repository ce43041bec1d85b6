"""Small column expressions that several operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def finite(x: Column) -> Column:
    """``x``, or null where it is null, NaN or infinite."""
    d = x.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


def ratio(a: Column, b: Column) -> Column:
    """a / b, null where b is zero or either is null."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def require(df: DataFrame, *columns: str, what: str = "table") -> DataFrame:
    """``df``, after a check that it has some columns."""
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"{what} lacks {', '.join(missing)}; it has {', '.join(df.columns)}")
    return df
