"""Small column expressions shared by the operators."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def clip(value: Column, low: float | None = None, high: float | None = None) -> Column:
    """Bound a value and keep null (a bare greatest/least would return the bound)."""
    out = value
    if low is not None:
        out = F.greatest(out, F.lit(float(low)))
    if high is not None:
        out = F.least(out, F.lit(float(high)))
    return F.when(value.isNotNull(), out)


def round_even(value: Column, digits: int) -> Column:
    """Scale, round half to even, unscale: the rounding of array libraries."""
    scale = float(10**digits)
    return F.rint(value * scale) / scale


def finite_or_null(value: Column) -> Column:
    """NaN and infinities become null."""
    return F.when(~F.isnan(value) & (F.abs(value) != F.lit(float("inf"))), value)


def lenient_double(value: Column) -> Column:
    """Text or number to double; unreadable text and NaN become null."""
    number = value.try_cast("double")
    return F.when(~F.isnan(number), number)


def lenient_long(value: Column) -> Column:
    """Text or number to a whole number, cut toward zero, null if unreadable."""
    return lenient_double(value).try_cast("bigint")


def present(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The names a table has. Exact spelling counts, unlike Spark's own lookup."""
    have = set(df.columns)
    return [name for name in names if name in have]


def column_or(df: DataFrame, names: str | Iterable[str], default: object) -> Column:
    """First column of ``names`` the table has, else a literal.

    The choice follows from the table's columns when the plan is built, never
    from the values of a row.
    """
    wanted = [names] if isinstance(names, str) else list(names)
    found = present(df, wanted)
    return F.col(found[0]) if found else F.lit(default)


WHITE = " \t\n\r\f\v"


def strip(value: Column) -> Column:
    """Text without white space of any kind at both ends."""
    return F.btrim(value, F.lit(WHITE))


def quoted(name: str) -> str:
    """A column name that Spark takes as it is, dots and backticks included."""
    return "`" + name.replace("`", "``") + "`"


def text_flag(value: Column) -> Column:
    """true / 1 / yes in any case is true, everything else (null too) is false."""
    return F.coalesce(F.lower(strip(value.cast("string"))).isin("true", "1", "yes"), F.lit(False))


def numeric_columns(df: DataFrame, exclude: Iterable[str] = ()) -> list[str]:
    """Names of number columns in table order; booleans are not numbers."""
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def nan_to_null(df: DataFrame) -> DataFrame:
    """One missing value instead of two: NaN in double and float columns becomes null."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floats}) if floats else df


def title_label(name: str) -> str:
    """snake_case to Title Case."""
    return name.replace("_", " ").title()
