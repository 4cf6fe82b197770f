"""Row filters and splits."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldprep.functions.recode import holds, in_set


def keep_values(df: DataFrame, field: str, values: Iterable) -> DataFrame:
    """Rows whose field is one of the values; a literal list reaches the scan as a pushed filter."""
    return df.filter(F.col(field).isin(list(values)))


def keep_year(df: DataFrame, year: int, column: str = "Year") -> DataFrame:
    return df.filter(F.col(column) == year)


def split_by(df: DataFrame, condition: Column) -> tuple[DataFrame, DataFrame]:
    """Disjoint and complete: rows for which the condition holds, and all others."""
    return df.filter(holds(condition)), df.filter(~holds(condition))


def within(value: Column, start: Column, end: Column, buffer_minutes: int = 0) -> Column:
    """Inclusive interval test, optionally widened on both sides."""
    if not buffer_minutes:
        return value.between(start, end)
    slack = F.expr(f"INTERVAL {int(buffer_minutes)} MINUTE")
    return value.between(start - slack, end + slack)


def first_source_rows(df: DataFrame, n: int, position: str) -> DataFrame:
    """The first n rows of a hand-kept list, by the row number the list carries."""
    return df.filter(F.col(position) <= n)


def drop_missing(df: DataFrame, *columns: str) -> DataFrame:
    return df.dropna(subset=list(columns))


def keep_era(df: DataFrame, first: int | None, last: int | None, column: str = "Year") -> DataFrame:
    year = F.col(column)
    keep = F.lit(True)
    if first is not None:
        keep = keep & (year >= first)
    if last is not None:
        keep = keep & (year <= last)
    return df.filter(keep & year.isNotNull())


def name_preset(
    df: DataFrame, name: str, pattern: str, strict_name: str, city: str, cities: Sequence[str]
) -> DataFrame:
    """Names matching a pattern; one ambiguous name must also lie near a listed city."""
    ambiguous = F.col(name) == strict_name
    return df.filter(F.col(name).rlike(pattern) & ~(ambiguous & ~in_set(F.col(city), cities)))
