"""Exact aggregate expressions. Sums stay DECIMAL or BIGINT, so results do not depend on row order."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)


def money(c: Column) -> Column:
    return c.cast(MONEY)


def number(c: Column) -> Column:
    return c.cast("double")


def ratio(a: Column, b: Column) -> Column:
    """a / b as double; null where b is zero or null."""
    return F.try_divide(number(a), number(b))


def mean(c: Column) -> Column:
    """Average over non-null values: exact sum, one division."""
    return ratio(F.sum(c), F.count(c))


def count_if(condition: Column) -> Column:
    return F.count(F.when(condition, F.lit(1)))


def sum_if(condition: Column, c: Column, zero) -> Column:
    return F.coalesce(F.sum(F.when(condition, c)), F.lit(zero))


def days_between(start: Column, end: Column) -> Column:
    """Whole days from start to end. Both are dates, so midnights and 24 h periods agree."""
    return F.datediff(end, start)


def as_of(facts: DataFrame, reference_date=None, column: str = "TransactionDate") -> Column:
    """Reference date of a report: the given date, or the newest date in the facts.

    The default is a scalar subquery. A job that runs many reports resolves it once with
    ``newest_date`` and passes the literal, which Spark can push into the scan.
    """
    if reference_date is None:
        return facts.agg(F.max(F.col(column)).cast("date").alias("ref")).scalar()
    if isinstance(reference_date, Column):
        return reference_date
    return F.lit(reference_date).cast("date")


def newest_date(facts: DataFrame, column: str = "TransactionDate"):
    return facts.agg(F.max(F.col(column)).cast("date")).first()[0]


def numeric_columns(df: DataFrame, exclude=()) -> list[str]:
    skip = set(exclude)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType) and f.name not in skip]


def zero_filled(df: DataFrame, columns=None) -> DataFrame:
    """Null to 0 in numeric columns, also DECIMAL ones, which ``fillna`` leaves alone."""
    targets = set(numeric_columns(df) if columns is None else columns)
    return df.selectExpr(
        *[
            f"coalesce(`{f.name}`, cast(0 as {f.dataType.simpleString()})) as `{f.name}`" if f.name in targets else f"`{f.name}`"
            for f in df.schema.fields
        ]
    )
