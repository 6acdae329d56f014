"""Row filters of listing tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def complete(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def in_market(df: DataFrame, state: str = "UT", low: float = 5000, high: float = 700000) -> DataFrame:
    """State, price range and valid coordinates."""
    return df.where((F.col("state") == state) & F.col("price").between(low, high) & F.col("latitude").between(-90, 90) & F.col("longitude").between(-180, 180))


def not_value(c: Column, *values: str) -> Column:
    """Null, or none of the values."""
    return c.isNull() | ~c.isin(*values)


def recent(end: Column, as_of: Column, months: int = 24) -> Column:
    """Open, or ended within the months."""
    return end.isNull() | (end >= F.add_months(as_of, -months))


def possible(area: Column, beds: Column, baths: Column) -> Column:
    """Not a building without rooms, nor rooms without a building."""
    zero = lambda c: F.coalesce(c, F.lit(0)) == 0
    return ~(~zero(area) & zero(beds) & zero(baths)) & ~(zero(area) & ~zero(beds) & ~zero(baths))


def finite_positive(c: Column) -> Column:
    return (c > 0) & ~F.isnan(c) & (c < F.lit(float("inf")))


def bounds(df: DataFrame, value: str) -> DataFrame:
    """Extent of the rows that can be drawn on a map."""
    return df.dropna(subset=["lat", "lon", value]).agg(*(f(c).alias(f"{f.__name__}_{c}") for c in ("lat", "lon", value) for f in (F.min, F.max)))


def coalesced(df: DataFrame, name: str, *others: str) -> DataFrame:
    """The column, or else the first of the others that has a value; rows without any are left out."""
    return df.withColumn(name, F.coalesce(name, *others)).where(F.col(name).isNotNull())


def recently_seen(df: DataFrame, latest: str, as_of: str, days: int = 210) -> DataFrame:
    """Groups whose latest date is at most so many days old."""
    return df.where(F.col(latest) >= F.date_sub(F.lit(as_of).cast("date"), days))
