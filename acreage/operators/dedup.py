"""Deduplication and identity."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreage.sources.scratch import settled


def latest_by(df: DataFrame, keys: list[str], order: list[Column], null_keys: str = "collapse") -> DataFrame:
    """One row per key, the first in ``order`` (which should be total). Null keys are one key, or all kept (``keep_all``).

    Asking for the first row number lets Spark keep one row per key in each task
    before the shuffle, so that a hot key, null ones among them, arrives as a row per task.
    """
    first = lambda rows: rows.withColumn("_row", F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where("_row = 1").drop("_row")
    if null_keys != "keep_all":
        return first(df)
    some_null = F.lit(False)
    for k in keys:
        some_null = some_null | F.col(k).isNull()
    return first(df.where(~some_null)).unionByName(df.where(some_null))


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    return latest_by(df, keys, order)


def numbered(df: DataFrame, name: str, order: list[Column]) -> DataFrame:
    """Row numbers from 1 in a global order, without moving all rows to one task.

    The sorted frame is written, so that rows and partition sizes come from the same ranges even if executors are lost.
    """
    part = settled(df.orderBy(*order).withColumn("_id", F.monotonically_increasing_id()).withColumn("_part", F.shiftrightunsigned("_id", 33)), "numbered")
    sizes = part.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("_part", before.alias("_before"))  # one row per partition
    inside = F.col("_id") - F.shiftleft(F.col("_part"), 33)
    return part.join(F.broadcast(offsets), "_part").withColumn(name, (F.col("_before") + inside + 1).cast("long")).drop("_id", "_part", "_before")


def sequential_id(df: DataFrame, name: str, prefix: str, order: list[Column]) -> DataFrame:
    return numbered(df, "_number", order).withColumn(name, F.concat(F.lit(prefix), F.col("_number").cast("string"))).drop("_number")


def hash_id(*parts: Column) -> Column:
    """SHA-256 of the trimmed, lower-cased parts joined by a bar; nulls are empty."""
    return F.sha2(F.concat_ws("|", *(F.lower(F.trim(F.coalesce(p.cast("string"), F.lit("")))) for p in parts)), 256)


def unscraped_first(df: DataFrame, url: str = "url", scraped: str = "scraped_at", created: str = "created_at", tie: str | None = None) -> DataFrame:
    """One row per url of a queue: an unscraped one if there is one, then the newest."""
    order = [F.when(F.col(scraped).isNull(), 0).otherwise(1), F.col(created).desc()]
    return latest_by(df, [url], [*order, F.col(tie)] if tie else order)


def distinct_phrases(c: Column) -> Column:
    """Distinct items of nested lists, sorted."""
    return F.array_sort(F.array_distinct(F.flatten(c)))
