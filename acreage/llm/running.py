"""Running totals over groups of any size, without gathering a group in one task."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def running_total(df: DataFrame, group: list[str], bucket: str, order: list[str], value: Column, name: str) -> DataFrame:
    """Add ``name``: the sum of ``value`` over the rows up to this one, by group, in the order (bucket, *order).

    ``bucket`` is a column whose order agrees with the wanted one and which cuts each
    group into many small pieces. Each piece is sorted on its own; the sums of the
    pieces before it come from one row per piece.
    """
    pieces = df.groupBy(*group, bucket).agg(F.sum(value).alias("_piece"))
    before = Window.partitionBy(*group).orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    offsets = pieces.select(
        *(F.col(c).alias(f"_o_{c}") for c in [*group, bucket]),
        F.coalesce(F.sum("_piece").over(before), F.lit(0)).alias("_before"),
    )
    same = None
    for c in [*group, bucket]:
        one = df[c].eqNullSafe(offsets[f"_o_{c}"])
        same = one if same is None else same & one
    inside = Window.partitionBy(*group, bucket).orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    return (
        df.join(offsets, same, "left")
        .withColumn(name, F.sum(value).over(inside) + F.col("_before"))
        .drop("_before", *(f"_o_{c}" for c in [*group, bucket]))
    )
