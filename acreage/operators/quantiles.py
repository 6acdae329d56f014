"""Exact quantiles of groups of any size, by counting ranges instead of gathering a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreage.sources.scratch import settled

#: A range with so many values is sorted in one task; a larger one is counted in finer ranges first.
SORTED_ROWS = 50_000
RANGES = 1024


def _range_of(value: Column, low: Column, high: Column) -> Column:
    """Which of the equal ranges between low and high holds the value; never falls as the value grows. NaN and infinity are in the outermost."""
    edge = 1.7e308
    finite = lambda c: F.when(F.isnan(c), edge).otherwise(F.greatest(F.least(c, F.lit(edge)), F.lit(-edge))) / 2
    return F.least(F.floor((finite(value) - finite(low)) / (finite(high) - finite(low)) * RANGES), F.lit(RANGES))


def quantiles(df: DataFrame, keys: list[str], columns: list[str], shares: tuple[float, ...] = (0.25, 0.75), sorted_rows: int = SORTED_ROWS) -> DataFrame:
    """Per group, ``_q_<column>``: the column's values at the shares, as doubles, linear between neighbours; null if the group has no value.

    Each share's one or two ranks are sought for. A group's values are counted in
    ranges between its least and greatest; the range that holds a rank is counted again
    in finer ones, until it holds few values or a single one. Rows of null keys have no quantiles.
    The frame is written before: means that come in another order each time they are made
    differ in their last digits, and a group's least value would no longer be among its values.
    """
    return quantiles_of_table(settled(df.dropna(subset=keys).select(*dict.fromkeys([*keys, *columns])), "quantiles-input"), keys, columns, shares, sorted_rows)


def quantiles_of_table(df: DataFrame, keys: list[str], columns: list[str], shares: tuple[float, ...] = (0.25, 0.75), sorted_rows: int = SORTED_ROWS) -> DataFrame:
    """``quantiles`` of a frame that gives the same values each time it is read."""
    value = F.array(*(F.struct(F.lit(k).alias("c"), F.col(c).cast("double").alias("v")) for k, c in enumerate(columns)))
    rows = df.dropna(subset=keys).select(*keys, F.inline(value)).where("v is not null").withColumnsRenamed({"c": "_c", "v": "_v"})
    of = [*keys, "_c"]
    groups = rows.groupBy(*of).agg(F.count("*").alias("_n"), F.min("_v").alias("_low"), F.max("_v").alias("_high"))
    at = [(F.col("_n") - 1) * p for p in shares]
    ranks = F.array_distinct(F.flatten(F.array(*(F.array(F.floor(x), F.ceil(x)) for x in at))))
    sought = settled(groups.withColumn("_total", F.col("_n")).withColumn("_rank", F.explode(ranks)).withColumn("_before", F.lit(0).cast("long")), "quantiles-sought")
    ready, written = None, False
    span = [*of, "_low", "_high"]
    wide = (F.col("_n") > sorted_rows) & (F.col("_low") < F.col("_high"))
    while True:
        narrow = sought.where(~wide)
        ready = narrow if ready is None else ready.unionByName(narrow)
        sought = sought.where(wide)
        if not sought.limit(1).count():
            break
        rows, written = (rows if written else settled(rows, "quantiles-rows")), True
        ranges = sought.select(*span).distinct()
        held = rows.join(ranges, of).where("_v between _low and _high").withColumn("_range", _range_of(F.col("_v"), F.col("_low"), F.col("_high")))
        counts = held.groupBy(*span, "_range").agg(F.count("*").alias("_m"), F.min("_v").alias("_a"), F.max("_v").alias("_b"))
        below = Window.partitionBy(*span).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # RANGES + 1 rows at most
        counts = counts.withColumn("_below", F.coalesce(F.sum("_m").over(below), F.lit(0)))
        inside = F.col("_rank") - F.col("_before")
        met = sought.join(counts, span).where((inside >= F.col("_below")) & (inside < F.col("_below") + F.col("_m")))
        sought = settled(met.select(*of, F.col("_m").alias("_n"), F.col("_a").alias("_low"), F.col("_b").alias("_high"), "_total", "_rank", (F.col("_before") + F.col("_below")).alias("_before")), "quantiles-sought")
    order = Window.partitionBy(*span).orderBy("_v")
    spans = ready.where("_low < _high").select(*span).distinct()
    placed = rows.join(spans, of).where("_v between _low and _high").withColumn("_place", F.row_number().over(order) - 1)
    same = ready.where("_low >= _high").select(*of, "_total", "_rank", F.col("_low").alias("_v"))
    found = same.unionByName(ready.join(placed, span).where("_rank - _before = _place").select(*of, "_total", "_rank", "_v"))

    def share(k: int, p: float) -> Column:
        position = (F.col("_total") - 1) * p
        low, high = (F.max(F.when((F.col("_c") == k) & (F.col("_rank") == end), F.col("_v"))) for end in (F.floor(position), F.ceil(position)))
        part = F.max(F.when(F.col("_c") == k, position - F.floor(position)))
        return F.when(part > 0, low * (1 - part) + high * part).otherwise(low)

    return found.groupBy(*keys).agg(*(F.array(*(share(k, p) for p in shares)).alias(f"_q_{c}") for k, c in enumerate(columns)))
