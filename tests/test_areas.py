"""Areas: distinct counts without a sort of all rows, and their points made once."""

from pyspark.sql import functions as F

from acreage.operators import series
from acreage.plans import mart_queries, marts

LEVELS, COUNTS = {"zip": "zip", "msa": "msa"}, {"units": "u", "prices": "p"}


def test_distinct_counts(spark):
    """A value in two places, nulls, both zeros, a place without any value and one without a zip."""
    rows = [("1", "a", 5, 1.5), ("1", "a", 5, 2.5), ("1", "a", 6, None), ("2", "a", 5, 0.0), ("2", "a", 7, -0.0), ("3", "b", None, None), (None, "b", 5, 1.5), (None, "b", 8, 1.5)]
    df = spark.createDataFrame(rows, "zip string, msa string, u int, p double")
    told = lambda found: {(r.geography_type, r.geography_value): (r.units, r.prices) for r in found.collect()}
    by_place, by_level = series.distinct_by_place(df, LEVELS, COUNTS, largest=("zip",)), series.distinct_by_level(df, LEVELS, COUNTS)
    assert told(by_place) == {("zip", "1"): (2, 2), ("zip", "2"): (2, 1), ("zip", "3"): (0, 0), ("msa", "a"): (4, 3), ("msa", "b"): (2, 1)}
    assert told(by_level) == {("zip", "1"): (2, 2), ("zip", "2"): (2, 1), ("msa", "a"): (3, 3), ("msa", "b"): (2, 1)}
    for found in (by_place, by_level):
        assert "SortAggregate" not in found._jdf.queryExecution().executedPlan().toString()


def test_rental_areas_read_their_points_once(spark, monkeypatch):
    """Trends, strengths and gains of both prices come from a table of points, not from all units each."""
    seen, real = [], marts.area_analysis
    monkeypatch.setattr(marts, "area_analysis", lambda points, *a: seen.extend(points.inputFiles()) or real(points, *a))
    assert mart_queries.mart_rental_areas(spark, "/root/testdata/sf0.001").where(F.col("total_units") > 0).count() > 0
    assert seen and all("mart-rental-areas" in f for f in seen)
