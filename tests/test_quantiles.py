"""Exact quantiles against numpy, with groups that are counted in several rounds."""

import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from acreage.operators import series
from acreage.operators.quantiles import quantiles


def test_quantiles(spark):
    """Hot groups, ties, one value, powers of ten, nulls; whatever may be sorted at once, the result is the same."""
    rng = random.Random(1)
    rows = [("hot", rng.gauss(0, 1), 5.0) for _ in range(3000)] + [("ties", float(rng.randrange(3)), 1.0) for _ in range(2000)] + [("powers", 10.0 ** rng.randrange(-200, 200), None) for _ in range(500)]
    rows += [("one", 7.0, 7.0), ("two", 1.0, None), ("two", 2.0, 4.0), ("none", None, 3.0), (None, 1.0, 1.0), ("steep", 1e308, -1e308), ("steep", -1e308, 1e308)] + [("steep", float(k), 1.0) for k in range(300)]
    df = spark.createDataFrame(rows, "k string, a double, b double").repartition(7)
    for most in (50_000, 40):
        got = {r.k: (r._q_a, r._q_b) for r in quantiles(df, ["k"], ["a", "b"], (0.25, 0.5, 0.75), most).collect()}
        assert sorted(got) == ["hot", "none", "one", "powers", "steep", "ties", "two"]
        for key, found in got.items():
            for place, said in enumerate(found, start=1):
                values = [r[place] for r in rows if r[0] == key and r[place] is not None]
                expected = np.percentile(values, [25, 50, 75]).tolist() if values else [None] * 3
                assert said == pytest.approx(expected, rel=1e-12) if values else said == expected


def test_fences(spark):
    """What is far out goes, nulls stay where they may, and a group without a value of a column keeps none or all."""
    rows = [("g", float(k), None if k % 4 else 1.0) for k in range(20)] + [("g", 900.0, 1.0), ("h", 1.0, None), ("h", math.nan, None)]
    df = spark.createDataFrame(rows, "k string, a double, b double")
    assert sorted(r.a for r in series.iqr_filter(df, ["k"], ["a", "b"], nulls_pass=("b",)).where("k = 'g'").collect()) == [float(k) for k in range(20)]
    assert series.iqr_filter(df, ["k"], ["b"]).where("k = 'h'").count() == 0 and series.iqr_filter(df, ["k"], ["b"], nulls_pass=("b",)).where("k = 'h'").count() == 2


def test_values_that_differ_in_their_last_digits_each_time_they_are_made(spark):
    """As means do whose rows a shuffle brings in another order; neither a rank nor a row on a fence may be lost."""
    jitter = F.udf(lambda v: v * (1 + random.SystemRandom().randrange(-9, 9) * 2.0**-52), "double").asNondeterministic()
    df = spark.createDataFrame([(g, float(k)) for g in range(40) for k in range(1, 10)], "g int, v double").withColumn("v", jitter("v"))
    assert {(r.g, *(round(q, 9) for q in r._q_v)) for r in quantiles(df, ["g"], ["v"]).collect()} == {(g, 3.0, 7.0) for g in range(40)}
    assert series.iqr_filter(df, ["g"], ["v"]).count() == 360
