"""Spatial joins where a plain grid fails: poles, the date line, very uneven points."""

import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from acreage.functions import maths as M
from acreage.operators import spatial
from acreage.plans import queries


def frame(spark, rows, key):
    return spark.createDataFrame(rows, f"{key} int, lat double, lon double")


def sphere(a, b):
    (y, x), (v, u) = (tuple(map(math.radians, p)) for p in (a, b))
    h = math.sin((v - y) / 2) ** 2 + math.cos(y) * math.cos(v) * math.sin((u - x) / 2) ** 2
    return 2 * M.EARTH_METERS * math.asin(min(1.0, math.sqrt(h)))


def planar(a, b):
    apart = abs(a[1] - b[1])
    return math.hypot(a[0] - b[0], min(apart, abs(360 - apart)))


def test_no_pair_is_lost_near_the_poles(spark):
    """All pairs of a brute force, for places on all latitudes, on poles, edges of bands and both sides of longitude 180."""
    near = [(89.9, 0.0), (89.9, 30.0), (90.0, 12.0), (-90.0, -170.0), (-89.95, 100.0), (-89.95, -80.0), (88.0, 179.99), (88.0, -179.99), (0.0, 180.0), (0.0, -180.0), (60.0, 10.0), (60.02, 10.05), (None, 1.0)]
    spread = [(-90 + k * 179.9 / 400 + 0.03, (k * 137.5) % 360 - 180) for k in range(400)]
    close = [(lat + 0.03, lon + 0.05) for lat, lon in spread]
    a, b = near + spread, near + close
    for meters in (8046.7, 45.72, 300000.0):
        got = {(r.k, r.r_id) for r in spatial.radius_join(frame(spark, [(i, *p) for i, p in enumerate(a)], "k"), frame(spark, [(i, *p) for i, p in enumerate(b)], "id"), meters).collect()}
        assert got == {(i, j) for i, p in enumerate(a) for j, q in enumerate(b) if p[0] is not None and q[0] is not None and sphere(p, q) <= meters}
        assert meters < 8000 or (0, 1) in got


def test_a_far_north_point_changes_no_other_candidates(spark):
    rows = [(k, 40.5 + k % 60 * 0.004, -112 + k // 60 * 0.01) for k in range(3000)]
    count = lambda more: spatial.candidate_pairs(frame(spark, rows, "k"), frame(spark, rows + more, "id"), 8046.7).where("r_id < 5000").count()
    assert count([]) == count([(9000, 89.0, 5.0)])


def test_nearest_k_against_brute_force(spark):
    """A dense town, a lonely place, equal places, and points far from all; k beyond what there is gives all."""
    town = [(40 + k % 40 * 1e-5, -112 + k // 40 * 1e-5) for k in range(1200)]
    places = town + [(41.0, -111.0)] * 5 + [(0.0, 179.9), (0.0, -179.95), (-60.0, 20.0)]
    points = [(40 + k * 0.013, -112 + k * 0.021) for k in range(60)] + [(0.0, 180.0), (0.0, -179.99), (-90.0, 0.0), (80.0, 175.0), (41.0, -111.0)]
    right, left = frame(spark, [(i, *p) for i, p in enumerate(places)] + [(7000, None, 3.0)], "id"), frame(spark, [(i, *p) for i, p in enumerate(points)] + [(900, 3.0, None)], "k")
    found = {}
    for r in spatial.nearest_k(left, right, "k", "id", 4, leaf=8).collect():
        found.setdefault(r.k, {})[r.place] = (r.r_id, r.distance)
    assert sorted(found) == list(range(len(points)))
    for i, p in enumerate(points):
        best = sorted((planar(p, q), j) for j, q in enumerate(places))[:4]
        assert [found[i][n][1] for n in (1, 2, 3, 4)] == pytest.approx([g * 111000 for g, _ in best], abs=1e-5)
        assert [found[i][n][0] for n in (1, 2, 3, 4)] == [j for _, j in best] or len({round(g, 9) for g, _ in best}) < 4
    few = spatial.nearest_k(left, right.where("id < 3"), "k", "id", 5)
    assert few.groupBy("k").count().where("count <> 3").count() == 0 and spatial.nearest_k(left, right.where("id < 0"), "k", "id", 2).count() == 0


def test_geodesic(spark):
    """A surveyed line, an equator's and a meridian's degree, one place twice."""
    lines = [(-37.95103342, 144.42486789, -37.65282114, 143.92649553, 54972.271), (0.0, 0.0, 0.0, 1.0, 111319.491), (0.0, 5.0, 1.0, 5.0, 110574.389), (40.0, -112.0, 40.0, -112.0, 0.0), (40.0, 179.9995, 40.0, -179.9995, 85.394)]
    rows = spark.createDataFrame(lines, "a double, b double, c double, d double, m double").withColumn("got", M.geodesic(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()
    assert [r.got for r in rows] == pytest.approx([r.m for r in rows], rel=3e-5, abs=1e-6)


def _town(spark):
    """Copies of places, places around longitude 180 and a pole, values with nulls, more rows in a cell than a block holds."""
    places = [(40 + k % 30 * 0.01, -112 + k // 30 * 0.01) for k in range(300)] + [(40.0, -112.0)] * 20 + [(10.0, 179.99), (10.0, -179.99), (89.99, 5.0), (89.99, -175.0), (None, 1.0)]
    left = frame(spark, [(i, *p) for i, p in enumerate(places)], "k")
    right = spark.createDataFrame([(i, *p, None if i % 5 == 0 else float(i)) for i, p in enumerate(places)], "id int, lat double, lon double, v double")
    return places, left, right


def test_sums_around_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spatial, "_LEFT_BLOCK", 7)
    monkeypatch.setattr(spatial, "_RIGHT_BLOCK", 11)
    places, left, right = _town(spark)
    found = {}
    for r in spatial.sums_around(left, {"all": (right, ["v", "id"]), "few": (right.where("id < 40"), ["id"])}, 5000.0, 4.4 / 5000).collect():
        n, sums, weights = found.setdefault((r.lat, r.lon, r._set), [0, [0.0, 0.0], [0.0, 0.0]])
        found[r.lat, r.lon, r._set][0] += r.n
        for i, (s, w) in enumerate(zip(r.sums, r.weights, strict=True)):
            sums[i] += s
            weights[i] += w
    for p in {p for p in places if p[0] is not None}:
        near = [(j, math.exp(-4.4 / 5000 * sphere(p, q))) for j, q in enumerate(places) if q[0] is not None and sphere(p, q) <= 5000]
        got = found[(*p, "all")]
        assert got[0] == len(near)
        assert got[1] == pytest.approx([sum(w * j for j, w in near if j % 5), sum(w * j for j, w in near)])
        assert got[2] == pytest.approx([sum(w for j, w in near if j % 5), sum(w for _, w in near)])
        few = [w for j, w in near if j < 40]
        assert found[(*p, "few")][0] == len(few) if few else (*p, "few") not in found


def test_nearest_around_and_within_against_brute_force(spark, monkeypatch):
    monkeypatch.setattr(spatial, "_LEFT_BLOCK", 7)
    monkeypatch.setattr(spatial, "_RIGHT_BLOCK", 11)
    places, left, right = _town(spark)
    found = {}
    for r in spatial.nearest_around(left, right, "id", 3000.0, 4).collect():
        found.setdefault((r.lat, r.lon), {})[r.place] = (r.distance, r.id)
    for p in {p for p in places if p[0] is not None}:
        best = sorted((sphere(p, q), j) for j, q in enumerate(places) if q[0] is not None and sphere(p, q) <= 3000)[:4]
        assert [found[p][n + 1][0] for n in range(len(best))] == pytest.approx([g for g, _ in best], abs=1e-6) and len(found[p]) == len(best)
    assert [found[40.0, -112.0][n][1] for n in (1, 2, 3, 4)] == [0, 300, 301, 302]
    got = {r.k for r in spatial.within(left, right.where("id in (0, 320)"), "k", 3000.0).collect()}
    assert got == {i for i, p in enumerate(places) if p[0] is not None and min(sphere(p, places[0]), sphere(p, places[320])) <= 3000}


def test_work_on_copies_of_a_place_is_done_once(spark, monkeypatch):
    """Left rows at one place reach the blocks, and the twins' join, as one."""
    seen = []
    real, pairs = spatial._in_blocks, spatial.candidate_pairs
    monkeypatch.setattr(spatial, "_in_blocks", lambda left, right, *a: seen.append((left.count(), right.count())) or real(left, right, *a))
    monkeypatch.setattr(spatial, "candidate_pairs", lambda left, right, *a: seen.append((left.count(), right.count())) or pairs(left, right, *a))
    rows = frame(spark, [(i, 40.0, -112.0) for i in range(500)], "k")
    assert spatial.sums_around(rows, {"s": (rows, ["k"])}, 500.0, 0.001).first().n == 500
    assert spatial.within(rows, rows, "k", 500.0).count() == 500
    named = lambda df, t: df.withColumn("t", F.concat(F.lit(t), F.col("k").cast("string")))
    assert spatial.resolve_sources(named(rows, "a"), named(rows.unionByName(frame(spark, [(900, 41.0, -112.0)], "k")), "b"), "k", ["t"]).select("k").collect() == [(900,)]
    assert seen == [(1, 1), (1, 1), (2, 1)]


def test_nearest_k_looks_at_a_place_of_many_rows_once(spark, monkeypatch):
    sizes, real = [], spatial.settled
    monkeypatch.setattr(spatial, "settled", lambda df, label: (lambda out: (sizes.append(out.count()) if label == "nearest-open" else None) or out)(real(df, label)))
    left = frame(spark, [(i, 40.0, -112.0) for i in range(300)], "k")
    found = spatial.nearest_k(left, frame(spark, [(7, 40.0, -112.1), (8, 40.0, -112.2), (9, 41.0, -112.0)], "id"), "k", "id", 2, leaf=1).collect()
    assert len(found) == 600 and {(r.place, r.r_id) for r in found} == {(1, 7), (2, 8)} and len({r.k for r in found}) == 300
    assert max(sizes) <= 3


def _shares(pairs):
    """Rows of the fullest task, and of all."""
    counts = [r["count"] for r in pairs.groupBy(F.spark_partition_id()).count().collect()]
    return max(counts), sum(counts)


def _crowd(spark):
    """Rows in one task, most of them in one cell, some at one place."""
    places = [(40 + k % 20 * 1e-4, -112 + k // 20 * 1e-4) for k in range(200)] + [(40.0, -112.0)] * 60 + [(40.002, -111.9), (None, 1.0)]
    return places, frame(spark, [(i, *p) for i, p in enumerate(places)], "k").coalesce(1), frame(spark, [(i, *p) for i, p in enumerate(places)], "id").coalesce(1)


def test_pairs_of_a_full_cell_are_dealt_to_all_tasks(spark, monkeypatch):
    monkeypatch.setattr(spatial, "_LEFT_PAIRED", 10, raising=False)
    monkeypatch.setattr(spatial, "_RIGHT_BLOCK", 40)
    places, left, right = _crowd(spark)
    for meters in (0.001, 300.0, 3e7):
        pairs = spatial.radius_join(left, right, meters)
        assert sorted((r.k, r.r_id) for r in pairs.select("k", "r_id").collect()) == [(i, j) for i, p in enumerate(places[:-1]) for j, q in enumerate(places[:-1]) if sphere(p, q) <= meters]
        assert pairs.columns == ["k", "lat", "lon", "r_id", "r_lat", "r_lon", "distance"]
    most, all_ = _shares(spatial.radius_join(left, right, 3000.0))
    assert all_ == 260**2 + 1 and most < 0.5 * all_


def test_pairs_of_radius_pairs_are_made_once_for_each_place(spark, monkeypatch, tmp_path):
    """Customers whose keys differ by 10,000 lie at one place; each has all its pairs, in shares that tasks divide."""
    monkeypatch.setattr(spatial, "_LEFT_PAIRED", 10, raising=False)
    seen, pairs = [], spatial.candidate_pairs
    monkeypatch.setattr(spatial, "candidate_pairs", lambda left, *a: seen.append(left.count()) or pairs(left, *a))
    spark.range(50).select((F.pmod("id", F.lit(3)) + F.col("id") * 10000).alias("c_custkey"), F.lit(1.0).alias("c_acctbal"), F.lit("x").alias("c_mktsegment")).write.parquet(f"{tmp_path}/customer.parquet")
    spark.range(400).select(F.col("id").alias("s_suppkey"), F.lit(1.0).alias("s_acctbal")).write.parquet(f"{tmp_path}/supplier.parquet")
    got = [(r.c_custkey, r.r_s_suppkey) for r in queries.radius_pairs(spark, str(tmp_path)).collect()]
    at = lambda k, a, b: (40 + k * 7919 % a / 10000, -112 + k * 104729 % b / 10000)
    assert sorted(got) == sorted((k % 3 + k * 10000, s) for k in range(50) for s in range(400) if sphere(at(k % 3 + k * 10000, 10000, 10000), at(s, 9973, 9967)) <= M.SMOOTHING_METERS)
    assert seen == [3] and len(got) > 100


def test_cells_are_never_null(spark):
    """Else Spark measures the cells of all rows a second time, before copies of a place drop out, to leave out null ones."""
    rows = frame(spark, [(1, 40.0, -112.0), (2, -90.0, 180.0)], "k")
    placed = spatial._Bands(400.0).placed(rows.distinct(), "lat", "lon")
    assert not any(placed.schema[c].nullable for c in ("_band", "_column")) and placed.where("_band is null or _column is null").count() == 0
    plan = spatial.candidate_pairs(rows.select("lat", "lon").distinct(), rows, 400.0)._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Filter" in line and "COS" in line.upper()]


def test_weights_are_made_in_arrays_that_fit_a_cache():
    """However many rows lie around a place; arcs by their series are arcs, near and far."""
    rng = np.random.default_rng(3)
    a, b = (pd.DataFrame({"lat": 40 + rng.random(n) / 10, "lon": -112 + rng.random(n) / 10}) for n in (300, 5000))
    chunks, reach = spatial._chunks(15000.0, spatial._AT_ONCE)
    sums, sizes = np.zeros(300), []
    for rows, near, square in chunks(a, b):
        sizes.append(square.size)
        sums[rows] += spatial._decayed(square, (square <= reach * reach).astype(float), 3e-4, 1).sum(axis=1)
    assert max(sizes) <= 128 * 512
    y1, x1, y2, x2 = (np.radians(v) for v in (a["lat"].to_numpy()[:, None], a["lon"].to_numpy()[:, None], b["lat"].to_numpy(), b["lon"].to_numpy()))
    meters = 2 * 6371008.8 * np.arcsin(np.sqrt(np.sin((y2 - y1) / 2) ** 2 + np.cos(y1) * np.cos(y2) * np.sin((x2 - x1) / 2) ** 2))
    assert sums == pytest.approx(np.where(meters <= 15000, np.exp(-3e-4 * meters), 0).sum(axis=1), rel=1e-9)
    for square in ([0.0, 1e-12, 3e-4, 4e-4], [0.0, 1e-3, 1.0, 4.0]):
        arcs = 2 * 6371008.8 * np.arcsin(np.sqrt(square) / 2)
        assert spatial._decayed(np.array(square), np.array([1.0, 1.0, 1.0, 0.0]), 1e-7, 1) == pytest.approx(np.exp(-1e-7 * arcs) * [1, 1, 1, 0], rel=1e-14)


def test_nearest_k_sends_cells_of_places_down_instead_of_each_place(spark, monkeypatch):
    """Many places look at fewer cells than they are; where rows around a cell are too many for a task, each place goes by itself, to the same end."""
    sizes, real = [], spatial.settled
    monkeypatch.setattr(spatial, "settled", lambda df, label: (lambda out: (sizes.append(out.count()) if label == "nearest-open" else None) or out)(real(df, label)))
    points = [(40 + k * 7919 % 997 / 1000, -112 + k * 104729 % 991 / 1000) for k in range(1500)]
    places = [(40 + k * 7919 % 983 / 1000, -112 + k * 104729 % 977 / 1000) for k in range(300)]
    left, right = frame(spark, [(i, *p) for i, p in enumerate(points)], "k"), frame(spark, [(i, *p) for i, p in enumerate(places)], "id")
    told = lambda: {(r.k, r.place): (r.r_id, round(r.distance, 5)) for r in spatial.nearest_k(left, right, "k", "id", 2).collect()}
    found = told()
    assert len(found) == 3000 and max(sizes) < 1500
    for i in range(0, 1500, 50):
        best = sorted((planar(points[i], q), j) for j, q in enumerate(places))[:2]
        assert [found[i, n] for n in (1, 2)] == [(j, round(g * 111000, 5)) for g, j in best]
    monkeypatch.setattr(spatial, "_RIGHT_BLOCK", 5)
    assert told() == found
