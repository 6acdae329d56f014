"""Edge cases of functions and operators on hand-made rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from acreage.functions import maths as M
from acreage.functions import text as X
from acreage.operators import checks, dedup, filters, series, spatial, work_queue
from acreage.sources import pages as P
from acreage.sources import tables


def one(spark, **columns):
    return spark.range(1).select(*(c.alias(n) for n, c in columns.items())).first()


def test_text(spark):
    r = one(spark, a=X.title_case(F.lit("123 o'neil st-east")), b=X.text_to_date(F.lit("2024-01-05T10:00:00Z")), c=X.text_to_date(F.lit("2024-13-45")), d=X.text_to_date(F.lit("Jan 5")), e=X.digits(F.lit("12 days")), f=X.digits(F.lit("")))
    assert tuple(r) == ("123 O'Neil St-East", dt.date(2024, 1, 5), None, None, 12, None)
    area = lambda v, u, k: X.to_sqft(F.lit(v).cast("double"), F.lit(u), k)
    assert tuple(one(spark, a=area(2, "Acres", False), b=area(500, "sqft", False), c=area(7, "rods", False), d=area(7, "rods", True))) == (87120.0, 500.0, None, 7.0)


def test_price_history(spark):
    texts = ['"[{\\"date\\":\\"2024-01-01\\",\\"price\\":5}]"', "null", '""', "[]", '[{"date":"2024-01-01","price":5}]', None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").select("i", F.explode(X.price_history(F.col("t"))).alias("p")).collect()
    assert sorted((r.i, r.p.price) for r in rows) == [(0, 5.0), (4, 5.0)]


def test_maths(spark):
    r = one(spark, a=M.mortgage_payment(F.lit(100000.0), 8.2), b=M.mortgage_payment(F.lit(100000.0), 6.25), c=M.ratio(F.lit(1.0), F.lit(0.0)), d=M.t_column(0.975, F.lit(5)), e=M.t_column(0.975, F.lit(1000)))
    assert (round(r.a, 4), round(r.b, 4), r.c) == (747.7545, 615.7172, None)
    assert r.d == pytest.approx(2.570581836) and r.e == pytest.approx(1.962339081, abs=1e-7)
    assert [M.t_quantile(0.975, k) for k in (1, 2, 30, 100)] == pytest.approx([12.706204736, 4.30265273, 2.042272456, 1.983971519])


def test_dedup(spark):
    rows = spark.createDataFrame([(1, "2024-01-01", "a"), (1, "2024-02-01", "b"), (1, "2024-02-01", "c"), (None, "x", "d"), (None, "y", "e")], "k int, t string, v string")
    order = [F.desc("t"), F.asc("v")]
    assert {r.v for r in dedup.latest_by(rows, ["k"], order).collect()} == {"b", "e"}
    assert {r.v for r in dedup.latest_by(rows, ["k"], order, "keep_all").collect()} == {"b", "d", "e"}
    got = one(spark, a=dedup.hash_id(F.lit(" Foo "), F.lit(None).cast("string"), F.lit("Bar"), F.lit("84000")), b=F.sha2(F.lit("foo||bar|84000"), 256))
    assert got.a == got.b
    numbers = dedup.numbered(spark.range(1000).repartition(7), "n", [F.desc("id")]).collect()
    assert sorted((r.n, r.id) for r in numbers) == [(k + 1, 999 - k) for k in range(1000)]


def test_radius_and_nearest(spark):
    refs = spark.createDataFrame([(1, 40.0, -112.0, 1.0), (2, 40.01, -112.0, 2.0), (3, 40.0, -111.95, None), (4, 40.0, -111.909, 9.0), (5, 40.08, -112.0, 9.0), (6, None, 1.0, 9.0)], "id int, lat double, lon double, v double")
    centre = spark.createDataFrame([(0, 40.0, -112.0)], "k int, lat double, lon double")
    pairs = spatial.radius_join(centre, refs, 8046.7)
    assert sorted((r.r_id, round(r.distance, 1)) for r in pairs.collect()) == [(1, 0.0), (2, 1112.0), (3, 4259.0), (4, 7751.4)]
    assert spatial.radius_join(centre, refs, 8046.7, degree_circle=5 / 69 * 1.2).count() == 3
    w = pairs.where("r_id < 4").withColumn("w", M.decay_weight(F.col("distance")))
    assert w.agg(M.weighted_mean(F.col("r_v"), F.col("w")).alias("m")).first().m == pytest.approx(1.35251, abs=1e-4)
    far = spark.createDataFrame([(0, 40.0, -112.0), (1, -70.0, 100.0)], "k int, lat double, lon double")
    twins = spark.createDataFrame([(9, 40.0, -111.9), (3, 40.0, -112.1)], "id int, lat double, lon double")
    got = {r.k: (r.r_id, r.distance) for r in spatial.nearest(far, twins, "k", "id").collect()}
    assert got[0][0] == 3 and got[0][1] == pytest.approx(11100.0) and got[1][0] in (3, 9)


def test_across_the_date_line(spark):
    a = spark.createDataFrame([(0, 10.0, 179.99), (1, 10.0, 0.0)], "k int, lat double, lon double")
    b = spark.createDataFrame([(7, 10.0, -179.99), (8, 10.0, 179.98), (9, 10.0, 0.02), (10, 10.0, 181.0)], "id int, lat double, lon double")
    assert sorted((r.k, r.r_id) for r in spatial.radius_join(a, b, 8046.7).collect()) == [(0, 7), (0, 8), (1, 9)]
    assert sorted((r.k, r.r_id) for r in spatial.radius_join(a, b, 9e6).collect()) == [(0, 7), (0, 8), (0, 10), (1, 9)]


def test_nearest_where_points_are_dense(spark):
    rows = [(k, 40.0 + k % 40 * 1e-4, -112.0 + k // 40 * 1e-4) for k in range(1600)] + [(5000 + k, 41.0, -111.0) for k in range(300)]
    places = spark.createDataFrame(rows, "id int, lat double, lon double")
    points = spark.createDataFrame([(k, 40.0 + k * 0.01, -112.0 + k * 0.01) for k in range(120)], "k int, lat double, lon double")
    got = {r.k: (r.r_id, r.distance) for r in spatial.nearest(points, places, "k", "id").collect()}
    for k, lat, lon in ((r.k, r.lat, r.lon) for r in points.collect()):
        gap, best = min((((lat - y) ** 2 + (lon - x) ** 2) ** 0.5, i) for i, y, x in rows)
        assert got[k][1] == pytest.approx(gap * 111000, abs=1e-6) and (got[k][0] == best or gap < 1e-9 or abs(got[k][1] - gap * 111000) < 1e-6)


def test_resolve(spark):
    homes = spark.createDataFrame([("1 A St", 40.0, -112.0), (None, 10.0, 10.0)], "address string, lat double, lon double")
    land = spark.createDataFrame([(1, "x", 40.0002, -112.0), (2, "1 a st", 50.0, 5.0), (3, "y", 50.0, 5.0), (4, None, 60.0, 6.0)], "k int, address string, lat double, lon double")
    assert {r.k for r in spatial.resolve_sources(homes, land, "k", ["address"]).collect()} == {3, 4}


def test_intervals(spark):
    rows = spark.createDataFrame([("a", "2024-01-03", "2024-01-15"), ("b", "2024-01-08", "2024-01-08"), ("c", "2024-01-03", None), ("d", "2024-01-02", "2024-01-05")], "k string, f string, t string")
    rows = rows.select("k", F.to_date("f").alias("f"), F.to_date("t").alias("t"))
    got = series.expand_intervals(rows, "f", "t", F.lit("2024-01-01").cast("date")).collect()
    assert sorted((r.k, str(r.date)) for r in got) == [("a", "2024-01-08"), ("a", "2024-01-15"), ("b", "2024-01-08")]


def test_rolling_months_and_iqr(spark):
    rows = spark.createDataFrame([("g", "2024-01-31", 10.0), ("g", "2024-02-29", 20.0), ("g", "2024-03-31", 30.0), ("g", "2024-05-15", 40.0)], "g string, d string, v double").withColumn("d", F.to_date("d"))
    got = series.rolling_months(rows, "x", ["g"], "d", ["v"]).collect()
    assert sorted((str(r.d), r.v, r.window_rows, r.window_days) for r in got) == [("2024-03-31", 20.0, 3, 60), ("2024-05-15", 35.0, 2, 45)]
    values = spark.createDataFrame([(1, float(v), None if v == 2 else 1.0) for v in (1, 2, 3, 4, 100)], "g int, v double, r double")
    assert {r.v for r in series.iqr_filter(values, ["g"], ["v", "r"], nulls_pass=("r",)).collect()} == {1.0, 2.0, 3.0, 4.0}


def test_trend(spark):
    rows = [("a", d, v) for d, v in ((0, 100.0), (10, 110.0), (20, 118.0), (30, 131.0))] + [("b", 0, 5.0), ("b", 1, 6.0), ("c", 0, 7.0), ("e", 3, 1.0), ("e", 3, 2.0), ("e", 3, 3.0)]
    df = spark.createDataFrame(rows, "k string, d int, v double").withColumn("d", F.date_add(F.lit("2024-01-01").cast("date"), F.col("d")))
    got = {r.k: r for r in series.trend(df, ["k"], "d", "v", "2024-03-01", 30).collect()}
    a = got["a"]
    assert [round(x, 2) for x in (a.predicted_current_price, a.predicted_current_price_lower, a.predicted_current_price_upper, a.predicted_future_price, a.predicted_future_price_lower, a.predicted_future_price_upper)] == [160.2, 149.72, 170.68, 190.5, 174.18, 206.82]
    assert round(a.average_percent_gain_per_year, 4) == 2577.7993
    assert got["b"].predicted_current_price_lower == 0 and got["c"].predicted_current_price == 0 and got["e"].predicted_future_price == pytest.approx(2.0)
    s = {r.k: r for r in series.trend_strength(df, ["k"], "d", "v").collect()}
    assert s["a"].trend_strength_pct == 100 and round(s["a"].trend_variance_pct, 6) == 1.580837 and s["b"].trend_variance_pct == 0


def test_filters_and_queue(spark):
    as_of = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    r = one(spark, a=filters.recent(F.lit("2022-01-02").cast("date"), F.lit("2024-01-02").cast("date")), b=filters.recent(F.lit("2022-01-01").cast("date"), F.lit("2024-01-02").cast("date")), c=filters.possible(F.lit(0), F.lit(2), F.lit(2)))
    assert tuple(r) == (True, False, False)
    urls = spark.sql("""select * from values ('a', 'UT', date'2024-01-01', null), ('a', 'UT', null, null), ('b', 'UT', null, timestamp_ntz'2024-01-01 20:00:00'), ('c', 'UT', null, timestamp_ntz'2024-01-01 18:00:00')
        t(url, state, scraped_at, last_pulled)""").withColumn("processing_id", F.lit(None).cast("string"))
    assert [r.url for r in work_queue.claimable(urls, as_of).collect()] == ["c"]
    batch, marked = work_queue.claim_batch(urls, as_of, 5, "me")
    assert [r.url for r in batch.collect()] == ["c"] and {r.url for r in marked.where("processing_id = 'me'").collect()} == {"c"}


def test_checks(spark):
    rows = spark.createDataFrame([(1, 5), (1, 1001), (None, 7)], "id int, v int")
    got = checks.quality_report(rows, [("unique", "id", (), "error"), ("not_null", "id", (), "error"), ("range", "v", (1, 1000), "warn")]).collect()
    assert [(r.failures, r.status) for r in got] == [(1, "error"), (1, "error"), (1, "warn")]
    stamps = spark.sql("select timestamp'2024-01-01 00:00:00' as t")
    assert checks.freshness(stamps, "t", F.lit("2024-01-02 06:00:00").cast("timestamp")).first().status == "warn"


def test_pages(spark):
    county, state, kind = P.url_parts(F.lit("https://e.org/sanpete-county-utah-farms-and-ranches-for-sale/pid/12"))
    value, unit = P.lot_size(F.lit("1,200.5 acres"))
    url = F.lit("https://e.org/12-NE-Main-St-Ogden-UT-84403/x")
    assert tuple(one(spark, a=county, b=state, c=kind, d=value, e=unit, f=P.state_code(url), g=P.state_code(url, "last"))) == ("sanpete", "utah", "farms-and-ranches", 1200.5, "acres", "NE", "UT")
    page = F.lit('<script type="application/ld+json">{"a": 1}</script><script>window.s = "{\\"propertyDetailPage\\": {\\"propertyData\\": {\\"acres\\": 2, \\"price\\": 10, \\"title\\": \\"' + "x\\\\n" * 50000 + '\\"}}}";</script> Desert')
    land = {k: v for k, v in P.land_record(P.server_state(page, r"window\.s"), page).items() if k in ("cost_per_acre", "geography", "distance_to_city_miles", "city")}
    r = one(spark, a=F.try_variant_get(P.json_ld(page), "$.a", "int"), **land)
    assert (r.a, r.cost_per_acre, r.geography, r.distance_to_city_miles, r.city) == (1, 5.0, ["Desert"], None, None)
    home = F.parse_json(F.lit('{"property": {"price": 5, "schools": [{"distance": 1}, {"distance": 3}], "priceHistory": [{"date": "2024-01-01", "price": 1}, {"date": "2024-02-01", "price": 2}], "foreclosureAmount": 7, "foreclosingBank": null}}'))
    r = one(spark, **P.home_record(home))
    assert (r.price, r.num_schools_close_to, r.avg_school_distance, r.most_recent_price, r.foreclosure) == (5.0, 2, 2.0, 1.0, {"foreclosureAmount": "7"})
    r = one(spark, **P.home_record(F.parse_json(F.lit("{}"))))
    assert (r.price, r.num_schools_close_to, r.avg_school_distance, r.home_insights, r.price_history, r.risks) == (None, 0, None, [], [], None)
    assert len(r) == 54


def test_tables(spark, tmp_path):
    (tmp_path / "s.csv").write_text('address,cost\n"1 A St, X",5\n\n\n"2 B St",6\n')
    assert tables.read_seed(spark, str(tmp_path / "s.csv"), "address string, cost int").count() == 2
    rows = spark.createDataFrame([("UT", 1), ("UT", 2), ("NV", 3), ("CA", 4)], "state string, v int")
    report = tables.copy_slices(rows, str(tmp_path / "o"), "state", spark.createDataFrame([("UT",), ("NV",), ("AZ",), (None,), ("UT",)], "state string"))
    assert {r.state: r["rows"] for r in report.collect()} == {"UT": 2, "NV": 1, "AZ": 0}
