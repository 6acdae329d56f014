"""The marts applied to listings that are derived from the supplied tables, and the same in SQL.

Customers stand for homes (their orders for price histories), parts for land,
suppliers for rental buildings and line items for their units. Steps that several
queries need are tables, written once per session.
"""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from acreage.functions import maths as M
from acreage.operators import series
from acreage.plans import marts
from acreage.plans.oracle import _A, _B, _geodesic, _t_values
from acreage.plans.queries import AS_OF, _json, _point, _read
from acreage.sources import tables
from acreage.sources.swap import Folder

NEAR, AROUND = 20000.0, 15000.0
QUERIES = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


_HELD, _MARK = {}, {}


def step(f):
    """A step of the plan: its tables are written once per session and input, and shared by all queries that need them.

    A mark lies beside the tables: once somebody has cleared the folder, all steps are made anew.
    """

    @functools.wraps(f)
    def once(spark, d):
        app = spark.sparkContext.applicationId
        if app not in _MARK or not Folder(spark, _MARK[app]).exists(_MARK[app]):
            for key in [k for k in _HELD if k[0] == app]:
                del _HELD[key]
            _MARK[app] = tables.scratch(spark, "mart-steps")
            Folder(spark, _MARK[app]).claim(_MARK[app])
        if (app, d, f.__name__) not in _HELD:
            made = f(spark, d)
            _HELD[app, d, f.__name__] = made
        return _HELD[app, d, f.__name__]

    return once


def _pick(key: str, *texts: str):
    return F.element_at(F.array(*(F.lit(t) for t in texts)), (F.col(key) % len(texts) + 1).cast("int"))


def _buildings(spark, d):
    s = _read(spark, d, "supplier")
    return s.select(F.col("s_suppkey").alias("id"), F.concat(F.lit("msa"), F.col("s_nationkey").cast("string")).alias("msa"), F.when(F.col("s_suppkey") % 3 > 0, F.col("s_nationkey").cast("string")).alias("zip_code"), *_point("s_suppkey", 9973, 9967), (F.col("s_suppkey") % 10 / 10.0).alias("leased_percentage"), (F.col("s_suppkey") % 7 / 10.0).alias("exposure_percentage"), F.array(F.concat(F.lit("u"), F.col("s_nationkey").cast("string"))).alias("listing_urls"))


def _units(spark, d):
    price = F.col("l_extendedprice")
    return _read(spark, d, "lineitem").select(F.col("l_suppkey").alias("building_id"), F.to_date("l_shipdate").alias("date"), F.col("l_partkey").alias("unit_id"), F.col("l_linenumber").alias("bed"), (F.col("l_linenumber") % 3).alias("bath"), (F.col("l_quantity") * 20).alias("sqft"), price.alias("price"), (price * (1 - F.col("l_discount"))).alias("effective_price"))


def _homes(spark, d):
    o = _read(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.to_json(F.collect_list(F.struct(F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"), F.col("o_totalprice").alias("price")))).alias("price_history"))
    k = F.col("c_custkey")
    return _read(spark, d, "customer").join(o, "c_custkey", "left").select(
        F.concat(F.lit("h"), k.cast("string")).alias("id"), F.concat(F.lit("u"), k.cast("string")).alias("url"), F.date_add(F.lit("2024-01-01").cast("date"), (k % 50).cast("int")).cast("timestamp").alias("created_at"), F.concat(F.lit(" "), k.cast("string"), F.lit(" main ROAD")).alias("street_address"),
        F.lit("provo ").alias("city"), F.lit("ut").alias("state"), F.col("c_nationkey").cast("string").alias("zip_code"), (F.col("c_acctbal") * 100 + 150000).alias("price"), *_point("c_custkey"), _pick("c_custkey", "Single Family", "condominium ", "APTS", "Mobile home").alias("home_type"),
        (k % 5).cast("int").alias("bedrooms"), (k % 3).cast("double").alias("bathrooms"), (k % 7 * 300.0).alias("living_area"), F.when(k % 6 == 0, "sqm").otherwise("sqft").alias("living_area_units"),
        F.when(k % 2 == 0, (k % 11 + 1) * 0.15).otherwise((k % 11 + 1) * 5000.0).alias("lot_area_value"), F.when(k % 2 == 0, "Acres").otherwise("Sq Ft").alias("lot_area_units"), F.lit("2024-01-15T00").alias("date_posted_text"), (1990 + k % 40).cast("int").alias("year_built"), "price_history",
        F.when(k % 3 == 0, F.concat(F.lit("The "), k.cast("string"))).alias("marketing_name"), F.lit("FOR_SALE").alias("status"), (k % 90).alias("days_on_market"), (k % 1000).alias("page_view_count"), (k % 17).alias("favorite_count"), (k % 5 == 0).alias("is_income_restricted"),
        (k % 7 == 0).alias("is_preforeclosure_auction"), _json('{"k": ', k, "}").alias("address"), F.when(k % 2 == 0, _json("[", k % 4, ", 1]")).otherwise("{bad").alias("selling_soon"), F.array((k % 6) / 2.0).alias("school_distances"), F.lit("nice").alias("description"),
        F.create_map(F.lit("flood"), (k % 3).cast("string")).alias("risks"), F.lit("{}").alias("foreclosure"), F.lit(1).alias("num_schools_close_to"), ((k % 6) / 2.0).alias("avg_school_distance"), (k % 100).alias("lot_size"),
    )


def _land(spark, d):
    k = F.col("p_partkey")
    return _read(spark, d, "part").select(
        F.concat(F.lit("l"), k.cast("string")).alias("id"), F.concat(F.lit("v"), k.cast("string")).alias("url"), F.date_add(F.lit("2024-02-01").cast("date"), (k % 50).cast("int")).cast("timestamp").alias("created_at"), F.concat((k % 200).cast("string"), F.when(k % 5 == 0, " main road").otherwise(" side road")).alias("street_address"),
        F.lit("PROVO").alias("city"), F.lit("ut").alias("state"), F.lit("1").alias("zip_code"), (F.col("p_retailprice") * 200).alias("price"), *_point("p_partkey", 9941, 9931), _pick("p_partkey", "Vacant land", "home", "Hunting Property", "recreational").alias("property_type"),
        (F.col("p_size") % 4).cast("int").alias("beds"), (k % 3).cast("double").alias("baths"), F.when(k % 4 == 1, F.col("p_size") * 100.0).alias("homesqft"), (F.col("p_size") * 0.1).alias("lot_size"), _pick("p_partkey", "Acres", "acre", "rods").alias("lot_size_units"),
        F.when(k % 2 == 0, F.col("p_name")).alias("name"), F.col("p_brand").alias("title"), F.when(k % 3 == 0, "unit 2").alias("address2"), F.lit(40.25).alias("city_latitude"), F.when(k % 4 > 0, -111.5).alias("city_longitude"), (k % 30 / 2.0).alias("distance_to_city_miles"),
        F.lit("2024-03-04").cast("date").alias("date_posted"),
    )


@step
def _staged(spark, d):
    homes, land = _homes(spark, d), _land(spark, d)
    lookup = tables.settled(marts.building_lookup(_buildings(spark, d), {"home": homes, "land": land}), "mart-lookup")
    return tables.settled(marts.home_staging(homes, lookup, NEAR), "mart-homes"), tables.settled(marts.land_staging(land, lookup, NEAR), "mart-land")


@step
def _summary(spark, d):
    units = _units(spark, d)
    points = units.groupBy("building_id", F.trunc("date", "month").alias("date")).agg(F.avg("price").alias("price"), F.avg("effective_price").alias("effective_price"))
    points = tables.settled(points, "mart-months")
    found = marts.analysis(points, ["building_id"], {"price": "price", "effective_price": "effective_price"}, AS_OF, least=8, without_outliers=True)
    return tables.settled(marts.building_summary(_buildings(spark, d), units, found), "mart-buildings")


@step
def _unified(spark, d):
    homes, land = _staged(spark, d)
    return tables.settled(marts.developed(homes, land), "mart-developed"), tables.settled(marts.empty_lots(homes, land), "mart-lots")


@step
def _sets(spark, d):
    developed, lots = _unified(spark, d)
    rents = ["avg_rent_price_per_sqft", "avg_rent_price_per_bed", "avg_effective_rent_price_per_sqft"]
    predicted = [f"predicted_current_effective_price_per_{u}" for u in ("sqft", "bed")]
    return {
        "buildings": (_summary(spark, d), {n: n for n in rents} | {f"avg_{n}": n for n in (*predicted, "leased_percentage")}, {}),
        "homes": (developed.where("source = 'home'"), {"avg_home_price_per_sqft": "price_per_sqft"}, {}),
        "lots": (lots, {"avg_empty_lot_cost_per_sqft": "price_per_lot_sqft"}, {}),
    }


def _around(spark, d, rows, sets):
    return tables.settled(marts.smoothed(rows, ["source", "source_id"], sets, AROUND, {"buildings": "building_id"}), "mart-around")


@step
def _main(spark, d):
    """Developed properties with their surroundings, empty lots, and what surroundings are made of."""
    developed, lots = _unified(spark, d)
    sets = _sets(spark, d)
    return tables.settled(marts.developed_main(developed, _around(spark, d, developed, sets)), "mart-main"), lots, sets


@step
def _lots_around(spark, d):
    return _around(spark, d, _unified(spark, d)[1], _sets(spark, d))


@step
def _manual_staged(spark, d):
    manual = _manual(spark, d)
    return tables.settled(marts.manual_staging(manual, marts.building_lookup(_buildings(spark, d), {"manual": manual}), NEAR), "mart-manual")


@step
def _with_manual(spark, d):
    """Developed properties, manual ones among them."""
    return tables.settled(marts.developed(*_staged(spark, d), _manual_staged(spark, d)), "mart-with-manual")


@query
def mart_homes(spark, d):
    return _staged(spark, d)[0].select("id", "street_address", "home_type", "bedrooms", F.round("interior_sqft", 2).alias("interior_sqft"), F.round("lot_sqft", 1).alias("lot_sqft"), "zip_code", "msa", "closest_building_id", F.round("distance", 1).alias("distance"))


@query
def mart_land(spark, d):
    return _staged(spark, d)[1].select("id", "property_type", "beds", F.round("interior_sqft", 1).alias("interior_sqft"), F.round("lot_sqft", 1).alias("lot_sqft"), F.round("cost_per_acre", 1).alias("cost_per_acre"), "closest_building_id")


@query
def mart_home_history(spark, d):
    points = marts.home_history(_staged(spark, d)[0], ["msa", "zip_code"]).withColumn("month", F.trunc("date", "month"))
    return series.geo_rollup(points, {"msa": "msa", "zip": "zip_code"}, ["month"], [M.rounded(F.avg("price"), 1).alias("price"), F.count_distinct("id").alias("homes")])


@query
def mart_buildings(spark, d):
    columns = ["avg_rent_price_per_sqft", "avg_effective_rent_price_per_bed", "predicted_current_price_per_sqft", "predicted_future_effective_price_per_bed", "concession_percentage"]
    return _summary(spark, d).select("building_id", "num_units", *(M.rounded(F.col(c), 3).alias(c) for c in columns))


def _shown(rows):
    """All columns of a unified table; dates without a time, the length of histories (their order is none), rounded prices."""
    out = {"created_at": F.to_date("created_at"), "price": M.rounded(F.col("price"), 2), "lot_sqft": M.rounded(F.col("lot_sqft"), 1), "price_per_lot_sqft": M.rounded(F.col("price_per_lot_sqft"), 3)}
    if "interior_sqft" in rows.columns:
        out |= {"interior_sqft": M.rounded(F.col("interior_sqft"), 1), "price_per_sqft": M.rounded(F.col("price_per_sqft"), 2), "price_history": F.json_array_length("price_history")}
    return rows.withColumns(out)


@query
def mart_developed(spark, d):
    """All 38 columns of the unified developed properties, manual ones among them."""
    return _shown(_with_manual(spark, d))


@query
def mart_empty_lots(spark, d):
    """All 23 columns of the unified empty lots."""
    return _shown(_unified(spark, d)[1])


def _raw_listings(spark, d, rows, key: str):
    """Versions of listings: one per order of a customer (or line of a part), some sold, abroad, in another state, too dear or without a place."""
    n, k = F.col("version"), F.col(key)
    return rows.withColumns({
        "state": F.when(n % 7 == 0, "NV").otherwise("UT"), "status": F.when(n % 5 == 0, "SOLD").when(n % 5 == 1, F.lit(None)).otherwise("FOR_SALE"), "country": F.when(n % 11 == 0, "CAN").when(n % 11 == 1, "USA"),
        "latitude": F.when(n % 13 > 0, F.col("lat")), "longitude": F.col("lon"), "price": n % 900 * 1000.0 + k % 10, "created_at": F.date_add(F.lit("2024-01-01").cast("date"), (n % 300).cast("int")).cast("timestamp"),
    }).drop("lat", "lon", "id", "version", key)


def _queue(spark, d):
    """The urls that are known; some twice."""
    c = _read(spark, d, "customer").where("c_acctbal > 0").select(F.col("c_custkey").alias("k"))
    p = _read(spark, d, "part").where("p_size > 10").select(F.col("p_partkey").alias("k"))
    urls = c.select(F.concat(F.lit("u"), F.col("k").cast("string")).alias("url")).unionByName(p.select(F.concat(F.lit("v"), F.col("k").cast("string")).alias("url")))
    return urls.unionByName(urls.where("url like '%7'")).unionByName(urls.limit(1).select(F.lit(None).cast("string").alias("url")))


@query
def mart_homes_from_raw(spark, d):
    """Home listings from their raw versions: known urls, the market, the newest version, ids, the nearest building, staging."""
    versions = _read(spark, d, "orders").select(F.concat(F.lit("u"), F.col("o_custkey").cast("string")).alias("_url"), F.col("o_orderkey").alias("version"), F.col("o_custkey").alias("_k"))
    homes = _homes(spark, d).withColumnRenamed("url", "source_url").drop("state", "status", "price", "created_at")
    raw = marts.raw_homes(_raw_listings(spark, d, homes.join(versions, F.col("source_url") == F.col("_url")).drop("_url"), "_k"), _queue(spark, d))
    raw = tables.settled(raw, "mart-raw-homes")
    staged = marts.home_staging(raw, marts.building_lookup(_buildings(spark, d), {"home": raw}), NEAR)
    return staged.select("id", "url", F.to_date("created_at").alias("created_at"), "status", "price", "home_type", M.rounded(F.col("lot_sqft"), 1).alias("lot_sqft"), "zip_code", "closest_building_id")


@query
def mart_land_from_raw(spark, d):
    """Land listings from their raw versions, likewise; some lack what a land listing needs."""
    versions = _read(spark, d, "lineitem").select(F.concat(F.lit("v"), F.col("l_partkey").cast("string")).alias("_url"), (F.col("l_orderkey") * 7 + F.col("l_linenumber")).alias("version"), F.col("l_partkey").alias("_k"))
    land = _land(spark, d).drop("state", "price", "created_at").withColumn("city_longitude", F.coalesce("city_longitude", F.lit(0.0))).withColumn("lot_size", F.when(F.col("lot_size") > 0.3, F.col("lot_size")))
    raw = marts.raw_land(_raw_listings(spark, d, land.join(versions, F.col("url") == F.col("_url")).drop("_url"), "_k"), _queue(spark, d))
    raw = tables.settled(raw, "mart-raw-land")
    staged = marts.land_staging(raw, marts.building_lookup(_buildings(spark, d), {"land": raw}), NEAR)
    return staged.select("id", "url", F.to_date("created_at").alias("created_at"), "price", "property_type", M.rounded(F.col("lot_sqft"), 1).alias("lot_sqft"), "closest_building_id")


@query
def mart_rental_staging(spark, d):
    """The kept buildings and units in their declared types: per building its units, their rounded prices and recoded beds."""
    raw = _raw_units(spark, d).withColumns({"bed": F.col("l_beds") % 4, "bath": F.lit("2"), "floor": F.lit("n/a"), "effective_price": F.col("price") * 0.9})
    buildings = marts.rental_buildings(_raw_buildings(spark, d).withColumns({"year_built": F.lit("1990"), "is_condo": F.lit("true"), "leased_percentage": F.lit("0.5")}))
    units = marts.unit_staging(marts.rental_units(raw, buildings, AS_OF))
    about = units.groupBy("building_id").agg(F.count("*").alias("units"), F.sum("price").alias("price"), F.sum("effective_price").alias("effective_price"), F.sum("bed").alias("beds"), F.sum("bath").alias("baths"), F.count("floor").alias("floors"))
    kept = marts.building_staging(buildings).select(F.col("id").alias("building_id"), "year_built", "is_condo", "leased_percentage", "number_stories")
    return kept.join(about, "building_id")


@query
def mart_surroundings(spark, d):
    around = _main(spark, d)[0]
    means = ["avg_rent_price_per_sqft", "avg_predicted_current_effective_price_per_bed", "avg_leased_percentage", "avg_home_price_per_sqft", "avg_empty_lot_cost_per_sqft"]
    return around.select("source", "source_id", *(F.round(c, 3).alias(c) for c in means), "buildings_within_radius", "homes_within_radius", "lots_within_radius", F.array_join(F.transform("closest_buildings", lambda x: x.cast("string")), ",").alias("closest_buildings"))


@query
def mart_profits(spark, d):
    rows = marts.expanded_developed(_main(spark, d)[0])
    return rows.select("unified_id", "source", "source_id", *(F.round(c, 1).alias(c) for c in ("monthly_payment", "best_case_profit", "worst_case_profit", "average_case_profit")))


@query
def mart_lots(spark, d):
    main, lots, _ = _main(spark, d)
    rows = marts.expanded_lots(lots.join(_lots_around(spark, d), ["source", "source_id"], "left"), main)
    return rows.select("source", "source_id", *(F.round(c, 1).alias(c) for c in ("potential_sqft", "lot_payment", "full_payment", "profit_sqft")))


@query
def mart_flips(spark, d):
    rejected = _read(spark, d, "customer").where("c_acctbal < 0").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("url"))
    return marts.flips(_main(spark, d)[0], rejected).select("source", "source_id", *(F.round(c, 3).alias(c) for c in ("hoped_income", "invest_to_monthly_return", "share_of_average_price")))


def _raw_buildings(spark, d):
    """Suppliers as they come: some of another state, those of a nation under the same urls."""
    s = _read(spark, d, "supplier")
    return s.select(
        F.col("s_suppkey").alias("id"), F.col("s_name").alias("street_address"), F.lit("provo").alias("city"), F.when(F.col("s_acctbal") > 0, "UT").otherwise("NV").alias("state"), F.lit("84000").alias("zip_code"),
        *_point("s_suppkey", 9973, 9967), F.lit("msa").alias("msa"), F.array(F.concat(F.lit("u"), F.col("s_nationkey").cast("string"))).alias("listing_urls"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("s_suppkey") % 50).cast("int")).alias("created_on"),
    )


def _raw_units(spark, d):
    li = _read(spark, d, "lineitem")
    price, area = F.col("l_extendedprice"), F.col("l_quantity")
    return li.select(
        F.concat_ws("-", "l_orderkey", "l_partkey").alias("id"), F.col("l_suppkey").alias("building_id"), F.when(area >= 10, price).alias("price"), F.when(area >= 5, price * 2).alias("min_price"), (price * 3).alias("max_price"),
        F.when(F.col("l_tax") > 0.02, area * 20).alias("sqft"), F.when(F.col("l_tax") > 0.01, area * 10).alias("min_sqft"), F.when(F.col("l_tax") > 0, area * 30).alias("max_sqft"), (F.col("l_returnflag") == "A").alias("is_floorplan"),
        F.when(F.col("l_linenumber") > 1, F.to_date("l_shipdate")).alias("exit_market"), F.to_date("l_shipdate").alias("created_on"), F.col("l_linenumber").alias("l_beds"),
    )


def _manual(spark, d):
    k = F.col("n_nationkey")
    return _read(spark, d, "nation").select(
        F.concat(F.lit("m"), k.cast("string")).alias("id"), F.col("n_name").alias("street_address"), F.lit("Provo").alias("city"), F.lit("UT").alias("state"), F.lit("84001").alias("zip_code"), *_point("n_nationkey"),
        (k * 1000.0 + 200000).alias("price"), (k % 4).cast("int").alias("bedrooms"), (k % 3).cast("double").alias("bathrooms"), (k * 50.0).alias("living_area"),
    )


@step
def _history(spark, d):
    return tables.settled(marts.home_history(_staged(spark, d)[0], ["url", "msa", "zip_code"]), "mart-history")


@step
def _found_homes(spark, d):
    return tables.settled(marts.home_analysis(_history(spark, d), AS_OF), "mart-home-analysis")


@query
def mart_rental_buildings(spark, d):
    return marts.rental_buildings(_raw_buildings(spark, d)).select("id", "street_address", "created_on")


@query
def mart_rental_units(spark, d):
    kept = marts.rental_units(_raw_units(spark, d), marts.rental_buildings(_raw_buildings(spark, d)), AS_OF)
    return kept.groupBy("building_id").agg(F.count("*").alias("units"), F.sum("sqft").alias("sqft"), F.max("created_on").alias("newest"))


@query
def mart_rental_history(spark, d):
    kept = marts.rental_history(_raw_units(spark, d), marts.rental_buildings(_raw_buildings(spark, d)))
    return kept.groupBy("building_id").agg(F.count("*").alias("leases"), F.sum(F.col("price").cast("decimal(18,2)")).cast("double").alias("price"))


@query
def mart_manual(spark, d):
    return _manual_staged(spark, d).select("id", "closest_building_id", "msa", "interior_sqft", "price")


@query
def mart_developed_manual(spark, d):
    return _with_manual(spark, d).where("source = 'manual'").select("source_id", "beds", "baths", M.rounded(F.col("price_per_sqft"), 2).alias("price_per_sqft"))


@query
def mart_home_analysis(spark, d):
    found = _found_homes(spark, d)
    return found.select("id", "url", "max_date", "data_span_days", *(M.rounded(F.col(c), 1).alias(c) for c in ("latest_price", "predicted_current_price", "predicted_future_price", "average_percent_gain_per_year")))


@query
def mart_home_summary(spark, d):
    rows = marts.home_summary(_staged(spark, d)[0], _found_homes(spark, d).drop("url"))
    columns = ["price_per_bedroom", "price_per_sqft", "predicted_current_price_per_bedroom", "predicted_future_price_per_sqft"]
    return rows.select("id", *(M.rounded(F.col(c), 1).alias(c) for c in columns))


@query
def mart_rental_areas(spark, d):
    levels = {"zip": "zip_code", "msa": "msa"}
    rows = _units(spark, d).join(_buildings(spark, d).select(F.col("id").alias("building_id"), *levels.values()), "building_id").withColumn("month", F.trunc("date", "month"))
    points = series.geo_rollup(rows, levels, ["month"], [F.avg("price").alias("price"), F.avg("effective_price").alias("effective_price")]).withColumnRenamed("month", "date")
    points = tables.settled(points, "mart-rental-areas")
    about = series.distinct_by_place(rows, levels, {"total_units": "unit_id", "total_buildings": "building_id"}, largest=("zip",))
    found = marts.area_analysis(points, {"price": "price", "effective_price": "effective_price"}, about, {"total_units": 0, "total_buildings": 0}, AS_OF)
    columns = ["predicted_current_price", "predicted_future_effective_price", "average_percent_gain_per_year", "average_percent_gain_per_year_effective"]
    return found.select("geography_type", "geography_value", "total_units", "total_buildings", *(M.rounded(F.col(c), 1).alias(c) for c in columns))


@query
def mart_home_areas(spark, d):
    rows = _history(spark, d).withColumn("month", F.trunc("date", "month"))
    months = series.geo_rollup(rows, {"msa": "msa", "zip": "zip_code"}, ["month"], [F.avg("price").alias("price"), F.count_distinct("id").cast("double").alias("property_count")])
    points = series.rolling_months(months, "months", ["geography_type", "geography_value"], "month", ["price", "property_count"]).withColumnRenamed("month", "date")
    points = tables.settled(points, "mart-home-areas")
    known = {"total_properties_in_geography": 0, "avg_property_value": 0.0, "median_property_value": 0.0, "property_value_std_dev": 0.0}
    found = marts.area_analysis(points, {"price": "price"}, marts.home_areas(points), known, AS_OF, recent=True)
    columns = ["avg_property_value", "median_property_value", "property_value_std_dev", "predicted_current_price", "average_percent_gain_per_year"]
    return found.select("geography_type", "geography_value", "total_properties_in_geography", *(M.rounded(F.col(c), 1).alias(c) for c in columns))


@query
def mart_lot_profitability(spark, d):
    lots = _land(spark, d).select("id", "lat", "lon", (F.col("price") / F.nullif(F.col("lot_size"), F.lit(0.0))).alias("cost_per_acre"))
    units = _read(spark, d, "supplier").select(*_point("s_suppkey", 9973, 9967), F.col("s_acctbal").alias("rent_per_bed"))
    rows = marts.lot_profitability(lots, units, NEAR, 8.0)
    return rows.select("id", *(M.rounded(F.col(c), 1).alias(c) for c in ("potential_rent_per_bed", "acre_cost_per_bed")), M.rounded(F.col("estimate_profit"), 4).alias("estimate_profit"))


@step
def _all_sets(spark, d):
    """The six sets in full, from the same listings."""
    developed, lots = _unified(spark, d)
    homes, found = _staged(spark, d)[0], _found_homes(spark, d)
    summary = tables.settled(marts.home_summary(homes, found.drop("url")), "mart-home-summary")
    return marts.surroundings(_summary(spark, d), summary, found.join(homes.select("id", "lat", "lon"), "id"), lots, developed)


def _all_around(spark, d, rows, sets):
    return tables.settled(marts.smoothed(rows, ["source", "source_id"], sets, AROUND, {"buildings": "building_id", "homes": "id"}), "mart-all-around")


def _places(name: str) -> int:
    """Decimals that a mean is compared with: prices of whole properties are large."""
    return 1 if "price" in name else 3


@query
def mart_all_surroundings(spark, d):
    """All means, counts and lists around each developed property."""
    sets = _all_sets(spark, d)
    around = _all_main(spark, d)[0]
    floats = [n for _, names, _ in sets.values() for n in names]
    whole = [n for _, _, names in sets.values() for n in names]
    lists = [F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c) for c in ("closest_buildings", "closest_homes")]
    return around.select("source", "source_id", *whole, *(M.rounded(F.col(c), _places(c)).alias(c) for c in floats), *(f"{n}_within_radius" for n in sets), *lists)


@query
def mart_lots_main(spark, d):
    rows = marts.lots_main(_unified(spark, d)[1], _lots_around(spark, d))
    return rows.select("unified_id", "source", "source_id", F.round("avg_empty_lot_cost_per_sqft", 3).alias("avg_empty_lot_cost_per_sqft"), F.round("avg_home_price_per_sqft", 3).alias("avg_home_price_per_sqft"), "lots_within_radius")


@step
def _all_main(spark, d):
    """Developed properties with all their surroundings, and the summaries that these come from."""
    developed, sets = _unified(spark, d)[0], _all_sets(spark, d)
    main = developed.join(_all_around(spark, d, developed, sets), ["source", "source_id"], "left")
    return tables.settled(main, "mart-all-main"), sets["buildings"][0], sets["homes"][0]


def _accepted(spark, d, main):
    accepted = _read(spark, d, "customer").where("c_acctbal > 0").select(F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("url"))
    return marts.accepted_flips(main, accepted, most=400000)


@query
def mart_accepted_flips(spark, d):
    """Flips of accepted urls within the prices, and manual properties whatever their price and state."""
    every = _with_manual(spark, d)
    main = every.join(_all_around(spark, d, every, _all_sets(spark, d)), ["source", "source_id"], "left")
    return _accepted(spark, d, main).select("source", "source_id", *(F.round(c, 2).alias(c) for c in ("estimate_potential_home_value", "estimated_home_value_increase", "estimated_income_sqft")))


def _rounded(rows):
    return rows.withColumns({c: M.rounded(F.col(c), _places(c)) for c, kind in rows.dtypes if kind == "double" and c != "distance_miles"} | {c: F.array_join(c, ",") for c in rows.columns if c == "listing_urls"}).withColumn("place", F.col("place").cast("long"))


@query
def mart_building_report(spark, d):
    return _rounded(marts.comparables_report(marts.explanations(*_all_main(spark, d)), "buildings"))


@query
def mart_home_report(spark, d):
    return _rounded(marts.comparables_report(marts.explanations(*_all_main(spark, d)), "homes"))


@query
def mart_flip_report(spark, d):
    """The full report: accepted flips with the buildings around."""
    main, buildings, homes = _all_main(spark, d)
    return _rounded(marts.flip_report(_accepted(spark, d, main), marts.comparables_report(marts.explanations(main, buildings, homes), "buildings")))


_LAND_POINT = _A.replace("10000)", "9941)", 1).replace("104729 % 10000)", "104729 % 9931)").format("p_partkey")
_POINT_SIN = "2 * 6371008.8::double * asin(sqrt(least(pow(sin(radians({b}.lat - {a}.lat) / 2), 2) + cos(radians({a}.lat)) * cos(radians({b}.lat)) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2), 1)))"
_STAGED = f"""build as (select s_suppkey as building_id, 'msa' || s_nationkey as msa, case when s_suppkey % 3 > 0 then s_nationkey::varchar end as bzip, s_suppkey % 10 / 10.0::double as leased, s_suppkey % 7 / 10.0::double as exposure, {_B.format('s_suppkey')} from supplier),
home0 as (select 'h' || c_custkey as id, 'u' || c_custkey as url, c_custkey as k, c_custkey || ' Main Road' as street_address, c_nationkey::varchar as zip, c_acctbal * 100 + 150000 as price, {_A.format('c_custkey')},
  ['single_family', 'condo', 'apartment', 'manufactured'][c_custkey % 4 + 1] as home_type, c_custkey % 7 * 300.0::double as area from customer),
home1 as (select *, case when k % 5 = 0 and area > 0 then 1 else k % 5 end::int as bedrooms, case when k % 6 = 0 then area * 10.7639::double else area end as interior_sqft, case when k % 2 = 0 then (k % 11 + 1) * 0.15::double * 43560 else (k % 11 + 1) * 5000.0::double end as lot_sqft from home0 where not (area = 0 and k % 5 <> 0)),
homenear as (select h.*, b.*exclude (lat, lon), sqrt(pow(h.lat - b.lat, 2) + pow(h.lon - b.lon, 2)) * 111000 as distance from home1 h, build b where lot_sqft < 65340 qualify row_number() over (partition by id order by sqrt(pow(h.lat - b.lat, 2) + pow(h.lon - b.lon, 2)), building_id) = 1),
homes as (select *, coalesce(bzip, zip) as zip_code from homenear where distance <= {NEAR}),
land0 as (select 'l' || p_partkey as id, 'v' || p_partkey as url, p_partkey % 200 || case when p_partkey % 5 = 0 then ' Main Road' else ' Side Road' end as street_address, p_retailprice * 200 as price, {_LAND_POINT}, ['undeveloped-land', 'homes', 'hunting property', 'recreational-property'][p_partkey % 4 + 1] as property_type,
  p_size % 4 as beds0, p_partkey % 3 as baths, case when p_partkey % 4 = 1 then p_size * 100.0::double else 0 end as interior_sqft, case when p_partkey % 3 < 2 then p_size * 0.1::double * 43560 end as lot_sqft from part),
land1 as (select *, case when beds0 = 0 and interior_sqft > 0 then 1 else beds0 end::int as beds from land0 where property_type <> 'hunting property'),
land2 as (select * from land1 where not (interior_sqft > 0 and beds = 0 and baths = 0) and not (interior_sqft = 0 and beds <> 0 and baths <> 0)),
landnear as (select l.*, b.building_id, b.msa, sqrt(pow(l.lat - b.lat, 2) + pow(l.lon - b.lon, 2)) * 111000 as distance from land2 l, build b qualify row_number() over (partition by id order by sqrt(pow(l.lat - b.lat, 2) + pow(l.lon - b.lon, 2)), building_id) = 1),
land as (select * from landnear where distance <= {NEAR})"""


def _free(area: str) -> str:
    """Land with or without a building that isn't among such homes."""
    near = _geodesic("l", "h")
    return f"select l.* from land l where interior_sqft {area} 0 and not exists (select 1 from homes h where h.interior_sqft {area} 0 and (h.street_address = l.street_address or {near} <= 45.72))"


_DEVELOPED = f"""{_STAGED},
developed as (select 'home' as source, id as source_id, url, home_type as property_type, (1990 + k % 40)::int as year_built, price, lot_sqft, interior_sqft, bedrooms as beds, (k % 3)::double as baths, lat, lon from homes where interior_sqft > 0
  union all select 'land', id, url, property_type, null, price, lot_sqft, interior_sqft, beds, baths::double, lat, lon from ({_free('>')})),
lots as (select 'home' as source, id as source_id, price, lot_sqft, lat, lon from homes where interior_sqft = 0 union all select 'land', id, price, lot_sqft, lat, lon from ({_free('=')}))"""


def _slopes(value: str) -> str:
    return f"select building_id, avg({value}) as my, avg(x) as mx, case when regr_sxx({value}, x) > 0 then regr_sxy({value}, x) / regr_sxx({value}, x) else 0 end as slope from months group by 1"


_X0 = f"date_diff('day', date '1970-01-01', date '{AS_OF}')"
_SUMMARY = f"""units as (select l_suppkey as building_id, date_trunc('month', l_shipdate::date) as date, l_linenumber as bed, l_quantity * 20 as sqft, l_extendedprice as price, l_extendedprice * (1 - l_discount) as effective from lineitem),
months0 as (select building_id, date_diff('day', date '1970-01-01', date::date)::double as x, avg(price) as price, avg(effective) as effective from units group by building_id, date qualify count(*) over (partition by building_id) >= 8),
fence_p as (select building_id, quantile_cont(price, [0.25, 0.75]) as q from months0 group by 1),
months1 as (select m.* from months0 m join fence_p using (building_id) where price between q[1] - 1.5 * (q[2] - q[1]) and q[2] + 1.5 * (q[2] - q[1])),
fence_e as (select building_id, quantile_cont(effective, [0.25, 0.75]) as q from months1 group by 1),
months as (select m.* from months1 m join fence_e using (building_id) where effective between q[1] - 1.5 * (q[2] - q[1]) and q[2] + 1.5 * (q[2] - q[1])),
tp as ({_slopes('price')}), te as ({_slopes('effective')}),
means as (select building_id, avg(bed) as beds, avg(sqft) as sqft, avg(price) as price, avg(effective) as effective, count(*) as num_units from units group by 1),
summary as (select b.*, num_units, m.beds as m_beds, m.price / m.sqft as rent_sqft, m.price / m.beds as rent_bed, m.effective / m.sqft as effective_sqft, m.effective / m.beds as effective_bed, (m.price - m.effective) / m.price as concession,
  (tp.my + tp.slope * ({_X0} - tp.mx)) / m.sqft as now_sqft, (te.my + te.slope * ({_X0} - te.mx)) / m.sqft as now_effective_sqft, (te.my + te.slope * ({_X0} - te.mx)) / m.beds as now_effective_bed, (te.my + te.slope * ({_X0} + 365 - te.mx)) / m.beds as next_effective_bed
  from build b left join means m on m.building_id = b.building_id left join tp on tp.building_id = b.building_id left join te on te.building_id = b.building_id)"""


def _means_sql(name: str, at: str, other: str, values: dict[str, str]) -> str:
    gap = _POINT_SIN.format(a="p", b="o")
    means = ", ".join(f"sum(w * {c}) / nullif(sum(case when {c} is not null then w end), 0) as {n}" for n, c in values.items())
    pairs = f"select p.source, p.source_id, {', '.join(f'o.{c}' for c in values.values())}, {gap} as gap from {at} p, {other} o"
    return f"{name} as (select source, source_id, count(*) as n, {means} from (select *, exp(-4.4::double * gap / {AROUND}) as w from ({pairs}) where gap <= {AROUND}) group by 1, 2)"


def _main_sql(at: str) -> str:
    """The properties of a table with the means around them."""
    rents = {"a_units": "num_units", "a_beds": "m_beds", "a_concession": "concession", "a_rent_sqft": "rent_sqft", "a_rent_bed": "rent_bed", "a_effective_sqft": "effective_sqft", "a_now_sqft": "now_effective_sqft", "a_now_bed": "now_effective_bed", "a_leased": "leased"}
    parts = [_means_sql(f"{at}_b", at, "summary", rents), _means_sql(f"{at}_h", at, "home_prices", {"a_home": "home_sqft"}), _means_sql(f"{at}_l", at, "lot_prices", {"a_lot": "lot_cost"})]
    joins = " ".join(f"left join {at}_{x} {x} on {x}.source = p.source and {x}.source_id = p.source_id" for x in "bhl")
    counts = ", ".join(f"coalesce({x}.n, 0) as {x}_n" for x in "bhl")
    return f"{', '.join(parts)}, {at}_main as (select p.*, {', '.join(f'b.{n}' for n in rents)}, h.a_home, l.a_lot, {counts} from {at} p {joins})"


_MAIN = f"""{_DEVELOPED}, {_SUMMARY},
home_prices as (select lat, lon, price / interior_sqft as home_sqft from developed where source = 'home'),
lot_prices as (select lat, lon, case when lot_sqft > 0 then price / lot_sqft end as lot_cost from lots), {_main_sql('developed')}"""
_PAY, _LOT_PAY = (f"({1000000 * r * (1 + r) ** 360 / ((1 + r) ** 360 - 1)!r}::double / 1000000)" for r in (8.2 / 1200, 6.25 / 1200))


def _up(value: str, places: int = 1) -> str:
    return f"floor({value} * {10 ** places} + 0.500001::double) / {10 ** places}"


def _trend_sql(source: str, keys: str, values: tuple[str, ...], date: str = "date") -> str:
    """Sums of a trend for groups with two dates or more."""
    x = f"date_diff('day', date '1970-01-01', {date}::date)::double"
    parts = ", ".join(
        f"avg({v}) as m_{v}, case when regr_sxx({v}, {x}) > 0 then regr_sxy({v}, {x}) / regr_sxx({v}, {x}) else 0 end as s_{v}, arg_min({v}, {date}) as a_{v}, arg_max({v}, {date}) as z_{v}" for v in values
    )
    return f"select {keys}, avg({x}) as mx, min({date})::date as min_date, max({date})::date as max_date, {parts} from {source} group by {keys} having count(*) >= 2"


def _at(v: str, ahead: int = 0) -> str:
    return f"(m_{v} + s_{v} * ({_X0} + {ahead} - mx))"


def _gain(v: str) -> str:
    return f"case when max_date > min_date and a_{v} > 0 then (pow(z_{v} / a_{v}, 365.25::double / (max_date - min_date)) - 1) * 100 else 0 end"


_RAW = """rb as (select *, date '2024-01-01' + (s_suppkey % 50)::int as created from supplier where s_acctbal > 0 qualify row_number() over (partition by s_nationkey order by date '2024-01-01' + (s_suppkey % 50)::int desc, s_suppkey) = 1)"""
_KEPT = f"""{_STAGED}, pts as (select id, url, msa, zip_code, o_orderdate::date as date, o_totalprice as price from homes join orders on o_custkey = k where o_totalprice > 0),
  q as (select id, quantile_cont(price, [0.25, 0.75]) as q from pts group by 1), kept as (select pts.* from pts join q using (id) where price between q[1] - 1.5 * (q[2] - q[1]) and q[2] + 1.5 * (q[2] - q[1]))"""
_FOUND = f"{_KEPT}, byday as (select id, url, date, avg(price) as price from kept group by 1, 2, 3), g as ({_trend_sql('byday', 'id, url', ('price',))}), found as (select * from g where max_date >= date '{AS_OF}' - 210)"
_MANUAL = f"""{_STAGED}, man as (select 'm' || n_nationkey as id, n_nationkey * 1000.0::double + 200000 as price, n_nationkey % 4 as beds, (n_nationkey % 3)::double as baths, n_nationkey * 50.0::double as interior_sqft, {_A.format('n_nationkey')} from nation),
  mannear as (select m.*, b.building_id, b.msa, sqrt(pow(m.lat - b.lat, 2) + pow(m.lon - b.lon, 2)) * 111000 as distance from man m, build b qualify row_number() over (partition by id order by sqrt(pow(m.lat - b.lat, 2) + pow(m.lon - b.lon, 2)), building_id) = 1),
  manual as (select * from mannear where distance <= {NEAR})"""

_HOMES_FOUND = f"""{_FOUND.removeprefix(_STAGED + ', ')},
  home_sums as (select h.id, h.lat, h.lon, case when bedrooms > 0 then price / bedrooms end as per_bedroom, case when interior_sqft > 0 then price / interior_sqft end as per_sqft, case when interior_sqft > 0 then {_at('price')} / interior_sqft end as now_sqft from homes h left join found f on f.id = h.id),
  home_trends as (select h.lat, h.lon, {_gain('price')} as gain, (max_date - min_date) as span from found f join homes h on h.id = f.id),
  developed_prices as (select lat, lon, price / interior_sqft as per_interior, case when lot_sqft > 0 then price / lot_sqft end as per_lot from developed)"""


def _fit_sql(source: str, keys: str, value: str, x: str, date: str) -> str:
    """Everything that a trend's forecasts, bounds and growth need."""
    return f"""select *, (select t from tt where dof = greatest(n - 2, 1)) as t, greatest((syy - slope * sxy) / n, 0) as mse from (select *, case when sxx > 0 then sxy / sxx else 0 end as slope from
      (select {keys}, count(*) as n, avg({x}) as mx, avg({value}) as my, regr_sxx({value}, {x}) as sxx, regr_sxy({value}, {x}) as sxy, regr_syy({value}, {x}) as syy, min({date}) as min_date, max({date}) as max_date,
       arg_min({value}, {date}) as a_v, arg_max({value}, {date}) as z_v from {source} group by {keys}))"""


def _forecast(f: str, ahead: int, side: str = "") -> str:
    point = f"({f}.my + {f}.slope * ({_X0} + {ahead} - {f}.mx))"
    half = f"{f}.t * sqrt({f}.mse * case when {f}.sxx > 0 then 1 + pow({_X0} + {ahead} - {f}.mx, 2) / {f}.sxx else 1.1 end)"
    return point if not side else f"(case when {f}.n > 2 then {point} {'-' if side == '_lower' else '+'} {half} when {f}.n is not null then 0 end)"


def _growth(f: str) -> str:
    return f"case when {f}.max_date > {f}.min_date and {f}.a_v > 0 then (pow({f}.z_v / {f}.a_v, 365.25::double / ({f}.max_date - {f}.min_date)) - 1) * 100 when {f}.n is not null then 0 end"


def _all_surroundings_sql() -> tuple[str, str]:
    """Means of six sets, each under the name that the mart gives it."""
    sides, times = ("", "_lower", "_upper"), (("current", 0), ("future", 365))
    forecasts = {f"predicted_{time}{kind}_price{side}": _forecast(f, ahead, side) for time, ahead in times for kind, f in (("", "fp"), ("_effective", "fe")) for side in sides}
    columns = {f"avg_{c}_per_{u}": f"{x} / nullif({by}, 0)" for c, x in forecasts.items() for u, by in (("sqft", "m.sqft"), ("bed", "m.beds"))}
    columns |= {f"avg_{k}rent_price_per_{u}": f"m.{v} / nullif({by}, 0)" for k, v in (("", "price"), ("effective_", "effective")) for u, by in (("sqft", "m.sqft"), ("bed", "m.beds"))}
    columns |= {"avg_beds": "m.beds", "avg_baths": "m.baths", "avg_sqft": "m.sqft", "avg_price": "m.price", "avg_effective_price": "m.effective", "num_units": "m.num_units"}
    columns |= {"avg_leased_percentage": "b.leased", "avg_exposure_percentage": "b.exposure", "avg_concession_percentage": "(m.price - m.effective) / nullif(m.price, 0)"}
    of_homes = {"price": "h.price"} | {f"predicted_{time}_price{side}": _forecast("f", ahead, side) for time, ahead in times for side in sides}
    homes = {f"avg_home_{c}_per_{u}": f"case when {by} > 0 then {x} / {by} end" for c, x in of_homes.items() for u, by in (("bedroom", "h.bedrooms"), ("sqft", "h.interior_sqft"))}
    homes |= {"avg_home_current_price": "h.price", "avg_home_bedrooms": "h.bedrooms", "avg_home_living_area_sqft": "h.interior_sqft"}
    columns |= {"gain_effective": _growth("fe")}
    homes |= {"gain": _growth("f"), "home_url": "h.url"}
    own = ("gain_effective", "gain", "home_url")  # of reports only
    gains = {"avg_building_average_percent_gain_per_year": _growth("fp"), "avg_building_average_percent_gain_per_year_effective": _growth("fe")}
    trends = {"avg_home_average_percent_gain_per_year": _growth("f"), "avg_home_trend_strength_pct": "case when s.n >= 3 then s.hits / s.m * 100 else 0 end", "avg_home_trend_variance_pct": "case when s.n >= 3 then s.sd * 100 else 0 end", "avg_home_data_span_days": "(f.max_date - f.min_date)"}
    listed = lambda names: ", ".join(f"{x} as {n}" for n, x in names.items())
    sets = {"buildings": columns, "building_trends": gains, "homes": homes, "home_trends": trends, "lots": {"avg_empty_lot_cost_per_sqft": ""}, "developed": {"avg_interior_sqft_cost": "", "avg_developed_lot_cost_per_sqft": ""}}
    sets = {name: {n: x for n, x in names.items() if n not in own} for name, names in sets.items()}
    means = ", ".join(_means_sql(f"a_{name}", "developed", f"s_{name}", {n: n for n in names}) for name, names in sets.items())
    joins = " ".join(f"left join a_{name} on a_{name}.source = p.source and a_{name}.source_id = p.source_id" for name in sets)
    whole = ("num_units", "avg_home_data_span_days")
    shown = [f"round_even(a_{name}.{n}, 0)::int as {n}" if n in whole else f"{_up(f'a_{name}.{n}', _places(n))} as {n}" for name, names in sets.items() for n in names]
    shown += [f"coalesce(a_{name}.n, 0) as {name}_within_radius" for name in sets]
    gap = _POINT_SIN.format(a="p", b="o")
    near = ", ".join(
        f"l_{name} as (select * from (select *, row_number() over (partition by source, source_id order by gap, id) as rk from (select p.source, p.source_id, o.{key} as id, {gap} as gap from developed p, s_{name} o) where gap <= {AROUND}) where rk <= 10), n_{name} as (select source, source_id, string_agg(id::varchar, ',' order by rk) as ids from l_{name} group by 1, 2)"
        for name, key in (("buildings", "building_id"), ("homes", "id"))
    )
    lists = " ".join(f"left join n_{name} on n_{name}.source = p.source and n_{name}.source_id = p.source_id" for name in ("buildings", "homes"))
    return f"""with tt(dof, t) as (values {_t_values()}), {_DEVELOPED}, {_SUMMARY}, {_FOUND.removeprefix(_STAGED + ', ')},
      means2 as (select building_id, avg(bed) as beds, avg(l_linenumber % 3) as baths, avg(sqft) as sqft, avg(price) as price, avg(effective) as effective, count(*) as num_units from (select *, bed as l_linenumber from units) group by 1),
      mdates as (select *, date '1970-01-01' + x::int as day from months), fp as ({_fit_sql('mdates', 'building_id', 'price', 'x', 'day')}), fe as ({_fit_sql('mdates', 'building_id', 'effective', 'x', 'day')}),
      daily as (select *, date_diff('day', date '1970-01-01', date)::double as x from byday where id in (select id from found)), hf as ({_fit_sql('daily', 'id', 'price', 'x', 'date')}),
      changes as (select id, date, price, price / lag(price) over (partition by id order by date) - 1 as ch from daily),
      ways as (select id, count(*) as n, count(ch) as m, stddev_pop(ch) as sd, case when arg_max(price, date) > arg_min(price, date) then 1 else -1 end as way from changes group by 1),
      strengths as (select w.*, h.hits from ways w join (select c.id, count(*) filter (sign(ch) = way)::double as hits from changes c join ways using (id) group by 1) h using (id)),
      s_buildings as (select b.building_id, b.lat, b.lon, {listed(columns)} from build b left join means2 m on m.building_id = b.building_id left join fp on fp.building_id = b.building_id left join fe on fe.building_id = b.building_id),
      s_building_trends as (select b.lat, b.lon, {listed(gains)} from build b join fp on fp.building_id = b.building_id left join fe on fe.building_id = b.building_id),
      s_homes as (select h.id, h.lat, h.lon, {listed(homes)} from homes h left join hf f on f.id = h.id),
      s_home_trends as (select h.lat, h.lon, {listed(trends)} from homes h join hf f on f.id = h.id join strengths s on s.id = h.id),
      s_lots as (select lat, lon, case when lot_sqft > 0 then price / lot_sqft end as avg_empty_lot_cost_per_sqft from lots),
      s_developed as (select lat, lon, price / interior_sqft as avg_interior_sqft_cost, case when lot_sqft > 0 then price / lot_sqft end as avg_developed_lot_cost_per_sqft from developed),
      {means}, {near}""", f"select p.source, p.source_id, {', '.join(shown)}, n_buildings.ids as closest_buildings, n_homes.ids as closest_homes from developed p {joins} {lists}"


def _report_sql(name: str, details: dict[str, str]) -> str:
    """Comparables of properties with a rent nearby, by their distance on the spheroid."""
    gap, key = _geodesic("p", "o"), "building_id" if name == "buildings" else "id"
    return f"""pairs as (select p.source, p.source_id, {gap} as meters, o.* from l_{name} l join developed p on p.source = l.source and p.source_id = l.source_id join s_{name} o on o.{key} = l.id
      join a_buildings a on a.source = l.source and a.source_id = l.source_id where coalesce(a.avg_rent_price_per_sqft, a.avg_predicted_current_effective_price_per_sqft) is not null),
      report as (select source, source_id, row_number() over (partition by source, source_id order by meters, {key}) - 1 as place, {key} as id, round(meters / 1609.34::double, 2) as distance_miles, {', '.join(f'{x} as {n}' for n, x in details.items())} from pairs)"""


_AROUND_ALL, _SHOWN_AROUND = _all_surroundings_sql()
_ALL_SURROUNDINGS = f"{_AROUND_ALL} {_SHOWN_AROUND}"
_BUILDING_REPORT = {
    "listing_urls": "(select 'u' || s_nationkey from supplier where s_suppkey = building_id)", "leased_percentage": _up("avg_leased_percentage", 3), "average_percent_gain_per_year_effective": _up("gain_effective", 3),
    **{f"avg_effective_rent_price_per_{u}": _up(f"avg_effective_rent_price_per_{u}") for u in ("bed", "sqft")}, **{f"predicted_{t}_effective_price_per_{u}": _up(f"avg_predicted_{t}_effective_price_per_{u}") for t in ("current", "future") for u in ("bed", "sqft")},
}
_HOME_REPORT = {
    "url": "home_url", "price": _up("avg_home_current_price"), "bedrooms": "avg_home_bedrooms", "interior_sqft": _up("avg_home_living_area_sqft", 3), "average_percent_gain_per_year": _up("gain", 3),
    **{f"price_per_{u}": _up(f"avg_home_price_per_{u}") for u in ("bedroom", "sqft")}, **{f"predicted_{t}_price_per_{u}": _up(f"avg_home_predicted_{t}_price_per_{u}") for t in ("current", "future") for u in ("bedroom", "sqft")},
}
_VERSION = """o_orderkey % 900 * 1000.0::double + o_custkey % 10 as price, date '2024-01-01' + (o_orderkey % 300)::int as created"""
_MARKET = "n % 7 > 0 and n % 13 > 0 and v.price between 5000 and 700000"
_QUEUE_SQL = "queue as (select 'u' || c_custkey as url from customer where c_acctbal > 0 union all select 'v' || p_partkey from part where p_size > 10)"
_WIDE = f"""wide_home as (select h.*, n.points from homes h left join (select o_custkey, count(*)::int as points from orders group by 1) n on o_custkey = h.k), wide_land as (select l.*, p.p_name, p.p_brand, p.p_partkey as k from land l join part p on 'l' || p.p_partkey = l.id
  where l.id in (select id from ({_free('>')}) union all select id from ({_free('=')})))"""
_EVERY = {"source_id": "id", "lat": "lat", "lon": "lon", "price": "price::double", "closest_building_id": "building_id", "msa": "msa", "interior_sqft": "interior_sqft::double", "status": "'FOR_SALE'"}
_NONE = {n: f"null::{(kind or 'string').replace('string', 'varchar')}" for n, kind in (marts.DEVELOPED | marts.LOTS).items()} | {"price_history": "null::int", "created_at": "null::date"}
_FALSE = {n: "false" for n in ("is_income_restricted", "is_auction", "has_estimate")}
_HOME_SHAPE = {
    **_NONE, **_EVERY, **_FALSE, "source_url": "url", "created_at": "date '2024-01-01' + (k % 50)::int", "property_name": "case when k % 3 = 0 then 'The ' || k else street_address end", "street_address": "street_address", "city": "'Provo'", "state": "'UT'", "zip_code": "zip_code", "beds": "bedrooms",
    "baths": "(k % 3)::double", "year_built": "(1990 + k % 40)::int", "property_type": "home_type", "lot_sqft": "lot_sqft", "date_posted": "date '2024-01-15'", "days_on_market": "(k % 90)::int", "page_view_count": "(k % 1000)::int", "favorite_count": "(k % 17)::int", "is_income_restricted": "k % 5 = 0",
    "is_auction": "k % 7 = 0", "address": "'{\"k\":' || k || '}'", "selling_soon": "case when k % 2 = 0 then '[' || k % 4 || ',1]' end", "price_history": "points", "school_distances": "'[' || ((k % 6) / 2.0::double) || ']'", "risks": "'{\"flood\":\"' || k % 3 || '\"}'", "foreclosure": "'{}'",
    "num_schools_close_to": "1::int", "avg_school_distance": "(k % 6) / 2.0::double", "lot_size": "(k % 100)::double",
}
_LAND_SHAPE = {
    **_NONE, **_EVERY, **_FALSE, "source_url": "url", "created_at": "date '2024-02-01' + (k % 50)::int", "property_name": "case when k % 2 = 0 then p_name else p_brand end", "street_address": "street_address", "city": "'Provo'", "state": "'UT'", "zip_code": "'1'", "beds": "beds", "baths": "baths::double",
    "property_type": "property_type", "lot_sqft": "lot_sqft", "date_posted": "date '2024-03-04'", "avg_school_distance": "k % 30 / 2.0::double",
    "address": "'{\"address1\":\"' || street_address || '\",\"address2\":' || case when k % 3 = 0 then '\"unit 2\"' else 'null' end || ',\"city_coords\":{\"lat\":40.25,\"lon\":' || case when k % 4 > 0 then '-111.5' else 'null' end || '}}'",
}
_MANUAL_SHAPE = {
    **_NONE, **_EVERY, **_FALSE, "property_name": "n_name", "street_address": "n_name", "zip_code": "'84001'", "beds": "beds::int", "baths": "baths", "property_type": "'manual_property'", "address": "'{\"address\":\"' || n_name || '\",\"zip_code\":\"84001\"}'",
}


def _shape_sql(source: str, own: dict[str, str], table: str) -> str:
    """All columns of a unified table from one source."""
    shape = marts.DEVELOPED if table == "developed" else marts.LOTS
    given = own | {"source": f"'{source}'", "geog_point": "'POINT(' || lon || ' ' || lat || ')'", "description": "'nice'" if source == "home" and table == "lots" else "null::varchar"}
    if table == "lots" and source == "land":
        given["lot_size"] = "(select p_size * 0.1::double from part where 'l' || p_partkey = wide_land.id)"
    return ", ".join(f"{given[n]} as {n}" for n in shape)


ORACLE_SQL = {
    "mart_surroundings": f"""with {_MAIN}, near as (select source, source_id, string_agg(building_id::varchar, ',' order by rk) as ids from (select *, row_number() over (partition by source, source_id order by gap, building_id) as rk from
      (select p.source, p.source_id, o.building_id, {_POINT_SIN.format(a="p", b="o")} as gap from developed p, summary o) where gap <= {AROUND}) where rk <= 10 group by 1, 2)
      select m.source, m.source_id, round(a_rent_sqft, 3) as avg_rent_price_per_sqft, round(a_now_bed, 3) as avg_predicted_current_effective_price_per_bed, round(a_leased, 3) as avg_leased_percentage, round(a_home, 3) as avg_home_price_per_sqft,
      round(a_lot, 3) as avg_empty_lot_cost_per_sqft, b_n as buildings_within_radius, h_n as homes_within_radius, l_n as lots_within_radius, near.ids as closest_buildings from developed_main m left join near on near.source = m.source and near.source_id = m.source_id""",
    "mart_profits": f"""with {_MAIN}, e as (select *, row_number() over (order by source, source_id) as unified_id, price * {_PAY} as pay, coalesce(a_rent_sqft, a_now_sqft) * interior_sqft as by_area, coalesce(a_rent_bed, a_now_bed) * beds as by_beds from developed_main)
      select unified_id, source, source_id, round(pay, 1) as monthly_payment, round(greatest(by_area - pay, by_beds - pay), 1) as best_case_profit, round(least(by_area - pay, by_beds - pay), 1) as worst_case_profit, round((by_area - pay + by_beds - pay) / 2, 1) as average_case_profit
      from e where by_area is not null""",
    "mart_lots": f"""with {_MAIN}, {_main_sql('lots')}, r as (select avg(interior_sqft / lot_sqft) as interior, avg((price - lot_sqft * a_lot) / interior_sqft) as build from developed_main where interior_sqft > 0 and lot_sqft > 0 and a_lot is not null),
      e as (select l.*, lot_sqft * r.interior as potential, price + lot_sqft * r.interior * r.build as total from lots_main l, r)
      select source, source_id, round(potential, 1) as potential_sqft, round(price * {_LOT_PAY}, 1) as lot_payment, round(total * {_LOT_PAY}, 1) as full_payment, round(a_now_sqft * potential - total * {_LOT_PAY}, 1) as profit_sqft from e""",
    "mart_flips": f"""with {_MAIN}, e as (select *, coalesce(interior_sqft * a_effective_sqft * a_leased, interior_sqft * a_effective_sqft * 0.9::double) as income from developed_main
        where b_n > 2 and h_n > 2 and beds > 0 and baths > 0 and price > 20000 and property_type not in ('undeveloped-land', 'manufactured') and year_built < 2015 and url not in (select 'u' || c_custkey from customer where c_acctbal < 0))
      select source, source_id, round(income, 3) as hoped_income, round(price / nullif(income, 0), 3) as invest_to_monthly_return, round(price / interior_sqft / nullif(a_home, 0), 3) as share_of_average_price from e""",
    "mart_homes": f"with {_STAGED} select id, street_address, home_type, bedrooms, round(interior_sqft, 2) as interior_sqft, round(lot_sqft, 1) as lot_sqft, zip_code, msa, building_id as closest_building_id, round(distance, 1) as distance from homes",
    "mart_land": f"with {_STAGED} select id, property_type, beds, round(interior_sqft, 1) as interior_sqft, round(lot_sqft, 1) as lot_sqft, round(coalesce(case when lot_sqft > 0 then price / lot_sqft * 43560 end, 0), 1) as cost_per_acre, building_id as closest_building_id from land",
    "mart_home_history": f"""with {_STAGED}, pts as (select id, msa, zip_code, o_orderdate::date as date, o_totalprice as price from homes join orders on o_custkey = k where o_totalprice > 0),
      q as (select id, quantile_cont(price, [0.25, 0.75]) as q from pts group by 1), kept as (select pts.* from pts join q using (id) where price between q[1] - 1.5 * (q[2] - q[1]) and q[2] + 1.5 * (q[2] - q[1])),
      s as (select 'msa' as geography_type, msa as geography_value, * from kept union all select 'zip', zip_code, * from kept)
      select geography_type, geography_value, date_trunc('month', date)::date as month, {_up('avg(price)')} as price, count(distinct id) as homes from s where geography_value is not null group by 1, 2, 3""",
    "mart_buildings": f"""with {_STAGED}, {_SUMMARY} select building_id, num_units, {_up('rent_sqft', 3)} as avg_rent_price_per_sqft, {_up('effective_bed', 3)} as avg_effective_rent_price_per_bed, {_up('now_sqft', 3)} as predicted_current_price_per_sqft,
      {_up('next_effective_bed', 3)} as predicted_future_effective_price_per_bed, {_up('concession', 3)} as concession_percentage from summary""",
    "mart_developed": f"""with {_DEVELOPED}, {_MANUAL.removeprefix(_STAGED + ', ')}, {_WIDE},
      d as (select {_shape_sql('home', _HOME_SHAPE, 'developed')} from wide_home where interior_sqft > 0 union all by name select {_shape_sql('land', _LAND_SHAPE, 'developed')} from wide_land where interior_sqft > 0
        union all by name select {_shape_sql('manual', _MANUAL_SHAPE, 'developed')} from (select m.*, n.n_name from manual m join nation n on 'm' || n_nationkey = id) where interior_sqft > 0)
      select * replace ({_up('price', 2)} as price, {_up('lot_sqft')} as lot_sqft, {_up('interior_sqft')} as interior_sqft), {_up('price / interior_sqft', 2)} as price_per_sqft, {_up('case when lot_sqft > 0 then price / lot_sqft end', 3)} as price_per_lot_sqft from d""",
    "mart_empty_lots": f"""with {_DEVELOPED}, {_WIDE},
      d as (select {_shape_sql('home', _HOME_SHAPE, 'lots')} from wide_home where interior_sqft = 0 union all by name select {_shape_sql('land', _LAND_SHAPE, 'lots')} from wide_land where interior_sqft = 0)
      select * replace ({_up('price', 2)} as price, {_up('lot_sqft')} as lot_sqft), {_up('case when lot_sqft > 0 then price / lot_sqft end', 3)} as price_per_lot_sqft from d""",
    "mart_homes_from_raw": f"""with {_STAGED}, {_QUEUE_SQL}, v as (select 'u' || o_custkey as url, o_orderkey as n, o_custkey as k, {_VERSION} from orders),
      kept as (select * from v where {_MARKET} and n % 5 > 1 and n % 11 > 0 and url in (select url from queue) qualify row_number() over (partition by url order by created desc, price) = 1),
      r as (select *, 'home_' || row_number() over (order by url) as rid from kept),
      h as (select r.rid as id, r.url, r.created as created_at, 'FOR_SALE' as status, r.price, h.home_type, h.lot_sqft, h.zip, h.lat, h.lon from r join home1 h on h.k = r.k where lot_sqft < 65340),
      near as (select h.*, b.building_id, b.bzip, sqrt(pow(h.lat - b.lat, 2) + pow(h.lon - b.lon, 2)) * 111000 as distance from h, build b qualify row_number() over (partition by id order by sqrt(pow(h.lat - b.lat, 2) + pow(h.lon - b.lon, 2)), building_id) = 1)
      select id, url, created_at, status, price, home_type, {_up('lot_sqft')} as lot_sqft, coalesce(bzip, zip) as zip_code, building_id as closest_building_id from near where distance <= {NEAR}""",
    "mart_land_from_raw": f"""with {_STAGED}, {_QUEUE_SQL}, v as (select 'v' || l_partkey as url, l_orderkey * 7 + l_linenumber as n, l_partkey as k, {_VERSION.replace('o_orderkey', '(l_orderkey * 7 + l_linenumber)').replace('o_custkey', 'l_partkey')} from lineitem),
      kept as (select v.* from v join part on p_partkey = v.k where {_MARKET} and p_size * 0.1::double > 0.3::double and url in (select url from queue) qualify row_number() over (partition by url order by created desc, price) = 1),
      r as (select *, 'land_' || row_number() over (order by url) as rid from kept),
      l as (select r.rid as id, r.url, r.created as created_at, r.price, l.property_type, l.lot_sqft, l.lat, l.lon from r join land2 l on l.id = 'l' || r.k),
      near as (select l.*, b.building_id, sqrt(pow(l.lat - b.lat, 2) + pow(l.lon - b.lon, 2)) * 111000 as distance from l, build b qualify row_number() over (partition by id order by sqrt(pow(l.lat - b.lat, 2) + pow(l.lon - b.lon, 2)), building_id) = 1)
      select id, url, created_at, price, property_type, {_up('lot_sqft')} as lot_sqft, building_id as closest_building_id from near where distance <= {NEAR}""",
    "mart_rental_staging": f"""with {_RAW}, u as (select l_orderkey || '-' || l_partkey as id, l_suppkey as building_id, l_shipdate::date as created, l_linenumber % 4 as bed, l_extendedprice as price, coalesce(case when l_tax > 0.02 then 1 end, case when l_tax > 0.01 then 1 end, case when l_tax > 0 then 1 end) as sqft from lineitem
        where l_quantity >= 10 and l_returnflag <> 'A' and (l_linenumber = 1 or l_shipdate::date >= date '{AS_OF}' - interval 24 month) and l_suppkey in (select s_suppkey from rb)),
      n as (select * from u where sqft is not null qualify row_number() over (partition by id order by created desc, price) = 1)
      select building_id::varchar as building_id, 1990::int as year_built, true as is_condo, 0.5::double as leased_percentage, null::int as number_stories, count(*) as units, sum(round(price)::bigint)::bigint as price, sum(round(price * 0.9::double)::bigint)::bigint as effective_price,
        sum(case when bed = 0 then 1 else bed end)::bigint as beds, (2 * count(*))::bigint as baths, 0::bigint as floors from n group by 1""",
    "mart_rental_buildings": f"with {_RAW} select s_suppkey as id, s_name as street_address, created as created_on from rb",
    "mart_rental_units": f"""with {_RAW}, u as (select l_orderkey || '-' || l_partkey as id, l_suppkey as building_id, l_shipdate::date as created, l_extendedprice as price,
        coalesce(case when l_tax > 0.02 then l_quantity * 20 end, case when l_tax > 0.01 then l_quantity * 10 end, case when l_tax > 0 then l_quantity * 30 end) as sqft from lineitem
        where l_quantity >= 10 and l_returnflag <> 'A' and (l_linenumber = 1 or l_shipdate::date >= date '{AS_OF}' - interval 24 month) and l_suppkey in (select s_suppkey from rb)),
      n as (select * from u where sqft is not null qualify row_number() over (partition by id order by created desc, price) = 1)
      select building_id, count(*) as units, sum(sqft) as sqft, max(created) as newest from n group by 1""",
    "mart_rental_history": f"""with {_RAW} select l_suppkey as building_id, count(*) as leases, sum((case when l_quantity >= 10 then l_extendedprice when l_quantity >= 5 then l_extendedprice * 2 else l_extendedprice * 3 end)::decimal(18,2))::double as price
      from lineitem where l_suppkey in (select s_suppkey from rb) group by 1""",
    "mart_manual": f"with {_MANUAL} select id, building_id as closest_building_id, msa, interior_sqft, price from manual",
    "mart_developed_manual": f"with {_MANUAL} select id as source_id, beds::int as beds, baths, {_up('price / interior_sqft', 2)} as price_per_sqft from manual where interior_sqft > 0",
    "mart_home_analysis": f"with {_FOUND} select id, url, max_date, (max_date - min_date)::int as data_span_days, {_up('z_price')} as latest_price, {_up(_at('price'))} as predicted_current_price, {_up(_at('price', 365))} as predicted_future_price, {_up(_gain('price'))} as average_percent_gain_per_year from found",
    "mart_home_summary": f"""with {_FOUND} select h.id, {_up('case when bedrooms > 0 then price / bedrooms end')} as price_per_bedroom, {_up('case when interior_sqft > 0 then price / interior_sqft end')} as price_per_sqft,
      {_up(f"case when bedrooms > 0 then {_at('price')} / bedrooms end")} as predicted_current_price_per_bedroom, {_up(f"case when interior_sqft > 0 then {_at('price', 365)} / interior_sqft end")} as predicted_future_price_per_sqft from homes h left join found f on f.id = h.id""",
    "mart_rental_areas": f"""with {_STAGED}, u as (select building_id, msa, bzip, l_partkey as unit, date_trunc('month', l_shipdate::date)::date as date, l_extendedprice as price, l_extendedprice * (1 - l_discount) as effective from lineitem join build on building_id = l_suppkey),
      places as (select bzip, msa, count(distinct unit) as u, count(distinct building_id) as b from u group by 1, 2),
      meta as (select 'zip' as t, bzip as v, max(u)::bigint as u, max(b)::bigint as b from places where bzip is not null group by 2 union all select 'msa', msa, sum(u)::bigint, sum(b)::bigint from places group by 2),
      points as (select 'zip' as t, bzip as v, date, avg(price) as price, avg(effective) as effective from u where bzip is not null group by 2, 3 union all select 'msa', msa, date, avg(price), avg(effective) from u group by 2, 3),
      g as ({_trend_sql('points', 't, v', ('price', 'effective'))})
      select g.t as geography_type, g.v as geography_value, coalesce(u, 0) as total_units, coalesce(b, 0) as total_buildings, {_up(_at('price'))} as predicted_current_price, {_up(_at('effective', 365))} as predicted_future_effective_price,
      {_up(_gain('price'))} as average_percent_gain_per_year, {_up(_gain('effective'))} as average_percent_gain_per_year_effective from g left join meta on meta.t = g.t and meta.v = g.v""",
    "mart_home_areas": f"""with {_KEPT}, s as (select 'msa' as t, msa as v, * from kept union all select 'zip', zip_code, * from kept),
      months as (select t, v, date_trunc('month', date)::date as date, avg(price) as price, count(distinct id)::double as n from s where v is not null group by 1, 2, 3),
      r as (select t, v, date, avg(price) over w as price, avg(n) over w as n, count(*) over w as k, date_diff('day', min(date) over w, date) as span from months window w as (partition by t, v order by date range between interval 2 month preceding and current row)),
      points as (select * from r where k >= 2 and span >= 30), g as ({_trend_sql('points', 't, v', ('price',))}),
      about as (select t, v, floor(avg(n) + 0.5)::bigint as homes, avg(price) as mean, quantile_cont(price, 0.5) as median, stddev_samp(price) as deviation from points group by 1, 2)
      select g.t as geography_type, g.v as geography_value, homes as total_properties_in_geography, {_up('mean')} as avg_property_value, {_up('median')} as median_property_value, {_up('coalesce(deviation, 0)')} as property_value_std_dev,
      {_up(_at('price'))} as predicted_current_price, {_up(_gain('price'))} as average_percent_gain_per_year from g join about a on a.t = g.t and a.v = g.v where max_date >= date '{AS_OF}' - 210""",
    "mart_lot_profitability": f"""with {_STAGED}, lot as (select id, lat, lon, price / nullif(p_size * 0.1::double, 0) as cost from land0 join part on 'l' || p_partkey = id),
      pair as (select l.id, l.cost, s_acctbal as rent, {_POINT_SIN.format(a='l', b='b')} as m from lot l, build b join supplier on s_suppkey = building_id),
      e as (select id, cost / 12 as acre, sum(exp(-0.5::double * pow(m * (3963 / 6371008.8::double) / 5, 2)) * rent) / sum(exp(-0.5::double * pow(m * (3963 / 6371008.8::double) / 5, 2))) as bed from pair
        where m * (3963 / 6371008.8::double) <= 8 and id in (select id from pair where m <= {NEAR}) group by id, cost)
      select id, {_up('bed')} as potential_rent_per_bed, {_up('acre')} as acre_cost_per_bed, {_up('case when acre > 0 then bed / acre end', 4)} as estimate_profit from e""",
    "mart_lots_main": f"""with {_MAIN}, {_main_sql('lots')} select row_number() over (order by source, source_id) as unified_id, source, source_id, round(a_lot, 3) as avg_empty_lot_cost_per_sqft, round(a_home, 3) as avg_home_price_per_sqft, l_n as lots_within_radius from lots_main""",
    "mart_all_surroundings": _ALL_SURROUNDINGS,
    "mart_accepted_flips": f"""with {_MAIN}, {_HOMES_FOUND}, {_MANUAL.removeprefix(_STAGED + ', ')},
      every as (select source, source_id, url, price, interior_sqft, lat, lon from developed union all select 'manual', id, null, price, interior_sqft, lat, lon from manual where interior_sqft > 0),
      {_means_sql('eh', 'every', 'home_sums', {'h_price': 'per_sqft'})}, {_means_sql('eb', 'every', 'summary', {'a_now_sqft': 'now_effective_sqft', 'a_leased': 'leased'})}
      select m.source, m.source_id, round(h_price * interior_sqft, 2) as estimate_potential_home_value, round(h_price * interior_sqft - price, 2) as estimated_home_value_increase, round(interior_sqft * a_now_sqft * a_leased, 2) as estimated_income_sqft
      from every m left join eh on eh.source = m.source and eh.source_id = m.source_id left join eb on eb.source = m.source and eb.source_id = m.source_id
      where m.source = 'manual' or price <= 400000 and price > 45000 and url in (select 'u' || c_custkey from customer where c_acctbal > 0)""",
    "mart_building_report": f"{_AROUND_ALL}, {_report_sql('buildings', _BUILDING_REPORT)} select * from report",
    "mart_home_report": f"{_AROUND_ALL}, {_report_sql('homes', _HOME_REPORT)} select * from report",
    "mart_flip_report": f"""{_AROUND_ALL}, {_report_sql('buildings', _BUILDING_REPORT)}
      select source, source_id, place, listing_urls, distance_miles, predicted_current_effective_price_per_sqft, leased_percentage from report join developed using (source, source_id)
      where price <= 400000 and price > 45000 and url in (select 'u' || c_custkey from customer where c_acctbal > 0)""",
}
