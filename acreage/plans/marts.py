"""Marts over rental buildings, home, land and manual listings: cleaned, analysed, summarised, smoothed and ranked.

Each function takes and returns DataFrames. Listings have id, url, created_at,
street_address, city, state, zip_code, price, lat and lon besides the columns
that a function names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.functions import maths as M
from acreage.functions import text as X
from acreage.operators import dedup, filters, series, spatial
from acreage.sources.scratch import settled

NEAR_METERS = 2414.01
FOUR_MILES_METERS = 6437.38
MOST_LOT_SQFT = 1.5 * X.SQFT_PER_ACRE
# Names of categories and what they are filed under.
HOME_TYPES = {
    "single family": "single_family", "condominium": "condo", "town_home": "townhouse", "apts": "apartment", "mobile home": "manufactured", "multi-family": "multi_family", "unknown": "home_type_unknown",
}
LAND_TYPES = {
    "undeveloped land": "undeveloped-land", "vacant land": "undeveloped-land", "vacant": "undeveloped-land", "recreational": "recreational-property", "recreational property": "recreational-property",
    "home": "homes", "residential": "homes",
}
LAND_KEPT = ("undeveloped-land", "homes", "recreational-property")
_PLACE = {"property_name": "string", "street_address": "string", "city": "string", "state": "string", "zip_code": "string", "lat": "double", "lon": "double", "geog_point": "string", "price": "double"}
_SOURCE = {"source": "string", "source_id": "string", "source_url": "string", "created_at": "timestamp"}
_NEAR = {"closest_building_id": None, "msa": "string"}
#: The unified tables: each source's columns under common names, with their types (None: as they come). JSON columns are text.
DEVELOPED = {
    **_SOURCE, **_PLACE, "beds": "int", "baths": "double", "interior_sqft": "double", "year_built": "int", "property_type": "string", "lot_sqft": "double", "status": "string", "date_posted": "date", "days_on_market": "int",
    "page_view_count": "int", "favorite_count": "int", "is_income_restricted": "boolean", "is_auction": "boolean", "has_estimate": "boolean", "address": "string", "selling_soon": "string", "price_history": "string", "school_distances": "string",
    "risks": "string", "description": "string", "foreclosure": "string", "num_schools_close_to": "int", "avg_school_distance": "double", **_NEAR,
}
LOTS = {**_SOURCE, **_PLACE, "lot_sqft": "double", "lot_size": "double", "status": "string", "date_posted": "date", "days_on_market": "int", "description": "string", "risks": "string", "avg_school_distance": "double", **_NEAR}


def _filed(c: str, types: dict[str, str]) -> Column:
    return X.mapped(F.col(c), types, F.lower(F.trim(c)))


def _zero(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit(0))


def _beds(beds: str, area: str) -> Column:
    """A building without bedrooms counts as having one."""
    return F.when((_zero(beds) == 0) & (_zero(area) > 0), 1).otherwise(_zero(beds))


def _clean_address(df: DataFrame) -> DataFrame:
    return df.withColumns({"street_address": X.title_case(F.col("street_address")), "city": X.title_case(F.col("city")), "state": F.upper(F.trim("state")), "zip_code": F.trim("zip_code")})


def building_lookup(buildings: DataFrame, sources: dict[str, DataFrame]) -> DataFrame:
    """The nearest building of each listing: source, property_id, closest_building_id, msa, building_zip, distance."""
    b, out = buildings.select(F.col("id").alias("building"), "msa", "zip_code", "lat", "lon"), None
    for name, df in sources.items():
        near = spatial.nearest(df.select("id", "lat", "lon"), b, "id", "building").select(
            F.lit(name).alias("source"), F.col("id").alias("property_id"), F.col("r_building").alias("closest_building_id"), F.col("r_msa").alias("msa"), F.col("r_zip_code").alias("building_zip"), "distance"
        )
        out = near if out is None else out.unionByName(near)
    return out


def _near_building(df: DataFrame, lookup: DataFrame, source: str, meters: float) -> DataFrame:
    """Only listings with a building near enough."""
    near = lookup.where((F.col("source") == source) & (F.col("distance") <= meters)).drop("source")
    return df.join(near, F.col("id") == F.col("property_id")).drop("property_id")


def rental_buildings(buildings: DataFrame, state: str = "UT") -> DataFrame:
    """Complete buildings of the state, the newest of those with the same listing urls; all without urls count as one."""
    whole = filters.complete(buildings.where(F.col("state") == state), ["city", "street_address", "lat", "lon", "zip_code", "msa"])
    return dedup.latest_by(whole, ["listing_urls"], [F.desc("created_on"), F.asc("id")])


def rental_units(units: DataFrame, buildings: DataFrame, as_of: str) -> DataFrame:
    """Units of the buildings with a price and an area, on the market in the last two years; no floor plans; the newest row per unit."""
    rows = filters.coalesced(units.where("price is not null and is_floorplan = false"), "sqft", "min_sqft", "max_sqft")
    rows = rows.where(filters.recent(F.col("exit_market"), F.lit(as_of).cast("date"))).join(buildings.select(F.col("id").alias("building_id")), "building_id", "left_semi")
    return dedup.latest_by(rows, ["id"], [F.desc("created_on"), F.asc("price")])


def rental_history(history: DataFrame, buildings: DataFrame) -> DataFrame:
    """Leases of the buildings with a price: their own, or else the least or the greatest asked."""
    return filters.coalesced(history, "price", "min_price", "max_price").join(buildings.select(F.col("id").alias("building_id")), "building_id", "left_semi")


def raw_homes(listings: DataFrame, urls: DataFrame, state: str = "UT", low: float = 5000, high: float = 700000) -> DataFrame:
    """Home listings (source_url, created_at, status, country) of the queue's urls, in the market and for sale: the newest per url, numbered by url. A tie goes to the lower price."""
    known = listings.join(urls.select(F.col("url").alias("source_url")).where("source_url is not null"), "source_url", "left_semi")
    rows = filters.in_market(known, state, low, high).where(~F.col("status").isin("SOLD", "FOR_RENT") & filters.not_value(F.col("country"), "CAN"))
    newest = dedup.latest_by(rows, ["source_url"], [F.desc("created_at"), F.asc("price")])
    return dedup.sequential_id(newest, "id", "home_", [F.asc("source_url")]).withColumnsRenamed({"source_url": "url", "latitude": "lat", "longitude": "lon"})


def raw_land(listings: DataFrame, urls: DataFrame, state: str = "UT", low: float = 5000, high: float = 700000) -> DataFrame:
    """Land listings of the queue's urls, in the market and complete: the newest per url, numbered by url. A tie goes to the lower price."""
    known = listings.join(urls.select("url").where("url is not null"), "url", "left_semi")
    rows = filters.complete(filters.in_market(known, state, low, high), ["zip_code", "lot_size", "city", "street_address", "city_latitude", "city_longitude"])
    newest = dedup.latest_by(rows, ["url"], [F.desc("created_at"), F.asc("price")])
    return dedup.sequential_id(newest, "id", "land_", [F.asc("url")]).withColumnsRenamed({"latitude": "lat", "longitude": "lon"})


# The declared columns of staged buildings and units
UNIT_TYPES = {
    "id": "string", "building_id": "string", "floorplan_name": "string", "unit_name": "string", "availability": "date", "price": "int", "bed": "int", "bath": "int", "partial_bath": "int", "sqft": "int", "created_on": "date", "enter_market": "date",
    "exit_market": "date", "days_on_market": "int", "effective_price": "int", "floor": "int", "renovated": "boolean", "furnished": "boolean", "den": "boolean", "convertible": "boolean", "amenities": None,
}
BUILDING_TYPES = {
    "id": "string", "street_address": "string", "street_address_alias": None, "city": "string", "state": "string", "zip_code": "string", "lat": "double", "lon": "double", "msa": "string", "building_name": "string", "building_website": "string",
    "is_single_family": "boolean", "is_condo": "boolean", "is_apartment": "boolean", "number_units": "int", "year_built": "int", "number_stories": "int", "management_company": "string", "created_on": "date", "verified_listing": "boolean",
    "avg_quality": "double", "estimated_occupancy": "double", "is_student": "boolean", "is_senior": "boolean", "latest_unit_source": "string", "is_affordable": "boolean", "building_amenities": None, "unit_amenities": None,
    "leased_percentage": "double", "exposure_percentage": "double", "listing_urls": None,
}


def _typed(df: DataFrame, types: dict[str, str | None]) -> DataFrame:
    """The declared columns; what the source lacks is null, fractions are rounded to whole numbers, a value that can't be cast is null."""
    kinds, numbers = dict(df.dtypes), ("float", "double", "decimal")

    def one(name: str, kind: str | None) -> Column:
        if name not in kinds:
            return F.lit(None).cast(kind or "string")
        value = F.round(name) if kind == "int" and kinds[name].startswith(numbers) else F.col(name)
        return value.try_cast(kind) if kind else value

    return df.select(*(one(name, kind).alias(name) for name, kind in types.items()))


def unit_staging(units: DataFrame) -> DataFrame:
    """Units in their declared types; one without bedrooms has one."""
    return _typed(units, UNIT_TYPES).withColumn("bed", F.when(F.col("bed") == 0, 1).otherwise(F.col("bed")))


def building_staging(buildings: DataFrame) -> DataFrame:
    return _typed(buildings, BUILDING_TYPES)


def home_staging(homes: DataFrame, lookup: DataFrame, meters: float = NEAR_METERS, most_lot: float = MOST_LOT_SQFT) -> DataFrame:
    """Home listings (home_type, bedrooms, bathrooms, living_area and its unit, lot_area_value and its unit) near a rental building, on small lots.

    Bathrooms aren't used to find impossible listings: bedrooms stand for them.
    A lot in an unknown unit counts as square feet; one without a size is left out.
    """
    area, beds = _zero("living_area"), _beds("bedrooms", "living_area")
    rows = _clean_address(homes.where(filters.possible(area, beds, _zero("bedrooms")))).withColumns({
        "home_type": _filed("home_type", HOME_TYPES), "bedrooms": beds.cast("int"), "interior_sqft": X.to_sqft(area, F.coalesce("living_area_units", F.lit("")), True),
        "lot_sqft": X.to_sqft(F.col("lot_area_value"), F.coalesce("lot_area_units", F.lit("")), True), "date_posted": X.text_to_date(F.col("date_posted_text")),
    })
    near = _near_building(rows.where(F.col("lot_sqft") < most_lot), lookup, "home", meters)
    return near.withColumn("zip_code", F.coalesce("building_zip", "zip_code")).drop("building_zip", "living_area", "living_area_units", "lot_area_value", "lot_area_units", "date_posted_text")


def land_staging(land: DataFrame, lookup: DataFrame, meters: float = NEAR_METERS) -> DataFrame:
    """Land listings (property_type, beds, baths, homesqft, lot_size and its unit) of the kept types near a building. A lot in an unknown unit has no size."""
    beds = _beds("beds", "homesqft")
    rows = _clean_address(land.where(filters.possible(_zero("homesqft"), beds, _zero("baths")))).withColumns({
        "property_type": _filed("property_type", LAND_TYPES), "beds": beds.cast("int"), "baths": _zero("baths"), "interior_sqft": _zero("homesqft").cast("double"), "lot_sqft": X.to_sqft(F.col("lot_size"), F.col("lot_size_units"), False),
    })
    rows = rows.where(F.col("property_type").isin(*LAND_KEPT)).withColumn("cost_per_acre", F.coalesce(M.ratio(F.col("price"), F.col("lot_sqft")) * X.SQFT_PER_ACRE, F.lit(0.0)))
    return _near_building(rows, lookup, "land", meters).drop("building_zip", "homesqft", "lot_size_units")


def manual_staging(manual: DataFrame, lookup: DataFrame, meters: float = FOUR_MILES_METERS) -> DataFrame:
    """Listings collected by hand (bedrooms, bathrooms, living_area) near a building."""
    rows = manual.withColumnsRenamed({"living_area": "interior_sqft"})
    return _near_building(rows, lookup, "manual", meters).drop("building_zip")


def home_history(homes: DataFrame, keep: list[str]) -> DataFrame:
    """A row per point of each home's price history, without points that are outliers of the home in price or change."""
    points = homes.select("id", *keep, F.explode(X.price_history(F.col("price_history"))).alias("p"))
    rows = points.select("id", *keep, X.text_to_date(F.col("p.date")).alias("date"), F.col("p.price").alias("price"), F.col("p.priceChangeRate").alias("price_change_rate"))
    return series.iqr_filter(rows.where("price > 0 and date is not null"), ["id"], ["price", "price_change_rate"], nulls_pass=("price_change_rate",))


def analysis(points: DataFrame, keys: list[str], values: dict[str, str], as_of: str, least: int = 1, without_outliers: bool = False) -> DataFrame:
    """Trend, forecast, growth and strength for each of ``values`` (column: what stands for ``price`` in the new names).

    Groups have ``least`` points or more; after that, points outside the fences
    of one value and then of the next can be left out.
    """
    big, out = series.at_least(points, keys, least) if least > 1 else points, None
    big = series.iqr_filter_in_turn(big, keys, list(values)) if without_outliers else big
    big = settled(big, "analysis-points")  # read by each trend and strength, several times
    for column, name in values.items():
        usable = big.where(filters.finite_positive(F.col(column)))
        t = series.trend(usable, keys, "date", column, as_of).join(series.trend_strength(usable, keys, "date", column), keys)
        suffix = "" if name == "price" else f"_{name.removesuffix('_price')}"
        named = t.select(*keys, *(F.col(c).alias(c.replace("price", name) if "price" in c else f"{c}{suffix}") for c in t.columns if c not in keys))
        out = named if out is None else out.join(named, keys, "full")
    return out


def home_analysis(history: DataFrame, as_of: str) -> DataFrame:
    """Trends of homes (id, url, date, price) with two dates or more, the last of them recent. Prices of a date are averaged."""
    points = history.groupBy("id", "url", "date").agg(F.avg("price").alias("price"))
    found = analysis(points, ["id", "url"], {"price": "price"}, as_of, least=2)
    return filters.recently_seen(found, "max_date", as_of)


def area_analysis(points: DataFrame, values: dict[str, str], about: DataFrame, defaults: dict[str, float], as_of: str, recent: bool = False) -> DataFrame:
    """Trends of areas (geography_type, geography_value) with two dates or more, with what is known about each, or else the defaults."""
    keys = ["geography_type", "geography_value"]
    found = analysis(points, keys, values, as_of, least=2)
    found = filters.recently_seen(found, "max_date", as_of) if recent else found
    joined = found.join(about.select(*keys, *defaults), keys, "left")
    return joined.withColumns({c: F.coalesce(c, F.lit(x)) for c, x in defaults.items()})


def home_areas(points: DataFrame) -> DataFrame:
    """What is known about each area from its dates (price, property_count): homes per date, mean, median and deviation of prices."""
    return points.groupBy("geography_type", "geography_value").agg(
        F.floor(F.avg("property_count") + 0.5).cast("long").alias("total_properties_in_geography"), F.avg("price").alias("avg_property_value"), F.percentile("price", 0.5).alias("median_property_value"),
        F.stddev_samp("price").alias("property_value_std_dev"),
    )


def lot_profitability(lots: DataFrame, units: DataFrame, near_meters: float = 16093.44, radius_miles: float = 1.0, beds_per_acre: int = 12) -> DataFrame:
    """Lots (id, lat, lon, cost_per_acre) near rented units (lat, lon, rent_per_bed), by the rent of a bed over its share of an acre's cost."""
    per_meter = 3963 / 6371008.8  # miles, on the sphere of this estimate
    close = spatial.within(lots, units, "id", near_meters)
    rented = units.select("lat", "lon", "rent_per_bed", F.lit(1.0).alias("_one"))
    around = spatial.sums_around(close, {"units": (rented, ["rent_per_bed", "_one"])}, radius_miles / per_meter, 0.5 * (per_meter / 5.0) ** 2, 2)
    total = lambda c, i: F.sum(F.get(c, F.lit(i)))
    # a unit without a rent weighs too
    rents = around.groupBy("lat", "lon").agg(F.when(total("weights", 0) > 0, total("sums", 0) / total("weights", 1)).alias("potential_rent_per_bed"))
    rows = close.join(rents, ["lat", "lon"]).withColumn("acre_cost_per_bed", F.col("cost_per_acre") / beds_per_acre)
    return rows.withColumn("estimate_profit", M.ratio(F.col("potential_rent_per_bed"), F.col("acre_cost_per_bed"))).orderBy(F.desc_nulls_last("estimate_profit"), "id")


def building_summary(buildings: DataFrame, units: DataFrame, found: DataFrame) -> DataFrame:
    """Buildings with means of their units (bed, bath, sqft, price, effective_price) and all prices per square foot and per bed."""
    means = units.groupBy("building_id").agg(
        *(F.avg(c).alias(f"avg_{n}") for c, n in (("bed", "beds"), ("bath", "baths"), ("sqft", "sqft"), ("price", "price"), ("effective_price", "effective_price"))), F.count("*").alias("num_units")
    )
    rows = buildings.withColumnRenamed("id", "building_id").join(means, "building_id", "left").join(found, "building_id", "left")
    prices = [c for c in found.columns if c.startswith("predicted_")]
    per = {f"{c}_per_{unit}": F.col(c) / F.nullif(F.col(by), F.lit(0)) for c in prices for unit, by in (("sqft", "avg_sqft"), ("bed", "avg_beds"))}
    per |= {f"{n}_per_{unit}": F.col(c) / F.nullif(F.col(by), F.lit(0)) for n, c in (("avg_rent_price", "avg_price"), ("avg_effective_rent_price", "avg_effective_price")) for unit, by in (("sqft", "avg_sqft"), ("bed", "avg_beds"))}
    return rows.withColumns(per).withColumn("concession_percentage", (F.col("avg_price") - F.col("avg_effective_price")) / F.nullif(F.col("avg_price"), F.lit(0)))


def home_summary(homes: DataFrame, found: DataFrame) -> DataFrame:
    """Homes with their price and predictions per bedroom and per square foot."""
    rows = homes.join(found, "id", "left")
    prices = ["price", *(c for c in found.columns if c.startswith("predicted_"))]
    return rows.withColumns({f"{c}_per_{unit}": M.ratio(F.col(c), F.col(by)) for c in prices for unit, by in (("bedroom", "bedrooms"), ("sqft", "interior_sqft"))})


def _given(df: DataFrame, *names: str) -> Column:
    """The first of the columns that has a value; null where the source has none of them."""
    return F.coalesce(*(F.col(n) for n in names if n in df.columns), F.lit(None))


def _unified(df: DataFrame, source: str, shape: dict[str, str | None], own: dict[str, Column]) -> DataFrame:
    """One source in the common shape: its ``own`` expressions, else its column of that name, else null."""
    common = {
        "source": F.lit(source), "source_id": F.col("id"), "source_url": _given(df, "url"), "geog_point": F.concat(F.lit("POINT("), F.col("lon").cast("string"), F.lit(" "), F.col("lat").cast("string"), F.lit(")")),
        "beds": _given(df, "beds", "bedrooms"), "baths": _given(df, "baths", "bathrooms"), "is_income_restricted": F.lit(False), "is_auction": F.lit(False), "has_estimate": F.lit(False), "status": F.lit("FOR_SALE"),
    }
    held = {n: own.get(n, common.get(n, _given(df, n))) for n in shape}
    return df.select(*((held[n].cast(kind) if kind else held[n]).alias(n) for n, kind in shape.items()))


def _as_json(df: DataFrame, name: str) -> Column:
    return X.clean_json(F.col(name)) if dict(df.dtypes)[name] == "string" else F.to_json(name)


def _unified_home(homes: DataFrame, shape: dict[str, str | None]) -> DataFrame:
    own = {
        "property_name": _given(homes, "marketing_name", "street_address"), "property_type": _given(homes, "home_type"), "status": _given(homes, "status"), "is_income_restricted": _given(homes, "is_income_restricted"),
        "is_auction": _given(homes, "is_preforeclosure_auction"), **{n: _as_json(homes, n) for n in ("address", "selling_soon", "price_history", "school_distances", "risks", "foreclosure") if n in homes.columns},
    }
    return _unified(homes, "home", shape, own if shape is LOTS else {**own, "description": F.lit(None)})


def _unified_land(land: DataFrame, shape: dict[str, str | None]) -> DataFrame:
    spot = F.struct(*(_given(land, f"city_{c}").cast("double").alias(n) for n, c in (("lat", "latitude"), ("lon", "longitude"))))
    address = F.to_json(F.struct(_given(land, "street_address").alias("address1"), _given(land, "address2").cast("string").alias("address2"), spot.alias("city_coords")), {"ignoreNullFields": "false"})
    own = {"property_name": _given(land, "name", "title"), "address": address, "avg_school_distance": _given(land, "distance_to_city_miles"), "description": F.lit(None), "year_built": F.lit(None)}
    return _unified(land, "land", shape, own)


def _unified_manual(manual: DataFrame) -> DataFrame:
    own = {"property_name": F.col("street_address"), "city": F.lit(None), "state": F.lit(None), "property_type": F.lit("manual_property"), "lot_sqft": F.lit(None), "address": F.to_json(F.struct(F.col("street_address").alias("address"), "zip_code"), {"ignoreNullFields": "false"})}
    return _unified(manual, "manual", DEVELOPED, own)


def _with_land(homes: DataFrame, land: DataFrame) -> DataFrame:
    """Homes, and land listings that aren't listed as homes too."""
    return homes.unionByName(spatial.resolve_sources(homes, land, "source_id", ["street_address", "city", "state"]))


def developed(homes: DataFrame, land: DataFrame, manual: DataFrame | None = None) -> DataFrame:
    """All staged listings with a building, in one table of 38 columns, with their price per square foot of interior and of lot."""
    rows = _with_land(_unified_home(homes, DEVELOPED).where("interior_sqft > 0"), _unified_land(land, DEVELOPED).where("interior_sqft > 0"))
    if manual is not None:
        rows = rows.unionByName(_unified_manual(manual).where("interior_sqft > 0"))
    return rows.withColumns({"price_per_sqft": M.ratio(F.col("price"), F.col("interior_sqft")), "price_per_lot_sqft": M.ratio(F.col("price"), F.col("lot_sqft"))})


def empty_lots(homes: DataFrame, land: DataFrame) -> DataFrame:
    """All staged listings without a building, in one table of 23 columns, with their price per square foot of lot."""
    lots = _with_land(_unified_home(homes.where("interior_sqft = 0"), LOTS), _unified_land(land.where("interior_sqft = 0"), LOTS))
    return lots.withColumn("price_per_lot_sqft", M.ratio(F.col("price"), F.col("lot_sqft")))


def smoothed(properties: DataFrame, keys: list[str], sets: dict[str, tuple[DataFrame, dict[str, str], dict[str, str]]], meters: float = M.SMOOTHING_METERS, closest: dict[str, str] | None = None) -> DataFrame:
    """Distance-decayed means around each property, one row per property.

    ``sets``: name -> (frame with lat and lon, float means, whole-number means),
    both as new name -> column; no two means have one name. Each gives a count
    ``<name>_within_radius``. ``closest``: name of a set -> its id; gives the ids of the ten nearest.
    Each place is looked at once, however many properties or rows of a set lie there.
    """
    columns = {name: (df, [*floats.values(), *whole.values()]) for name, (df, floats, whole) in sets.items()}
    around = spatial.sums_around(properties, columns, meters, M.DECAY / meters)
    of = lambda name, c: F.sum(F.when(F.col("_set") == name, c))
    means = []
    for name, (_, floats, whole) in sets.items():
        for i, n in enumerate((*floats, *whole)):
            mean = of(name, F.get("sums", F.lit(i))) / F.nullif(of(name, F.get("weights", F.lit(i))), F.lit(0.0))
            means.append((F.bround(mean, 0).cast("int") if n in whole else mean).alias(n))
    counts = [of(name, F.col("n")).alias(f"{name}_within_radius") for name in sets]
    found = around.groupBy("lat", "lon").agg(*means, *counts)
    for name in (n for n in sets if closest and n in closest):
        near = spatial.nearest_around(properties, sets[name][0], closest[name], meters)
        lists = near.groupBy("lat", "lon").agg(F.array_sort(F.collect_list(F.struct("place", F.col(closest[name]).alias("id"))))["id"].alias(f"closest_{name}"))
        found = found.join(lists, ["lat", "lon"], "left")
    return properties.select(*keys, "lat", "lon").join(found, ["lat", "lon"], "left").drop("lat", "lon").fillna(0, [f"{name}_within_radius" for name in sets])


def surroundings(buildings: DataFrame, homes: DataFrame, found_homes: DataFrame, lots: DataFrame, properties: DataFrame) -> dict[str, tuple[DataFrame, dict[str, str], dict[str, str]]]:
    """The six sets that ``smoothed`` takes: every mean of summarised buildings and their trends, homes and theirs, empty lots, developed properties.

    ``buildings`` as of ``building_summary``, ``homes`` of ``home_summary``,
    ``found_homes`` of ``home_analysis`` with lat and lon.
    """
    predicted = [f"predicted_{time}{kind}_price{side}" for time in ("current", "future") for kind in ("", "_effective") for side in ("", "_lower", "_upper")]
    rents = [f"avg_{kind}rent_price_per_{u}" for kind in ("", "effective_") for u in ("sqft", "bed")] + ["avg_beds", "avg_baths", "avg_sqft", "avg_price", "avg_effective_price"]
    shares = [c for c in ("leased_percentage", "exposure_percentage", "concession_percentage") if c in buildings.columns]
    of_buildings = {n: n for n in rents} | {f"avg_{c}_per_{u}": f"{c}_per_{u}" for c in predicted for u in ("sqft", "bed")} | {f"avg_{c}": c for c in shares}
    of_homes = {f"avg_home_{c}_per_{u}": f"{c}_per_{u}" for c in ("price", *(c for c in predicted if "effective" not in c)) for u in ("bedroom", "sqft")}
    of_homes |= {"avg_home_current_price": "price", "avg_home_bedrooms": "bedrooms", "avg_home_living_area_sqft": "interior_sqft"}
    gains = {f"avg_building_{c}": c for c in ("average_percent_gain_per_year", "average_percent_gain_per_year_effective")}
    return {
        "buildings": (buildings, of_buildings, {"num_units": "num_units"}),
        "building_trends": (buildings.where("average_percent_gain_per_year is not null"), gains, {}),
        "homes": (homes, of_homes, {}),
        "home_trends": (found_homes, {f"avg_home_{c}": c for c in ("average_percent_gain_per_year", "trend_strength_pct", "trend_variance_pct")}, {"avg_home_data_span_days": "data_span_days"}),
        "lots": (lots, {"avg_empty_lot_cost_per_sqft": "price_per_lot_sqft"}, {}),
        "developed": (properties, {"avg_interior_sqft_cost": "price_per_sqft", "avg_developed_lot_cost_per_sqft": "price_per_lot_sqft"}, {}),
    }


def lots_main(rows: DataFrame, around: DataFrame) -> DataFrame:
    """Empty lots under one id, with their surroundings."""
    return dedup.numbered(rows, "unified_id", [F.asc("source"), F.asc("source_id")]).join(around, ["source", "source_id"], "left")


def developed_main(rows: DataFrame, around: DataFrame) -> DataFrame:
    """Developed properties under one id, with their surroundings and the income they may give."""
    numbered = dedup.numbered(rows, "unified_id", [F.asc("source"), F.asc("source_id")])
    income = F.col("interior_sqft") * F.col("avg_effective_rent_price_per_sqft")
    return numbered.join(around, ["source", "source_id"], "left").withColumns({"estimated_monthly_income_sqft": income, "estimated_monthly_income_sqft_leased": income * F.col("avg_leased_percentage")})


def expanded_developed(main: DataFrame, yearly_percent: float = 8.2) -> DataFrame:
    """Payment, income by area and by beds, and the best, worst and mean profit; without a rent nearby, no row."""
    sqft, bed = (F.coalesce(f"avg_rent_price_per_{u}", f"avg_predicted_current_effective_price_per_{u}") for u in ("sqft", "bed"))
    rows = main.where(sqft.isNotNull()).withColumns({"monthly_payment": M.mortgage_payment(F.col("price"), yearly_percent), "income_sqft": sqft * F.col("interior_sqft"), "income_beds": bed * F.col("beds")})
    a, b = F.col("income_sqft") - F.col("monthly_payment"), F.col("income_beds") - F.col("monthly_payment")
    return rows.withColumns({"best_case_profit": F.greatest(a, b), "worst_case_profit": F.least(a, b), "average_case_profit": (a + b) / 2})


def expanded_lots(lots: DataFrame, main: DataFrame, yearly_percent: float = 6.25) -> DataFrame:
    """What a lot would hold, cost and earn if it were developed like the developed properties (one row of means)."""
    known = main.where("interior_sqft > 0 and lot_sqft > 0 and avg_empty_lot_cost_per_sqft is not null")
    building = (F.col("price") - F.col("lot_sqft") * F.col("avg_empty_lot_cost_per_sqft")) / F.col("interior_sqft")
    ratios = known.agg(F.avg(F.col("interior_sqft") / F.col("lot_sqft")).alias("interior_per_lot_sqft"), F.avg(building).alias("building_cost_per_sqft"))
    rows = lots.crossJoin(F.broadcast(ratios))  # one row
    rows = rows.withColumn("potential_sqft", F.col("lot_sqft") * F.col("interior_per_lot_sqft")).withColumn("building_cost", F.col("potential_sqft") * F.col("building_cost_per_sqft"))
    rows = rows.withColumns({
        "lot_payment": M.mortgage_payment(F.col("price"), yearly_percent), "total_cost": F.col("price") + F.col("building_cost"), "income_sqft": F.col("avg_predicted_current_effective_price_per_sqft") * F.col("potential_sqft"),
    })
    full = M.mortgage_payment(F.col("total_cost"), yearly_percent)
    return rows.withColumns({"full_payment": full, "profit_sqft": F.col("income_sqft") - full})


def flips(main: DataFrame, rejected: DataFrame, least_near: int = 2, least_price: float = 20000, built_before: int = 2015) -> DataFrame:
    """Developed properties to buy, in order of the years of income that they cost; rejected urls are left out."""
    income = F.coalesce("estimated_monthly_income_sqft_leased", F.col("estimated_monthly_income_sqft") * 0.9)
    kept = main.where((F.col("buildings_within_radius") > least_near) & (F.col("homes_within_radius") > least_near) & (F.col("beds") > 0) & (F.col("baths") > 0) & (F.col("price") > least_price))
    kept = kept.where(~F.col("property_type").isin("undeveloped-land", "manufactured") & (F.col("year_built") < built_before))
    ranked = kept.join(rejected.select(F.col("url").alias("source_url")).where("source_url is not null"), "source_url", "left_anti")
    return ranked.withColumns({"hoped_income": income, "invest_to_monthly_return": F.col("price") / F.nullif(income, F.lit(0.0)), "share_of_average_price": F.col("price_per_sqft") / F.nullif(F.col("avg_home_price_per_sqft"), F.lit(0.0))}).orderBy(
        F.asc_nulls_last("invest_to_monthly_return"), "source_id"
    )


def accepted_flips(main: DataFrame, accepted: DataFrame, most: float = 210000, most_included: bool = True, least: float = 45000, states: tuple[str, ...] = ("UT", "ID", "AZ"), months: int = 1) -> DataFrame:
    """Developed properties of the accepted urls within the prices and states, and all manual ones, by what the homes around say they gain.

    ``months`` of income are given. Growth is (future - current) / current, of rents and of home prices per bedroom.
    """
    cheap = F.col("price") <= most if most_included else F.col("price") < most
    urls = accepted.select(F.col("url").alias("source_url")).where("source_url is not null").distinct().withColumn("_accepted", F.lit(True))
    rows = main.join(urls, "source_url", "left")
    rows = rows.where((cheap & (F.col("price") > least) & F.col("state").isin(*states) & F.col("_accepted")) | (F.col("source") == "manual")).drop("_accepted")
    worth = F.col("avg_home_price_per_sqft") * F.col("interior_sqft")
    growth = lambda c: M.ratio(F.col(f"avg_{c.format('future')}") - F.col(f"avg_{c.format('current')}"), F.col(f"avg_{c.format('current')}"))
    return rows.withColumns({
        "estimate_potential_home_value": worth, "estimated_home_value_increase": worth - F.col("price"),
        "estimated_income_sqft": F.col("interior_sqft") * F.col("avg_predicted_current_effective_price_per_sqft") * F.col("avg_leased_percentage") * months,
        "predicted_effective_rent_price_growth_percentage": growth("predicted_{}_effective_price_per_sqft"), "predicted_price_growth_percentage": growth("home_predicted_{}_price_per_bedroom"),
    }).orderBy(F.desc_nulls_last("estimated_home_value_increase"), "source", "source_id")


#: What the reports tell of each comparable, besides its distance.
BUILDING_DETAILS = [
    "listing_urls", "leased_percentage", "average_percent_gain_per_year_effective", "avg_effective_rent_price_per_bed", "avg_effective_rent_price_per_sqft", "predicted_current_effective_price_per_bed",
    "predicted_future_effective_price_per_bed", "predicted_current_effective_price_per_sqft", "predicted_future_effective_price_per_sqft",
]
HOME_DETAILS = [
    "url", "price", "bedrooms", "interior_sqft", "average_percent_gain_per_year", "price_per_bedroom", "price_per_sqft", "predicted_current_price_per_bedroom", "predicted_future_price_per_bedroom", "predicted_current_price_per_sqft",
    "predicted_future_price_per_sqft",
]


def _detailed(rows: DataFrame, listed: str, summary: DataFrame, key: str, details: list[str], name: str) -> DataFrame:
    """(source, source_id, name): the listed ids' rows of the summary, nearest first on the spheroid, ten at most per property as the lists are."""
    about = F.struct(*(_given(summary, c).alias(c) for c in details))
    known = summary.select(F.col(key).alias("_id"), F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), about.alias("_about"))
    pairs = rows.select("source", "source_id", "lat", "lon", F.explode(listed).alias("_id")).join(known, "_id").withColumn("_meters", M.geodesic(F.col("lat"), F.col("lon"), F.col("_lat"), F.col("_lon")))
    item = F.struct("_meters", "_id", M.miles(F.col("_meters")).alias("distance_miles"), "_about.*")
    return pairs.groupBy("source", "source_id").agg(F.transform(F.array_sort(F.collect_list(item)), lambda x: F.struct(x["_id"].alias("id"), x["distance_miles"].alias("distance_miles"), *(x[c].alias(c) for c in details))).alias(name))


def explanations(main: DataFrame, buildings: DataFrame, homes: DataFrame) -> DataFrame:
    """(source, source_id, buildings, homes): for each property with a rent nearby, all fields of the buildings and homes in its lists of nearest ones; empty without any.

    ``main`` has lat, lon, closest_buildings, closest_homes and the rents around; ``buildings`` as of ``building_summary``, ``homes`` of ``home_summary``.
    """
    rows = main.where(F.coalesce("avg_rent_price_per_sqft", "avg_predicted_current_effective_price_per_sqft").isNotNull())
    out = rows.select("source", "source_id")
    for name, summary, key, details in (("buildings", buildings, "building_id", BUILDING_DETAILS), ("homes", homes, "id", HOME_DETAILS)):
        found = _detailed(rows, f"closest_{name}", summary, key, details, name)
        none = F.array().cast(found.schema[name].dataType)
        out = out.join(found, ["source", "source_id"], "left").withColumn(name, F.coalesce(name, none))
    return out


def comparables_report(explained: DataFrame, name: str) -> DataFrame:
    """A row per property and comparable (``buildings`` or ``homes``), nearest first."""
    return explained.select("source", "source_id", F.posexplode(name).alias("place", "_c")).select("source", "source_id", "place", "_c.*").orderBy("source_id", "place")


def flip_report(flips: DataFrame, report: DataFrame) -> DataFrame:
    """The ranked flips with the buildings that their rents come from."""
    columns = ["listing_urls", "distance_miles", "predicted_current_effective_price_per_sqft", "leased_percentage"]
    return flips.select("source", "source_id").join(report.select("source", "source_id", "place", *columns), ["source", "source_id"])
