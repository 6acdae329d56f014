"""Listing records from pages: embedded JSON, links, urls and flags, as native expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.functions.maths import METERS_PER_MILE, haversine, ratio

# The states' names and codes
STATES = {
    "alabama": "AL", "alaska": "AK", "arizona": "AZ", "arkansas": "AR", "california": "CA", "colorado": "CO", "connecticut": "CT", "delaware": "DE", "florida": "FL", "georgia": "GA",
    "hawaii": "HI", "idaho": "ID", "illinois": "IL", "indiana": "IN", "iowa": "IA", "kansas": "KS", "kentucky": "KY", "louisiana": "LA", "maine": "ME", "maryland": "MD",
    "massachusetts": "MA", "michigan": "MI", "minnesota": "MN", "mississippi": "MS", "missouri": "MO", "montana": "MT", "nebraska": "NE", "nevada": "NV", "new-hampshire": "NH", "new-jersey": "NJ",
    "new-mexico": "NM", "new-york": "NY", "north-carolina": "NC", "north-dakota": "ND", "ohio": "OH", "oklahoma": "OK", "oregon": "OR", "pennsylvania": "PA", "rhode-island": "RI", "south-carolina": "SC",
    "south-dakota": "SD", "tennessee": "TN", "texas": "TX", "utah": "UT", "vermont": "VT", "virginia": "VA", "washington": "WA", "west-virginia": "WV", "wisconsin": "WI", "wyoming": "WY",
}


def embedded_json(html: Column, patterns: list[str]) -> Column:
    """JSON of the first pattern whose group 1 is JSON, as a variant."""
    return F.coalesce(*(F.try_parse_json(F.nullif(F.regexp_extract(html, p, 1), F.lit(""))) for p in patterns))


# Where sites put a listing's JSON, and which of its caches holds a rented building's
HOME_SCRIPTS = [r'(?s)<script id="__NEXT_DATA__" type="application/json">(.*?)</script>', r'(?s)<script id=hdpApolloPreloadedData type="application/json">(.*?)</script>']
LAND_STATE = r"window\.serverState"
RENTAL_CACHE = "ForRentDoubleScrollFullRenderQuery"
# Words of a land listing's page and the lists that they belong to
LAND_WORDS = {
    "mortgage_options": ["Owner Finance"], "activities": ["Camping"], "lot_description": ["Acreage"], "geography": ["Desert", "Mountain", "Rural"], "road_frontage_desc": ["Dirt", "Gravel/Rock"],
}
# Classes and names of the parts of a land listing's page
LAND_FACTS, LAND_AMENITIES = "_66d543c", ("Property Description", "_01623cf")


def home_page(data: Column) -> Column:
    """A home's page from a script's JSON: the rented building in ``apiCache``, or else the first entry of the client's cache, both JSON text inside the JSON."""
    rented = keyed_value(data, "$.apiCache", RENTAL_CACHE)
    return F.coalesce(rented, *(first_value(data, f"$.props.pageProps.{c}gdpClientCache") for c in ("componentProps.", "")))


def json_ld(html: Column) -> Column:
    """The first JSON-LD object of a page, or the first object of its first list."""
    found = F.regexp_extract_all(html, F.lit(r'(?s)<script[^>]*type="application/ld\+json"[^>]*>(.*?)</script>'), F.lit(1))
    objects = F.transform(found, lambda x: F.coalesce(F.get(F.from_json(x, "array<string>"), F.lit(0)), x))
    return F.try_parse_json(F.get(F.filter(objects, lambda x: F.ltrim(x).startswith("{")), F.lit(0)))


def server_state(html: Column, name: str) -> Column:
    """A quoted, escaped JSON blob assigned to a script variable, as a variant."""
    text = F.regexp_extract(html, rf'(?s){name}\s*=\s*("(?:[^"\\]|\\.)*+")', 1)
    return F.try_parse_json(F.try_variant_get(F.try_parse_json(F.nullif(text, F.lit(""))), "$", "string"))


def lot_size(text: Column) -> tuple[Column, Column]:
    """Value and unit of a text such as ``1,200.5 acres``."""
    value = F.regexp_replace(F.regexp_extract(text, r"([\d,]*\.?\d+)\s*([A-Za-z]+)", 1), ",", "").try_cast("double")
    return value, F.nullif(F.lower(F.regexp_extract(text, r"([\d,]*\.?\d+)\s*([A-Za-z]+)", 2)), F.lit(""))


def _bare(text: Column) -> Column:
    """What is left of markup without its tags, trimmed."""
    return F.regexp_replace(F.regexp_replace(text, "<[^>]*>", ""), r"^\s+|\s+$", "")


def _blocks(html: Column, tag: str, name: str) -> Column:
    """The insides of the elements of a class; an element ends at the first closing tag."""
    return F.regexp_extract_all(html, F.lit(rf'(?s)<{tag}[^>]*class="(?:[^"]*\s)?{name}(?:\s[^"]*)?"[^>]*>(.*?)</{tag}>'), F.lit(1))


def labelled(html: Column, label: str) -> Column:
    """What follows the bold label (``Size:``) in the last of a page's facts that has it; case and colon don't count."""
    own = lambda block: F.rtrim(F.lower(_bare(F.regexp_extract(block, r"(?s)<b[^>]*>(.*?)</b>", 1))), F.lit(":")) == label
    return F.regexp_replace(F.try_element_at(F.filter(_blocks(html, "div", LAND_FACTS), own), F.lit(-1)), r"(?s)^.*?</b>", "")


def lot_facts(html: Column) -> dict[str, Column]:
    """A lot's size and unit, its types, and what the page says of amenities."""
    value, unit = lot_size(_bare(labelled(html, "size")))
    linked = lambda part: F.transform(F.regexp_extract_all(part, F.lit(r"(?s)<a\b[^>]*>(.*?)</a>"), F.lit(1)), _bare)
    section, name = LAND_AMENITIES
    about = F.regexp_extract(html, rf'(?s)<section[^>]*aria-label="{section}"[^>]*>(.*?)</section>', 1)
    none = F.array().cast("array<string>")
    return {"lot_size": value, "lot_size_units": unit, "lot_type": F.coalesce(linked(labelled(html, "type")), none), "amenities": F.coalesce(F.transform(_blocks(about, "div", name), _bare), none)}


def keyword_flags(text: Column, words: list[str]) -> Column:
    """Those of the words that the text contains."""
    return F.filter(F.array(*(F.lit(w) for w in words)), lambda w: F.contains(text, w))


def url_parts(url: Column) -> tuple[Column, Column, Column]:
    """County, state and property type of a url such as ``/sanpete-county-utah-farms-for-sale/pid/1``."""
    pattern = rf"/([a-z-]+)-county-({'|'.join(sorted(STATES, key=len, reverse=True))})-([a-z-]+)-for-sale"
    return tuple(F.nullif(F.regexp_extract(F.lower(url), pattern, k), F.lit("")) for k in (1, 2, 3))


def state_code(url: Column, pick: str = "first") -> Column:
    """The first (or last) token of the url that is a state's code, in any case."""
    codes = F.array(*(F.lit(c) for c in sorted(STATES.values())))
    found = F.filter(F.split(F.upper(url), r"[/\-]"), lambda t: F.array_contains(codes, t))
    return F.try_element_at(found, F.lit(1 if pick == "first" else -1))


def sitemap_urls(df: DataFrame, xml: str) -> DataFrame:
    return df.withColumn("loc", F.explode(F.regexp_extract_all(F.col(xml), F.lit(r"(?s)<loc>\s*(.*?)\s*</loc>"), F.lit(1))))


def listing_type(url: Column) -> Column:
    """The kind of listing that a site map is of, from its file's name."""
    return F.regexp_replace(F.element_at(F.split(url, "/"), -1), r"\.xml\.gz$", "")


def sitemap_jobs(df: DataFrame, url: str, xml: str) -> DataFrame:
    """(url, state, type) of the listings in site maps; those whose url names no state are left out."""
    rows = sitemap_urls(df.withColumn("type", listing_type(F.col(url))), xml)
    return rows.select(F.col("loc").alias("url"), state_code(F.col("loc")).alias("state"), "type").where("state is not null")


def page_links(df: DataFrame, html: str, containing: str, base: str) -> DataFrame:
    """Distinct links of each page that contain a text, made absolute."""
    found = F.filter(F.regexp_extract_all(F.col(html), F.lit(r'<a[^>]*href="([^"]*)"'), F.lit(1)), lambda x: F.contains(x, F.lit(containing)))
    absolute = F.transform(F.array_distinct(found), lambda x: F.when(x.startswith("/"), F.concat(F.lit(base), x)).otherwise(x))
    return df.withColumn("link", F.explode(absolute))


def robot_page(html: Column, phrases: list[str]) -> Column:
    low = F.lower(html)
    out = F.lit(False)
    for p in phrases:
        out = out | F.contains(low, F.lit(p.lower()))
    return out


# The columns of a home listing that are copied, and what they are called in its JSON
HOME_TEXTS = {
    "status": "homeStatus", "posting_url": "postingUrl", "date_posted_string": "datePostedString", "marketing_name": "marketingName", "posting_product_type": "postingProductType",
    "lot_area_units": "lotAreaUnits", "living_area_units": "livingAreaUnits", "street_address": "streetAddress", "city": "city", "state": "state", "zipcode": "zipCode", "currency": "currency",
    "home_type": "homeType", "living_area_units_short": "livingAreaUnitsShort", "country": "country", "new_construction_type": "newConstructionType", "time_on_market": "timeOnZillow",
    "rental_application_accepted_type": "rentalApplicationsAcceptedType", "description": "description", "county": "county",
}
HOME_NUMBERS = {
    "last_sold_price": "lastSoldPrice", "lot_area_value": "lotAreaValue", "lot_size": "lotSize", "living_area": "livingAreaValue", "price": "price", "bathrooms": "bathrooms", "monthly_hoa_fee": "monthlyHoaFee",
    "estimate": "zestimate", "estimate_low_percent": "zestimateLowPercent", "estimate_high_percent": "zestimateHighPercent", "latitude": "latitude", "longitude": "longitude", "list_price_low": "listPriceLow",
}
HOME_WHOLE = {"bedrooms": "bedrooms", "year_built": "yearBuilt", "page_view_count": "pageViewCount", "favorite_count": "favoriteCount", "days_on_market": "daysOnZillow"}
HOME_FLAGS = {"is_eligible_property": "buyAbilityData.isEligibleProperty", "is_preforeclosure_auction": "isPreforeclosureAuction", "is_income_restricted": "isIncomeRestricted", "has_bad_geocode": "hasBadGeocode"}
HOME_NESTED = {"selling_soon": "sellingSoon", "address": "address"}
FORECLOSURE = [
    "foreclosureDefaultFilingDate", "foreclosureAuctionFilingDate", "foreclosureLoanDate", "foreclosureLoanOriginator", "foreclosureLoanAmount", "foreclosurePriorSaleDate", "foreclosurePriorSaleAmount",
    "foreclosureBalanceReportingDate", "foreclosureDefaultDescription", "foreclosurePastDueBalance", "foreclosureUnpaidBalance", "foreclosureAuctionTime", "foreclosureAuctionDescription",
    "foreclosureAuctionCity", "foreclosureAuctionLocation", "foreclosureDate", "foreclosureAmount", "foreclosingBank", "foreclosureJudicialType",
]


def first_value(value: Column, path: str) -> Column:
    """The first value, as a variant, of the object that is JSON text inside a variant."""
    return F.try_parse_json(F.get(F.map_values(F.from_json(F.try_variant_get(value, path, "string"), "map<string, string>")), F.lit(0)))


def keyed_value(value: Column, path: str, containing: str) -> Column:
    """The first value, as a variant, whose key contains a text, of the object that is JSON text inside a variant."""
    entries = F.map_entries(F.from_json(F.try_variant_get(value, path, "string"), "map<string, string>"))
    return F.try_parse_json(F.get(F.filter(entries, lambda e: F.contains(e["key"], F.lit(containing))), F.lit(0))["value"])


def _nested(v: Column, path: str, kind: str) -> Column:
    return F.from_json(F.to_json(F.try_variant_get(v, path, "variant")), kind)


def home_record(page: Column) -> dict[str, Column]:
    """Columns of a home listing from its page's variant (``property`` and the climate beside it). The most recent price is the history's first entry."""
    kinds = [(HOME_TEXTS, "string"), (HOME_NUMBERS, "double"), (HOME_WHOLE, "int"), (HOME_FLAGS, "boolean")]
    copied = {n: F.try_variant_get(page, f"$.property.{p}", kind) for names, kind in kinds for n, p in names.items()}
    nested = {n: F.to_json(F.try_variant_get(page, f"$.property.{p}", "variant")) for n, p in HOME_NESTED.items()}
    none = lambda kind: F.array().cast(f"array<{kind}>")
    schools = F.coalesce(F.transform(_nested(page, "$.property.schools", "array<struct<distance: double>>"), lambda s: s["distance"]), none("double"))
    distances = F.filter(schools, lambda d: d.isNotNull())
    history = _nested(page, "$.property.priceHistory", "array<struct<date: string, price: double, priceChangeRate: double>>")
    insights = _nested(page, "$.property.homeInsights", "array<struct<insights: array<struct<phrases: array<string>>>>>")
    phrases = F.flatten(F.transform(insights, lambda i: F.flatten(F.transform(i["insights"], lambda x: x["phrases"]))))
    facts = _nested(page, "$.property", "map<string, string>")
    risk = "struct<probability: string, riskScore: struct<label: string, value: int, max: int>>"
    climate = F.map_filter(_nested(page, "$.zgProperty.odpPropertyModels.climate", f"map<string, struct<primary: {risk}>>"), lambda _, x: x["primary"].isNotNull())
    score = lambda p: F.struct(p["probability"].alias("probability"), *(p["riskScore"][a].alias(b) for a, b in (("label", "risk_label"), ("value", "risk_value"), ("max", "risk_value_out_of"))))
    newest = F.get(history, F.lit(0))
    return {
        **copied, **nested, "price_history": F.coalesce(history, none("struct<date: string, price: double, priceChangeRate: double>")), "most_recent_price": newest["price"], "most_recent_price_date": newest["date"],
        "most_recent_price_change_rate": newest["priceChangeRate"], "home_insights": F.coalesce(F.array_sort(F.array_distinct(phrases)), none("string")), "school_distances": distances, "num_schools_close_to": F.size(distances),
        "avg_school_distance": ratio(F.aggregate(distances, F.lit(0.0), lambda a, x: a + x), F.size(distances)), "risks": F.transform_values(climate, lambda _, x: score(x["primary"])),
        "foreclosure": F.map_filter(facts, lambda k, x: k.isin(*FORECLOSURE) & ~F.coalesce(x, F.lit("")).isin("", "false", "0", "0.0", "null", "[]", "{}")),
    }


def land_record(state: Column, html: Column) -> dict[str, Column]:
    """Columns of a land listing from its server state, with costs and the distance to its city. A coordinate of 0 is none."""
    get = lambda path, kind: F.try_variant_get(state, f"$.propertyDetailPage.propertyData.{path}", kind)
    acres, price, sqft = get("acres", "double"), get("price", "double"), get("homesqft", "double")
    lat, lon, city_lat, city_lon = get("latitude", "double"), get("longitude", "double"), get("city.latitude", "double"), get("city.longitude", "double")
    known = (F.nullif(c, F.lit(0.0)) for c in (lat, lon, city_lat, city_lon))
    return {
        "state": get("address.stateAbbreviation", "string"), "zip": get("address.zip", "string"), **{n: F.lower(get(f"address.{n}", "string")) for n in ("city", "address1", "address2")},
        "latitude": lat, "longitude": lon, "city_latitude": city_lat, "city_longitude": city_lon, "acres": acres, "beds": get("beds", "int"), "baths": get("baths", "int"), "homesqft": sqft,
        "property_types": F.to_json(get("types", "variant")), "is_irrigated": get("isIrrigated", "boolean"), "is_residence": get("isResidence", "boolean"), "price": price, "listing_date": get("listingDate", "string"),
        "title": get("title", "string"), "description": get("description", "string"), "executive_summary": get("executiveSummary", "string"), **{f"is_{n.lower()}": get(f"is{n}", "boolean") for n in ("Diamond", "Gold", "Platinum", "Showcase")},
        "cost_per_acre": ratio(price, acres), "cost_per_homesqft": ratio(price, sqft), "distance_to_city_miles": haversine(*known) / METERS_PER_MILE,
        **{n: keyword_flags(html, words) for n, words in LAND_WORDS.items()},
    }


def land_page(html: Column, url: Column) -> dict[str, Column]:
    """All columns of a land listing: what its url, linked data, facts, words and server state say."""
    county, _, kind = url_parts(url)
    about = json_ld(html)
    texts = {n: F.try_variant_get(about, f"$.{p}", "string") for n, p in (("name", "name"), ("date_posted", "datePosted"))}
    return {"url": url, "property_type": kind, "county": county, **texts, **lot_facts(html), **land_record(server_state(html, LAND_STATE), html)}
