"""The same queries in SQL, for comparison on the same tables."""

from acreage.sources.pages import HOME_FLAGS, HOME_NUMBERS, HOME_TEXTS, HOME_WHOLE, LAND_WORDS, STATES

_A = "40 + ({0} * 7919 % 10000) / 10000.0::double as lat, -112 + ({0} * 104729 % 10000) / 10000.0::double as lon"
_B = "40 + ({0} * 7919 % 9973) / 10000.0::double as lat, -112 + ({0} * 104729 % 9967) / 10000.0::double as lon"
_CUSTOMERS = f"cust as (select c_custkey, c_acctbal, c_mktsegment, {_A.format('c_custkey')} from customer)"
_SUPPLIERS = f"supp as (select s_suppkey, s_name, s_acctbal, {_B.format('s_suppkey')} from supplier)"
_DISTANCE = "2 * 6371008.8::double * asin(sqrt(least(pow(sin(radians({1}.lat - {0}.lat) / 2), 2) + cos(radians({0}.lat)) * cos(radians({1}.lat)) * pow(sin(radians({1}.lon - {0}.lon) / 2), 2), 1)))"
_REDUCED = "atan(tan(radians({0}.lat)) * (1 - 1 / 298.257223563::double))"


def _geodesic(a: str, b: str) -> str:
    """Meters on the spheroid by Lambert's formula."""
    one, two = _REDUCED.format(a), _REDUCED.format(b)
    angle = f"(2 * asin(sqrt(least(pow(sin(({two} - {one}) / 2), 2) + cos({one}) * cos({two}) * pow(sin(radians({b}.lon - {a}.lon) / 2), 2), 1))))"
    x = f"({angle} - sin({angle})) * pow(sin(({one} + {two}) / 2) * cos(({two} - {one}) / 2) / cos({angle} / 2), 2)"
    y = f"coalesce(({angle} + sin({angle})) * pow(cos(({one} + {two}) / 2) * sin(({two} - {one}) / 2) / nullif(sin({angle} / 2), 0), 2), 0)"
    return f"6378137::double * ({angle} - 1 / 298.257223563::double / 2 * ({x} + {y}))"


_PAIRS = f"{_CUSTOMERS}, {_SUPPLIERS}, pairs as (select * from (select c.c_custkey, c.c_acctbal, c.lat, c.lon, s.s_suppkey, s.s_name, s.s_acctbal, s.lat as slat, s.lon as slon, {_DISTANCE.format('c', 's')} as distance from cust c, supp s) where distance <= 8046.7)"
_URLS = "urls as (select (event_id % 4000)::varchar as url, event_type as state, case when value > 20 then ts::date end as scraped_at, ts as created_at, case when event_id % 3 = 0 then ts end as last_pulled, event_id from events)"
_LISTINGS = "listings as (select (o_custkey % 400)::varchar as url, o_orderdate as created_at, o_orderkey as id, o_orderstatus as status, o_orderpriority as priority from orders)"
_CLAIMED = """claimed as (select url, state, case when place <= 25 then 'first' else 'second' end as worker from (select *, row_number() over (order by md5('0:' || url), url) as place from
  (select url, min(state) as state from urls group by 1 having count(scraped_at) = 0 and count(*) filter (last_pulled > timestamp '2024-01-30' - interval 48 hour) = 0)) where place <= 65)"""
_LEASES = "leases as (select o_orderkey, o_custkey as building_id, o_orderdate::date as from_date, o_totalprice as price, o_orderpriority, to_date from orders join (select l_orderkey, max(l_shipdate::date) as to_date from lineitem group by 1) on l_orderkey = o_orderkey)"
_WEEKLY = f"""{_LEASES},
grid as (select unnest(generate_series((select min(from_date) from leases), (select max(to_date) from leases), interval 7 day))::date as date),
weekly as (select l.*, g.date from leases l join grid g on g.date between l.from_date and l.to_date
  where building_id in (select building_id from leases group by 1 having max(to_date) >= date '2001-09-01' - interval 7 month))"""
_ROLLUP = f"""{_WEEKLY},
located as (select w.*, nullif(c_mktsegment, 'BUILDING') as segment, n_name, r_name from weekly w join customer on c_custkey = building_id join nation on n_nationkey = c_nationkey join region on r_regionkey = n_regionkey),
stacked as (select 'segment' as geography_type, segment as geography_value, date, price from located union all select 'nation', n_name, date, price from located
  union all select 'region', r_name, date, price from located union all select 'priority', o_orderpriority, date, price from located),
rolled as (select geography_type, geography_value, date, sum(price::decimal(18,2))::double / count(price) as price, count(*) as unit_count from stacked where geography_value is not null group by 1, 2, 3)"""
_MONTHLY = "monthly as (select c_nationkey, date_trunc('month', o_orderdate)::date as date, avg(o_totalprice) as price from orders join customer on c_custkey = o_custkey group by 1, 2)"
_DAYS = "days as (select user_id, ts::date as day, sum(value::decimal(20,6))::double as v from events group by 1, 2)"
_SMOOTH = f"""{_PAIRS}, weighted as (select *, exp(-4.4::double * distance / 8046.7) as w, case when s_acctbal > 0 then s_acctbal end as v from pairs),
means as (select c_custkey, sum(w * v) / nullif(sum(case when v is not null then w end), 0) as average, round_even(sum(w * s_suppkey) / sum(w), 0)::int as average_key, count(*) as neighbours from weighted group by 1),
smooth as (select c.c_custkey, round(average, 3) as average, average_key, coalesce(neighbours, 0)::bigint as neighbours from cust c left join means m on m.c_custkey = c.c_custkey)"""
_FLIPS = f"""{_SMOOTH}, flips as (select s.c_custkey, c.c_acctbal, c.c_mktsegment, round(average - c.c_acctbal, 3) as value_increase, round(case when average > 0 then c.c_acctbal / average end, 4) as payback
  from smooth s join customer c on c.c_custkey = s.c_custkey where neighbours > 2)"""
_NEAR = f"{_PAIRS}, near as (select * from (select *, row_number() over (partition by c_custkey order by distance, s_suppkey) as rk from pairs) where rk <= 10)"

_CODES = str(tuple(sorted(STATES.values())))


def _t_values() -> str:
    from acreage.functions.maths import t_table

    return ", ".join(f"({k}, {x!r}::double)" for k, x in enumerate(t_table(0.975), start=1))


def _fences(c: str, k: float, nulls: bool = False) -> str:
    inside = f"{c} between q_{c}[1] - {k} * (q_{c}[2] - q_{c}[1]) and q_{c}[2] + {k} * (q_{c}[2] - q_{c}[1])"
    return f"({inside} or {c} is null)" if nulls else f"({inside})"


def _predictions() -> str:
    out = []
    for name, ahead in (("current", 0), ("future", 365)):
        x0 = f"(date_diff('day', date '1970-01-01', date '2001-09-01') + {ahead})"
        point = f"(case when n >= 2 then my + slope * ({x0} - mx) else 0 end)"
        half = f"(t * sqrt(mse * case when sxx > 0 then 1 + pow({x0} - mx, 2) / sxx else 1.1 end))"
        out += [f"round({point}, 2) as predicted_{name}_price", f"round(case when n > 2 then {point} - {half} else 0 end, 2) as predicted_{name}_price_lower", f"round(case when n > 2 then {point} + {half} else 0 end, 2) as predicted_{name}_price_upper"]
    return ", ".join(out)


def _rolling() -> str:
    w = "over (partition by user_id order by day rows between {} preceding and current row)"
    parts = [f"round(v - lag(v, {n}) over (partition by user_id order by day), 5) as v_diff_{n}" for n in (1, 4)]
    for n in (4, 8, 12):
        parts += [f"round(avg(v) {w.format(n - 1)}, 5) as v_mean_{n}", f"round(coalesce(stddev_samp(v) {w.format(n - 1)}, 0), 5) as v_std_{n}"]
    return ", ".join(parts)


def _home_columns() -> str:
    """Every column of the made homes."""
    texts = [n for n in HOME_TEXTS if n not in ("status", "city", "zipcode")]
    numbers = [n for n in HOME_NUMBERS if n not in ("price", "living_area")]
    columns = {n: f"'{i}-' || page_id" for i, n in enumerate(texts)} | {n: f"page_id * {i + 2} + 0.5::double" for i, n in enumerate(numbers)}
    columns |= {n: f"(page_id * 10 + {i})::int" for i, n in enumerate(HOME_WHOLE)} | {n: f"page_id % {i + 2} = 0" for i, n in enumerate(HOME_FLAGS)}
    columns |= {
        "status": "'FOR_SALE'", "price": "(page_id * 1000)::double", "bedrooms": "(page_id % 5)::int", "zipcode": "(84000 + page_id % 100)::varchar", "living_area": "(page_id % 7 * 100)::double", "city": "'O''Neil \"' || page_id % 9 || '\"'", "selling_soon": "'[' || page_id || ']'", "address": """'{"city":"x"}'""",
        "price_history": "'2020-01-0' || page_id % 9 + 1 || '|' || page_id * 900 || '|0.5;2021-01-01|1'", "most_recent_price": "(page_id * 900)::double", "most_recent_price_date": "'2020-01-0' || page_id % 9 + 1", "most_recent_price_change_rate": "0.5::double", "home_insights": "'a,b,c' || page_id % 3",
        "school_distances": "case when page_id % 3 = 0 then '' else '1.5,' || page_id % 4 || '.0' end", "num_schools_close_to": "case when page_id % 3 = 0 then 0 else 2 end::int", "avg_school_distance": "case when page_id % 3 > 0 then (1.5::double + page_id % 4) / 2 end",
        "risks": "'1|0.' || page_id % 10 || '|Minor|' || page_id % 6 || '|10'", "foreclosure": "case when page_id % 2 = 1 then 'foreclosureAmount=1,' else '' end || 'foreclosureDate=2020'",
    }
    return ", ".join(f"{x} as {n}" for n, x in columns.items())


def _page_words() -> str:
    return ", ".join(f"array_to_string(list_filter([{', '.join(repr(w) for w in words)}], lambda w: contains(said, w)), ',') as {n}" for n, words in LAND_WORDS.items())


ORACLE_SQL = {
    "latest_event_per_user_type": "select user_id, event_type, event_id, round(value, 4) as value from events qualify row_number() over (partition by user_id, event_type order by ts desc, event_id desc) = 1",
    "first_order_per_customer": "select o_custkey, o_orderkey from orders qualify row_number() over (partition by o_custkey order by o_orderdate, o_orderkey) = 1",
    "queue_dedup": f"with {_URLS} select url, event_id, scraped_at is not null as scraped from urls qualify row_number() over (partition by url order by (scraped_at is not null), created_at desc, event_id) = 1",
    "stable_ids": "select c_custkey, sha256(lower(trim(c_name)) || '|' || lower(trim(c_mktsegment)) || '|' || coalesce(nullif(c_nationkey, 3)::varchar, '')) as id from customer",
    "sequential_ids": "select c_custkey, 'cust_' || row_number() over (order by c_name desc, c_custkey) as id from customer",
    "distinct_phrases": "select p_brand, array_to_string(list_sort(list_distinct(flatten(list(string_split(p_type, ' '))))), '|') as phrases from part group by 1",
    "staging_normalise": r"""
      with u as (select *, p_size % 4 as area, (p_size % 3)::int as b, (p_partkey % 3) as bt, (['Acres', 'sqft', 'sqm', 'rods'])[(p_partkey % 4 + 1)::int] as unit,
        '2024-' || lpad((p_partkey % 14)::varchar, 2, '0') || '-15T00:00' as raw, trim(' 12 o''' || p_name || '-east ') as addr from part)
      select p_partkey, array_to_string(list_transform(regexp_extract_all(lower(addr), '([\p{L}\p{N}]+|[^\p{L}\p{N}]+)', 1), lambda x: upper(x[1]) || x[2:]), '') as address,
        concat_ws(', ', p_brand, nullif(p_type, 'ECONOMY'), p_name) as full_address,
        round(case unit when 'Acres' then p_retailprice * 43560::double when 'sqm' then p_retailprice * 10.7639::double when 'sqft' then p_retailprice end, 2) as land_sqft,
        round(case unit when 'Acres' then p_retailprice * 43560::double when 'sqm' then p_retailprice * 10.7639::double else p_retailprice end, 2) as home_sqft,
        try_cast(raw[1:10] as date) as posted, p_size::int as days,
        case lower(p_brand) when 'brand#11' then 'single' when 'brand#12' then 'multi' when 'brand#13' then 'lot' else 'other' end as home_type,
        (case when area > 0 and b = 0 then 1 else b end)::int as beds
      from u where not (area <> 0 and b = 0 and bt = 0) and not (area = 0 and b <> 0 and bt <> 0)""",
    "market_filter": "select c_custkey, round(c_acctbal, 2) as price from customer where c_mktsegment = 'BUILDING' and c_acctbal between 100 and 5000 and (c_custkey % 5 = 0 or c_custkey % 5 not in (2, 3))",
    "recent_units": "select l_linenumber, count(*) as n from lineitem where l_linenumber <= 1 or l_shipdate::date >= date '2001-09-01' - interval 24 month group by 1",
    "map_bounds": f"with {_CUSTOMERS} select round(min(lat), 4) as min_lat, round(max(lat), 4) as max_lat, round(min(lon), 4) as min_lon, round(max(lon), 4) as max_lon, round(min(c_acctbal), 4) as min_c_acctbal, round(max(c_acctbal), 4) as max_c_acctbal from cust",
    "not_rejected": "select o_orderkey, o_custkey from orders where o_custkey not in (select c_custkey from customer where c_acctbal < 0 and c_custkey <> 5)",
    "accepted_only": "select o_orderkey, o_custkey from orders where o_custkey in (select c_custkey from customer where c_acctbal > 9000)",
    "missing_parent": "select c_custkey from customer where c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')",
    "weekly_history": f"with {_WEEKLY} select building_id, date, sum(price::decimal(18,2))::double / count(price) as price, count(*) as units from weekly group by 1, 2",
    "date_grid": f"with {_LEASES} select unnest(generate_series((select min(from_date) from leases), (select max(to_date) from leases), interval 7 day))::date as date",
    "geo_rollup": f"with {_ROLLUP} select * from rolled",
    "area_metadata": """
      with o as (select * from orders join customer on c_custkey = o_custkey),
      s as (select 'segment' as geography_type, c_mktsegment as geography_value, o_totalprice as p, o_orderdate::date as d, o_custkey as c from o union all select 'priority', o_orderpriority, o_totalprice, o_orderdate::date, o_custkey from o)
      select geography_type, geography_value, count(distinct d) as dates, count(distinct c) as buildings, sum(p::decimal(18,2))::double / count(p) as average, round(quantile_cont(p, 0.5), 4) as median, round(stddev_samp(p), 2) as deviation, min(d) as first_date, max(d) as last_date
      from s group by 1, 2""",
    "top_areas_per_type": f"with {_ROLLUP} select * from (select geography_type, geography_value, sum(unit_count)::bigint as units, row_number() over (partition by geography_type order by sum(unit_count) desc, geography_value) as place from rolled group by 1, 2) where place <= 3",
    "iqr_filtered": f"""
      with li as (select l_suppkey, l_extendedprice as p, case when l_discount <> 0.05 then l_discount end as r from lineitem),
      q as (select l_suppkey, quantile_cont(p, [0.25, 0.75]) as q_p, quantile_cont(r, [0.25, 0.75]) as q_r from li group by 1)
      select l_suppkey, count(*) as n, round(sum(p), 2) as total from li join q using (l_suppkey) where {_fences("p", 1.5)} and {_fences("r", 1.5, True)} group by 1""",
    "iqr_sequential": f"""
      with li as (select l_suppkey, l_extendedprice as p, l_quantity * l_quantity as q from lineitem),
      a as (select l_suppkey, quantile_cont(q, [0.25, 0.75]) as q_q from li group by 1), b as (select li.* from li join a using (l_suppkey) where {_fences("q", 0.5)}),
      c as (select l_suppkey, quantile_cont(p, [0.25, 0.75]) as q_p from b group by 1)
      select l_suppkey, count(*) as n, round(sum(q), 2) as total from b join c using (l_suppkey) where {_fences("p", 0.5)} group by 1""",
    "rolling_quarter": """
      with d as (select o_orderpriority, o_orderdate::date as date, avg(o_totalprice) as price, count(*)::double as n from orders group by 1, 2),
      r as (select o_orderpriority, date, avg(price) over w as price, avg(n) over w as property_count, count(*) over w as window_rows, date_diff('day', min(date) over w, date) as window_days
        from d window w as (partition by o_orderpriority order by date range between interval 2 month preceding and current row))
      select o_orderpriority, date, floor(price * 10 + 0.500001::double) / 10 as price, floor(property_count * 1000 + 0.500001::double) / 1000 as property_count, window_rows, window_days from r where window_rows >= 2 and window_days >= 30""",
    "json_history": "select user_id, ts::date as date, count(*) as n, round(sum(round(value, 2)), 2) as price from events group by 1, 2",
    "json_roundtrip": "select event_id, case when event_id % 5 <> 0 then replace(props, ' ', '') end as props from events",
    "trend_by_nation": f"""
      with {_MONTHLY}, tt(dof, t) as (values {_t_values()}), x as (select *, date_diff('day', date '1970-01-01', date)::double as x from monthly where c_nationkey in (select c_nationkey from monthly group by 1 having count(*) >= 8)),
      g as (select c_nationkey, count(*) as n, avg(x) as mx, avg(price) as my, regr_sxx(price, x) as sxx, regr_sxy(price, x) as sxy, regr_syy(price, x) as syy, min(date) as min_date, max(date) as max_date, arg_min(price, date) as p0, arg_max(price, date) as p1 from x group by 1),
      h as (select *, case when sxx > 0 then sxy / sxx else 0 end as slope from g), k as (select *, greatest((syy - slope * sxy) / n, 0) as mse from h join tt on dof = greatest(n - 2, 1))
      select c_nationkey, n as points, min_date, max_date, (max_date - min_date)::int as data_span_days, round(p1, 2) as latest_price,
        round(case when max_date > min_date and p0 > 0 then (pow(p1 / p0, 365.25::double / (max_date - min_date)) - 1) * 100 else 0 end, 2) as average_percent_gain_per_year, {_predictions()} from k""",
    "trend_strength": f"""
      with {_MONTHLY}, c as (select *, price / lag(price) over (partition by c_nationkey order by date) - 1 as ch from monthly),
      g as (select c_nationkey, count(*) as n, count(ch) as m, stddev_pop(ch) as sd, case when arg_max(price, date) > arg_min(price, date) then 1 else -1 end as way from c group by 1)
      select c_nationkey, round(case when n >= 3 then h / m * 100 else 0 end, 3) as trend_strength_pct, round(case when n >= 3 then sd * 100 else 0 end, 3) as trend_variance_pct
      from g join (select c.c_nationkey, count(*) filter (sign(ch) = way)::double as h from c join g using (c_nationkey) group by 1) using (c_nationkey)""",
    "nearest_supplier": f"""
      with {_CUSTOMERS}, {_SUPPLIERS}, p as (select c_custkey, s_suppkey, sqrt(pow(c.lat - s.lat, 2) + pow(c.lon - s.lon, 2)) as g from cust c, supp s)
      select c_custkey, s_suppkey as r_s_suppkey, round(g * 111000, 2) as distance from p qualify row_number() over (partition by c_custkey order by g, s_suppkey) = 1""",
    "nearest_k": f"""
      with {_CUSTOMERS}, {_SUPPLIERS}, far as (select c_custkey, (c_custkey * 7919 % 18001) / 100.0::double - 90 as lat, (c_custkey * 104729 % 36000) / 100.0::double - 180 as lon from customer),
      p as (select points, c_custkey, s_suppkey, sqrt(pow(c.lat - s.lat, 2) + pow(least(abs(c.lon - s.lon), 360 - abs(c.lon - s.lon)), 2)) as g from (select 'near' as points, c_custkey, lat, lon from cust union all select 'far', * from far) c, supp s)
      select points, c_custkey, row_number() over (partition by points, c_custkey order by g, s_suppkey) as place, s_suppkey as r_s_suppkey, round(g * 111000, 2) as distance from p qualify row_number() over (partition by points, c_custkey order by g, s_suppkey) <= 3""",
    "polar_pairs": f"""
      with c as (select c_custkey, ((c_custkey * 7919 % 9973) / 4986.5::double + 88) * case when c_custkey % 2 = 0 then 1 else -1 end as lat, (c_custkey * 104729 % 9967) * (360.0::double / 9967) - 180 as lon from customer),
      s as (select s_suppkey, ((s_suppkey * 7919 % 9941) / 4970.5::double + 88) * case when s_suppkey % 2 = 0 then 1 else -1 end as lat, (s_suppkey * 104729 % 9931) * (360.0::double / 9931) - 180 as lon from supplier)
      select c_custkey, s_suppkey as r_s_suppkey, round(distance, 2) as distance from (select c_custkey, s_suppkey, {_DISTANCE.format("c", "s")} as distance from c, s) where distance <= 20000""",
    "radius_pairs": f"with {_PAIRS} select c_custkey, s_suppkey as r_s_suppkey, round(distance, 2) as distance from pairs",
    "degree_circle_pairs": f"with {_PAIRS} select c_custkey, count(*) as n from pairs where sqrt(pow(lat - slat, 2) + pow(lon - slon, 2)) <= 8046.7::double / 1609.34 / 69 * 1.2 group by 1",
    "smoothed_values": f"with {_SMOOTH} select * from smooth",
    "top10_nearest": f"with {_NEAR} select c_custkey, string_agg(s_suppkey::varchar, ',' order by rk) as ids from near group by 1",
    "exists_within_radius": f"with {_PAIRS} select distinct c_custkey from pairs where distance <= 1000",
    "gaussian_estimate": f"""
      with prt as (select p_partkey, {_A.format("p_partkey")} from part), {_SUPPLIERS}, p as (select p_partkey, s_acctbal, {_DISTANCE.format("p", "s")} as distance from prt p, supp s)
      select p_partkey, round(sum(exp(-0.5 * pow(distance / 1609.34 / 5, 2)) * s_acctbal) / sum(exp(-0.5 * pow(distance / 1609.34 / 5, 2))), 3) as estimate from p where distance <= 1609.34 group by 1""",
    "resolved_sources": f"""
      with {_CUSTOMERS}, {_SUPPLIERS} select c_custkey from cust c where not exists (select 1 from supp s where {_geodesic("c", "s")} <= 400 or lower('A' || (s_suppkey * 7)) = lower('a' || c_custkey))""",
    "building_ratios": """
      with g as (select l_partkey, avg(l_extendedprice) as p, avg(l_extendedprice * (1 - l_discount)) as e, avg(l_quantity - 25) as sqft, max(l_tax) as t, count(*) as units from lineitem group by 1)
      select l_partkey, units, round(case when sqft > 0 then p / sqft end, 4) as price_per_sqft, round(case when p > 0 then (p - e) / p end, 4) as concession, round(coalesce(nullif(t, 0), -1), 3) as tax from g""",
    "mortgage_columns": """
      with p as (select p_partkey, p_retailprice * 1000 as price, p_size * 200.0::double as income, pow(1 + 8.2::double / 100 / 12, 360) as f from part), q as (select *, price * (8.2::double / 100 / 12 * f / (f - 1)) as pay from p)
      select p_partkey, round(pay, 2) as payment, round(greatest(income * 0.9::double, income * 1.1::double) - pay, 2) as best_profit, round(least(income * 0.9::double, income * 1.1::double) - pay, 2) as worst_profit, round(case when income > 0 then price / income end, 2) as payback from q""",
    "lot_development": """
      with r as (select avg(p_size / p_retailprice) as interior, avg(p_retailprice / p_size) as build, pow(1 + 6.25::double / 100 / 12, 360) as f from part where p_size > 0)
      select p_partkey, round(p_retailprice * interior, 3) as potential_sqft, round((p_retailprice * 100 + p_retailprice * interior * build * 100) * (6.25::double / 100 / 12 * f / (f - 1)), 2) as full_payment from part, r""",
    "comparables": f"with {_NEAR} select c.c_custkey, count(n.c_custkey) as n, coalesce(string_agg(n.s_name, ';' order by rk), '') as names from cust c left join near n on n.c_custkey = c.c_custkey group by 1",
    "comparables_exploded": f"with {_NEAR} select c_custkey, rk - 1 as place, s_suppkey as id, s_name, round(s_acctbal, 2) as value, round({_geodesic('c', 's')} / 1609.34::double, 2) as miles from (select *, {{'lat': lat, 'lon': lon}} as c, {{'lat': slat, 'lon': slon}} as s from near)",
    "flip_rank": f"with {_FLIPS} select * from flips where c_acctbal > 200 and c_custkey not in (select o_custkey from orders where o_orderstatus = 'P')",
    "flip_rank_accepted": f"with {_FLIPS} select * from flips where ((c_acctbal between 500 and 7000 and c_mktsegment <> 'BUILDING') or c_mktsegment = 'MACHINERY') and c_custkey in (select o_custkey from orders where o_orderstatus = 'F')",
    "row_changes": f"with {_DAYS} select user_id, day, round((v + 1) / lag(v + 1) over (partition by user_id order by day) - 1, 4) as v_change from days",
    "rolling_rows": f"with {_DAYS} select user_id, day, {_rolling()} from days",
    "interpolated": f"""
      with {_DAYS}, h as (select user_id, day, case when extract(day from day) % 4 = 1 then v end as v, row_number() over (partition by user_id order by day) as i from days), k as (select *, case when v is not null then i end as pos from h),
      f as (select *, arg_max(v, pos) over b as a, max(pos) over b as ai, arg_min(v, pos) over n as z, min(pos) over n as zi from k
        window b as (partition by user_id order by day rows between unbounded preceding and current row), n as (partition by user_id order by day rows between current row and unbounded following))
      select user_id, day, floor(case when v is not null then v when i - ai <= 2 then case when zi is null then a else a + (z - a) * (i - ai) / (zi - ai) end end * 1000 + 0.500001::double) / 1000 as v from f""",
    "weeks_ahead": f"""
      with {_DAYS}, l as (select user_id, max(day) as day, arg_max(v, day) as v from days group by 1), w as (select user_id, week, (day + week::int * 7) as day, v from l, generate_series(1, 4) s(week))
      select user_id, week, day, extract(year from day) as year, extract(month from day) as month, extract(quarter from day) as quarter, round(v, 3) as v from w""",
    "today_features": f"""
      with {_MONTHLY}, l as (select c_nationkey, max(date) as date from monthly group by 1), m as (select *, extract(month from date) as month from l)
      select c_nationkey, date, extract(year from date) as year, month, extract(quarter from date) as quarter, (month in (12, 1, 2))::bigint as season_winter, (month in (3, 4, 5))::bigint as season_spring, (month in (6, 7, 8))::bigint as season_summer, (month in (9, 10, 11))::bigint as season_fall from m""",
    "claimable_urls": f"with {_URLS} select url, min(state) as state from urls group by 1 having count(scraped_at) = 0 and count(*) filter (last_pulled > timestamp '2024-01-30' - interval 48 hour) = 0",
    "marked_scraped": f"""
      with {_URLS}, {_LISTINGS}, m as (select u.*, url in (select url from listings where status = 'F') as hit from urls u)
      select case when hit then date '2001-09-01' else scraped_at end as scraped_at, count(*) as n, count(case when not hit then last_pulled end) as leased from m group by 1""",
    "reset_never_scraped": f"with {_URLS}, {_LISTINGS} select url, count(case when url in (select url from listings where status = 'F' and priority = '1-URGENT') then scraped_at end) as scraped from urls group by 1",
    "backfill_scraped": f"with {_URLS}, {_LISTINGS} select u.url, event_id, coalesce(scraped_at, d) as scraped_at from urls u left join (select url, max(created_at)::date as d from listings group by 1) n on n.url = u.url",
    "upsert_absent": "select c_custkey as id, c_name as name from customer union all select p_partkey, 'new' from part where p_partkey not in (select c_custkey from customer)",
    "page_progress": "select o_custkey, count(distinct o_orderkey) as pages_done, min(o_orderkey) as first_page, max(o_orderkey) as last_page, max(o_orderkey) + 1 as next_page from orders group by 1",
    "page_gaps": """
      with p as (select distinct o_orderpriority, o_custkey * 3 % 997 as page from orders where o_orderstatus = 'F'), s as (select o_orderpriority, unnest(generate_series(min(page), max(page))) as page from p group by 1)
      select * from s except select * from p""",
    "snapshot_diff": """
      with e as (select user_id as url, ts::date as lastmod, event_type from events), n as (select url, max(lastmod) as lastmod from e group by 1)
      select url, lastmod, case when (url, lastmod) in (select (url, lastmod) from e where event_type in ('view', 'error')) then 'unchanged' else 'new_or_changed' end as change from n""",
    "reconcile_report": f"""
      with {_URLS}, {_LISTINGS}
      select 'events' as source, measure, value::bigint as value from (
        select 'url_rows' as measure, count(*) as value from urls union all select 'listing_rows', count(*) from listings
        union all select 'duplicate_urls', count(*) from (select url from urls group by 1 having count(*) > 1) union all select 'duplicate_listings', count(*) from (select url from listings group by 1 having count(*) > 1)
        union all select 'scraped', count(scraped_at) from urls union all select 'not_scraped', count(*) - count(scraped_at) from urls
        union all select 'listings_without_url', count(distinct url) from listings where url not in (select url from urls) union all select 'urls_without_listing', count(distinct url) from urls where url not in (select url from listings))""",
    "quality_report": """
      select test, column_name, failures, case when failures = 0 then 'pass' else severity end as status from (
        select 'unique' as test, 'o_orderkey' as column_name, (select count(*) from (select 1 from orders group by o_orderkey having count(*) > 1)) as failures, 'error' as severity
        union all select 'unique', 'o_custkey', (select count(*) from (select 1 from orders group by o_custkey having count(*) > 1)), 'error'
        union all select 'not_null', 'k', (select count(*) from orders where o_custkey = 7), 'error'
        union all select 'range', 'o_totalprice', (select count(*) from orders where o_totalprice not between 1000 and 400000), 'warn')""",
    "failing_rows": """
      with o as (select o_orderkey, o_custkey, case when o_custkey <> 7 then o_custkey end as k, trunc(o_totalprice)::int as o_totalprice from orders),
      j as (select *, '{"o_orderkey":' || o_orderkey || ',"o_custkey":' || o_custkey || case when k is null then '' else ',"k":' || k end || ',"o_totalprice":' || o_totalprice || '}' as v from o)
      select 'unique' as test, 'o_orderkey' as column_name, o_orderkey::varchar as value, count(*) as n from o group by 3 having count(*) > 1 union all select 'unique', 'o_custkey', o_custkey::varchar, count(*) from o group by 3 having count(*) > 1
      union all select 'not_null', 'k', v, count(*) from j where k is null group by 3 union all select 'range', 'o_totalprice', v, count(*) from j where o_totalprice not between 1000 and 400000 group by 3""",
    "area_distinct": """
      with o as (select c_mktsegment, o_orderpriority, c_nationkey, o_orderdate as d, o_custkey as c from orders join customer on c_custkey = o_custkey),
      s as (select 'segment' as geography_type, c_mktsegment as geography_value, d, c from o union all select 'priority', o_orderpriority, d, c from o union all select 'nation', c_nationkey::varchar, d, c from o)
      select geography_type, geography_value, count(distinct d) as dates, count(distinct c) as buildings from s where geography_value is not null group by 1, 2""",
    "freshness": "select round(h, 3) as age_hours, case when h > 48 then 'error' when h > 24 then 'warn' else 'pass' end as status from (select (epoch(timestamp '2024-02-01') - floor(epoch(max(ts)))) / 3600 as h from events)",
    "page_links": """select distinct page_id, case when starts_with(l, '/') then 'https://example.org' || l else l end as link from (select page_id, unnest(regexp_extract_all(html, '<a[^>]*href="([^"]*)"', 1)) as l from pages) where contains(l, '/')""",
    "page_title_host": r"select page_id, regexp_extract(html, '(?s)<title>(.*?)</title>', 1) as title, regexp_extract(url, '^https?://([^/?#]+)', 1) as host from pages",
    "page_flags": "select page_id, array_to_string(list_filter(['<nav>', '<table', '<h2', '<footer', '<aside'], lambda w: contains(html, w)), ',') as flags from pages",
    "robot_pages": """select page_id from pages where contains(lower(html), 'lang="fr"') or contains(lower(html), 'captcha') or contains(lower(html), 'are you a robot')""",
    "sitemap_locations": "select page_id, url as loc from pages union all select page_id, 'https://example.org/' || page_id from pages",
    "url_parts": r"""
      with u as (select n_nationkey, regexp_replace(lower(n_name), '[^a-z]', '-', 'g') as county, (['utah', 'new-mexico', 'west-virginia', null])[(n_nationkey % 4 + 1)::int] as state, (['farms-and-ranches', 'homes', 'undeveloped-land'])[(n_nationkey % 3 + 1)::int] as kind from nation)
      select c_custkey, case when state is not null then county end as county, state, case when state is not null then kind end as kind from u join customer on c_nationkey = n_nationkey""",
    "lot_sizes": "select p_partkey, round(p_retailprice, 1) as value, case when p_partkey % 2 = 0 then 'acres' else 'sqft' end as unit from part",
    "list_items": "select p_partkey, p_brand || '|' || p_type || '|x' || p_size as items from part",
    "synced_rows": "select event_id, replace(props, ' ', '') as props, event_type from events",
    "seeded_sample": "select c_custkey, c_name from customer order by md5('7:' || c_custkey), c_custkey limit 20",
    "copied_slices": """
      with s(slice) as (values ('AUTOMOBILE'), ('MACHINERY'), ('BUILDING'), ('none')), c as (select s.slice, count(c_custkey) as n, sum(c_acctbal::decimal(18,2))::double / nullif(count(c_custkey), 0) as a from s left join customer on c_mktsegment = slice group by 1)
      select slice, case when slice <> 'MACHINERY' then n end as expected, case when slice = 'MACHINERY' then 0 else n end as rows, case when slice = 'MACHINERY' then 'failed' else 'copied' end as status,
        case when slice = 'MACHINERY' then 0 else n end as held, case when slice <> 'MACHINERY' then floor(a * 100 + 0.500001::double) / 100 end as average from c""",
    "exported_table": "select c_custkey, case when c_mktsegment = 'MACHINERY' and c_custkey % 2 = 0 then 'unknown' else c_acctbal::decimal(18,2)::varchar end as c_amount, c_mktsegment from customer",
    "synced_table": "select event_id, replace(props, ' ', '') as props, event_type from events",
    "claimed_batch": f"with {_URLS}, {_CLAIMED} select url, state, worker from claimed",
    "stamped_queue": f"with {_URLS}, {_CLAIMED} select event_id, u.url, case when worker is not null then timestamp '2024-01-30' else last_pulled end as last_pulled, worker as processing_id from urls u left join claimed c on c.url = u.url",
    "registered_urls": f"""
      with {_URLS}, {_LISTINGS}, n as (select distinct url || case when id % 3 = 0 then 'x' else '' end as url, status as state from listings),
      f as (select url, min(state) as state from n group by 1)
      select true as skip, url, 'old' as origin, count(*) as rows, min(state) as state from urls group by url union all select true, url, 'new', 1, state from f where url not in (select url from urls)
      union all select false, url, 'old', count(*), min(state) from urls group by url union all select false, url, 'new', count(*), min(state) from n group by url""",
    "plain_values": """
      select event_id, case when event_id % 5 > 0 then '{"texts":["' || event_type || 'é",null],"days":{"' || event_type || 'é":"' || strftime(ts, '%Y-%m-%d') || '"},"times":[{"at":"' || strftime(ts, '%Y-%m-%dT%H:%M:%S') || '","event_id":' || event_id || '}]}' end as v from events""",
    "slice_counts": "select c_mktsegment, count(*) as rows from customer where c_mktsegment is not null group by 1",
    "first_by_id": "select o_orderkey, o_custkey from orders order by o_orderkey limit 10",
    "newest_events": "select event_id, ts from events order by ts desc, event_id desc limit 5",
    "distinct_listing": "select distinct o_orderpriority, o_orderstatus from orders order by 1, 2 limit 12",
    "newest_per_url": f"with {_LISTINGS} select url, id from listings qualify row_number() over (partition by url order by created_at desc, id) = 1",
    "listed_in_queue": f"with {_URLS}, {_LISTINGS} select url, id from listings where url in (select url from urls where scraped_at is null) qualify row_number() over (partition by url order by created_at desc, id) = 1",
    "latest_for_display": f"with {_DAYS} select user_id, day, v from days qualify row_number() over (partition by user_id order by day desc) = 1",
    "declared_columns": "select c_custkey::varchar as c_custkey, trunc(c_acctbal)::bigint as c_acctbal, null::varchar as c_phone from customer",
    "replaced_table": "select c_custkey, c_acctbal, c_mktsegment, true as stamped from customer where c_acctbal > 0",
    "appended_rows": """select s_suppkey, '{"s_name":"' || s_name || '","s_nationkey":' || s_nationkey || '}' as about, 2::bigint as times from supplier""",
    "seed_file": """select n_name || ', "x"' as name, n_nationkey as key from nation""",
    "copied_children": "select o_orderkey, o_custkey, case when o_totalprice > 1000 then o_orderstatus end as o_orderstatus from orders where o_custkey in (select c_custkey from customer where c_acctbal > 0)",
    "home_records": f"select page_id, {_home_columns()} from pages",
    "land_records": f"""select page_id, 'https://e.org/sanpete-county-utah-' || case when page_id % 2 = 0 then 'farms-and-ranches' else 'homes' end || '-for-sale/pid/' || page_id as url, case when page_id % 2 = 0 then 'farms-and-ranches' else 'homes' end as property_type, 'sanpete' as county,
      'n' || page_id as name, '2020' as date_posted, case when page_id % 4 > 0 then page_id % 90 * 1000 + 0.5::double end as lot_size, case when page_id % 4 > 0 then 'acres' end as lot_size_units, case when page_id % 4 > 0 then 'Farm,Lot' else '' end as lot_type, 'well ' || page_id || ',barn' as amenities,
      'UT' as state, (84000 + page_id % 100)::varchar as zip, 'provo' as city, page_id || ' "main" rd' as address1, 'unit ' || page_id % 8 as address2, 40::double as latitude, -112::double as longitude, case when page_id % 3 > 0 then 40.5::double end as city_latitude, case when page_id % 3 > 0 then -112 + page_id % 50 / 100.0::double end as city_longitude,
      (page_id % 10)::double as acres, (page_id % 5)::int as beds, (page_id % 3)::int as baths, (page_id % 4 * 500)::double as homesqft, '["a","b"]' as property_types, true as is_irrigated, false as is_residence, (page_id * 100)::double as price, '2020-01-0' || page_id % 9 + 1 as listing_date,
      'T' || page_id as title, 'D' || page_id as description, 'E' || page_id as executive_summary, page_id % 3 = 0 as is_diamond, page_id % 2 = 0 as is_gold, page_id % 5 = 0 as is_platinum, page_id % 7 = 0 as is_showcase,
      floor(case when page_id % 10 > 0 then page_id * 100 / (page_id % 10) end * 100 + 0.500001::double) / 100 as cost_per_acre, floor(case when page_id % 4 > 0 then page_id * 100 / (page_id % 4 * 500) end * 1000 + 0.500001::double) / 1000 as cost_per_homesqft,
      floor(case when page_id % 3 > 0 then {_DISTANCE.format('a', 'b')} / 1609.34::double end * 1000 + 0.500001::double) / 1000 as distance_to_city_miles, {_page_words()}
      from (select *, {{'lat': 40::double, 'lon': -112::double}} as a, {{'lat': 40.5::double, 'lon': -112 + page_id % 50 / 100.0::double}} as b,
        case when page_id % 2 = 0 then 'Owner Finance Camping' else 'Acreage' end || case page_id % 3 when 0 then ' Gravel/Rock' when 1 then ' Dirt Gravel' else ' Paved' end || html as said from pages)""",
    "sitemap_jobs": """select 'https://e.org/homedetails/' || page_id || case page_id % 3 when 0 then '-Main-St-Ogden-UT-84403/' else '-Oak-Reno-nv-1/' end as url, case page_id % 3 when 0 then 'UT' else 'NV' end as state, 'for-sale-by-' || case when page_id % 2 = 0 then 'agent' else 'owner' end as type
      from pages where page_id % 3 < 2""",
    "linked_data": "select page_id, ['l', 'o', 's'][page_id % 3 + 1] || page_id as name from pages",
    "url_states": f"""with u as (select page_id, list_filter(string_split_regex(upper('https://e.org/' || page_id || case page_id % 3 when 0 then '-Main-St-Ogden-UT-84403/' when 1 then '-ne-main-st-ogden-ut/x' else '-nowhere/' end || url), '[/-]'),
      lambda x: x in {_CODES}) as t from pages) select page_id, t[1] as "first", t[-1] as "last" from u""",
}
