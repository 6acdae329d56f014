"""Grids, intervals, roll-ups, outliers, rolling windows and trends."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from acreage.functions.maths import t_column
from acreage.operators.quantiles import quantiles_of_table
from acreage.sources.scratch import settled


def date_grid(df: DataFrame, first: str, last: str, days: int = 7) -> DataFrame:
    """``date``: every ``days`` days from the least ``first`` to the greatest ``last``."""
    ends = df.agg(F.min(first).alias("a"), F.max(last).alias("b"))
    return ends.select(F.explode(F.sequence("a", "b", F.make_dt_interval(F.lit(days)))).alias("date"))


def expand_intervals(df: DataFrame, first: str, last: str, start: Column, days: int = 7) -> DataFrame:
    """A row per grid date within each row's interval, ends included; the grid begins at ``start``. A null end matches none."""
    steps = F.ceil(F.greatest(F.datediff(F.col(first), start), F.lit(0)) / days).cast("int")
    head = F.date_add(start, steps * days)
    dates = F.when(head <= F.col(last), F.sequence(head, F.col(last), F.make_dt_interval(F.lit(days))))
    return df.withColumn("date", F.explode(dates))


def interval_means(df: DataFrame, keys: list[str], first: str, last: str, start: Column, amount: str, count: str, days: int = 7) -> DataFrame:
    """The mean of ``amount`` and the rows in ``count`` for each group and grid date that an interval holds, as ``expand_intervals`` and a roll-up would give.

    Each interval adds its amount at its first date and takes it back after its last, so that
    rows are two per interval, then one per group and date: no interval is spread over its dates.
    Amounts are summed as decimals, exactly.
    """
    begin = F.ceil(F.greatest(F.datediff(F.col(first), start), F.lit(0)) / days).cast("int")
    end = F.floor(F.datediff(F.col(last), start) / days).cast("int")
    value = F.col(amount).cast("decimal(18,2)")
    known = F.col(amount).isNotNull().cast("int")
    change = lambda at, sign: F.struct(at.alias("at"), (sign * F.coalesce(value, F.lit(0))).cast("decimal(18,2)").alias("value"), (sign * known).alias("known"), F.lit(sign).alias("rows"))
    changes = df.withColumns({"_start": start, "_begin": begin, "_end": end}).where("_begin <= _end")
    changes = changes.select(*keys, "_start", F.explode(F.array(change(F.col("_begin"), 1), change(F.col("_end") + 1, -1))).alias("_c"))
    sums = changes.groupBy(*keys, "_start", "_c.at").agg(*(F.sum(f"_c.{c}").alias(c) for c in ("value", "known", "rows")))
    order = Window.partitionBy(*keys).orderBy("at")  # a row per date of the grid at most
    upto = {c: F.sum(c).over(order) for c in ("value", "known", "rows")}
    held = sums.withColumns(upto | {"_next": F.lead("at").over(order)}).where("rows > 0")
    dates = held.withColumn("_at", F.explode(F.sequence("at", F.col("_next") - 1)))
    mean = F.when(F.col("known") > 0, F.col("value").cast("double") / F.col("known"))
    return dates.select(*keys, F.date_add("_start", F.col("_at") * days).alias("date"), mean.alias(amount), F.col("rows").alias(count))


def by_level(df: DataFrame, levels: dict[str, str]) -> DataFrame:
    """The rows once per level, with geography_type and geography_value; null values are left out."""
    pairs = F.array(*(F.struct(F.lit(name).alias("geography_type"), F.col(c).cast("string").alias("geography_value")) for name, c in levels.items()))
    return df.select("*", F.inline(pairs)).where("geography_value is not null")


def geo_rollup(df: DataFrame, levels: dict[str, str], by: list[str], aggregates: list[Column]) -> DataFrame:
    """One aggregate per level and value, stacked as (geography_type, geography_value); null values are left out."""
    return by_level(df, levels).groupBy("geography_type", "geography_value", *by).agg(*aggregates)


def _counted(sets: dict[str, DataFrame], keys: list[str]) -> DataFrame:
    """A column for each of the sets, which are rows of keys and a _value: how many distinct values, not null, each key has."""
    stacked = None
    for name, rows in sets.items():  # each in its own type, as two sums over a shuffle: no task holds a key's values
        counts = rows.select(*keys, "_value").distinct().groupBy(*keys).agg(F.count("_value").alias("_n")).withColumn("_count", F.lit(name))
        stacked = counts if stacked is None else stacked.unionByName(counts)
    return stacked.groupBy(*keys).agg(*(F.coalesce(F.sum(F.when(F.col("_count") == n, F.col("_n"))), F.lit(0)).alias(n) for n in sets))


def distinct_by_place(df: DataFrame, levels: dict[str, str], counts: dict[str, str], largest: tuple[str, ...] = ()) -> DataFrame:
    """Distinct values counted per combination of all levels, then summed per level and value, so that one found in two places counts twice.

    ``largest``: levels that take the greatest place's counts instead of the sum.
    """
    places = _counted({n: df.select(*levels.values(), F.col(c).alias("_value")) for n, c in counts.items()}, list(levels.values()))
    one = F.col("geography_type").isin(*largest)
    return by_level(places, levels).groupBy("geography_type", "geography_value").agg(*(F.when(one, F.max(n)).otherwise(F.sum(n)).alias(n) for n in counts))


def distinct_by_level(df: DataFrame, levels: dict[str, str], counts: dict[str, str]) -> DataFrame:
    """Distinct values per level and value, found in the distinct values of each combination of all levels. A place without any value is left out."""
    held = {n: df.select(*levels.values(), F.col(c).alias("_value")).where("_value is not null").distinct() for n, c in counts.items()}
    return _counted({n: by_level(rows, levels) for n, rows in held.items()}, ["geography_type", "geography_value"])


def iqr_filter(df: DataFrame, keys: list[str], columns: list[str], k: float = 1.5, nulls_pass: tuple[str, ...] = ()) -> DataFrame:
    """Rows within Tukey's fences of their group in all columns, fences from the same input, which is written first so that it is."""
    held = settled(df.dropna(subset=keys), "iqr-input")
    joined = held.join(quantiles_of_table(held, keys, columns), keys, "left")
    ok = F.lit(True)
    for c in columns:
        low, high = F.col(f"_q_{c}")[0], F.col(f"_q_{c}")[1]
        inside = (F.col(c) >= low - k * (high - low)) & (F.col(c) <= high + k * (high - low))
        ok = ok & ((inside | F.col(c).isNull()) if c in nulls_pass else inside)
    return joined.where(ok).drop(*(f"_q_{c}" for c in columns))


def iqr_filter_in_turn(df: DataFrame, keys: list[str], columns: list[str], k: float = 1.5) -> DataFrame:
    """Column after column, each on what the one before left."""
    for c in columns:
        df = iqr_filter(df, keys, [c], k)
    return df


def at_least(df: DataFrame, keys: list[str], rows: int) -> DataFrame:
    """Rows of groups with so many rows."""
    big = df.groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") >= rows).select(*keys)
    return df.join(big, keys, "left_semi")


def rolling_months(df: DataFrame, view: str, keys: list[str], date: str, columns: list[str], months: int = 3, least_rows: int = 2) -> DataFrame:
    """Calendar windows of ``months`` months: means, ``window_rows`` and ``window_days``, where rows and span suffice."""
    over = f"(partition by {', '.join(keys)} order by {date} range between interval '{months - 1}' month preceding and current row)"
    means = ", ".join(f"avg({c}) over {over} as {c}" for c in columns)
    kept = ", ".join(keys)
    framed = df.sparkSession.sql(
        f"select {kept}, {date}, {means}, count(*) over {over} as window_rows, datediff({date}, min({date}) over {over}) as window_days from {{df}}", df=df.select(*keys, date, *columns)
    )
    return framed.where((F.col("window_rows") >= least_rows) & (F.col("window_days") >= (months - 1) * 0.5 * 30))


def trend(df: DataFrame, keys: list[str], date: str, value: str, as_of: str, horizon: int = 365, confidence: float = 0.95) -> DataFrame:
    """Least-squares trend, growth per year and forecasts with bounds, one row per group; no row if a group has no value.

    The interval uses mse = SSE / n, leverage 1 + (x0 - mean)^2 / Sxx (1.1 if all
    dates are equal) and max(n - 2, 1) degrees of freedom; two rows have bounds
    0, one row gives zeros.
    """
    x, y = F.datediff(F.col(date), F.lit("1970-01-01").cast("date")).cast("double"), F.col(value).cast("double")
    g = df.where(F.col(value).isNotNull() & F.col(date).isNotNull()).groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg(x).alias("mx"), F.avg(y).alias("my"), F.regr_sxx(y, x).alias("sxx"), F.regr_sxy(y, x).alias("sxy"), F.regr_syy(y, x).alias("syy"),
        F.min(date).alias("min_date"), F.max(date).alias("max_date"), F.min_by(y, date).alias("first_price"), F.max_by(y, date).alias("latest_price"),
    )
    slope = F.when(F.col("sxx") > 0, F.col("sxy") / F.col("sxx")).otherwise(0.0)
    g = g.withColumn("slope", slope).withColumn("mse", F.greatest((F.col("syy") - F.col("slope") * F.col("sxy")) / F.col("n"), F.lit(0.0)))
    g = g.withColumn("t", t_column(0.5 + confidence / 2, F.greatest(F.col("n") - 2, F.lit(1))))
    days = F.datediff("max_date", "min_date")
    growth = F.when((days > 0) & (F.col("first_price") > 0), (F.pow(F.col("latest_price") / F.col("first_price"), 365.25 / days) - 1) * 100).otherwise(0.0)
    out = [*keys, F.col("n").cast("long").alias("points"), "min_date", "max_date", days.cast("int").alias("data_span_days"), "latest_price", growth.alias("average_percent_gain_per_year")]
    for name, ahead in (("current", 0), ("future", horizon)):
        x0 = F.datediff(F.date_add(F.lit(as_of).cast("date"), ahead), F.lit("1970-01-01").cast("date")).cast("double")
        point = F.when(F.col("n") >= 2, F.col("my") + F.col("slope") * (x0 - F.col("mx"))).otherwise(0.0)
        leverage = F.when(F.col("sxx") > 0, 1 + F.pow(x0 - F.col("mx"), F.lit(2.0)) / F.col("sxx")).otherwise(1.1)
        half = F.col("t") * F.sqrt(F.col("mse") * leverage)
        out.append(point.alias(f"predicted_{name}_price"))
        out += [F.when(F.col("n") > 2, point + sign * half).otherwise(0.0).alias(f"predicted_{name}_price_{side}") for side, sign in (("lower", -1), ("upper", 1))]
    return g.select(*out)


def trend_strength(df: DataFrame, keys: list[str], date: str, value: str) -> DataFrame:
    """Share of changes with the sign of the overall growth, and the deviation of changes, in percent; 0 below three rows."""
    w = Window.partitionBy(*keys).orderBy(date)
    change = F.col(value) / F.lag(value).over(w) - 1
    g = df.withColumn("_change", change).groupBy(*keys).agg(
        F.count("*").alias("n"), F.min_by(value, date).alias("a"), F.max_by(value, date).alias("b"), F.collect_list(F.signum("_change")).alias("s"), F.stddev_pop("_change").alias("sd"), F.count("_change").alias("m"),
    ).drop("s")
    way = g.select(*keys, "n", "m", "sd", F.when(F.col("b") > F.col("a"), 1.0).otherwise(-1.0).alias("_way"))
    hits = df.withColumn("_change", change).join(way.select(*keys, "_way"), keys).groupBy(*keys).agg(F.count_if(F.signum("_change") == F.col("_way")).alias("hits"))
    enough = F.col("n") >= 3
    return way.join(hits, keys).select(
        *keys, F.when(enough, F.col("hits") / F.col("m") * 100).otherwise(0.0).alias("trend_strength_pct"), F.when(enough, F.col("sd") * 100).otherwise(0.0).alias("trend_variance_pct")
    )


def rolling_rows(df: DataFrame, keys: list[str], order: str, column: str, sizes: tuple[int, ...] = (4, 8, 12)) -> DataFrame:
    """Means and sample deviations over the last rows (a single row: 0), and differences over 1 and 4 rows."""
    w = Window.partitionBy(*keys).orderBy(order)
    out = {f"{column}_diff_{n}": F.col(column) - F.lag(column, n).over(w) for n in (1, 4)}
    for n in sizes:
        last = w.rowsBetween(-(n - 1), 0)
        out |= {f"{column}_mean_{n}": F.avg(column).over(last), f"{column}_std_{n}": F.coalesce(F.stddev_samp(column).over(last), F.lit(0.0))}
    return df.withColumns(out)


def percent_change(df: DataFrame, keys: list[str], order: str, column: str) -> DataFrame:
    return df.withColumn(f"{column}_change", F.col(column) / F.lag(column).over(Window.partitionBy(*keys).orderBy(order)) - 1)


def interpolated(df: DataFrame, keys: list[str], order: str, column: str, limit: int = 2) -> DataFrame:
    """Linear by row position, at most ``limit`` rows in a gap and forward only; leading gaps stay, trailing ones take the last value."""
    w = Window.partitionBy(*keys).orderBy(order)
    row = F.row_number().over(w)
    d = df.withColumn("_i", row).withColumn("_at", F.when(F.col(column).isNotNull(), F.col("_i")))
    back, ahead = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    d = d.withColumns({"_a": F.last(column, True).over(back), "_ai": F.last("_at", True).over(back), "_b": F.first(column, True).over(ahead), "_bi": F.first("_at", True).over(ahead)})
    line = F.when(F.col("_bi").isNull(), F.col("_a")).otherwise(F.col("_a") + (F.col("_b") - F.col("_a")) * (F.col("_i") - F.col("_ai")) / F.nullif(F.col("_bi") - F.col("_ai"), F.lit(0)))
    filled = F.when(F.col(column).isNotNull(), F.col(column)).when(F.col("_i") - F.col("_ai") <= limit, line)
    return d.withColumn(column, filled).drop("_i", "_at", "_a", "_ai", "_b", "_bi")


def weeks_ahead(df: DataFrame, keys: list[str], date: str, days: int = 28) -> DataFrame:
    """Each entity's last row for each coming week, with the shifted date's parts."""
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), date).alias("r")).select("r.*")
    out = last.withColumn("week", F.explode(F.sequence(F.lit(1), F.lit(-(-days // 7))))).withColumn(date, F.date_add(F.col(date), F.col("week") * 7))
    return out.withColumns({"year": F.year(date), "month": F.month(date), "quarter": F.quarter(date)})


def today_features(df: DataFrame, keys: list[str], date: str) -> DataFrame:
    """Each entity's last row with date parts and one column per season."""
    last = df.groupBy(*keys).agg(F.max_by(F.struct(*df.columns), date).alias("r")).select("r.*")
    seasons = {"winter": (12, 1, 2), "spring": (3, 4, 5), "summer": (6, 7, 8), "fall": (9, 10, 11)}
    return last.withColumns({"year": F.year(date), "month": F.month(date), "quarter": F.quarter(date)} | {f"season_{s}": F.month(date).isin(*m).cast("int") for s, m in seasons.items()})
