"""Column checks, freshness and reconciliation reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from acreage.sources.tables import replace_table


Rule = tuple[str, str, tuple, str]  # kind (unique, not_null, range), column, arguments, severity


def _failing(kind: str, column: Column, given: tuple) -> Column:
    return column.isNull() if kind == "not_null" else ~column.between(*given)


def _examined(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(rule, value, n): each value of a column that must be unique, and each row that fails another rule, as JSON; how often it occurs. All rules in one pass over the rows."""
    row, found = F.to_json(F.struct("*")), []
    for k, (kind, name, given, _) in enumerate(rules):
        c = F.col(name)
        fails, value = (c.isNotNull(), c.cast("string")) if kind == "unique" else (_failing(kind, c, given), row)
        found.append(F.when(fails, F.struct(F.lit(k).alias("rule"), value.alias("value"))))
    return df.select(F.inline(F.array_compact(F.array(*found)))).groupBy("rule", "value").agg(F.count("*").alias("n"))


def _named(rules: list[Rule]) -> Column:
    """What is known of each rule, by its number."""
    return F.array(*(F.struct(F.lit(kind).alias("test"), F.lit(name).alias("column_name"), F.lit(severity).alias("severity")) for kind, name, _, severity in rules))


def _unique(rules: list[Rule]) -> Column:
    return F.col("rule").isin(*(k for k, rule in enumerate(rules) if rule[0] == "unique"))


def failing_rows(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """(test, column_name, value, n): rows that fail a rule, as JSON, and values that aren't unique; ``n`` times each."""
    kept = _examined(df, rules).where(~_unique(rules) | (F.col("n") > 1))
    return kept.select(F.get(_named(rules), "rule").alias("_rule"), "value", "n").select("_rule.test", "_rule.column_name", "value", "n")


def store_failures(df: DataFrame, rules: list[Rule], path: str) -> None:
    """Keep the failing rows as a table by rule, in place of the last run's."""
    replace_table(failing_rows(df, rules), path, ["test", "column_name"])


def quality_report(df: DataFrame, rules: list[Rule]) -> DataFrame:
    """One row per rule: ``failures`` (rows, or values that aren't unique) and ``status`` (pass, warn or error). One scan for all rules."""
    failures = F.sum(F.when(_unique(rules), (F.col("n") > 1).cast("long")).otherwise(F.col("n")))
    found = _examined(df, rules).groupBy("rule").agg(failures.alias("failures"))
    every = df.sparkSession.range(len(rules)).select(F.col("id").cast("int").alias("rule")).join(found, "rule", "left")
    rows = every.select(F.get(_named(rules), "rule").alias("_rule"), F.coalesce("failures", F.lit(0)).alias("failures"))
    return rows.select("_rule.test", "_rule.column_name", "failures", F.when(F.col("failures") == 0, "pass").otherwise(F.col("_rule.severity")).alias("status"))


def freshness(df: DataFrame, stamp: str, as_of: Column, warn_hours: int = 24, error_hours: int = 48) -> DataFrame:
    hours = (F.unix_seconds(as_of.cast("timestamp")) - F.unix_seconds(F.max(F.col(stamp).cast("timestamp")))) / 3600
    age = df.agg(hours.alias("age_hours"))
    return age.select("age_hours", F.when(F.col("age_hours") > error_hours, "error").when(F.col("age_hours") > warn_hours, "warn").otherwise("pass").alias("status"))


def table_report(name: str, urls: DataFrame, listings: DataFrame) -> DataFrame:
    """Totals, duplicates, scraped counts and orphans of a queue and its listings, as (source, measure, value). One scan of each; a null url matches none."""
    both = urls.select("url", F.lit(1).alias("u"), F.lit(0).alias("l"), F.col("scraped_at").isNotNull().cast("int").alias("s")).unionByName(listings.select("url", F.lit(0).alias("u"), F.lit(1).alias("l"), F.lit(0).alias("s")))
    per_url = both.groupBy("url").agg(*(F.sum(c).alias(c) for c in "uls"))
    alone = lambda other: F.col("url").isNull() | (F.col(other) == 0)
    measures = {
        "url_rows": F.sum("u"), "listing_rows": F.sum("l"), "duplicate_urls": F.count_if(F.col("u") > 1), "duplicate_listings": F.count_if(F.col("l") > 1), "scraped": F.sum("s"), "not_scraped": F.sum(F.col("u") - F.col("s")),
        "listings_without_url": F.count_if((F.col("l") > 0) & alone("u")), "urls_without_listing": F.count_if((F.col("u") > 0) & alone("l")),
    }
    one = per_url.agg(*(F.coalesce(value, F.lit(0)).cast("long").alias(measure) for measure, value in measures.items()))
    return one.select(F.inline(F.array(*(F.struct(F.lit(name).alias("source"), F.lit(m).alias("measure"), F.col(m).alias("value")) for m in measures))))
