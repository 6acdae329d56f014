"""Jobs on url queues: claim, mark, reset, register, progress, differences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from acreage.operators.dedup import latest_by
from acreage.sources.scratch import settled
from acreage.sources.swap import locked
from acreage.sources.tables import read_table, replace_table


def claimable(urls: DataFrame, as_of: Column, states: list[str] | None = None, lease_hours: int = 5) -> DataFrame:
    """(url, state): urls none of whose rows is scraped or leased within the lease."""
    rows = urls.where(F.col("state").isin(states)) if states else urls
    busy = F.col("last_pulled") > as_of - F.make_dt_interval(F.lit(0), F.lit(lease_hours))
    groups = rows.groupBy("url").agg(F.count_if(F.col("scraped_at").isNotNull()).alias("_done"), F.count_if(busy).alias("_busy"), F.min("state").alias("state"))
    return groups.where("_done = 0 and _busy = 0").select("url", "state")


def claim_batch(urls: DataFrame, as_of: Column, n: int, worker: str, states: list[str] | None = None, lease_hours: int = 5, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """A random batch of claimable urls, and the queue with their lease stamped."""
    batch = sample_rows(claimable(urls, as_of, states, lease_hours), n, "url", seed)
    return batch, stamped(urls, batch, as_of, worker)


def stamped(urls: DataFrame, batch: DataFrame, as_of: Column, worker: str) -> DataFrame:
    """The queue with the lease of the batch's urls."""
    mine = F.col("_claimed").isNotNull()
    marked = urls.join(batch.select("url", F.lit(True).alias("_claimed")), "url", "left")
    marked = marked.withColumns({"last_pulled": F.when(mine, as_of).otherwise(F.col("last_pulled")), "processing_id": F.when(mine, F.lit(worker)).otherwise(F.col("processing_id"))})
    return marked.select(*urls.columns)


def claim(spark: SparkSession, path: str, as_of: Column, n: int, worker: str, states: list[str] | None = None, lease_hours: int = 5, seed: int = 0, wait_seconds: float = 300) -> DataFrame:
    """Claim a batch from the queue's table: the batch (url, state), whose leases are in the table when this returns.

    Reading, choosing and stamping are one step under the table's lock, so that two workers never get one url; if it fails, the table is as it was.
    """
    with locked(spark, path, wait_seconds):
        urls = read_table(spark, path)
        batch = settled(sample_rows(claimable(urls, as_of, states, lease_hours), n, "url", seed), "claimed")
        replace_table(stamped(urls, batch, as_of, worker), path, stamp=None)
    return batch


def sample_rows(df: DataFrame, n: int, key: str, seed: int = 0) -> DataFrame:
    """n rows in an order that looks random and can be repeated."""
    return df.orderBy(F.md5(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string"))), key).limit(n)


def mark_scraped(urls: DataFrame, done: DataFrame, date: Column) -> DataFrame:
    """Set the date on rows of the urls done, and end their lease."""
    hit = F.col("_hit").isNotNull()
    joined = urls.join(done.select("url").distinct().withColumn("_hit", F.lit(True)), "url", "left")
    return joined.withColumns({"scraped_at": F.when(hit, date).otherwise(F.col("scraped_at")), "last_pulled": F.when(~hit, F.col("last_pulled")), "processing_id": F.when(~hit, F.col("processing_id"))}).select(*urls.columns)


def reset_never_scraped(urls: DataFrame, listings: DataFrame) -> DataFrame:
    """Clear the date of urls without a listing."""
    known = listings.select("url").where("url is not null").distinct().withColumn("_hit", F.lit(True))
    return urls.join(known, "url", "left").withColumn("scraped_at", F.when(F.col("_hit"), F.col("scraped_at"))).select(*urls.columns)


def backfill_scraped(urls: DataFrame, listings: DataFrame) -> DataFrame:
    """Where no date is set, take that of the url's newest listing."""
    newest = listings.groupBy("url").agg(F.max("created_at").cast("date").alias("_date"))
    return urls.join(newest, "url", "left").withColumn("scraped_at", F.coalesce("scraped_at", "_date")).select(*urls.columns)


def insert_absent(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """The old rows, and new ones whose key isn't there; one row per new key, the first by all other columns."""
    first = latest_by(new, [key], [F.asc(c) for c in new.columns if c != key] or [F.asc(key)])
    return old.unionByName(first.join(old.select(key), key, "left_anti").select(*old.columns))


def register_urls(urls: DataFrame, new: DataFrame, skip_existing: bool = True) -> DataFrame:
    """The queue with the new urls; known ones are left out, or listed once more."""
    return insert_absent(urls, new, "url") if skip_existing else urls.unionByName(new)


def page_progress(pages: DataFrame, key: str, number: str) -> DataFrame:
    """Pages done per key: count, least, greatest and the next one."""
    return pages.groupBy(key).agg(F.countDistinct(number).alias("pages_done"), F.min(number).alias("first_page"), F.max(number).alias("last_page"), (F.max(number) + 1).alias("next_page"))


def page_gaps(pages: DataFrame, key: str, number: str) -> DataFrame:
    """Numbers missing between the least and the greatest of each key."""
    spans = pages.groupBy(key).agg(F.min(number).alias("a"), F.max(number).alias("b"))
    return spans.select(key, F.explode(F.sequence("a", "b")).alias(number)).join(pages.select(key, number).distinct(), [key, number], "left_anti")


def snapshot_diff(now: DataFrame, before: DataFrame, key: str = "url", stamp: str = "lastmod") -> DataFrame:
    """Distinct keys of ``now`` with ``change``: ``new_or_changed`` or ``unchanged`` against the last snapshot."""
    rows = now.groupBy(key).agg(F.max(stamp).alias(stamp))
    known = before.select(key, stamp).distinct().withColumn("_same", F.lit(True))
    return rows.join(known, [key, stamp], "left").select(key, stamp, F.when(F.col("_same"), "unchanged").otherwise("new_or_changed").alias("change"))
