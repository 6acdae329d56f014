"""Tables that survive failing writes, batches that are sent twice, copies from a database, claims of several workers."""

import os
import uuid
from concurrent.futures import ThreadPoolExecutor

import pytest
from pyspark.sql import functions as F

from acreage.operators import work_queue
from acreage.sources import jdbc, swap, tables


def failing(spark):
    return spark.range(3).select(F.when(F.col("id") == 2, F.raise_error(F.lit("bad row"))).otherwise(F.col("id")).alias("id"))


def test_a_failing_write_keeps_the_table(spark, tmp_path):
    path = f"file://{tmp_path}/t"
    with pytest.raises(Exception, match="bad row"):
        tables.replace_table(failing(spark), path)
    assert not (tmp_path / "t").exists()
    tables.replace_table(spark.range(5), path)
    with pytest.raises(Exception, match="bad row"):
        tables.replace_table(failing(spark), path)
    assert tables.read_table(spark, path).count() == 5 and sorted(os.listdir(tmp_path)) == ["t"]
    tables.replace_table(tables.read_table(spark, path).drop("created_at").where("id > 2"), path)  # from its own rows
    assert {r.id for r in tables.read_table(spark, path).collect()} == {3, 4}
    os.rename(tmp_path / "t", tmp_path / "_t-old")  # a swap that ended between its renames
    assert tables.read_table(spark, path).count() == 2 and (tmp_path / "t").exists()


def test_a_batch_counts_once(spark, tmp_path):
    path, rows = f"file://{tmp_path}/a", spark.createDataFrame([(1, ["x"]), (2, None)], "id int, v array<string>")
    assert [tables.append_rows(rows, path, b) for b in ("k/1", "k/1", None, None)] == [True, False, True, False]
    with pytest.raises(Exception, match="bad row"):
        tables.append_rows(failing(spark), path, "worse")
    assert tables.append_rows(rows.limit(0), path)
    back = spark.read.schema("id int, v string, batch string").json(path)
    assert sorted((r.id, r.v) for r in back.where("batch = 'k/1'").collect()) == [(1, '["x"]'), (2, None)] and back.count() == 4


def test_copied_pages(spark, tmp_path):
    """Ordered pages cover a slice once; null is a slice; a slice that fails later keeps its last copy."""
    url, path = f"jdbc:derby:memory:{uuid.uuid4().hex};create=true", f"file://{tmp_path}/c"
    rows = [(k, "9.50", "o'x" if k % 3 else "none") for k in range(20)]
    jdbc.to_database(spark.createDataFrame(rows, "id int, v string, s string"), url, "source", {"v": 16, "s": 8})
    typed = '(select "id", cast("v" as decimal(9,2)) as "v", nullif("s", \'none\') as "s" from source)'
    report = {r.slice: (r.expected, r["rows"], r.status) for r in jdbc.copy_database(spark, url, typed, path, "s", ["o'x", None, "no"], "id", 4).collect()}
    assert report == {"o'x": (13, 13, "copied"), None: (7, 7, "copied"), "no": (0, 0, "copied")}
    held = {r.id: r.s for r in spark.read.schema("id int, v decimal(9,2), s string").parquet(path).collect()}
    assert held == {k: "o'x" if k % 3 else None for k in range(20)}
    assert len(jdbc.pages("source", "1 = 1", "id", 9, 4)) == 3
    jdbc.to_database(spark.createDataFrame([(k, "oops" if k == 5 else v, s) for k, v, s in rows], "id int, v string, s string"), url, "source", {"v": 16, "s": 8})
    again = {r.slice: (r.status, r.error is None) for r in jdbc.copy_database(spark, url, typed.replace("nullif(\"s\", 'none')", '"s"'), path, "s", ["o'x", "none"], "id", 4).collect()}
    assert again == {"o'x": ("failed", False), "none": ("copied", True)} and spark.read.parquet(path).where(F.col("s") == "o'x").count() == 13
    assert not [n for n in os.listdir(tmp_path / "c") if "new" in n]


def test_two_workers_never_share_a_url(spark, tmp_path):
    path = f"file://{tmp_path}/q"
    urls = spark.range(60).select(F.concat(F.lit("u"), F.col("id") % 30).alias("url"), F.lit("UT").alias("state"), F.lit(None).cast("date").alias("scraped_at"), F.lit(None).cast("timestamp").alias("last_pulled"), F.lit(None).cast("string").alias("processing_id"))
    tables.replace_table(urls, path, stamp=None)
    as_of = F.lit("2024-01-02 00:00:00").cast("timestamp")
    with ThreadPoolExecutor(3) as pool:
        batches = [f.result() for f in [pool.submit(lambda w: [r.url for r in work_queue.claim(spark, path, as_of, 8, w).collect()], f"w{k}") for k in range(4)]]
    claimed = [u for b in batches for u in b]
    assert sorted(map(len, batches)) == [6, 8, 8, 8] and len(set(claimed)) == 30
    held = tables.read_table(spark, path)
    assert held.count() == 60 and held.where("processing_id is null").count() == 0
    assert {(r.url, r.processing_id) for r in held.collect()} == {(u, f"w{k}") for k, b in enumerate(batches) for u in b}
    with swap.locked(spark, path), pytest.raises(TimeoutError):
        work_queue.claim(spark, path, as_of, 1, "late", wait_seconds=0)
