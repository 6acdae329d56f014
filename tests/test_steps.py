"""Steps of marts that are shared by queries."""

import duckdb
from pyspark.sql import functions as F

from acreage.plans import mart_queries as marts
from acreage.sources import tables
from acreage.sources.swap import Folder

SF = "/root/testdata/sf0.001"


def test_steps_are_written_once_and_again_after_clearing(spark):
    calls = []

    @marts.step
    def counted(spark, d):
        calls.append(d)
        return tables.settled(spark.range(3), "test-step")

    assert counted(spark, "a").count() == counted(spark, "a").count() == 3 and calls == ["a"]
    assert counted(spark, "b").count() == 3 and calls == ["a", "b"]
    mark = marts._MARK[spark.sparkContext.applicationId]
    Folder(spark, mark).delete(mark)  # as clearing the folder would
    assert counted(spark, "a").count() == 3 and calls == ["a", "b", "a"]
    assert marts.QUERIES["mart_manual"](spark, SF).count() == marts.QUERIES["mart_manual"](spark, SF).count()


def test_halves_of_building_means_are_rounded_as_in_sql(spark, tmp_path):
    """A rent per square foot that ends in a half of its last decimal, which binary fractions put just below."""
    db = duckdb.connect()
    for name in ("customer", "part", "orders", "nation", "supplier", "lineitem"):
        rows = spark.read.parquet(f"{SF}/{name}.parquet")
        if name == "lineitem":
            rows = rows.withColumns({"l_extendedprice": F.lit(10.01).cast(rows.schema["l_extendedprice"].dataType), "l_quantity": F.lit(1).cast(rows.schema["l_quantity"].dataType)}).dropDuplicates(["l_suppkey"])
        rows.write.parquet(f"{tmp_path}/{name}.parquet")
        db.execute(f"create view {name} as select * from '{tmp_path}/{name}.parquet/*.parquet'")
    columns = ["building_id", "avg_rent_price_per_sqft", "avg_effective_rent_price_per_bed"]
    got = {tuple(r) for r in marts.QUERIES["mart_buildings"](spark, str(tmp_path)).select(*columns).collect()}
    assert got == set(db.execute(f"select {', '.join(columns)} from ({marts.ORACLE_SQL['mart_buildings']})").fetchall())
