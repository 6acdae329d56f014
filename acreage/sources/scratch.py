"""Tables that a job writes for itself in the folder that the cluster shares."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir`` of the session. Where it is unset, a temporary folder serves one process; on a cluster it would lose other machines' rows."""
    folder = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not folder:
        if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        folder = f"file://{tempfile.mkdtemp(prefix='acreage-')}"
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def scratch(spark: SparkSession, label: str) -> str:
    """A new folder's name under the shared one."""
    return f"{shared_folder(spark)}/acreage/{label}-{uuid.uuid4().hex}"


def settled(df: DataFrame, label: str) -> DataFrame:
    """The frame as a Parquet table in a scratch folder: plans on it stay short and survive lost executors."""
    path = scratch(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
