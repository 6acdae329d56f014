"""Where an operator may cut lineage: a written table in the folder that the cluster shares."""

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


def written(df: DataFrame, label: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder; later reads survive lost executors."""
    path = f"{shared_folder(df.sparkSession)}/acreage/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._written_to = path
    return out


def released(*tables: DataFrame) -> None:
    """Remove written tables that nothing will read again."""
    for df in tables:
        jvm, path = df.sparkSession._jvm, df._written_to
        jvm.org.apache.hadoop.fs.Path(path).getFileSystem(df.sparkSession._jsparkSession.sessionState().newHadoopConf()).delete(jvm.org.apache.hadoop.fs.Path(path), True)
