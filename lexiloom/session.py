"""Session settings and the folder that driver and executors share."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_session(app: str = "lexiloom", master: str | None = None, **settings: str) -> SparkSession:
    """A session with the settings that the operators' results rely on."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    chosen = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
        "spark.ui.enabled": "false",
    } | settings
    for key, value in chosen.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``.

    Where that is unset, a session on one machine (tests, a notebook) gets a temporary one; on a
    cluster no folder is sure to be shared by driver and executors, so it is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        base = "file://" + os.path.join(tempfile.gettempdir(), "lexiloom-shared")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def work_folder(spark: SparkSession, name: str) -> str:
    """A new path below the shared folder; nothing is made there yet."""
    return f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str, partition_by: str | None = None) -> DataFrame:
    """Cut lineage: write the rows as Parquet below the shared folder and read them back."""
    spark = df.sparkSession
    path = work_folder(spark, name)
    writer = df.write.option("compression", "zstd")
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
