"""The folder that the driver and all executors share."""

from __future__ import annotations

from pyspark.sql import SparkSession


def shared_folder(spark: SparkSession) -> str:
    """What spark.checkpoint.dir names. Only a session within one process may leave it unset: its own
    warehouse stands in then."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        folder = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/checkpoints"
    return folder.rstrip("/")
