"""Folders for what jobs write on their way."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def scratch(spark: SparkSession) -> str:
    """A new folder in the shared one of the cluster; a local one only where none is set and Spark runs locally."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if base is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = "/tmp/spark-scratch"
    return f"{base}/{uuid.uuid4().hex}"
