"""The folder that the driver and all executors share."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under ``spark.checkpoint.dir``. Where the cluster names no such folder there
    is none that all machines see, so only a local session gets one of its own."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all machines share")
        folder = tempfile.gettempdir()
    application = spark.sparkContext.applicationId
    return f"{folder.rstrip('/')}/runledger-{application}/{name}-{uuid.uuid4().hex}"
