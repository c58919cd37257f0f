"""The folder that driver and executors share."""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession


def shared_dir(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``. Only a session in one process may lack it: then a folder of this machine is set; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir names no folder that driver and executors share")
        found = "file://" + os.path.join(tempfile.gettempdir(), "checkpoints")
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")
