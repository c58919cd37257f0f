"""Folders whose parts appear whole and once: staged, then published by one rename under a name of their own.

``<path>/<name>=<id>`` holds what was published for an id. Staged parts lie in ``<path>/_staging``, which readers pass over.
The rename must be atomic and refuse a name that is taken, as those of HDFS and local file systems do.
"""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession

STAGING = "_staging"


def place_of(spark: SparkSession, path: str):
    """(path, its file system) in any store that Spark reads."""
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place, place.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    place, store = place_of(spark, path)
    return store.exists(place)


def remove(spark: SparkSession, path: str) -> None:
    place, store = place_of(spark, path)
    store.delete(place, True)


def published(spark: SparkSession, path: str, name: str) -> list[str]:
    """Ids published so far, as text, in their order as texts."""
    place, store = place_of(spark, path)
    if not store.exists(place):
        return []
    found = [f.getPath().getName() for f in store.listStatus(place)]
    return sorted(x[len(name) + 1 :] for x in found if x.startswith(f"{name}="))


def publish(spark: SparkSession, staged: str, path: str) -> bool:
    """Gives a staged folder its name; False if the name is taken, and then the staged folder goes."""
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    place, store = place_of(spark, staged)
    store.mkdirs(target.getParent())
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(place.toUri(), spark._jsc.hadoopConfiguration())
    none = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(store.makeQualified(place), store.makeQualified(target), none)
        return True
    except Py4JJavaError as e:
        if "AlreadyExists" not in e.java_exception.getClass().getSimpleName():
            raise
        store.delete(place, True)
        return False


def write_once(df: DataFrame, path: str, name: str, part: int | str, form: str = "parquet", **options: str) -> bool:
    """Appends ``df`` under an id, unless that id is published: then nothing is computed, and the result is False.

    What a run that failed has left staged for the id goes first. Of two writers of one id, one is published.
    """
    spark = df.sparkSession
    target, waiting = f"{path}/{name}={part}", f"{path}/{STAGING}/{name}={part}"
    if exists(spark, target):
        return False
    remove(spark, waiting)
    staged = f"{waiting}/{uuid.uuid4().hex}"
    df.write.options(**options).format(form).save(staged)
    done = publish(spark, staged, target)
    remove(spark, waiting)
    return done
