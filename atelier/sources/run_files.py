"""Files beside a run: its log, the plot's manual range, and where it resumes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.sources.published import place_of

# Endings of checkpoint files.
CHECKPOINT_ENDINGS = (".pth", ".pt")


def write_log(lines: DataFrame, path: str, begun: str, order: str) -> None:
    """A run's log anew: the time it began, then ``[LEVEL] message`` lines of (level, message) by ``order``.

    Parts of the written folder follow each other in that order.
    """
    line = F.concat(F.lit("["), F.col("level"), F.lit("] "), F.col("message"))
    head = lines.sparkSession.createDataFrame([(begun,)], "value string").select(F.lit(0).alias("__kind"), F.lit(None).cast(dict(lines.dtypes)[order]).alias("__at"), "value")
    body = lines.select(F.lit(1).alias("__kind"), F.col(order).alias("__at"), line.alias("value"))
    head.union(body).orderBy("__kind", "__at").select("value").write.mode("overwrite").text(path)


def read_range(spark: SparkSession, path: str) -> tuple[float, float] | None:
    """(low, high) of a text file of exactly two numbers, the first under the second; None for anything else, or no file."""
    place, store = place_of(spark, path)
    if not store.exists(place) or not store.getFileStatus(place).isFile():
        return None
    words = [r["word"] for r in spark.read.text(path).select(F.explode(F.regexp_extract_all("value", F.lit(r"(?U)\S+"), F.lit(0))).alias("word")).take(3)]  # a third one is one too many
    try:
        low, high = map(float, words)
    except ValueError:
        return None
    return (low, high) if low < high else None


def write_range(spark: SparkSession, path: str, low: float, high: float) -> None:
    """The range file, anew."""
    place, store = place_of(spark, path)
    out = store.create(place, True)
    out.writeBytes(f"{low} {high}\n")
    out.close()


def resume_path(spark: SparkSession, path: str | None) -> str | None:
    """What to resume from: None without a path, a folder's last checkpoint by name, or the file itself; else an error."""
    if path is None:
        return None
    place, store = place_of(spark, path)
    if store.exists(place):
        status = store.getFileStatus(place)
        found = sorted(f.getPath().toString() for f in store.listStatus(place) if f.getPath().getName().endswith(CHECKPOINT_ENDINGS))
        if status.isFile() and path.endswith(CHECKPOINT_ENDINGS) or found:
            return found[-1]
    raise FileNotFoundError(path)


def resume(spark: SparkSession, path: str | None, load_package, load_weights) -> dict:
    """Counters to go on with. Both loaders are plug points that take a path.

    A checkpoint of a folder must be a whole package. A file that is none is taken for bare weights:
    they are loaded, and the counters begin anew.
    """
    begin = {"global_step": 0, "epoch": 0, "prediction_type": None, "opt_step": 0}
    found = resume_path(spark, path)
    if found is None:
        return begin
    place, store = place_of(spark, path)
    if not store.getFileStatus(place).isFile():
        return {**begin, **load_package(found)}
    try:
        return {**begin, **load_package(found)}
    except Exception:
        load_weights(found)
        return begin
