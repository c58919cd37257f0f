"""Extension: caption rows from paths, tags and artists, joined on the item id in the path."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def assemble_captions(paths: DataFrame, tags: DataFrame, artists: DataFrame) -> DataFrame:
    """paths (path, item), tags (path, pos, tag), artists (item, names) -> (path, caption, author)."""
    captions = tags.groupBy("path").agg(F.array_sort(F.collect_list(F.struct("pos", "tag"))).alias("t"))  # an image's tags: vocabulary at most
    captions = captions.select("path", F.array_join(F.transform("t", lambda s: s["tag"]), ", ").alias("caption"))
    joined = paths.join(captions, "path", "left").join(artists, "item", "left")
    return joined.select("path", F.coalesce("caption", F.lit("")).alias("caption"), F.coalesce("names", F.lit("")).alias("author"))


def computed_once(df: DataFrame, key: str, compute) -> DataFrame:
    """A dear function of a column, computed once per distinct value and joined back."""
    values = df.select(key).distinct()
    return df.join(values.select(F.col(key), compute(F.col(key)).alias("computed")), key)


def looked_up(df: DataFrame, key: str, table: DataFrame, value: str, default) -> DataFrame:
    """Left lookup with a default for what is missing."""
    return df.join(table, key, "left").withColumn(value, F.coalesce(F.col(value), default))
