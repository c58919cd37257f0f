"""JSON-lines index of latent records."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

FIELDS = ("npz", "src", "caption", "author")


def record_key(path: Column) -> Column:
    """Stable name of a record: SHA-1 of the path's UTF-8 bytes."""
    return F.sha1(path.cast("binary"))


def index_line(path: Column, caption: Column, author: Column | None = None) -> Column:
    cells = [F.concat(record_key(path), F.lit(".npz")).alias("npz"), path.alias("src"), caption.alias("caption")]
    return F.to_json(F.struct(*cells, *([author.alias("author")] if author is not None else [])), {"ignoreNullFields": "false"})


def parse_index(lines: DataFrame, column: str = "value", fields: tuple[str, ...] = FIELDS, required: str = "npz") -> DataFrame:
    """Rows of valid lines that have the required field; absent texts are empty, explicit nulls stay null."""
    raw = F.col(column)
    keys = F.coalesce(F.json_object_keys(raw), F.array().cast("array<string>"))
    parsed = F.from_json(raw, ", ".join(f"`{f}` string" for f in fields) + ", __bad string", {"columnNameOfCorruptRecord": "__bad", "mode": "PERMISSIVE"})
    held = lines.withColumns({"__p": parsed, "__k": keys})
    kept = held.filter(F.col("__p.__bad").isNull() & F.array_contains("__k", required) & F.col(f"__p.{required}").isNotNull())
    others = [F.when(F.array_contains("__k", f), F.col(f"__p.{f}")).otherwise(F.lit("")).alias(f) for f in fields if f != required]
    rest = [c for c in lines.columns if c != column]
    return kept.select(*rest, F.col(f"__p.{required}").alias(required), *others)


def read_index(spark: SparkSession, path: str) -> DataFrame:
    return parse_index(spark.read.text(path))


def write_index(lines: DataFrame, path: str) -> None:
    lines.write.mode("overwrite").text(path)


def existing(index: DataFrame, files: DataFrame, key: str) -> DataFrame:
    """Index rows whose latent file exists."""
    return index.join(files.select(key), key, "left_semi")
