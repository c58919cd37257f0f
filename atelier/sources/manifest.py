"""File manifests: recursive scans, path lists, relative paths, and what is still to do."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.functions.text import strip

# Image extensions of the scans.
IMAGE_EXTENSIONS = (".bmp", ".jpeg", ".jpg", ".png", ".webp")


def extension(path: Column) -> Column:
    return F.regexp_extract(path, r"(\.[^./]*)$", 1)


def scan(spark: SparkSession, root: str, extensions: tuple[str, ...] = IMAGE_EXTENSIONS, fold_case: bool = True) -> DataFrame:
    """Paths below a folder by extension; contents are not read."""
    found = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path")
    ext = extension(F.col("path"))
    return found.filter((F.lower(ext) if fold_case else ext).isin(list(extensions)))


def from_list(spark: SparkSession, list_file: str, listing: DataFrame, ending: str = ".webp") -> DataFrame:
    """Listed paths, trimmed, not blank, of one extension, that the listing holds."""
    return listed(spark.read.text(list_file), "value", listing, ending)


def listed(lines: DataFrame, line: str, listing: DataFrame, ending: str = ".webp") -> DataFrame:
    """The same of lines from anywhere."""
    named = lines.select(strip(F.col(line)).alias("path")).filter(F.col("path") != "")
    return named.filter(F.col("path").endswith(ending)).join(listing.select("path"), "path", "left_semi")


def mapped(path: Column, root: str, target: str, ending: str, prefix: str = "") -> Column:
    """The path's place under another root with another extension; the prefix goes on the relative path."""
    relative = F.substring(path, len(root.rstrip("/")) + 2, 1 << 30)
    return F.concat(F.lit(target.rstrip("/") + "/" + prefix), F.regexp_replace(relative, r"\.[^./]*$", ""), F.lit(ending))


def pending(wanted: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Targets that do not exist yet."""
    return wanted.join(done.select(key), key, "left_anti")
