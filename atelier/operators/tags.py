"""Tags from score vectors: threshold, lines, files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.functions.text import fixed

THRESHOLD = 0.5


def select_tags(df: DataFrame, key: str, scores: str, vocabulary: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """(key, pos, tag, score) of scores at or above the threshold. vocabulary: (pos, tag), one row per score position."""
    long = df.select(F.col(key), F.posexplode(scores).alias("pos", "score")).filter(F.col("score").cast("double") >= threshold)
    return long.join(F.broadcast(vocabulary), "pos").select(key, "pos", "tag", F.col("score").cast("double").alias("score"))


def tag_line(tag: Column, score: Column) -> Column:
    return F.concat(tag, F.lit(" "), fixed(score, 3))


def tag_files(df: DataFrame, key: str, scores: str, prefix: str, threshold: float = THRESHOLD) -> DataFrame:
    """(key, content): a vector's lines in vocabulary order, empty if none passes. Arrays stay in their row: no shuffle.

    Tags are ``prefix`` and position; with a named vocabulary pass it through ``tag_lines_of``.
    """
    named = F.transform(F.col(scores), lambda x, i: F.struct(F.concat(F.lit(prefix), i.cast("string")).alias("tag"), x.cast("double").alias("score")))
    return df.select(F.col(key), tag_lines_of(named, threshold).alias("content"))


def tag_lines_of(named: Column, threshold: float) -> Column:
    kept = F.filter(named, lambda s: s["score"] >= threshold)
    return F.array_join(F.transform(kept, lambda s: tag_line(s["tag"], s["score"])), "\n")
