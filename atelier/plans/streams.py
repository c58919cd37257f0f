"""Queries that run the streaming forms over whole tables, and read what they wrote."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.functions.shared import shared_dir
from atelier.plans.common import Family, table
from atelier.streaming import streams

family = Family()
ALPHA = 0.9


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.readStream.schema(table(spark, d, name).schema).parquet(f"{d}/{name}.parque[t]")  # a pattern: the table may be a file or a folder


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/atelier/stream-{name}-{uuid.uuid4().hex}"


def _ended(spark: SparkSession, rows: DataFrame, at: str, folder: str) -> DataFrame:
    """The stream with one row far in the future, so that all others are older than the watermark."""
    end = [F.lit("2200-01-01").cast("timestamp").alias(f.name) if f.name == at else F.lit(None).cast(f.dataType).alias(f.name) for f in rows.schema]
    spark.range(1).select(*end).write.parquet(f"{folder}/end")
    return rows.union(spark.readStream.schema(rows.schema).parquet(f"{folder}/end"))


def _finished(rows: DataFrame, folder: str, prepare=None) -> DataFrame:
    query = streams.appended_once(rows, f"{folder}/out", f"{folder}/checkpoint", prepare)
    query.processAllAvailable()
    query.stop()
    return rows.sparkSession.read.schema(rows.schema).parquet(f"{folder}/out")


@family.add("stream_novelty", "SELECT doc_id, source FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def stream_novelty(spark, d):
    folder = _folder(spark, "novelty")
    query = streams.novelty_stream(_read(spark, d, "documents").select("doc_id", "source"), table(spark, d, "labels"), "doc_id", f"{folder}/out", f"{folder}/checkpoint")
    query.processAllAvailable()
    query.stop()
    return spark.read.parquet(f"{folder}/out").select("doc_id", "source")


@family.add("stream_first_sightings", "SELECT user_id, event_id, event_type FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) = 1")
def stream_first_sightings(spark, d):
    """Each user's first event; the table spans a month, so none is forgotten in between."""
    folder = _folder(spark, "first")
    items = _read(spark, d, "events").select("user_id", F.col("ts").cast("timestamp").alias("at"), "event_id", "event_type")
    found = _finished(streams.first_sightings(_ended(spark, items, "at", folder), "user_id", "at", ["event_id"], "60 days", "60 days"), folder)
    return found.filter("user_id is not null").select("user_id", "event_id", "event_type")


@family.add(
    "stream_loss_ema",
    f"""WITH RECURSIVE v AS (SELECT event_type, event_id, ts, CASE WHEN event_id % 13 <> 0 THEN value END AS x FROM events),
    o AS (SELECT event_type, event_id, x, row_number() OVER (PARTITION BY event_type ORDER BY ts, event_id) AS rn FROM v WHERE x IS NOT NULL),
    f AS (SELECT event_type, event_id, rn, x::DOUBLE AS e FROM o WHERE rn = 1 UNION ALL SELECT o.event_type, o.event_id, o.rn, {ALPHA}::DOUBLE * f.e + (1 - {ALPHA}::DOUBLE) * o.x FROM f JOIN o ON o.event_type = f.event_type AND o.rn = f.rn + 1)
    SELECT event_id, event_type, round(last_value(e IGNORE NULLS) OVER (PARTITION BY event_type ORDER BY ts, event_id), 6) AS ema FROM v LEFT JOIN f USING (event_id, event_type)""",
)
def stream_loss_ema(spark, d):
    """Running averages with state, of values a thirteenth of which is null."""
    key, value = next(iter(streams.STATE_STORE.items()))
    before = spark.conf.get(key, None)
    spark.conf.set(key, value)
    try:
        folder = _folder(spark, "ema")
        rows = _read(spark, d, "events").select("event_type", F.col("ts").cast("timestamp").alias("at"), "event_id", F.when(F.col("event_id") % 13 != 0, F.col("value")).alias("value"))
        found = _finished(streams.ema_stream(_ended(spark, rows, "at", folder), "event_type", "at", "event_id", "value", ALPHA, "60 days", bucket_ms=6 * 3_600_000), folder)
        return found.filter("event_type is not null").select("event_id", "event_type", F.round("ema", 6).alias("ema"))
    finally:
        spark.conf.set(key, before) if before else spark.conf.unset(key)
