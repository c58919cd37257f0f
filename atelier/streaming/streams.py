"""Structured Streaming forms of the incremental parts: novelty and first sightings written exactly once, running averages, cooperative stop."""

from __future__ import annotations

import time
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.errors import StreamingQueryException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from atelier.operators.metrics import decayed
from atelier.sources.published import exists, write_once

BUCKET_MS = 60_000  # milliseconds of event time whose rows a running average sorts at once
_FIRST = -(2**63)  # stands for a null tie, which comes first
_ASKED = "the stop file asked for this end"


def stop_asked(spark: SparkSession, path: str) -> bool:
    """True if the stop file exists, in any store that Spark reads."""
    return exists(spark, path)


class StopAsked(RuntimeError):
    """Ends a query where a batch would begin."""


def appended_once(rows: DataFrame, out: str, checkpoint: str, prepare: Callable[[DataFrame], DataFrame] | None = None, stop: str | None = None, form: str = "parquet", **options: str) -> StreamingQuery:
    """Appends each batch to ``out`` exactly once, whatever fails in between.

    A batch is published by one rename under its number, so a batch that runs again after a failure, with the rows its
    checkpoint says, is either passed over or written anew. One folder belongs to one checkpoint.
    ``stop``: a file that, once there, lets the running batch end and no other begin its work.
    """

    def write(batch: DataFrame, number: int) -> None:
        if stop is not None and stop_asked(batch.sparkSession, stop):
            raise StopAsked(_ASKED)
        write_once(batch if prepare is None else prepare(batch), out, "batch", number, form, **options)

    return rows.writeStream.option("checkpointLocation", checkpoint).foreachBatch(write).start()


def novelty_stream(items: DataFrame, catalog: DataFrame, key: str, out: str, checkpoint: str, stop: str | None = None) -> StreamingQuery:
    """Appends to ``out``, exactly once, the items that the catalog's snapshot lacks. The snapshot is of the start: what a
    run appends is not seen by it, so an item listed twice is written twice (``first_sightings`` writes it once)."""
    snapshot = catalog.select(key).distinct()
    return appended_once(items, out, checkpoint, lambda batch: batch.join(snapshot, key, "left_anti"), stop)


def first_sightings(items: DataFrame, key: str, at: str, order: list[str], delay: str, forget: str) -> DataFrame:
    """The first row of each key in order of (``at``, ``order``), in whatever order rows come within ``delay``.

    A key's sightings are one session until none comes for ``forget``; it is written when the watermark has passed that, and
    forgotten: seen again later, it is new again. State is one row for each key in an open session, and
    a batch's rows of one key meet as partial minima first.
    """
    rest = [c for c in items.columns if c not in (key, at, *order)]
    least = F.min(F.struct(at, *order, *rest)).alias("__first")
    grouped = items.withWatermark(at, delay).groupBy(F.session_window(at, forget).alias("__session"), key).agg(least)
    return grouped.select(key, *[F.col(f"__first.{c}").alias(c) for c in (at, *order, *rest)]).select(*items.columns)


class RunningAverage(StatefulProcessor):
    """e = x at first, then alpha * e + (1 - alpha) * x, in order of (time, tie), for one series.

    Rows wait in buckets of event time, a state entry each, until the watermark has passed their bucket: no row
    can come before them then. A timer for each bucket sorts it, takes all its averages at once and clears it.
    """

    def __init__(self, series: str, at: str, tie: str, value: str, alpha: float, bucket_ms: int) -> None:
        self.series, self.at, self.tie, self.value, self.alpha, self.bucket = series, at, tie, value, alpha, bucket_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.average = handle.getValueState("average", "e double")
        self.waiting = handle.getMapState("waiting", "bucket long", "times array<long>, ties array<long>, xs array<double>")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        for f in rows:
            times = f[self.at].astype("datetime64[us]").astype("int64").to_numpy()
            ties, xs = f[self.tie].to_numpy(np.int64), f[self.value].to_numpy(np.float64, na_value=np.nan)
            bucket = times // (self.bucket * 1000)
            for b in np.unique(bucket).tolist():
                own = bucket == b
                parts = [times[own].tolist(), ties[own].tolist(), [None if x else v for v, x in zip(xs[own].tolist(), np.isnan(xs[own]).tolist(), strict=True)]]
                if self.waiting.containsKey((b,)):
                    parts = [list(old) + new for old, new in zip(self.waiting.getValue((b,)), parts, strict=True)]
                else:
                    self.handle.registerTimer((b + 1) * self.bucket)
                self.waiting.updateValue((b,), tuple(parts))
        yield pd.DataFrame()

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        upto = expiredTimerInfo.getExpiryTimeInMs() // self.bucket - 1
        for b in sorted(k[0] for k in self.waiting.keys() if k[0] <= upto):
            times, ties, xs = self.waiting.getValue((b,))
            self.waiting.removeKey((b,))
            x = np.array([np.nan if v is None else v for v in xs], np.float64)
            order = np.lexsort((np.array(ties), np.array(times)))
            x = x[order]
            real = ~np.isnan(x)
            own = x[real]
            begun = self.average.get()[0] if self.average.exists() else (own[0] if len(own) else np.nan)
            e = own if self.alpha >= 1 else decayed(own, self.alpha, begun)
            held = np.concatenate([[begun if self.average.exists() else np.nan], e])[np.cumsum(real)]
            if len(own):
                self.average.update((float(e[-1]),))
            yield pd.DataFrame({self.series: [key[0]] * len(x), self.at: pd.to_datetime(np.array(times)[order], unit="us"), self.tie: np.array(ties)[order], "ema": pd.Series(held).astype(object).where(~np.isnan(held), None)})

    def close(self) -> None:
        pass


def ema_stream(rows: DataFrame, series: str, at: str, tie: str, value: str, alpha: float, delay: str, bucket_ms: int = BUCKET_MS) -> DataFrame:
    """(series, at, tie, ema) as the batch form ``metrics.ema`` gives them, for rows that come at most ``delay`` late; later ones are dropped.

    A null value leaves the average as it was; a row that comes twice counts twice. Rows appear once the watermark has passed
    their bucket of event time. State is kept in RocksDB: one number a series, and the rows of its open buckets. NaN counts as null.
    """
    kinds = dict(rows.dtypes)
    out = f"{series} {kinds[series]}, {at} timestamp, {tie} long, ema double"
    held = rows.select(series, F.col(at).cast("timestamp").alias(at), F.coalesce(F.col(tie).cast("long"), F.lit(_FIRST)).alias(tie), F.col(value).cast("double").alias(value)).withWatermark(at, delay)
    averaged = held.groupBy(series).transformWithStateInPandas(RunningAverage(series, at, tie, value, alpha, bucket_ms), out, "append", "eventTime")
    return averaged.withColumn(tie, F.nullif(F.col(tie), F.lit(_FIRST)))


STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


def run_until_stopped(spark: SparkSession, query: StreamingQuery, path: str, pause: float = 1.0) -> None:
    """Waits until the query has ended because of the stop file: between two batches, or at once if none is running.

    For queries of ``appended_once`` with the same file: the running batch ends and is committed; the next one fails before its work,
    and runs when the query is started again. It does not wait for the source, which may grow without end.
    """
    while query.isActive:
        if stop_asked(spark, path) and not query.status["isTriggerActive"]:
            query.stop()
        time.sleep(pause)
    failed = query.exception()
    if failed is not None and _ASKED not in str(failed):
        raise failed if isinstance(failed, StreamingQueryException) else RuntimeError(str(failed))
