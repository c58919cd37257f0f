"""Metric series, retention and latency statistics, none of which needs a whole series in one task."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType
from pyspark.sql.window import Window

from atelier.functions.ranking import blocks_by_quantile

HISTORY = 500_000
KEEP = 10


STEP = 64  # rows of a running average that one matrix product covers


def decayed(x: np.ndarray, alpha: float, begun: float) -> np.ndarray:
    """e[k] = alpha * e[k - 1] + (1 - alpha) * x[k] from e[-1] = begun, STEP rows at a time."""
    k = np.arange(STEP)
    weight = (1 - alpha) * np.tril(alpha ** np.clip(k[:, None] - k[None, :], 0, None).astype(float))
    power = alpha ** (k + 1.0)
    out = np.empty(len(x))
    whole = len(x) // STEP * STEP
    out[:whole] = (x[:whole].reshape(-1, STEP) @ weight.T).ravel()
    if whole < len(x):
        out[whole:] = weight[: len(x) - whole, : len(x) - whole] @ x[whole:]
    for low in range(0, len(x), STEP):
        part = out[low : low + STEP]
        part += power[: len(part)] * begun
        begun = part[-1]
    return out


def _averaged(batches: Iterator[pa.RecordBatch], series: str, value: str, alpha: float) -> Iterator[tuple]:
    """(batch, average from nothing, power of alpha, first value of the block so far, beginnings of blocks) of rows that come by series and block.

    The power is that of alpha by the number of values since the block's beginning; a null leaves things as they are.
    """
    now, e, power, first = None, 0.0, 1.0, np.nan
    for batch in batches:
        if not batch.num_rows:
            continue
        block = batch.column("__block").to_numpy()
        names = pc.fill_null(batch.column(series).cast(pa.string()), "\0").dictionary_encode().indices.to_numpy()
        x = batch.column(value).cast(pa.float64())
        real, x = pc.is_valid(x).to_numpy(zero_copy_only=False), pc.fill_null(x, 0.0).to_numpy()
        edges = np.flatnonzero(np.concatenate([[True], (block[1:] != block[:-1]) | (names[1:] != names[:-1])])).tolist()
        part, powers, firsts = np.empty(len(x)), np.empty(len(x)), np.empty(len(x))
        for a, b in zip(edges, [*edges[1:], len(x)], strict=True):
            key = (batch.column(series)[a].as_py(), int(block[a]))
            if key != now:
                now, e, power, first = key, 0.0, 1.0, np.nan
            own = x[a:b][real[a:b]]
            seen = np.cumsum(real[a:b])
            part[a:b] = np.concatenate([[e], decayed(own, alpha, e)])[seen]
            powers[a:b] = power * alpha ** seen.astype(float)
            first = own[0] if len(own) and np.isnan(first) else first
            firsts[a:b] = first
            e, power = part[b - 1], powers[b - 1]
        yield batch, part, powers, firsts, edges


def ema(df: DataFrame, series: str, at: str, tie: str, value: str, alpha: float, blocks: int | None = None) -> DataFrame:
    """Adds ``ema``: e = x at first, then alpha * e + (1 - alpha) * x, per series in order of (at, tie).

    A null value leaves the average as it was (null before the first value). A series is cut into blocks
    of time, as many as the rows need; the recurrence is linear, so a block's end is known up to
    alpha^rows times its beginning, and a fold over the few block ends gives each block its beginning.
    (A series begins as if its first value had been its average before.) alpha of 1 or more gives x itself.
    """
    if alpha >= 1:
        return df.withColumn("ema", F.col(value).cast("double"))
    keyed = df.withColumn("__at", F.col(at).cast("double") if dict(df.dtypes)[at] != "timestamp_ntz" else F.unix_micros(F.col(at).cast("timestamp")))
    keyed = keyed.withColumn("__block", blocks_by_quantile(keyed, "__at", blocks))
    dealt = keyed.repartition(series, "__block").sortWithinPartitions(series, "__block", at, tie)

    def ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The last state of each block: one row a block and batch that it spans, the last of which counts."""
        n = 0
        for batch, *states, edges in _averaged(batches, series, value, alpha):
            last = np.array([*edges[1:], batch.num_rows]) - 1
            n += 1
            yield pa.RecordBatch.from_arrays([batch.column(series).take(pa.array(last)), batch.column("__block").take(pa.array(last)), pa.array(np.full(len(last), n)), *(pa.array(s[last]) for s in states)], names=["__series", "__block", "__n", "__part", "__power", "__first"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch, part, powers, *_ in _averaged(batches, series, value, alpha):
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part), pa.array(powers)], names=[*batch.schema.names, "__part", "__power"])

    closed = dealt.select(series, "__block", value).mapInArrow(ends, f"__series {dict(df.dtypes)[series]}, __block int, __n long, __part double, __power double, __first double")
    closed = closed.groupBy("__series", "__block").agg(F.max_by(F.struct("__part", "__power", F.nanvl("__first", F.lit(None)).alias("__first")), "__n").alias("__end"))
    held = closed.select("__series", "__block", "__end.*")

    def fold(f: pd.DataFrame) -> pd.DataFrame:
        """Once through the ends of a series' blocks, of which there are a bounded number."""
        f = f.sort_values("__block")
        begun, e = [], np.nan
        for part, power, first in zip(f["__part"], f["__power"], f["__first"], strict=True):
            begun.append(e)
            now = part + power * (first if np.isnan(e) else e)
            e = e if np.isnan(now) else now
        return pd.DataFrame({"__series": f["__series"], "__of": f["__block"], "__begun": begun, "__first": f["__first"]})

    carried = held.groupBy("__series").applyInPandas(fold, f"__series {dict(df.dtypes)[series]}, __of int, __begun double, __first double")
    carried = carried.withColumns({c: F.nanvl(c, F.lit(None)) for c in ("__begun", "__first")})
    local = dealt.mapInArrow(run, StructType(list(dealt.schema)).add("__part", "double").add("__power", "double"))
    joined = local.join(carried, F.col(series).eqNullSafe(F.col("__series")) & (F.col("__block") == F.col("__of")))
    average = F.col("__part") + F.col("__power") * F.coalesce("__begun", "__first")
    return joined.withColumn("ema", F.when(F.col("__power") == 1, F.col("__begun")).otherwise(average)).select(*df.columns, "ema")


def vector_ema(vectors: Column, decay: float) -> Column:
    """Shadow copy after a short ordered array of vectors, element by element."""
    start = F.transform(F.element_at(vectors, 1), lambda x: x.cast("double"))
    rest = F.slice(vectors, 2, F.greatest(F.size(vectors) - 1, F.lit(0)))
    return F.aggregate(rest, start, lambda s, v: F.zip_with(s, v, lambda a, b: a * decay + b.cast("double") * (1 - decay)))


def tail(df: DataFrame, order: list[Column], n: int = HISTORY) -> DataFrame:
    """The last n rows: top-n of each task first."""
    return df.orderBy(*[c.desc() for c in order]).limit(n)


def every(df: DataFrame, step: str, k: int) -> DataFrame:
    return df.filter(F.col(step) % k == 0)


def pruned(checkpoints: DataFrame, keep: int = KEEP) -> DataFrame:
    """Checkpoints to delete. (name, kind 'ema' | 'raw', mtime)

    The newest of each kind stay; raw ones are touched only if there are too many ema ones. Only the top of each kind is
    shuffled, and what stays is ``keep`` rows a kind, so it is broadcast.
    """
    w = Window.partitionBy("kind").orderBy(F.col("mtime").desc(), F.col("name").desc())
    stays = checkpoints.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") <= keep).select("name", "kind")
    old = checkpoints.join(F.broadcast(stays), ["name", "kind"], "left_anti")
    many = checkpoints.agg((F.count_if(F.col("kind") == "ema") > keep).alias("__many"))
    return old.crossJoin(F.broadcast(many)).filter("__many").drop("__many")


def after_warmup(runs: DataFrame, series: str, order: list[str], discarded: int) -> DataFrame:
    """Runs but for the first ``discarded`` of each series, in an order without ties. Only these are ranked, each task's own first; the rest are compared with the last of them."""
    at = F.struct(*order)
    first = runs.select(F.col(series).alias("__series"), at.alias("__at")).withColumn("__rn", F.row_number().over(Window.partitionBy("__series").orderBy("__at")))
    last = first.filter(F.col("__rn") <= discarded).groupBy("__series").agg(F.max("__at").alias("__last"), F.count(F.lit(1)).alias("__n")).filter(F.col("__n") == discarded)
    return runs.join(last, F.col(series).eqNullSafe(F.col("__series"))).filter(at > F.col("__last")).select(*runs.columns)


def resume_choice(checkpoints: DataFrame, kinds: list[str]) -> DataFrame:
    """(name) to resume from: the last by name of the first kind that has any; null if none has."""
    latest = [F.max(F.when(F.col("kind") == k, F.col("name"))) for k in kinds]
    return checkpoints.agg(F.coalesce(*latest).alias("name"))


def resume_from(checkpoints: DataFrame, kinds: list[str]) -> str:
    """The same as a name; without any checkpoint of these kinds it is an error."""
    name = resume_choice(checkpoints, kinds).first()["name"]
    if name is None:
        raise FileNotFoundError("no checkpoint to resume from")
    return name


def nearest_ranks(df: DataFrame, group: str, value: str, shares: list[float], blocks: int | None = None) -> DataFrame:
    """(group, share, value) at sorted position int(share * (n - 1)): exact, without sorting a group in one task.

    Equal values are counted before they are sorted, so a value that most rows share is one row.
    """
    held = df.select(F.col(group), F.col(value).alias("__v"))
    held = held.withColumn("__block", blocks_by_quantile(held, "__v", blocks))
    counts = held.groupBy(group, "__block").agg(F.count(F.lit(1)).alias("__n"))
    up = Window.partitionBy(group).orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(group, "__block", "__n", F.coalesce(F.sum("__n").over(up), F.lit(0)).alias("__before"), F.sum("__n").over(Window.partitionBy(group)).alias("__all"))
    wanted = counts.withColumn("share", F.explode(F.array(*[F.lit(s) for s in shares])))
    wanted = wanted.withColumn("__rank", F.floor(F.col("share") * (F.col("__all") - 1)))
    wanted = wanted.filter((F.col("__rank") >= F.col("__before")) & (F.col("__rank") < F.col("__before") + F.col("__n")))
    inside = held.join(wanted.select(group, "__block").distinct(), [group, "__block"], "left_semi")  # only blocks that hold a wanted rank
    tied = inside.groupBy(group, "__block", "__v").agg(F.count(F.lit(1)).alias("__ties"))
    ranked = tied.withColumn("__to", F.sum("__ties").over(Window.partitionBy(group, "__block").orderBy("__v")))
    at = F.col("__rank") - F.col("__before")
    return wanted.join(ranked, [group, "__block"]).filter((at < F.col("__to")) & (at >= F.col("__to") - F.col("__ties"))).select(group, "share", F.col("__v").alias("value"))


SKETCH = 1000  # of a quantile sketch: items it keeps, about
# The published normalised rank error of such a sketch (one rank, 99 % confidence) is 2.296 / k ^ 0.9021.
RANK_ERROR, RANK_POWER = 2.296, 0.9021


def rank_error(k: int = SKETCH) -> float:
    """By how much a sketched quantile's rank may differ from its share, as a part of all rows."""
    return RANK_ERROR / k**RANK_POWER


def quantile_sketches(rows: DataFrame, groups: list[str], value: str, k: int = SKETCH) -> DataFrame:
    """(groups, sketch, n): a mergeable sketch of some kilobytes for each group, whatever its size. Nulls are left out.

    In a batch tasks' sketches meet, not rows. In a stream the sketch is the group's state; or each batch's sketches are
    appended, and ``sketched_ranks`` merges them when asked.
    """
    held = rows.filter(F.col(value).isNotNull())
    return held.groupBy(*groups).agg(F.kll_sketch_agg_double(F.col(value).cast("double"), F.lit(k)).alias("sketch"), F.count(F.lit(1)).alias("n"))


def sketched_ranks(sketches: DataFrame, group: str, shares: list[float], k: int = SKETCH) -> DataFrame:
    """(group, share, value) of the sketches of each group, merged in any order: beside ``nearest_ranks``, which is exact."""
    merged = sketches.groupBy(group).agg(F.kll_merge_agg_double("sketch", F.lit(k)).alias("sketch"))
    each = F.explode(F.array(*[F.struct(F.lit(float(s)).alias("share"), F.kll_sketch_get_quantile_double("sketch", F.lit(float(s))).alias("value")) for s in shares]))
    return merged.select(group, each.alias("q")).select(group, "q.share", "q.value")


def throughput(mean_ms: Column, batch: int) -> Column:
    return F.lit(1000.0) / (mean_ms + 1e-12) * batch


def in_range(value: Column, low: float, high: float) -> Column:
    """A plot's manual range counts only if low is under high."""
    return value.between(low, high) if low < high else F.lit(True)
