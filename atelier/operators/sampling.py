"""Reproducible batches, step counts and learning rates."""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.functions.permutation import Permutation
from atelier.functions.ranking import blocks_of, rank_by_uniform
from atelier.functions.text import uniform


def train_batches(df: DataFrame, key: str, size: int, seed: int, epoch: int = 0) -> DataFrame:
    """(key, batch, place) in a new order each epoch; an incomplete last batch is dropped."""
    n = df.count()
    ranked = rank_by_uniform(df.select(key), uniform(F.col(key), seed + epoch), key, "__rank", blocks_of(n))
    batch = F.floor(F.col("__rank") / size).cast("long")
    return ranked.select(key, batch.alias("batch"), (F.col("__rank") % size).cast("int").alias("place")).filter(F.col("batch") < n // size)


def epoch_order(n: int, seed: int, epoch: int) -> Permutation:
    """The order of an epoch's rows, computed from its number."""
    return Permutation(n, seed + epoch)


def keyed_batches(df: DataFrame, position: str, n: int, size: int, seed: int, epoch: int = 0, first: int = 0) -> DataFrame:
    """``df``, whose rows have positions 0 .. n - 1, with batch and place in the epoch's order, from batch ``first`` on.

    No row is moved: each computes its place. An incomplete last batch is dropped.
    """
    place = epoch_order(n, seed, epoch).place_column(F.col(position))
    placed = df.withColumn("__place", place)
    batch = F.expr(f"__place div {size}")
    return placed.withColumns({"batch": batch, "place": (F.col("__place") % size).cast("int")}).filter(F.col("batch").between(first, n // size - 1)).drop("__place")


def keyed_batch(df: DataFrame, position: str, n: int, size: int, seed: int, epoch: int, k: int) -> DataFrame:
    """Batch ``k`` of an epoch with its rows' places: their positions are computed first, so the scan is filtered by them, and nothing is shuffled."""
    if not 0 <= k < n // size:
        raise IndexError("batch out of range")
    held = epoch_order(n, seed, epoch).held_at(np.arange(k * size, (k + 1) * size)).tolist()
    places = F.create_map(*[F.lit(v) for i, p in enumerate(held) for v in (p, i)])
    return df.filter(F.col(position).isin(held)).withColumns({"batch": F.lit(k).cast("long"), "place": F.try_element_at(places, F.col(position)).cast("int")})


def step_plan(rows: int, batch: int, accumulate: int, epochs: int, warmup: int = 0) -> dict[str, int]:
    """Batches and optimiser steps of an epoch, all steps, and warm-up steps (3 %, 100 at least, if none are given)."""
    batches = rows // batch
    per_epoch = max(1, math.ceil(batches / accumulate))
    total = per_epoch * epochs
    return {"batches": batches, "steps_per_epoch": per_epoch, "total_steps": total, "warmup_steps": warmup if warmup > 0 else max(100, int(0.03 * total))}


def learning_rate(step: Column, base: float, most: int, warmup: int, least_share: float = 0.1) -> Column:
    """Base rate before the first step, then warm-up, then a cosine (which rises again past ``most``)."""
    progress = (step - warmup) / F.lit(float(max(1, most - warmup)))
    cosine = least_share + 0.5 * (1 - least_share) * (1 + F.cos(F.lit(math.pi) * progress))
    return F.when(step == 0, F.lit(base)).when(step < warmup, base * (step / F.lit(float(max(1, warmup))))).otherwise(base * cosine)


def accumulation_group(step: Column, accumulate: int) -> Column:
    """Number of the optimiser step that micro-step belongs to, over all epochs."""
    return F.floor(step / accumulate).cast("long")
