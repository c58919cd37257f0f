"""Arithmetic on arrays: scaling, quantising, layouts, noise and losses."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

# Latent scale factors, and the noise schedule's end points.
LATENT_SCALE = 0.18215
LATENT_SCALE_LARGE = 0.13025
STEPS, BETA_FIRST, BETA_LAST = 1000, 0.00085, 0.012


def _double(x: Column) -> Column:
    return x.cast("double")


def to_signed(a: Column) -> Column:
    """[0, 1] -> [-1, 1]."""
    return F.transform(a, lambda x: _double(x) * 2 - 1)


def scale(a: Column, factor: float = LATENT_SCALE) -> Column:
    return F.transform(a, lambda x: _double(x) * factor)


def unscale(a: Column, factor: float = LATENT_SCALE) -> Column:
    return F.transform(a, lambda x: _double(x) / factor)


def clamp(x: Column, low: float, high: float) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), x))


def quantize_unit(a: Column) -> Column:
    """[0, 1] -> 0..255, cut off."""
    return F.transform(a, lambda x: (clamp(_double(x), 0.0, 1.0) * 255).cast("int"))


def quantize_signed(a: Column) -> Column:
    """[-1, 1] -> 0..255, cut off."""
    return F.transform(a, lambda x: (clamp(_double(x) / 2 + 0.5, 0.0, 1.0) * 255).cast("int"))


def quantize_rounded(a: Column) -> Column:
    """[-1, 1] -> 0..255, rounded half to even."""
    return F.transform(a, lambda x: F.rint((clamp(_double(x), -1.0, 1.0) * 0.5 + 0.5) * 255).cast("int"))


def channels_last(a: Column, c: int, h: int, w: int) -> Column:
    """Channel, row, column order -> row, column, channel order."""
    return F.transform(F.sequence(F.lit(0), F.lit(c * h * w - 1)), lambda i: F.element_at(a, ((i % c) * (h * w) + F.floor(i / c) + 1).cast("int")))


def dropped_out(vector: Column, empty: Column, drawn: Column, p: float = 0.1) -> Column:
    """The unconditional vector with probability p, decided by a number in [0, 1)."""
    return F.when(drawn < p, empty).otherwise(vector)


def mean_square_error(a: Column, b: Column) -> Column:
    squares = F.zip_with(a, b, lambda x, y: (_double(x) - _double(y)) * (_double(x) - _double(y)))
    return F.aggregate(squares, F.lit(0.0), lambda s, x: s + x) / F.size(a)


def snr(alpha_bar: Column) -> Column:
    return alpha_bar / F.greatest(1 - alpha_bar, F.lit(1e-8))


def min_snr_weight(ratio: Column, gamma: float) -> Column:
    """1 for all where gamma is not positive."""
    return F.least(ratio, F.lit(gamma)) / (ratio + 1) if gamma > 0 else F.lit(1.0)


def noise_schedule(spark: SparkSession, steps: int = STEPS, first: float = BETA_FIRST, last: float = BETA_LAST) -> DataFrame:
    """(t, beta, alpha_bar): square roots of beta evenly spaced, alpha_bar the running product of 1 - beta."""
    root = F.lit(first**0.5) + F.col("t") * F.lit((last**0.5 - first**0.5) / (steps - 1))
    table = spark.range(steps).select(F.col("id").cast("int").alias("t")).withColumn("beta", root * root)
    w = Window.orderBy("t").rowsBetween(Window.unboundedPreceding, 0)  # a fixed, small number of rows
    return table.withColumn("alpha_bar", F.exp(F.sum(F.log(1 - F.col("beta"))).over(w)))


def add_noise(x: Column, noise: Column, alpha_bar: Column) -> Column:
    return F.zip_with(x, noise, lambda a, e: F.sqrt(alpha_bar) * _double(a) + F.sqrt(1 - alpha_bar) * _double(e))


def velocity(x: Column, noise: Column, alpha_bar: Column) -> Column:
    return F.zip_with(x, noise, lambda a, e: F.sqrt(alpha_bar) * _double(e) - F.sqrt(1 - alpha_bar) * _double(a))
