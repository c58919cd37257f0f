"""String rules: white space, fixed decimals, and numbers drawn from hashes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip(c: Column) -> Column:
    """White space of any script off both ends (``trim`` only takes spaces)."""
    return F.regexp_replace(c, r"(?U)^\s+|\s+$", "")


def or_empty(c: Column) -> Column:
    """Catalog cells are never null."""
    return F.coalesce(c, F.lit(""))


def fixed(c: Column, digits: int) -> Column:
    """A number with so many decimals and no thousands' marks, rounded half-even on its exact value."""
    return F.replace(F.format_number(c.cast("double"), digits), F.lit(","), F.lit(""))


def uniform(key: Column, seed: int) -> Column:
    """Reproducible number in [0, 1) from a key: 52 bits of a SHA-1, the same under any partitioning."""
    digest = F.sha1(F.concat(key.cast("string"), F.lit(f":{seed}")).cast("binary"))
    return F.conv(F.substring(digest, 1, 13), 16, 10).cast("double") / F.lit(float(2**52))
