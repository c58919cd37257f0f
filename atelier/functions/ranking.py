"""Positions in a global order, without one task sorting everything."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

BLOCK_ROWS = 250_000  # rows that one task sorts, about
CUT_ROWS = 500_000  # rows of a sample that cuts are taken from, at least
LEAST_BLOCKS, MOST_BLOCKS = 8, 4096  # of more rows than these hold, blocks grow; a task sorts them on disk


def blocks_of(rows: int) -> int:
    """Number of blocks for a table of so many rows."""
    return min(MOST_BLOCKS, max(LEAST_BLOCKS, -(-rows // BLOCK_ROWS)))


def quantile_cuts(df: DataFrame, key: str, blocks: int, rows: int | None = None) -> list:
    """Approximate quantiles that cut the rows into so many blocks (``blocks`` numbers reach the driver).

    Any cuts give right ranks, so with ``rows`` known a large table's are taken from a sample: else the
    sketches of all its tasks would meet in one.
    """
    held = df.select(key)
    share = max(CUT_ROWS, 100 * blocks) / max(rows or 1, 1)
    if share < 1:
        held = held.sample(share, seed=1)
    return sorted(set(held.select(F.percentile_approx(key, [i / blocks for i in range(1, blocks)], 10 * blocks)).first()[0] or []))


def block_of(key: Column, cuts: list) -> Column:
    """How many cuts are below the key: first among groups of cuts, then inside one, so a row meets about twice the root of them."""
    if not cuts:
        return F.lit(0)
    width = math.isqrt(len(cuts) - 1) + 1
    groups = [cuts[k : k + width] for k in range(0, len(cuts), width)]
    below = lambda edges: F.size(F.filter(edges, lambda c: c < key))
    if len(groups) == 1:
        return below(F.array(*[F.lit(c) for c in cuts]))
    group = below(F.array(*[F.lit(g[-1]) for g in groups]))
    inside = F.element_at(F.array(*[F.array(*[F.lit(c) for c in g]) for g in groups]), group + 1)
    return F.when(key > F.lit(cuts[-1]), F.lit(len(cuts))).otherwise(group * width + below(inside))


def blocks_by_quantile(df: DataFrame, key: str, blocks: int | None = None) -> Column:
    """Block number of a numeric key; as many blocks as the rows need, if their number is not given."""
    rows = df.count()
    return block_of(F.col(key), quantile_cuts(df, key, blocks or blocks_of(rows), rows))


def global_rank(df: DataFrame, block: Column, order: list[Column], name: str) -> DataFrame:
    """Rank from 0 in an order whose blocks, given by ``block``, follow each other."""
    dealt = df.withColumn("__block", block)
    counts = dealt.groupBy("__block").agg(F.count(F.lit(1)).alias("__n"))
    before = Window.orderBy("__block").rowsBetween(Window.unboundedPreceding, -1)  # over a count per block
    offsets = counts.select("__block", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    ranked = dealt.withColumn("__rn", F.row_number().over(Window.partitionBy("__block").orderBy(*order)))
    return ranked.join(offsets, "__block").withColumn(name, (F.col("__before") + F.col("__rn") - 1).cast("long")).drop("__block", "__before", "__rn")


def rank_by_key(df: DataFrame, key: str, name: str = "row_idx") -> DataFrame:
    return global_rank(df, blocks_by_quantile(df, key), [F.col(key)], name)


class KeyOrder:
    """Rows in the order of a numeric key, looked up by position: only the blocks that hold the wanted positions are ranked.

    Cuts and counts of the blocks are found once; the blocks' edges then filter the scan.
    """

    def __init__(self, df: DataFrame, key: str, blocks: int | None = None) -> None:
        self.df, self.key = df, key
        rows = df.count()
        self.cuts = quantile_cuts(df, key, blocks or blocks_of(rows), rows)
        found = {r["b"]: r["n"] for r in df.groupBy(block_of(F.col(key), self.cuts).alias("b")).agg(F.count(F.lit(1)).alias("n")).collect()}
        self.before = [0]
        for b in range(len(self.cuts) + 1):
            self.before.append(self.before[-1] + found.get(b, 0))

    def count(self) -> int:
        return self.before[-1]

    def between(self, start: int, length: int, name: str = "row_idx") -> DataFrame:
        """The rows at positions start .. start + length - 1, with their positions."""
        wanted = [b for b in range(len(self.cuts) + 1) if self.before[b] < start + length and self.before[b + 1] > start]
        low, high = (wanted[0], wanted[-1]) if wanted else (0, -1)
        k, inside = F.col(self.key), F.lit(bool(wanted))
        if wanted and low > 0:
            inside = inside & (k > F.lit(self.cuts[low - 1]))
        if wanted and high < len(self.cuts):
            inside = inside & (k <= F.lit(self.cuts[high]) if low > 0 else (k <= F.lit(self.cuts[high])) | k.isNull())
        ranked = global_rank(self.df.filter(inside), block_of(k, self.cuts), [k], name)
        return ranked.withColumn(name, F.col(name) + self.before[low]).filter(F.col(name).between(start, start + length - 1))


def rank_by_uniform(df: DataFrame, drawn: Column, tie: str, name: str, blocks: int | None = None) -> DataFrame:
    """Rank by numbers in [0, 1): a shuffle. Blocks are equal ranges, near equal in rows."""
    blocks = blocks or blocks_of(df.count())
    held = df.withColumn("__u", drawn)
    return global_rank(held, F.floor(F.col("__u") * blocks).cast("int"), [F.col("__u"), F.col(tie)], name).drop("__u")
