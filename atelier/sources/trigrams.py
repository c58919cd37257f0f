"""Substring lookup without a scan: an inverted index from three-byte sequences to the rows that hold them.

Rows are stored as they come, in blocks of 4096. For each block the index lists, for every trigram of UTF-8 bytes, the block's rows with
it; it is sorted by trigram, so a lookup reads the row groups with the needle's trigrams, intersects their lists block by block,
reads the blocks that are left, and checks their cells exactly. Each text ends in two zero bytes, so needles of one and two bytes
are beginnings of trigrams. The empty needle is in every cell. Null cells hold nothing.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.operators.catalog import contains

BITS = 12  # log2 of the rows of a block
SOME = 2_000  # blocks that a scan is told by number; more are found by a join
PIECE = 1 << 20  # bytes of a text whose trigrams are taken at once


def trigrams(text: bytes) -> np.ndarray:
    """The different trigrams of a text and its two closing zeros, as numbers."""
    found = np.zeros(0, np.int64)
    for at in range(0, max(len(text), 1), PIECE):
        x = np.frombuffer(text[at : at + PIECE + 2] + (b"\0\0" if at + PIECE + 2 >= len(text) + 2 else b""), np.uint8).astype(np.int64)
        if len(x) > 2:
            found = np.union1d(found, x[:-2] << 16 | x[1:-1] << 8 | x[2:])
    return found


class TrigramIndex:
    def __init__(self, spark: SparkSession, path: str, column: str) -> None:
        self.spark, self.column = spark, column
        self.rows, self.lists = f"{path}/rows", f"{path}/lists"

    @classmethod
    def build(cls, df: DataFrame, path: str, column: str) -> TrigramIndex:
        """Writes rows and lists. A block's lists are made where it is read, a text at a time."""
        out = cls(df.sparkSession, path, column)
        at = F.monotonically_increasing_id()
        df.withColumn("__at", at).withColumns({"__block": F.shiftright("__at", BITS), "__at": F.col("__at").bitwiseAND(F.lit((1 << BITS) - 1)).cast("int")}).write.parquet(out.rows)

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            now, held = None, {}

            def lists() -> pa.RecordBatch:
                keys = sorted(held)
                return pa.RecordBatch.from_arrays([pa.array(keys, pa.int32()), pa.array([now] * len(keys), pa.int64()), pa.array([held[k] for k in keys], pa.list_(pa.int32()))], names=["trigram", "block", "rows"])

            for batch in batches:
                for block, row, text in zip(*(batch.column(c).to_pylist() for c in ("__block", "__at", "text")), strict=True):
                    if block != now:
                        if held:
                            yield lists()
                        now, held = block, {}
                    for t in trigrams(text).tolist():
                        held.setdefault(t, []).append(row)
            if held:
                yield lists()

        stored = out.spark.read.parquet(out.rows).filter(F.col(column).isNotNull())
        listed = stored.select("__block", "__at", F.col(column).cast("binary").alias("text")).mapInArrow(run, "trigram int, block long, rows array<int>")
        listed.repartitionByRange("trigram", "block").sortWithinPartitions("trigram", "block").write.option("parquet.block.size", 4 << 20).parquet(out.lists)
        return out

    def candidates(self, needle: str) -> DataFrame:
        """(block, rows) that hold all trigrams of a needle of one byte or more."""
        raw = needle.encode()
        lists = self.spark.read.parquet(self.lists)
        if len(raw) < 3:
            low = int.from_bytes(raw.ljust(3, b"\0"), "big")
            inside = lists.filter(F.col("trigram").between(low, low + (1 << 8 * (3 - len(raw))) - 1))
            return inside.groupBy("block").agg(F.array_distinct(F.flatten(F.collect_list("rows"))).alias("rows"))
        own = np.frombuffer(raw, np.uint8).astype(np.int64)
        wanted = sorted(set((own[:-2] << 16 | own[1:-1] << 8 | own[2:]).tolist()))
        # a split may cut a block: its parts' lists of a trigram are put together first
        one = lists.filter(F.col("trigram").isin(wanted)).groupBy("block", "trigram").agg(F.flatten(F.collect_list("rows")).alias("rows"))
        both = one.groupBy("block").agg(F.collect_list("rows").alias("lists")).filter(F.size("lists") == len(wanted))
        met = F.aggregate(F.slice("lists", 2, len(wanted)), F.element_at("lists", 1), lambda a, b: F.array_intersect(a, b))
        return both.select("block", met.alias("rows")).filter(F.size("rows") > 0)

    def find(self, needle: str) -> DataFrame:
        """The rows whose cell holds the needle, as a scan would give them."""
        rows = self.spark.read.parquet(self.rows)
        exact = contains(F.col(self.column), needle)
        if not needle:
            return rows.filter(exact).drop("__block", "__at")
        near = self.candidates(needle)
        blocks = [r["block"] for r in near.select("block").limit(SOME + 1).collect()]
        if len(blocks) <= SOME:  # numbers in the scan's filter: other row groups are not read
            rows = rows.filter(F.col("__block").isin(blocks)) if blocks else rows.filter("false")
        placed = near.select(F.col("block").alias("__block"), F.explode("rows").alias("__at"))
        return rows.join(placed, ["__block", "__at"], "left_semi").filter(exact).drop("__block", "__at")

    def blocks_read(self, needle: str) -> tuple[int, int]:
        """How many blocks a lookup reads, of how many."""
        every = self.spark.read.parquet(self.rows).select("__block").distinct().count()
        return (self.candidates(needle).count() if needle else every), every
