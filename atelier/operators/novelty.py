"""Novelty against a catalog of any size: Bloom filters first, so that only items that may be known are shuffled.

Keys fall into parts by hash, each with a filter of its own, a row of a small table. Tasks make the filters of their parts from the
catalog's keys once; keys that come later are added to those of their parts. Probing is a broadcast join on the part with bit tests in SQL
functions. All filters together have at most ``MOST_BYTES``: of a larger catalog they let more through, and the exact anti-join decides.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.sources.published import published, remove, write_once

PART_KEYS = 500_000  # keys of a part, about
KEY_BITS = 12  # of a filter for each key, as long as ``MOST_BYTES`` allow
MOST_BYTES = 64 << 20
_LOW = (1 << 31) - 1
ROW = "part int, hashes int, bits array<long>"


def _hashed(key: str, parts: int) -> list[Column]:
    """(part, a, b) of a key: bit i of the filter is (a + i * b) modulo its size."""
    h = F.xxhash64(key)
    return [F.pmod(F.shiftrightunsigned(h, 33), F.lit(parts)).cast("int").alias("part"), h.bitwiseAND(F.lit(_LOW)).alias("a"), F.xxhash64(F.lit("b"), key).bitwiseAND(F.lit(_LOW)).bitwiseOR(F.lit(1)).alias("b")]


class KnownKeys:
    """Filters of the keys seen so far, in versions that are published whole."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def build(cls, keys: DataFrame, key: str, path: str, expected: int | None = None, most_bytes: int = MOST_BYTES) -> KnownKeys:
        """From a catalog's keys; ``expected``: how many there will be, if more than now."""
        out = cls(keys.sparkSession, path)
        n = max(1, expected or 0, keys.count())
        parts = max(1, -(-n // PART_KEYS))
        words = 1 << max(4, math.ceil(math.log2(n / parts * KEY_BITS / 64)))  # of 64 bits; a power of two
        while words > 1 and words * 8 * parts > most_bytes:
            words //= 2
        hashes = max(1, min(8, round(0.69 * words * 64 * parts / n)))
        out._write(keys, key, parts, words, hashes, None, 0)
        return out

    def version(self) -> int:
        found = published(self.spark, self.path, "version")
        if not found:
            raise FileNotFoundError(self.path)
        return max(map(int, found))

    def filters(self) -> DataFrame:
        """(part, hashes, bits): a row for each part."""
        return self.spark.read.schema(ROW).parquet(f"{self.path}/version={self.version()}")

    def add(self, keys: DataFrame, key: str) -> None:
        """Keys that the catalog has got: their bits are set in a new version; the last but one goes."""
        version, held = self.version(), self.filters()
        sizes = held.agg(F.count(F.lit(1)), F.max(F.size("bits")), F.max("hashes")).first()
        self._write(keys, key, *sizes, held, version + 1)
        remove(self.spark, f"{self.path}/version={version - 1}")

    def _write(self, keys: DataFrame, key: str, parts: int, words: int, hashes: int, before: DataFrame | None, version: int) -> None:
        empty = self.spark.range(parts).select(F.col("id").cast("int").alias("part"), F.array().cast("array<long>").alias("bits"), F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
        old = empty if before is None else before.select("part", "bits", F.lit(0).cast("long").alias("a"), F.lit(0).cast("long").alias("b"))
        hashed = keys.filter(F.col(key).isNotNull()).select(*_hashed(key, parts)).select("part", F.lit(None).cast("array<long>").alias("bits"), "a", "b")
        dealt = old.union(hashed).repartition("part").sortWithinPartitions("part")

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            """One part after the other: a fixed number of bits each, whatever its keys."""
            now, bits = None, np.zeros(words * 64, bool)

            def full() -> pa.RecordBatch:
                held = np.packbits(bits, bitorder="little").view(np.int64)
                return pa.RecordBatch.from_arrays([pa.array([now], pa.int32()), pa.array([hashes], pa.int32()), pa.array([held], pa.list_(pa.int64()))], names=["part", "hashes", "bits"])

            for batch in batches:
                part, a, b = (batch.column(c).to_numpy() for c in ("part", "a", "b"))
                old = batch.column("bits")
                edges = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)) if len(part) else np.zeros(1, int)
                for low, high in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
                    if part[low] != now:
                        if now is not None:
                            yield full()
                        now = int(part[low])
                        bits[:] = False
                    known = old.slice(low, high - low).is_valid().to_numpy(zero_copy_only=False)
                    for k in np.flatnonzero(known).tolist():
                        values = old[low + k].values.to_numpy()
                        if len(values):
                            bits |= np.unpackbits(values.view(np.uint8), bitorder="little").astype(bool)
                    x, y = a[low:high][~known], b[low:high][~known]
                    for i in range(hashes):
                        bits[(x + i * y) % len(bits)] = True
            if now is not None:
                yield full()

        write_once(dealt.mapInArrow(run, ROW), self.path, "version", version)

    def split(self, items: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
        """(items that may be known, items that are surely new); each is one narrow pass over ``items``."""
        filters = self.filters()
        parts = filters.count()
        part, a, b = _hashed(key, parts)
        held = filters.select(F.col("part").alias("__part"), F.col("hashes").alias("__hashes"), F.col("bits").alias("__bits"))
        placed = items.withColumns({"__of": part, "__a": a, "__b": b})

        def bit(i: Column) -> Column:
            at = (F.col("__a") + i * F.col("__b")) % (F.size("__bits") * F.lit(64))
            word = F.get("__bits", F.shiftright(at, 6).cast("int"))
            return F.getbit(word, (at % 64).cast("int")) == 1

        may = F.col(key).isNotNull() & F.forall(F.sequence(F.lit(0), F.col("__hashes") - 1), bit)
        on = (F.col("__of") == F.col("__part")) & may
        small = F.broadcast(held)  # ``MOST_BYTES`` at most
        return placed.join(small, on, "left_semi").select(*items.columns), placed.join(small, on, "left_anti").select(*items.columns)


def new_items_filtered(items: DataFrame, catalog: DataFrame, key: str, known: KnownKeys) -> DataFrame:
    """Items that the catalog lacks, as ``listing.new_items`` gives them; ``known`` must hold the catalog's keys."""
    maybe, new = known.split(items, key)
    return new.unionByName(maybe.join(catalog.select(key).distinct(), key, "left_anti").select(*items.columns))
