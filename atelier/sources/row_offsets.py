"""Record i of a JSON-lines index by one seek: counts of valid records per block of bytes, kept beside the file.

A block is a split of the file as Spark reads it: the lines that begin after its first byte and up to its end (the first
block has the file's first line, too). The counts are made by one distributed pass; a lookup reads the counts up to the wanted block,
then that block's bytes, in any store that Spark reads. Counts go with the files' sizes and times and are made anew if those change.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from atelier.sources.index import parse_index
from atelier.sources.published import exists, place_of, remove

BLOCK = 4 << 20  # bytes
_STEP = 1 << 16  # bytes read at once after a block's end, for the line that runs over it


class RowOffsets:
    """Lookup of valid records by position, in the order of files and lines."""

    def __init__(self, spark: SparkSession, path: str, beside: str | None = None, block: int = BLOCK) -> None:
        self.spark, self.path, self.block, self.bytes_read = spark, path, block, 0
        self.beside = beside or f"{path.rstrip('/')}.rows"
        stamp = self._stamp()
        if exists(spark, self.beside):
            held = spark.read.parquet(self.beside)
            if held.filter(F.col("stamp") == stamp).isEmpty():
                remove(spark, self.beside)
        if not exists(spark, self.beside):
            self._count(stamp)
        self.blocks = spark.read.parquet(self.beside)
        self.n = self.blocks.agg(F.max(F.col("before") + F.col("n"))).first()[0] or 0

    def _files(self) -> list:
        place, store = place_of(self.spark, self.path)
        if not store.exists(place):
            raise FileNotFoundError(self.path)
        return [f for f in store.listStatus(place) if f.isFile() and not f.getPath().getName().startswith(("_", "."))]

    def _stamp(self) -> str:
        """Sizes and times of the files, as one number, and the block's size."""
        told = sorted(f"{f.getPath().getName()}:{f.getLen()}:{f.getModificationTime()}" for f in self._files())
        return hashlib.sha256("|".join([*told, str(self.block)]).encode()).hexdigest()

    def _count(self, stamp: str) -> None:
        """One row a block: how many valid records begin in it, and before it. Blocks number the input's bytes over ``block``; they are ranked by file."""
        setting = "spark.sql.files.maxPartitionBytes"
        before = self.spark.conf.get(setting)
        self.spark.conf.set(setting, str(self.block))
        try:
            lines = self.spark.read.text(self.path).select("value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
            counted = parse_index(lines).groupBy("file", "start").agg(F.count(F.lit(1)).alias("n"))
            files = counted.groupBy("file").agg(F.sum("n").alias("all"))
            upto = Window.orderBy("file").rowsBetween(Window.unboundedPreceding, -1)  # a row a file
            offsets = files.select("file", F.coalesce(F.sum("all").over(upto), F.lit(0)).alias("offset"))
            inside = F.coalesce(F.sum("n").over(Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
            placed = counted.withColumn("inside", inside).join(offsets, "file")
            placed.select("file", "start", "n", (F.col("offset") + F.col("inside")).alias("before"), F.lit(stamp).alias("stamp")).write.mode("overwrite").parquet(self.beside)
        finally:
            self.spark.conf.set(setting, before)

    def __len__(self) -> int:
        return self.n

    def row(self, i: int) -> Row:
        """Record i (from 0, or from the end if negative), as ``parse_index`` gives it; beyond either end an IndexError."""
        if not -self.n <= i < self.n:
            raise IndexError("row index out of range")
        i %= self.n
        b = self.blocks.filter((F.col("before") <= i) & (F.col("before") + F.col("n") > i)).first()
        lines = self._lines(b["file"], b["start"])
        held = self.spark.createDataFrame([(k, x) for k, x in enumerate(lines)], "k long, value string").coalesce(1)
        return parse_index(held).orderBy("k").drop("k").limit(i - b["before"] + 1).tail(1)[0]

    def _lines(self, file: str, start: int) -> list[str]:
        """The block's lines, by one seek."""
        place, store = place_of(self.spark, file)
        end = min(start + self.block, store.getFileStatus(place).getLen())
        stream, jvm = store.open(place), self.spark._jvm
        try:
            stream.seek(start)
            held = self._read(jvm, stream, end - start)
            # the line that begins at the end belongs to this block, too
            more = True
            while more:
                part = self._read(jvm, stream, _STEP)
                cut = part.find(b"\n")
                held += part[: cut + 1] if cut >= 0 else part
                more = cut < 0 and len(part) == _STEP
        finally:
            stream.close()
        text = held.decode("utf-8", "replace").replace("\r\n", "\n").replace("\r", "\n").split("\n")
        return text if not start else text[1:]

    def _read(self, jvm, stream, n: int) -> bytes:
        out = bytes(stream.readNBytes(n))
        self.bytes_read += len(out)
        return out
