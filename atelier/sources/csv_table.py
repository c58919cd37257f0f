"""CSV catalogs: doubled quotes, line breaks in cells, strings only, rows of any length, positions kept.

A file is read by lines, in as many tasks as it has splits. Whether a line begins inside a quoted
cell depends on all lines before it, so a first pass tells for each split how it ends if it begins
outside and if it begins inside, and how many rows begin in it; a fold over the splits then gives
each its beginning and its rows' positions, and a second pass reads the rows. Only those rows that
run from one split into the next are put together by a shuffle.
"""

from __future__ import annotations

import csv
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from atelier.operators.catalog import Catalog
from atelier.sources.published import write_once

_SPLIT = "file string, start long, inside boolean, goes_on boolean, rows long, inside_goes_on boolean, inside_ended boolean, inside_rows long"
_ROW = "file string, start long, row_idx long, part long, text string, cells array<string>"


def ends_inside(line: str, inside: bool) -> bool:
    """Whether a quoted cell is open after the line; quotes open one only where a cell begins."""
    if '"' not in line:
        return inside
    at = 0
    while True:
        if not inside and line[at : at + 1] == '"':
            inside, at = True, at + 1
        if inside:
            at = line.find('"', at)
            while at >= 0 and line[at + 1 : at + 2] == '"':
                at = line.find('"', at + 2)
            if at < 0:
                return True
            inside = False
        at = line.find(",", at)
        if at < 0:
            return False
        at += 1


def cells_of(text: str) -> list[str]:
    """The cells of one row; a blank line has none."""
    csv.field_size_limit(2**31 - 1)
    return next(csv.reader(re.split("(?<=\n)", text)), [])  # other line ends are characters of a cell


def _lines(batch: pa.RecordBatch, encoding: str) -> Iterator[tuple[str, str, int]]:
    """(line, file, start of its split)"""
    return ((value.decode(encoding), file, start) for value, file, start in zip(*(batch.column(c).to_pylist() for c in ("value", "file", "start")), strict=True))


def _splits(batches: Iterator[pa.RecordBatch], encoding: str) -> Iterator[pa.RecordBatch]:
    """For each split: how it ends and how many rows begin in it, if it begins outside and inside a cell."""
    rows, now = [], None
    for batch in batches:
        for line, file, start in _lines(batch, encoding):
            if now is None or (file, start) != (now[0], now[1]):
                now = [file, start, False, False, 0, True, False, 0]
                rows.append(now)
            now[4] += not now[3]
            now[7] += not now[5]
            now[3] = ends_inside(line, now[3])
            now[5] = ends_inside(line, now[5])
            now[6] |= not now[5]
    names = [c.split()[0] for c in _SPLIT.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 8, (pa.string(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64(), pa.bool_(), pa.bool_(), pa.int64()), strict=True)], names=names)


def _begun(splits: list) -> dict[tuple[str, int], tuple[bool, int, tuple[int, int] | None]]:
    """(file, start) -> (inside, position of the first row that begins there, (split, position) of the row open at the beginning)."""
    out, inside, row, file, opened = {}, False, 0, None, None
    for s in sorted(splits, key=lambda s: (s["file"], s["start"])):
        if s["file"] != file:
            file, inside, opened = s["file"], False, None
        out[file, s["start"]] = (inside, row, opened if inside else None)
        row += s["inside_rows"] if inside else s["rows"]
        if not inside or s["inside_ended"]:
            opened = (s["start"], row - 1)  # the last row that begins here
        inside = s["inside_goes_on"] if inside else s["goes_on"]
    return out


def read_rows(spark: SparkSession, path: str, encoding: str = "utf-8") -> DataFrame:
    """(cells, row_idx): every row as it stands, blank ones too, in the order of files and lines.

    encoding: any of Python's in which line ends are single bytes, as in ASCII.
    """
    lines = spark.read.text(path).select(F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"))
    splits = lines.mapInArrow(lambda batches: _splits(batches, encoding), _SPLIT).collect()  # a row for each split of the input
    begun = _begun(splits)
    shared = spark.sparkContext.broadcast(begun)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, row, held, of, rows = None, False, 0, [], None, []

        def close(whole: bool) -> None:
            """A row that both begins and ends in this split is read here; of others, the part is kept."""
            nonlocal held
            if held:
                text = "\n".join(held)
                rows.append((now[0], of[0], of[1], now[1], None, cells_of(text)) if whole and of[0] == now[1] else (now[0], of[0], of[1], now[1], text, None))
            held = []

        def batch_of() -> pa.RecordBatch:
            types = (pa.string(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.list_(pa.string()))
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=["file", "start", "row_idx", "part", "text", "cells"])
            rows.clear()
            return out

        for batch in batches:
            for line, file, start in _lines(batch, encoding):
                if (file, start) != now:
                    close(not inside)
                    now = (file, start)
                    inside, row, of = shared.value[now]
                if not inside:
                    of, row = (start, row), row + 1
                held.append(line)
                inside = ends_inside(line, inside)
                if not inside:
                    close(True)
            if len(rows) > 2000:
                yield batch_of()
        close(False)
        if rows:
            yield batch_of()

    read = lines.mapInArrow(run, _ROW)
    whole = read.filter("cells is not null").select("cells", "row_idx")
    if not any(inside for inside, _, _ in begun.values()) and not any(s["goes_on"] or s["inside_goes_on"] for s in splits):
        return whole
    parts = read.filter("cells is null").groupBy("file", "row_idx").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("part", "text"))), lambda p: p["text"]), "\n").alias("text"))

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([cells_of(t) for t in batch.column("text").to_pylist()], pa.list_(pa.string())), batch.column("row_idx")], names=["cells", "row_idx"])

    return whole.unionByName(parts.select("text", "row_idx").mapInArrow(parse, "cells array<string>, row_idx long"))


def read_catalog(spark: SparkSession, path: str, encoding: str = "utf-8", has_header: bool = True) -> Catalog:
    """Width and names come from the first row; the others keep the cells they have."""
    rows = read_rows(spark, path, encoding)
    first = rows.filter("row_idx = 0").first()
    if first is None:
        raise StopIteration("empty file")
    if not has_header:
        return Catalog.of_cells(rows, [f"col{i}" for i in range(len(first["cells"]))])
    return Catalog.of_cells(rows.filter("row_idx > 0").withColumn("row_idx", F.col("row_idx") - 1), list(first["cells"]))


def append_rows(df: DataFrame, path: str) -> None:
    """Append to a headerless catalog."""
    df.write.mode("append").option("escape", '"').option("emptyValue", "").csv(path)


def append_rows_once(df: DataFrame, path: str, run: str) -> bool:
    """Append to a headerless catalog what one run has found, whole and once, however often the run is tried; False if it was there."""
    return write_once(df, path, "run", run, "csv", escape='"', emptyValue="")


def read_dictionary(spark: SparkSession, path: str) -> DataFrame:
    """(id, value, row_idx) of a headerless two-column file."""
    c = read_catalog(spark, path, has_header=False)
    bad = c.data().filter(F.size("cells") != 2).select(F.size("cells").alias("n")).first()
    if bad is not None:
        raise ValueError(f"2 cells a row are needed, {bad['n']} found")
    return c.data().select(F.col("col0").alias("id"), F.col("col1").alias("value"), "row_idx")


def read_captions(spark: SparkSession, path: str) -> DataFrame:
    """(path, caption, author, row_idx) by position; a missing cell is empty."""
    cell = lambda i: F.coalesce(F.try_element_at("cells", F.lit(i + 1)), F.lit(""))
    return read_catalog(spark, path).data().select(cell(0).alias("path"), cell(1).alias("caption"), cell(2).alias("author"), "row_idx")


def write_metrics(df: DataFrame, path: str, alpha: float, line: Column) -> None:
    """Metric series as text, its header naming alpha; the file is rewritten whole, in step order."""
    spark = df.sparkSession
    head = spark.createDataFrame([(-1, f"step,loss,loss_ema(alpha={alpha})")], "step long, value string")
    df.select("step", line.alias("value")).union(head).orderBy("step").select("value").write.mode("overwrite").text(path)
