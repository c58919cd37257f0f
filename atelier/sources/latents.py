"""Indexes with their array files as a data source of Spark: format ``latents``.

A folder holds index lines (JSON objects with npz, src, caption, author) and the ``.npz`` archives they name. The index is
read in ranges of bytes, each a task, so one archive's members are read by as many tasks as its lines are in ranges. What is not asked
for is not read: without array columns no archive is opened, a shape needs a member's header only, and filters on
text columns that Spark hands over are applied to the lines before any archive is opened.

Columns: the four texts; for an array ``x``, ``x`` (its numbers, flat) and ``x_shape``; and ``error``, which says why a record's arrays are null.
Lines count as in ``index.parse_index``. A line with ``member`` names the record's part of a shared archive: its ``x`` is ``<member>.x``.

Paths are those of stores that Arrow reads on each executor (file, hdfs, s3, gs).
"""

from __future__ import annotations

import io
import json
import os
import uuid
import zipfile
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, DataSourceReader, EqualTo, Filter, In, InputPartition, IsNotNull, StringContains, StringEndsWith, StringStartsWith, WriterCommitMessage
from pyspark.sql.types import ArrayType, StructType

TEXTS = ("npz", "src", "caption", "author")
RANGE = 8 << 20  # bytes of index lines that a task reads
OPEN = 8  # archives that a task keeps open
BATCH = 256  # records of an Arrow batch
SCHEMA = "npz string, src string, caption string, author string, latent array<float>, latent_shape array<int>"


def _store(path: str) -> tuple[fs.FileSystem, str]:
    if path.startswith("file:") and "://" not in path:  # as Hadoop writes local paths
        path = path.removeprefix("file:")
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("/") else os.path.abspath(path))


@dataclass
class LineRange(InputPartition):
    """Lines of a file that begin in [start, end)."""

    path: str
    start: int
    end: int


def ranges(path: str, size: int) -> list[LineRange]:
    """Ranges of all index files of a folder, or of one file."""
    store, place = _store(path)
    info = store.get_file_info(place)
    if info.type == fs.FileType.NotFound:
        raise FileNotFoundError(path)
    files = [info] if info.type == fs.FileType.File else [f for f in store.get_file_info(fs.FileSelector(place, recursive=True)) if f.type == fs.FileType.File and f.base_name.endswith(".jsonl")]
    return [LineRange(f.path, a, min(a + size, f.size)) for f in sorted(files, key=lambda f: f.path) for a in range(0, f.size, size)]


def lines_of(store: fs.FileSystem, part: LineRange) -> Iterator[bytes]:
    """Whole lines that begin in the range; the last may end after it."""
    with store.open_input_file(part.path) as f:
        at = part.start
        if at:
            f.seek(at - 1)
            at += len(_line(f)) - 1  # the line before the first one of this range
        while at < part.end:
            f.seek(at)
            line = _line(f)
            at += len(line)
            yield line


def _line(f, step: int = 1 << 14) -> bytes:
    """From the file's place to the end of the line, in small reads."""
    held = b""
    while True:
        part = f.read(step)
        cut = part.find(b"\n")
        if cut >= 0 or len(part) < step:
            return held + (part[: cut + 1] if cut >= 0 else part)
        held += part


def record_of(line: bytes) -> dict | None:
    """Texts of a valid line with an archive: absent ones are empty, explicit nulls stay null."""
    try:
        found = json.loads(line)
    except ValueError:
        return None
    if not isinstance(found, dict) or found.get("npz") is None:
        return None
    plain = lambda v: v if v is None or isinstance(v, str) else json.dumps(v, separators=(",", ":"))
    return {c: plain(found[c]) if c in found else "" for c in (*TEXTS, "member")}


_TESTS = {
    EqualTo: lambda v, f: v == f.value,
    In: lambda v, f: v in f.value,
    StringStartsWith: lambda v, f: v.startswith(f.value),
    StringEndsWith: lambda v, f: v.endswith(f.value),
    StringContains: lambda v, f: f.value in v,
    IsNotNull: lambda v, f: True,
}


class Archives:
    """Open archives of a folder, the last ``OPEN`` used."""

    def __init__(self, path: str) -> None:
        self.store, self.place = _store(path)
        self.held: dict[str, zipfile.ZipFile] = {}

    def of(self, name: str) -> zipfile.ZipFile:
        found = self.held.pop(name, None)
        if found is None:
            file = self.store.open_input_file(f"{self.place}/{name}")
            try:
                found = zipfile.ZipFile(file)
            except pa.ArrowInvalid:  # too short to look for a directory in
                raise zipfile.BadZipFile("File is not a zip file") from None
        self.held[name] = found
        while len(self.held) > OPEN:
            self.held.pop(next(iter(self.held))).close()
        return found

    def array(self, name: str, member: str, shape_only: bool) -> tuple[list[int], np.ndarray | None]:
        with self.of(name).open(f"{member}.npy") as f:
            version = np.lib.format.read_magic(f)
            shape, fortran, dtype = (np.lib.format.read_array_header_1_0 if version == (1, 0) else np.lib.format.read_array_header_2_0)(f)
            if dtype.kind not in "fiub":
                raise ValueError(f"{member} holds no numbers")
            if shape_only:
                return list(shape), None
            flat = np.frombuffer(f.read(), dtype)
            return list(shape), (flat.reshape(shape, order="F").ravel() if fortran else flat)


class LatentReader(DataSourceReader):
    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.columns, self.options = schema, options
        self.tests: list[Filter] = []

    def pushFilters(self, filters: list[Filter]) -> Iterable[Filter]:
        """Those on texts are applied here, the rest by Spark."""
        for f in filters:
            if type(f) in _TESTS and len(f.attribute) == 1 and f.attribute[0] in TEXTS:
                self.tests.append(f)
            else:
                yield f

    def partitions(self) -> Sequence[InputPartition]:
        return ranges(self.options["path"], int(self.options.get("rangebytes", RANGE)))

    def read(self, part: LineRange) -> Iterator[pa.RecordBatch]:
        store, _ = _store(self.options["path"])
        archives = Archives(self.options.get("arrays", self.options["path"]))
        names = [f.name for f in self.columns]
        arrays = {f.name for f in self.columns if isinstance(f.dataType, ArrayType)}
        shapes = {n for n in arrays if n.endswith("_shape")}
        kinds = {n: pa.list_(pa.int32()) if n in shapes else pa.list_(pa.float32()) if n in arrays else pa.string() for n in names}
        rows: list[dict] = []

        def batch() -> pa.RecordBatch:
            out = pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in rows], kinds[n]) for n in names], names=names)
            rows.clear()
            return out

        for line in lines_of(store, part):
            row = record_of(line)
            if row is None or not all((v := row[f.attribute[0]]) is not None and _TESTS[type(f)](v, f) for f in self.tests):
                continue
            lead = f"{row['member']}." if row["member"] else ""
            for n in {n.removesuffix("_shape") for n in arrays}:
                try:
                    shape, flat = archives.array(row["npz"], lead + n, n not in arrays)
                    row |= {f"{n}_shape": shape, n: None if flat is None else flat.astype(np.float32)}
                except (OSError, KeyError, ValueError, zipfile.BadZipFile) as e:  # one bad record must not end the run
                    row["error"] = f"{type(e).__name__}: {e}"
            rows.append(row)
            if len(rows) == BATCH:
                yield batch()
        if rows:
            yield batch()


@dataclass
class Written(WriterCommitMessage):
    """Names of a task's staged index part, if it had rows."""

    part: str | None


class LatentWriter(DataSourceArrowWriter):
    """One archive and one index part a task. A part is seen once the job has committed: parts of failed tasks stay hidden."""

    def __init__(self, schema: StructType, options: dict[str, str]) -> None:
        self.names = [f.name for f in schema]
        self.arrays = [f.name for f in schema if isinstance(f.dataType, ArrayType) and not f.name.endswith("_shape")]
        self.path, self.half = options["path"], options.get("half", "false") == "true"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> WriterCommitMessage:
        store, place = _store(self.path)
        name, lines, members = f"part-{uuid.uuid4().hex}", io.BytesIO(), 0
        store.create_dir(place, recursive=True)
        with store.open_output_stream(f"{place}/{name}.npz") as raw, zipfile.ZipFile(raw, "w", zipfile.ZIP_STORED, allowZip64=True) as archive:
            for batch in iterator:
                for row in batch.to_pylist():
                    for a in self.arrays:
                        if row[a] is not None:
                            flat = np.array(row[a], np.float16 if self.half else np.float32)
                            held = io.BytesIO()
                            np.save(held, flat.reshape(row.get(f"{a}_shape") or [len(flat)]))
                            archive.writestr(f"{members}.{a}.npy", held.getvalue())
                    line = {"npz": f"{name}.npz"} | {c: row[c] for c in TEXTS[1:] if c in row} | {"member": str(members)}
                    lines.write(json.dumps(line, ensure_ascii=False).encode() + b"\n")
                    members += 1
        if not members:
            store.delete_file(f"{place}/{name}.npz")
            return Written(None)
        with store.open_output_stream(f"{place}/{name}.staged") as f:
            f.write(lines.getvalue())
        return Written(name)

    def commit(self, messages: list[WriterCommitMessage | None]) -> None:
        store, place = _store(self.path)
        for m in messages:
            if m is not None and m.part:
                store.move(f"{place}/{m.part}.staged", f"{place}/{m.part}.jsonl")

    def abort(self, messages: list[WriterCommitMessage | None]) -> None:
        store, place = _store(self.path)
        for m in messages:
            if m is not None and m.part:
                store.delete_file(f"{place}/{m.part}.staged")
                store.delete_file(f"{place}/{m.part}.npz")


class LatentSource(DataSource):
    @classmethod
    def name(cls) -> str:
        return "latents"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema: StructType) -> DataSourceReader:
        return LatentReader(schema, self.options)

    def writer(self, schema: StructType, overwrite: bool) -> DataSourceArrowWriter:
        return LatentWriter(schema, self.options)


def _registered(spark: SparkSession) -> SparkSession:
    spark.dataSource.register(LatentSource)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark


def read_latents(spark: SparkSession, path: str, columns: str = SCHEMA, arrays: str | None = None, range_bytes: int = RANGE) -> DataFrame:
    """Records with the columns asked for; nothing else is decoded. ``arrays``: the archives' folder, if it is not the index's."""
    reader = _registered(spark).read.format("latents").schema(columns).option("rangebytes", range_bytes)
    return (reader.option("arrays", arrays) if arrays else reader).load(path)


def write_latents(df: DataFrame, path: str, half: bool = False) -> None:
    """Appends records (src, caption, author and array columns, with their shapes if they have more than one dimension)."""
    _registered(df.sparkSession)
    df.write.format("latents").mode("append").option("half", str(half).lower()).save(path)
