"""NumPy array files: read into (path, shape, data), written from it. Models plug in between."""

from __future__ import annotations

import io
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ARRAYS = "path string, name string, shape array<int>, data array<float>"


def decode(content: bytes, path: str) -> list[tuple[str, str, list[int], list[float]]]:
    """Arrays of one .npy or .npz file; pickled objects are refused, text members are skipped."""
    loaded = np.load(io.BytesIO(content), allow_pickle=False)
    members = {"": loaded} if isinstance(loaded, np.ndarray) else {k: loaded[k] for k in loaded.files}
    return [(path, k, list(a.shape), a.astype(np.float32).ravel().tolist()) for k, a in members.items() if a.dtype.kind in "fiu"]


def encode(shape: list[int], data: list[float], half: bool = False) -> bytes:
    out = io.BytesIO()
    np.save(out, np.array(data, np.float16 if half else np.float32).reshape(shape))
    return out.getvalue()


def read_arrays(spark: SparkSession, path: str) -> DataFrame:
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.np[yz]").option("recursiveFileLookup", "true").load(path).select("path", "content")

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame([r for c, p in zip(f["content"], f["path"], strict=True) for r in decode(c, p)], columns=["path", "name", "shape", "data"])

    return files.mapInPandas(run, ARRAYS)


def with_bytes(df: DataFrame, half: bool = False) -> DataFrame:
    """(path, shape, data) -> (path, content) ready for a file sink."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            yield pd.DataFrame({"path": f["path"], "content": [encode(list(s), list(d), half) for s, d in zip(f["shape"], f["data"], strict=True)]})

    return df.select("path", "shape", "data").mapInPandas(run, "path string, content binary")


def apply_model(df: DataFrame, model: Callable[[list[int], np.ndarray], np.ndarray]) -> DataFrame:
    """Plug point of encoders, decoders and taggers: an array in, an array out; a failing row has a status."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            rows = []
            for path, shape, data in zip(f["path"], f["shape"], f["data"], strict=True):
                try:
                    a = np.asarray(model(list(shape), np.asarray(data, np.float32).reshape(shape)), np.float32)
                    rows.append((path, list(a.shape), a.ravel().tolist(), "ok"))
                except Exception as e:  # noqa: BLE001  one bad record must not end the run
                    rows.append((path, None, None, str(e)))
            yield pd.DataFrame(rows, columns=["path", "shape", "data", "status"])

    return df.select("path", "shape", "data").mapInPandas(run, "path string, shape array<int>, data array<float>, status string")


def roundtrip(df: DataFrame, key: str, vector: str) -> DataFrame:
    """Arrays through their file form and back."""

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for f in frames:
            back = [decode(encode([len(v)], list(v)), "")[0][3] for v in f[vector]]
            yield pd.DataFrame({key: f[key], "n": [len(b) for b in back], "same": [bool(np.array_equal(np.asarray(b, np.float32), v)) for b, v in zip(back, f[vector], strict=True)]})

    return df.select(F.col(key), F.col(vector)).mapInPandas(run, f"{key} long, n long, same boolean")
