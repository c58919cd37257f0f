"""Quality by compression: two zstandard dictionaries, one of good and one of bad labelled text.

A text's compressed size under the bad dictionary less that under the good one, per byte, tells
which language it is nearer to. A monotone fit on other labelled rows turns it into a probability,
with a fit of its own for short texts, whose differences scatter more.

Learning uses bounded samples (``SAMPLE`` rows per class for the dictionaries, ``CALIBRATION`` rows
for the fit, none of more than ``LONGEST`` characters) of labelled rows that are not held out;
scoring covers every whole text.

The labelled rows are found in one pass and written. Only the dictionaries' texts (of ``DICTIONARY``
bytes a class at most) come to the driver; of the calibration rows, only their differences do.

Defined results: a null text counts as empty; an empty text has difference 0 and the score of that;
repeated rows score alike, and of rows that repeat a labelled doc_id one is learnt from (its text the
smallest by hash); very long texts are scored whole; an empty table gives no rows; without labels of both classes every score is the share of label 1
(one half without any); only doc_id and text are read, and of the labels doc_id and quality.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.llm.common import materialise, pieces, release

SAMPLE = 1_500
CALIBRATION = 4_000
LONGEST = 50_000  # characters of a row to learn from; longer ones are not learnt from at all
DICTIONARY = 2_000_000  # bytes
LEVEL = 9
BANDS = (200, 500)  # bytes: texts below each are calibrated by themselves ...
BAND_ROWS = 60  # ... where so many labelled rows are
THRESHOLD = 0.3


def fold(doc_id: Column) -> Column:
    return F.pmod(F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")), F.lit(5))


class Compressors:
    """Sizes of texts under both dictionaries."""

    def __init__(self, good: bytes, bad: bytes, level: int = LEVEL) -> None:
        import zstandard as z

        self.pair = []
        for raw in (good, bad):
            dictionary = z.ZstdCompressionDict(raw, dict_type=z.DICT_TYPE_RAWCONTENT)
            dictionary.precompute_compress(level=level)
            self.pair.append(z.ZstdCompressor(level=level, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False))

    def difference(self, text: bytes) -> float:
        good, bad = (len(c.compress(text)) for c in self.pair)
        return (bad - good) / max(len(text), 1)


def monotone_fit(x: np.ndarray, y: np.ndarray) -> tuple[list[float], list[float]]:
    """Points (difference, probability) of the isotonic regression of y on x, shrunk a little to the share of ones.

    A pool of equal probability gives both of its ends, so only the gaps between pools are interpolated.
    """
    order = np.argsort(x, kind="stable")
    share = (y.sum() + 1) / (len(y) + 2)
    pools: list[tuple[float, float, float, float]] = []  # sum of y, weight, lowest x, highest x
    for xi, yi in zip(x[order].tolist(), y[order].tolist(), strict=True):
        now = (yi, 1.0, xi, xi)
        while pools and pools[-1][0] * now[1] >= now[0] * pools[-1][1]:
            before = pools.pop()
            now = (before[0] + now[0], before[1] + now[1], before[2], now[3])
        pools.append(now)
    value = [(p[0] + share) / (p[1] + 1) for p in pools]
    return [e for p in pools for e in p[2:]], [v for v in value for _ in (0, 1)]


class Model:
    """Dictionaries and the fitted curves by length; ``good`` is None if a class was missing."""

    def __init__(self, good: bytes | None, bad: bytes | None, curves: list[tuple[list[float], list[float]]]) -> None:
        self.good, self.bad, self.curves = good, bad, curves

    def scorer(self):
        if self.good is None:
            return lambda _: self.curves[0][1][0]
        sizes = Compressors(self.good, self.bad)
        return lambda text: float(np.clip(np.interp(sizes.difference(text), *self.curves[band(len(text))]), 0.0, 1.0))


def band(size: int) -> int:
    return sum(size >= b for b in BANDS)


def labelled_rows(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(h, quality, use, text) to learn from, at most 2 * SAMPLE + CALIBRATION: use 0 for dictionaries, 1 for calibration."""
    known = labels.filter("quality in (0, 1)").select("doc_id", F.col("quality").cast("int").alias("quality")).filter(fold(F.col("doc_id")) != 0)
    known = known.withColumn("h", F.xxhash64("doc_id", F.lit(6))).withColumn("half", F.pmod("h", F.lit(2)))
    part = lambda rows, n, use: rows.orderBy("h", "quality").limit(n).select("doc_id", "quality", "h", F.lit(use).alias("use"))
    sample = part(known.filter("half = 0 and quality = 1"), SAMPLE, 0).union(part(known.filter("half = 0 and quality = 0"), SAMPLE, 0)).union(part(known.filter("half = 1"), CALIBRATION, 1)).distinct()
    texts = docs.select("doc_id", "text").filter(F.length("text").between(1, LONGEST))
    found = texts.join(F.broadcast(sample), "doc_id")
    return found.groupBy("h", "quality", "use").agg(F.min(F.struct(F.xxhash64("text").alias("t"), "text"))["text"].alias("text"))


def fitting(rows: list, size: int = DICTIONARY) -> list[int]:
    """The h of whole texts in their order, as many as fit."""
    out, held = [], 0
    for r in rows:
        if held + r["n"] <= size:
            out.append(r["h"])
            held += r["n"] + 1
    return out


def fit(docs: DataFrame, labels: DataFrame) -> Model:
    """Learn from labelled rows that are not held out."""
    found = materialise(labelled_rows(docs, labels), "labelled")
    sizes = found.filter("use = 0").select("h", "quality", F.octet_length("text").alias("n")).orderBy("h").collect()
    chosen = {q: fitting([r for r in sizes if r["quality"] == q]) for q in (1, 0)}
    counts = found.agg(F.count(F.lit(1)).alias("n"), F.sum("quality").alias("ones"), F.count_if(F.col("use") == 1).alias("rest")).first()
    if not chosen[1] or not chosen[0] or not counts["rest"]:
        release(found)
        return Model(None, None, [([0.0], [((counts["ones"] or 0) + 1) / (counts["n"] + 2)])])
    kept = found.sparkSession.createDataFrame([(h, q) for q in chosen for h in chosen[q]], "h long, quality int")
    texts = found.filter("use = 0").join(F.broadcast(kept), ["h", "quality"]).orderBy("h").collect()
    g, b = (b"\n".join(r["text"].encode() for r in texts if r["quality"] == q) for q in (1, 0))
    shared = found.sparkSession.sparkContext.broadcast((g, b))

    def differences(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sizes = Compressors(*shared.value)
        for batch in batches:
            own = [t.encode() for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("h"), pa.array([sizes.difference(t) for t in own], pa.float64()), pa.array([len(t) for t in own], pa.int64()), batch.column("quality")], names=["h", "x", "n", "quality"])

    rest = found.filter("use = 1").select("h", "text", "quality").mapInArrow(differences, "h long, x double, n long, quality int").orderBy("h", "quality").collect()
    release(found)
    x, y = np.array([r["x"] for r in rest]), np.array([r["quality"] for r in rest], float)
    bands = np.array([band(r["n"]) for r in rest])
    rows = [bands == k if (bands == k).sum() >= BAND_ROWS else np.ones(len(x), bool) for k in range(len(BANDS) + 1)]
    return Model(g, b, [monotone_fit(x[r], y[r]) for r in rows])


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every whole text. Narrow: one pass, no shuffle."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = shared.value.scorer()
        for batch in batches:
            for part in pieces(batch, "text"):
                s = np.array([judge((t or "").encode()) for t in part.column("text").to_pylist()])
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), part.column("held_out"), pa.array(s, pa.float64()), pa.array((s >= THRESHOLD).astype(np.int32))], names=["doc_id", "held_out", "score", "predicted"]
                )

    return docs.select("doc_id", (fold(F.col("doc_id")) == 0).alias("held_out"), "text").mapInArrow(run, "doc_id long, held_out boolean, score double, predicted int")


def classify(docs: DataFrame, labels: DataFrame) -> DataFrame:
    return score(docs, fit(docs, labels))
