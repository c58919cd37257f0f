"""Scores of the compression classifier, recomputed for all rows from zstandard and an isotonic fit by its minimax formula."""

import fractions
import struct
import zlib

import pytest
import xxhash
import zstandard

from atelier.llm import zstd_quality

SF = "/root/testdata/sf0.001"


def signed(h):
    return h - (1 << 64) if h >= 1 << 63 else h


def brute_fit(points):
    """(x, value) ends of the pools of equal means: at i the largest over starts of the least over ends of the mean between."""
    points = sorted(points, key=lambda p: p[0])
    y = [fractions.Fraction(int(p[1])) for p in points]
    n = len(y)
    sums = [fractions.Fraction(0)]
    for v in y:
        sums.append(sums[-1] + v)
    fit = [max(min((sums[k + 1] - sums[j]) / (k + 1 - j) for k in range(i, n)) for j in range(i + 1)) for i in range(n)]
    share = (sums[-1] + 1) / (n + 2)
    out, low = [], 0
    for i in range(n):
        if i + 1 == n or fit[i + 1] != fit[i]:
            value = float((sums[i + 1] - sums[low] + share) / (i + 1 - low + 1))
            out += [(points[low][0], value), (points[i][0], value)]
            low = i + 1
    return out


def at(curve, x):
    if x <= curve[0][0]:
        return curve[0][1]
    for (x0, v0), (x1, v1) in zip(curve[:-1], curve[1:], strict=True):
        if x0 <= x <= x1 and x1 > x0:
            return v1 if x == x1 else v0 + (v1 - v0) * (x - x0) / (x1 - x0)
    return curve[-1][1]


def brute_scores(docs, labels):
    known = set()
    for d, q in labels:
        if q in (0, 1) and d is not None and zlib.crc32(str(d).encode()) % 5:
            h = signed(xxhash.xxh64_intdigest(struct.pack("<i", 6), xxhash.xxh64_intdigest(struct.pack("<q", d), 42)))
            known.add((h, q, d))
    uses = {0: [r for q in (1, 0) for r in sorted(x for x in known if x[0] % 2 == 0 and x[1] == q)[: zstd_quality.SAMPLE]], 1: sorted(x for x in known if x[0] % 2)[: zstd_quality.CALIBRATION]}
    text = {}
    for d, t in docs:
        if d is not None and t and len(t) <= zstd_quality.LONGEST:
            key = (signed(xxhash.xxh64_intdigest(t.encode(), 42)), t)
            text[d] = min(text.get(d, key), key)
    sides = {}
    for q in (1, 0):
        held, size = [], 0
        for _, _, d in (r for r in uses[0] if r[1] == q and r[2] in text):
            raw = text[d][1].encode()
            if size + len(raw) <= zstd_quality.DICTIONARY:
                held.append(raw)
                size += len(raw) + 1
        dictionary = zstandard.ZstdCompressionDict(b"\n".join(held), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        sides[q] = zstandard.ZstdCompressor(level=zstd_quality.LEVEL, dict_data=dictionary, write_content_size=False, write_checksum=False, write_dict_id=False)
    difference = lambda raw: (len(sides[0].compress(raw)) - len(sides[1].compress(raw))) / max(len(raw), 1)
    rest = [(text[d][1].encode(), q) for _, q, d in uses[1] if d in text]
    curves = []
    for k in range(3):
        own = [r for r in rest if sum(len(r[0]) >= b for b in zstd_quality.BANDS) == k]
        curves.append(brute_fit([(difference(raw), q) for raw, q in (own if len(own) >= zstd_quality.BAND_ROWS else rest)]))
    return [(d, zlib.crc32(("" if d is None else str(d)).encode()) % 5 == 0, at(curves[sum(len((t or "").encode()) >= b for b in zstd_quality.BANDS)], difference((t or "").encode()))) for d, t in docs]


@pytest.mark.parametrize("band_rows", [60, 5])
def test_scores_of_all_rows(spark, monkeypatch, band_rows):
    """Labels of both classes for one id, labels and ids that are null, repeated rows and labels, empty, null and odd texts."""
    monkeypatch.setattr(zstd_quality, "BAND_ROWS", band_rows)
    docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    labels = [(r["doc_id"], r["quality"]) for r in spark.read.parquet(f"{SF}/labels.parquet").collect()]
    docs += [(None, "no id at all"), (10**9, ""), (10**9 + 1, None), (10**9 + 2, "\U0001f600 " * 40), docs[3], docs[3], (docs[5][0], "another text of one id")]
    first = [d for d, _ in labels[:8]]
    labels += [(first[0], 1), (first[0], 0), (first[1], 0), (first[1], 1), (None, 1), (None, 0), (first[2], None), (first[3], 7), labels[4], (10**9, 1), (10**9 + 1, 0), (10**9 + 2, 0)]
    got = zstd_quality.classify(spark.createDataFrame(docs, "doc_id long, text string").repartition(3), spark.createDataFrame(labels, "doc_id long, quality int")).collect()
    key = lambda r: (r[0] is not None, r[0] or 0, round(r[2], 9))
    got = sorted(((r["doc_id"], r["held_out"], r["score"], r["predicted"]) for r in got), key=key)
    want = sorted(brute_scores(docs, labels), key=key)
    assert len(got) == len(want)
    for a, b in zip(got, want, strict=True):
        assert a[:2] == b[:2] and abs(a[2] - b[2]) < 1e-9 and 0 <= a[2] <= 1 and a[3] == (a[2] >= 0.3)
    assert len({round(r[2], 9) for r in got}) > 3
