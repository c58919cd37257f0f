"""Packing by optimal length buckets.

Lengths in tokens are counted once per text. Over the histogram of all padded lengths a dynamic
programme chooses the bucket bounds that minimise padding; inside each bucket, rows form batches
of at most a token budget.

Only the histogram comes to the driver: one number per distinct length, at most the longest text's
tokens divided by ``MULTIPLE``. Slots in a bucket are dealt in blocks, so no task holds a bucket.

Defined results: a null or empty text has length 1 (its end token); a long text is counted whole, and
in a time in line with its length, whatever it holds; rows longer than the budget
are alone in their batch; equal lengths always share a bucket; repeated rows keep a place each; an
empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import base64
import re
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.llm.common import group_rank, materialise, pieces

VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
# Fixed value: how this public vocabulary's texts are cut before merging.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
BUCKETS = 16
BUDGET = 65_536  # tokens of a batch, padding included
MULTIPLE = 8  # lengths are padded to multiples of it at least
BLOCK_ROWS = 500_000  # rows of a block within which a bucket's slots are dealt
LONG_RUN = 10_000  # characters of white space from which on a run is cut out before the pattern sees it

# What the pattern's engine takes for white space (Python's own class holds four more controls).
_SPACE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_RUN = re.compile(f"(?<![{_SPACE}])[{_SPACE}]{{{LONG_RUN},}}")
_counters: dict[str, Callable[[str], int]] = {}


def token_counter(path: str = VOCABULARY) -> Callable[[str], int]:
    """The function text -> number of tokens.

    The pattern backtracks through white space and ends its process on runs of about a million
    characters. A long run is therefore cut out as the pattern would cut it: all of it is one piece
    at a text's end, else all but its last character, with which what follows begins.
    """
    if path not in _counters:
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}
        cut = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        whole = tiktoken.Encoding("piece", pat_str="(?s:.+)", mergeable_ranks=ranks, special_tokens={}).encode_ordinary

        def count(text: str) -> int:
            n, at = 0, 0
            if len(text) >= LONG_RUN:
                for m in _RUN.finditer(text):
                    end = m.end() - (m.end() < len(text))
                    n += len(cut(text[at : m.start()])) + len(whole(text[m.start() : end]))
                    at = end
            return n + len(cut(text[at:] if at else text))

        _counters[path] = count
    return _counters[path]


def token_lengths(docs: DataFrame, vocabulary: str = VOCABULARY) -> DataFrame:
    """doc_id, n_tokens (an end token included) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = token_counter(vocabulary)
        for batch in batches:
            for part in pieces(batch, "text"):
                n = [count(x) + 1 if x else 1 for x in part.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column("doc_id").cast(pa.int64()), pa.array(n, pa.int64())], names=["doc_id", "n_tokens"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n_tokens long")


def optimal_bounds(histogram: dict[int, int], buckets: int) -> list[int]:
    """At most ``buckets`` upper bounds, the longest length included, with the least padding.

    cost(i, j) = length_j * (rows after i up to j) - (tokens after i up to j). For each number of
    buckets the best i for j minimises a line in length_j, so a convex hull of lines answers all j
    in one sweep.
    """
    lengths = sorted(histogram)
    if not lengths:
        return []
    rows, tokens = [0], [0]
    for x in lengths:
        rows.append(rows[-1] + histogram[x])
        tokens.append(tokens[-1] + x * histogram[x])
    n = len(lengths)
    best = [None] + [lengths[j - 1] * rows[j] - tokens[j] for j in range(1, n + 1)]
    chosen = [[0] * (n + 1)]
    for _ in range(1, min(buckets, n)):
        new, origin = [None] * (n + 1), [0] * (n + 1)
        hull: list[tuple[int, int, int]] = []  # slope, intercept, index; slopes fall
        at = 0
        for j in range(1, n + 1):
            i = j - 1
            if i >= 1:
                line = (-rows[i], best[i] + tokens[i], i)
                while len(hull) >= 2 and (line[1] - hull[-2][1]) * (hull[-2][0] - hull[-1][0]) <= (hull[-1][1] - hull[-2][1]) * (hull[-2][0] - line[0]):
                    hull.pop()
                hull.append(line)
                at = min(at, len(hull) - 1)
                x = lengths[j - 1]
                while at + 1 < len(hull) and hull[at + 1][0] * x + hull[at + 1][1] <= hull[at][0] * x + hull[at][1]:
                    at += 1
                new[j] = x * rows[j] - tokens[j] + hull[at][0] * x + hull[at][1]
                origin[j] = hull[at][2]
            if new[j] is None or best[j] <= new[j]:
                new[j], origin[j] = best[j], -1
        best = new
        chosen.append(origin)
    bounds, j, level = [], n, len(chosen) - 1
    while j > 0:
        while chosen[level][j] == -1:
            level -= 1
        bounds.append(lengths[j - 1])
        j, level = (chosen[level][j], level - 1) if level else (0, 0)
    return bounds[::-1]


def padded(n: Column, multiple: int) -> Column:
    return (F.ceil(n / multiple) * multiple).cast("long")


def pack(lengths: DataFrame, buckets: int = BUCKETS, budget: int = BUDGET, multiple: int = MULTIPLE, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """(doc_id, n_tokens) -> the same with bucket, padded_tokens, batch, place and padding."""
    lengths = materialise(lengths, "lengths")
    counted = lengths.groupBy(padded(F.col("n_tokens"), multiple).alias("length")).agg(F.count(F.lit(1)).alias("n"))
    histogram = {r["length"]: r["n"] for r in counted.collect()}
    bounds = optimal_bounds(histogram, buckets)
    blocks = -(-sum(histogram.values()) // block_rows) or 1
    edges = F.array(*[F.lit(b).cast("long") for b in bounds]) if bounds else F.array(F.lit(0).cast("long"))
    bucketed = lengths.withColumn("bucket", F.size(F.filter(edges, lambda b: b < F.col("n_tokens"))).cast("int"))
    ranked = group_rank(bucketed, ["bucket"], F.pmod(F.xxhash64("doc_id", "n_tokens"), F.lit(blocks)).cast("int"), [F.col("doc_id"), F.col("n_tokens")], "slot")
    width = F.element_at(edges, F.col("bucket") + 1)
    per_batch = F.greatest(F.lit(1), F.floor(F.lit(budget) / width)).cast("long")
    return ranked.select(
        "doc_id",
        "n_tokens",
        "bucket",
        width.alias("padded_tokens"),
        F.floor(F.col("slot") / per_batch).cast("long").alias("batch"),
        (F.col("slot") % per_batch).cast("long").alias("place"),
        (width - F.col("n_tokens")).alias("padding"),
    )


def pack_documents(docs: DataFrame, vocabulary: str = VOCABULARY, **options: int) -> DataFrame:
    return pack(token_lengths(docs, vocabulary), **options)
