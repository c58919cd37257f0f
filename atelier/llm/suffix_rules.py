"""Quality rules by suffix arrays: repeated passages inside one text.

A suffix array over the words of each text is built by prefix doubling, all texts of a batch at
once. Neighbours' longest common prefixes give the LCP intervals, each a maximal repeated run of
words. The union of their spans must not cover too much of the text, and none may be too long.

Defined results: a null text counts as empty; an empty text has no words, so it fails the base
rule; repeated rows are judged alike; of repeats of one length all count, and a text of any length is
read whole; an empty table gives no rows; other columns of the table are neither read nor needed by
``repetition_rules`` and pass unchanged through ``keep_unrepetitive``, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from atelier.llm.common import pieces
from atelier.llm.words import Texts, Words, digest_long, mix, prefix_hash, span_hash, sums, texts, words

MIN_REPEAT = 8  # words; shorter repeats are ordinary language
MAX_COVERED = 0.35  # fraction of the words inside repeats
MAX_LONGEST = 100  # words of the longest repeat
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50

SCHEMA = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, covered_words long, longest_repeat long, n_repeats long"
)
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True


class SuffixArray:
    """Suffixes of every text's words, in order; ranks after 1, 2, 4, ... words are kept."""

    def __init__(self, w: Words) -> None:
        n = w.n
        self.stop = w.last[w.doc]  # word after the text of each word
        _, inverse, counts = np.unique(mix(w.hash + w.doc.astype(np.uint64) * np.uint64(0xA24BAED4963EE407)), return_inverse=True, return_counts=True)
        rank = (np.cumsum(counts) - counts)[inverse] + 1  # 0 is the end of a text
        active = np.flatnonzero(counts[inverse] > 1)
        self.levels = [rank.astype(np.int32)]
        step = 1
        while active.size:
            after = active + step
            tail = np.where(after < self.stop[active], rank[np.minimum(after, n - 1)], 0)
            key = rank[active] * (n + 2) + tail
            order = np.argsort(key, kind="stable")
            at, key = active[order], key[order]
            fresh = np.ones(len(at), bool)
            fresh[1:] = key[1:] != key[:-1]
            old = rank[at]
            opens = np.ones(len(at), bool)
            opens[1:] = old[1:] != old[:-1]
            place = np.arange(len(at))
            rank[at] = old + np.maximum.accumulate(np.where(fresh, place, 0)) - np.maximum.accumulate(np.where(opens, place, 0))
            group = np.cumsum(fresh) - 1
            active = np.sort(at[np.bincount(group)[group] > 1])
            step *= 2
            self.levels.append(rank.astype(np.int32))
        self.order = np.empty(n, np.int64)
        self.order[rank - 1] = np.arange(n)

    def common_prefixes(self, least: int) -> np.ndarray:
        """lcp[j]: words shared by suffixes j - 1 and j of the order; 0 where under ``least``."""
        n = len(self.order)
        lcp = np.zeros(n + 1, np.int64)
        level = least.bit_length() - 1
        if n < 2 or level >= len(self.levels):
            return lcp
        a, b = self.order[:-1], self.order[1:]
        near = np.flatnonzero(self.levels[level][a] == self.levels[level][b])
        a, b, found = a[near], b[near], np.zeros(len(near), np.int64)
        for k in reversed(range(len(self.levels))):
            x, y = a + found, b + found
            inside = (x < self.stop[a]) & (y < self.stop[b])
            same = inside & (self.levels[k][np.minimum(x, n - 1)] == self.levels[k][np.minimum(y, n - 1)])
            found += same.astype(np.int64) << k
        lcp[near + 1] = np.where(found >= least, found, 0)
        return lcp


def maximal_repeats(text: str, min_repeat: int = MIN_REPEAT) -> list[tuple[int, list[int]]]:
    """(length, word positions) of every LCP interval of one text: its maximal repeats."""
    w = words(texts(pa.array([text], pa.string())))
    if not w.n:
        return []
    sa = SuffixArray(w)
    out, stack = [], []  # stack: (length, first suffix of the interval)
    for j, length in enumerate([*sa.common_prefixes(min_repeat).tolist()[1:], 0], start=1):
        first = j - 1
        while stack and stack[-1][0] > length:
            tall, first = stack.pop()
            out.append((tall, sorted(sa.order[first:j].tolist())))
        if length and (not stack or stack[-1][0] < length):
            stack.append((length, first))
    return out


def _interval_count(lcp: np.ndarray, doc_of: np.ndarray, rows: int) -> np.ndarray:
    """LCP intervals per text: an entry opens one unless an equal one is open already."""
    counts = np.zeros(rows, np.int64)
    hot = np.flatnonzero(lcp)
    stack: list[int] = []
    before = -2
    for j, length, doc in zip(hot.tolist(), lcp[hot].tolist(), doc_of[hot].tolist(), strict=True):
        if j != before + 1:
            stack.clear()
        before = j
        while stack and stack[-1] > length:
            stack.pop()
        if not stack or stack[-1] < length:
            stack.append(length)
            counts[doc] += 1
    return counts


def profile(column: pa.Array, min_repeat: int = MIN_REPEAT) -> dict[str, np.ndarray]:
    """All measures of a batch of texts."""
    t = texts(column)
    prefix = prefix_hash(t)
    w = words(t, prefix)
    rows = t.rows
    count = (w.last - w.first).astype(np.int64)
    space = np.ones(len(t.data), bool)
    if w.n:
        delta = np.zeros(len(t.data) + 1, np.int32)
        delta[w.start] += 1
        delta[w.end] -= 1
        space = np.cumsum(delta[:-1]) == 0
    out = {
        "n_words": count,
        "word_chars": sums(((t.data & 0xC0) != 0x80) & ~space, t),
        "n_symbols": sums(_SYMBOL[t.data], t),
        "n_dup_lines": _repeated_lines(t, prefix, space),
        **{k: np.zeros(rows, np.int64) for k in ("n_repeat_words", "covered_words", "longest_repeat", "n_repeats")},
    }
    if not w.n:
        return out
    sa = SuffixArray(w)
    place = np.arange(w.n)
    out["n_repeat_words"] = np.bincount(w.doc[_window_words(sa, w)], minlength=rows)
    lcp = sa.common_prefixes(min_repeat)
    if lcp.any():
        longest = np.zeros(w.n, np.int64)
        longest[sa.order] = np.maximum(lcp[:-1], lcp[1:])
        covered = place < np.maximum.accumulate(np.where(longest > 0, place + longest, 0))
        out["covered_words"] = np.bincount(w.doc[covered], minlength=rows)
        np.maximum.at(out["longest_repeat"], w.doc, longest)
        doc_of = np.append(w.doc[sa.order], 0)
        out["n_repeats"] = _interval_count(lcp, doc_of, rows)
    return out


def _window_words(sa: SuffixArray, w: Words) -> np.ndarray:
    """Words in some three-word window that its text holds twice or more."""
    pair = sa.levels[1].astype(np.int64) if len(sa.levels) > 1 else None
    if pair is None or w.n < 3:
        return np.zeros(0, np.int64)
    at = np.flatnonzero(np.arange(w.n - 2) + 2 < sa.stop[: w.n - 2])
    size = np.bincount(pair)
    at = at[(size[pair[at]] > 1) & (size[pair[at + 1]] > 1)]
    if not at.size:
        return at
    key = pair[at] * (w.n + 2) + pair[at + 1]
    _, inverse, counts = np.unique(key, return_inverse=True, return_counts=True)
    at = at[counts[inverse] > 1]
    flags = np.zeros(w.n, bool)
    for k in range(3):
        flags[at + k] = True
    return np.flatnonzero(flags)


def _repeated_lines(t: Texts, prefix: np.ndarray, space: np.ndarray) -> np.ndarray:
    """Lines with a word that equal an earlier line of their text."""
    if not len(t.data):
        return np.zeros(t.rows, np.int64)
    breaks = np.flatnonzero(t.data == 10)
    start = np.unique(np.concatenate([t.cut[:-1], breaks + 1]))
    start = start[start < len(t.data)]
    end = np.minimum(np.append(start[1:], len(t.data)), len(t.data))
    end = np.where((end > start) & (t.data[end - 1] == 10), end - 1, end)
    doc = np.searchsorted(t.cut, start, side="right") - 1
    seen = np.zeros(len(t.data) + 1, np.int64)
    np.cumsum(~space, out=seen[1:])
    real = seen[end] > seen[start]
    start, end, doc = start[real], end[real], doc[real]
    key = mix(digest_long(span_hash(prefix, start, end), t.data, start, end) + doc.astype(np.uint64) * np.uint64(0xA24BAED4963EE407))
    _, first = np.unique(key, return_index=True)
    return np.bincount(doc, minlength=t.rows) - np.bincount(doc[first], minlength=t.rows)


def verdicts(p: dict[str, np.ndarray], max_covered: float, max_longest: int) -> tuple[np.ndarray, np.ndarray]:
    base_failed = (p["n_words"] < MIN_WORDS) | (100 * p["n_repeat_words"] > MAX_REPEAT_PERCENT * p["n_words"])
    clean = (p["covered_words"] <= max_covered * p["n_words"]) & (p["longest_repeat"] <= max_longest)
    return base_failed, clean & ~base_failed


def repetition_rules(docs: DataFrame, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """Measures and verdict of every text. Narrow: no shuffle, one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                p = profile(part.column("text"), min_repeat)
                base_failed, kept = verdicts(p, max_covered, max_longest)
                order = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), *(pa.array(p[k], pa.int64()) for k in order), pa.array(base_failed), pa.array(kept), *(pa.array(p[k], pa.int64()) for k in ("covered_words", "longest_repeat", "n_repeats"))],
                    names=["doc_id", *order, "base_failed", "kept", "covered_words", "longest_repeat", "n_repeats"],
                )

    return docs.select("doc_id", "text").mapInArrow(run, SCHEMA)


def keep_unrepetitive(docs: DataFrame, min_repeat: int = MIN_REPEAT, max_covered: float = MAX_COVERED, max_longest: int = MAX_LONGEST) -> DataFrame:
    """The rows of ``docs`` that pass, all their columns unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                _, kept = verdicts(profile(part.column("text"), min_repeat), max_covered, max_longest)
                yield part.filter(pa.array(kept))

    return docs.mapInArrow(run, docs.schema)
