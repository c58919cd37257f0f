"""Benchmark decontamination by latent semantic retrieval.

1. Vocabulary: the benchmark's words, but for those that a large share of its items hold.
2. One pass over all texts counts in how many disjoint passages each term stands (idf).
3. A second pass takes the corpus's part of the range of A'A, where A holds the normalised TF-IDF rows of all
   disjoint passages: each task adds A'(A R) for a fixed random matrix R, and blocks of its rows are
   summed by key. Benchmark items are rows of A, too, weighted so that all together weigh as much as the corpus.
   The eigenvectors follow from this one product (Nystroem form of the randomised SVD).
4. A third pass projects half-overlapping passages (for short items, short ones); an item is a
   candidate where the latent cosine is high enough. Candidates must then share a long common subsequence of words with the item, in
   order, and enough of its answer (its last sentence), so that paraphrases count and common words do not.
   An item of fewer than MIN_TERMS different words, or of at most FEW words, says too little for a
   cosine: its candidates are all passages that hold as many of its words as it cannot do without.

What reaches the driver is bounded by the benchmark: a count per term and a terms x rank matrix. A
benchmark of over ``MOST_ITEMS`` items or ``MOST_TERMS`` different words is searched in blocks of so
many, each with passes of its own, so matrices and broadcasts have a bound (about 100 MB); up to that
number of items tests measure what the search finds against all pairs.

Defined results: null texts count as empty; an item without words is never found, and words end at white
space or ASCII punctuation, also in scripts that write none between them; an empty
benchmark or table finds nothing; very long texts are searched whole, passage by passage; ties in an item's best place go to the earliest passage; repeated rows
are each reported; only doc_id and text, item_id and text are read.
"""

from __future__ import annotations

import copy
import functools
import itertools
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.llm.common import materialise, pieces, reading, release
from atelier.llm.words import Texts, Words, texts, words

HALF = 32  # words; a passage is two halves
SHORT_HALVES = (4, 8, 16)  # the same for items of at most two such halves, of which a longer passage would say too little
BRIEF = 16  # words of an item up to which a passage needs one term less
COMMON = 0.1  # share of items from which on a word is no term
FREQUENT = 0.01  # share of passages from which on a word is no term
KEPT_TERMS = 10  # each item keeps so many of its rarest words as terms against both rules
SPARE = 56  # rank beyond the number of items
MOST_RANK = 768
MOST_ITEMS, MOST_TERMS = MOST_RANK - SPARE, 30_000  # of a block of the benchmark; a block is sent to every executor
PRODUCTS = 4096  # at most so many tasks make a product each; of a larger table each takes several parts
SUMS = 32  # tasks' products are summed in so many groups before all of them
MIN_TERMS = 3  # terms that a passage needs to be a candidate, if the item has so many; a short one needs one less
FEW = 4
COSINE = 0.45
COVERED = 0.6  # part of the item's words in common order
SURE = 0.8  # from here on without an answer check
ANSWER = 0.5
LEAKS = "doc_id long, item_id long, at_word long, item_words long, common_words long, coverage double, answer_share double, cosine double"

_PLAIN = np.full(256, 32, np.uint8)
_PLAIN[128:] = np.arange(128, 256)
for _c in b"0123456789abcdefghijklmnopqrstuvwxyz":
    _PLAIN[_c] = _c


def plain_words(column: pa.Array) -> tuple[Texts, Words]:
    """Words in lower case without ASCII punctuation."""
    t = texts(pc.utf8_lower(column))
    t = Texts(_PLAIN[t.data], t.cut)
    return t, words(t)


class Items:
    """The benchmark: words of each item, its answer, and the vocabulary."""

    def __init__(self, rows: list[tuple[int, str]]) -> None:
        rows = sorted(((i, t or "") for i, t in rows if i is not None), key=lambda r: (r[0], r[1]))
        column = pa.array([t for _, t in rows], pa.string())
        _, w = plain_words(column) if rows else (None, None)
        self.ids, self.words, self.answers = [], [], []
        for k, (i, text) in enumerate(rows):
            own = w.hash[w.first[k] : w.last[k]]
            if not len(own):
                continue
            self.ids.append(i)
            self.words.append(own)
            tail = re.split(r"(?<=[.!?])\s+", text.strip())[-1]
            _, a = plain_words(pa.array([tail], pa.string()))
            self.answers.append(a.hash if a.n else own[-5:])
        held = [np.unique(x) for x in self.words]
        terms, shares = np.unique(np.concatenate(held), return_counts=True) if held else (np.zeros(0, np.uint64), np.zeros(0))
        rare = set(terms[shares <= max(2, COMMON * len(held))].tolist())
        by_share = dict(zip(terms.tolist(), shares.tolist(), strict=True))
        for x in held:  # each item keeps its rarest words at least
            rare.update(sorted(x.tolist(), key=lambda v: (by_share[v], v))[:KEPT_TERMS])
        self._use(np.array(sorted(rare), np.uint64))

    def _use(self, terms: np.ndarray) -> None:
        self.terms = terms
        self.sieve = np.zeros(1 << 20, bool)
        self.sieve[(terms & np.uint64((1 << 20) - 1)).astype(np.int64)] = True

    def without_frequent(self, df: np.ndarray, most: float) -> tuple[Items, np.ndarray]:
        """Items over the terms in at most so many passages, and those terms' counts.

        Each item keeps its rarest terms in any case, so one that stands everywhere is still found.
        """
        keep = df <= most
        for x in self.words:
            own = np.unique(self.lookup(x)[1])
            keep[own[np.argsort(df[own], kind="stable")[:KEPT_TERMS]]] = True
        out = copy.copy(self)
        out._use(self.terms[keep])
        return out, df[keep]

    def lookup(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(position, term number) of the hashes that are terms."""
        at = np.flatnonzero(self.sieve[(hashes & np.uint64((1 << 20) - 1)).astype(np.int64)])
        if not len(at):
            return at, at
        term = np.minimum(np.searchsorted(self.terms, hashes[at]), len(self.terms) - 1)
        real = self.terms[term] == hashes[at]
        return at[real], term[real]


def tf_idf(row: np.ndarray, term: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Normalised rows from occurrences: (row, term, weight), sorted by row, then term."""
    key, count = np.unique(row * len(idf) + term, return_counts=True)
    row, term = key // len(idf), key % len(idf)
    weight = (1 + np.log(count)) * idf[term]
    norm = np.sqrt(np.bincount(row, weight * weight))
    return row, term, (weight / norm[row]).astype(np.float32)


def add_rows(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """Sums of ``value`` by sorted ``row``."""
    out = np.zeros((n, value.shape[1]), np.float32)
    if len(row):
        first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
        out[row[first]] = np.add.reduceat(value, first, axis=0)
    return out


def project(row: np.ndarray, term: np.ndarray, weight: np.ndarray, space: np.ndarray, n: int) -> np.ndarray:
    """Sparse rows (sorted) times ``space``: the k-th terms of all rows together, for k = 0, 1, ..."""
    out = np.zeros((n, space.shape[1]), np.float32)
    if not len(row):
        return out
    first = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
    count = np.diff(np.append(first, len(row)))
    order = np.argsort(-count, kind="stable")
    first, count = first[order], count[order]
    part = np.zeros((len(first), space.shape[1]), np.float32)
    for k in range(int(count[0])):
        live = int(np.searchsorted(-count, -k, "left"))
        at = first[:live] + k
        part[:live] += weight[at, None] * space[term[at]]
    out[row[first]] = part
    return out


def gram_part(row: np.ndarray, term: np.ndarray, weight: np.ndarray, probe: np.ndarray) -> np.ndarray:
    """A'(A R) of some rows."""
    _, row = np.unique(row, return_inverse=True)
    held = project(row, term, weight, probe, int(row[-1]) + 1 if len(row) else 0)
    order = np.argsort(term, kind="stable")
    return add_rows(term[order], weight[order, None] * held[row[order]], len(probe))


def disjoint(w: Words, at: np.ndarray) -> np.ndarray:
    """Number of the disjoint passage of each word position, unique over the batch."""
    inside = (at - w.first[w.doc[at]]) // (2 * HALF)
    return w.doc[at] * (int((w.last - w.first).max()) // (2 * HALF) + 1) + inside


def passages_of(w: Words) -> int:
    return int((-(-(w.last - w.first) // (2 * HALF))).sum())


def eigenvectors(product: np.ndarray, probe: np.ndarray, rank: int) -> np.ndarray:
    """Leading eigenvectors of the matrix G whose product with ``probe`` is given."""
    core = probe.T @ product
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    real = values > max(values[-1], 0) * 1e-7
    root = product @ (vectors[:, real] / np.sqrt(values[real]))
    u, _, _ = np.linalg.svd(root, full_matrices=False)
    return u[:, :rank]


def latent_space(docs: DataFrame, items: Items, seed: int = 5) -> tuple[Items, np.ndarray, np.ndarray]:
    """(items over the terms used, idf, terms x rank projection), from all passages of ``docs``."""
    everything, whole = docs.sparkSession.sparkContext.broadcast(items), len(items.terms)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, total, n = everything.value, np.zeros(whole, np.int64), 0
        for batch in batches:
            for part in pieces(batch, "text"):
                _, w = plain_words(part.column("text"))
                if not w.n:
                    continue
                n += passages_of(w)
                at, term = known.lookup(w.hash)
                total += np.bincount(np.unique(disjoint(w, at) * whole + term) % whole, minlength=whole)
        has = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(np.append(has, -1)), pa.array(np.append(total[has], n))], names=["term", "n"])

    counted = {r["term"]: r["n"] for r in docs.select("text").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect()}
    n = counted.pop(-1, 0)
    df = np.zeros(whole)
    df[list(counted)] = list(counted.values())
    items, df = items.without_frequent(df, max(FREQUENT * n, 50))
    d, shared = len(items.terms), docs.sparkSession.sparkContext.broadcast(items)
    idf = 1 + np.log((n + 1) / (df + 1))
    rank = min(d, len(items.ids) + SPARE, MOST_RANK)
    probe = np.random.default_rng(seed).standard_normal((d, min(d, rank + 16))).astype(np.float32)
    probed = docs.sparkSession.sparkContext.broadcast((idf, probe))
    step = max(1, 25_000 // probe.shape[1])

    def gram(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, (idf, probe) = shared.value, probed.value
        total = np.zeros(probe.shape, np.float64)
        for batch in batches:
            for part in pieces(batch, "text"):
                _, w = plain_words(part.column("text"))
                at, term = known.lookup(w.hash)
                if len(at):
                    total += gram_part(*tf_idf(disjoint(w, at), term, idf), probe)
        for low in range(0, d, step):
            yield from rows_of(low, total[low : low + step])

    def rows_of(low: int, total: np.ndarray) -> Iterator[pa.RecordBatch]:
        """Those rows of a block that are not all zero."""
        has = np.flatnonzero(total.any(1)).astype(np.int32)
        if len(has):
            yield pa.RecordBatch.from_arrays([pa.array([low], pa.int64()), pa.array([has.tobytes()], pa.binary()), pa.array([total[has].astype(np.float32).tobytes()], pa.binary())], names=["low", "rows", "part"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Sums of the blocks, which come by ``low``."""
        low, total = None, None
        for batch in batches:
            for key, has, raw in zip(*(batch.column(c).to_pylist() for c in ("low", "rows", "part")), strict=True):
                if key != low:
                    if low is not None:
                        yield from rows_of(low, total)
                    low, total = key, np.zeros((step, probe.shape[1]))
                total[np.frombuffer(has, np.int32)] += np.frombuffer(raw, np.float32).reshape(-1, probe.shape[1])
        if low is not None:
            yield from rows_of(low, total)

    kind = "low long, rows binary, part binary"
    parts = docs.select("text").coalesce(PRODUCTS).mapInArrow(gram, kind).withColumn("task", F.pmod(F.spark_partition_id(), F.lit(SUMS)))
    parts = parts.repartition("low", "task").sortWithinPartitions("low").select("low", "rows", "part").mapInArrow(add, kind)
    parts = parts.repartition("low").sortWithinPartitions("low").mapInArrow(add, kind)
    product = np.zeros(probe.shape)
    for r in parts.collect():
        product[r["low"] + np.frombuffer(r["rows"], np.int32)] += np.frombuffer(r["part"], np.float32).reshape(-1, probe.shape[1])
    row, term, weight = tf_idf(*_item_rows(items), idf)
    product += max(n, 1) / len(items.ids) * gram_part(row, term, weight, probe)
    return items, idf, eigenvectors(product, probe.astype(np.float64), rank).astype(np.float32)


def _item_rows(items: Items) -> tuple[np.ndarray, np.ndarray]:
    found = [items.lookup(x)[1] for x in items.words]
    return np.repeat(np.arange(len(found)), [len(x) for x in found]), np.concatenate(found)


def common_subsequence(item_bits: dict[int, int], length: int, other: list[int]) -> int:
    """Length of the longest common subsequence, bit-parallel (Hyyroe 2004)."""
    full = (1 << length) - 1
    state = full
    for word in other:
        hit = state & item_bits.get(word, 0)
        state = ((state + hit) | (state - hit)) & full
    return length - state.bit_count()


def _bits(words_: list[int]) -> dict[int, int]:
    out: dict[int, int] = {}
    for k, x in enumerate(words_):
        out[x] = out.get(x, 0) | 1 << k
    return out


class Judge:
    """Checks candidates word by word."""

    def __init__(self, items: Items, covered: float) -> None:
        self.least = [covered * len(x) for x in items.words]
        self.counts = [Counter(x.tolist()) for x in items.words]
        self.items = [(len(x), _bits(x.tolist()), len(a), _bits(a.tolist())) for x, a in zip(items.words, items.answers, strict=True)]

    def best(self, item: int, own: list[int], first: int, words_: int) -> tuple[int, int, float]:
        """(common words, place, share of the answer) of the best stretch near the ``words_`` from word ``first`` of a text on."""
        length, bits, answer, answer_bits = self.items[item]
        wide, step = -(-length * 5 // 4), max(1, length // 4)
        low, high = max(0, first - length), min(len(own), first + words_ + length)
        best = (0, 0, 0.0)
        left, shared = self.counts[item], 0
        for word, n in Counter(own[low:high]).items():
            shared += min(n, left.get(word, 0))
        if shared < self.least[item]:  # a common subsequence cannot be longer
            return best
        for start in range(low, max(low + 1, high - length + step), step):
            part = own[start : start + wide]
            found = common_subsequence(bits, length, part)
            if found > best[0]:
                best = (found, start, common_subsequence(answer_bits, answer, part) / answer)
        return best


def _blocks(benchmark: DataFrame) -> Iterator[Items]:
    """The benchmark in blocks of at most MOST_ITEMS rows and about MOST_TERMS words, by item; those without words are left out."""
    benchmark = benchmark.select("item_id", "text")
    rows = benchmark.limit(MOST_ITEMS + 1).collect()
    if len(rows) > MOST_ITEMS:
        rows = benchmark.orderBy("item_id", "text").toLocalIterator()
    block, known = [], set()
    for r in itertools.chain(rows, [None]):
        if block and (r is None or len(block) == MOST_ITEMS or len(known) >= MOST_TERMS):
            items = Items(block)
            if items.ids:
                yield items
            block, known = [], set()
        if r is not None:
            block.append((r["item_id"], r["text"]))
            known.update((r["text"] or "").lower().split())


def find_leaks(docs: DataFrame, benchmark: DataFrame, cosine: float = COSINE, covered: float = COVERED) -> DataFrame:
    """A row for each text and each benchmark item that it holds, word by word or as a paraphrase."""
    found = [_leaks_of(docs, items, cosine, covered) for items in _blocks(benchmark)]
    return functools.reduce(DataFrame.union, found) if found else docs.sparkSession.createDataFrame([], LEAKS)


def _leaks_of(docs: DataFrame, items: Items, cosine: float, covered: float) -> DataFrame:
    searcher = _searcher(docs, items, cosine, covered)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = searcher()
        for batch in batches:
            for part in pieces(batch, "text"):
                found = search(part.column("text"))
                if found:
                    ids = part.column("doc_id").cast(pa.int64()).take(pa.array([f[0] for f in found], pa.int64()))
                    columns = list(zip(*(f[1:] for f in found), strict=True))
                    types = [pa.int64()] * 4 + [pa.float64()] * 3
                    yield pa.RecordBatch.from_arrays([ids, *(pa.array(c, t) for c, t in zip(columns, types, strict=True))], names=["doc_id", "item_id", "at_word", "item_words", "common_words", "coverage", "answer_share", "cosine"])

    return docs.select("doc_id", "text").mapInArrow(run, LEAKS)


def drop_leaking(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs`` that hold no benchmark item, all their columns unchanged."""
    kept = written = None
    for items in _blocks(benchmark):
        if kept is not None:  # written in between, so that a task holds one block at a time
            last, written = written, materialise(kept, "clean")
            if last is not None:
                release(last)
        kept = _without(docs if written is None else written, _searcher(docs, items, COSINE, COVERED))
    return docs if kept is None else kept if written is None else reading(kept, written)


def _without(docs: DataFrame, searcher) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        search = searcher()
        for batch in batches:
            for part in pieces(batch, "text"):
                clean = np.ones(part.num_rows, bool)
                clean[[f[0] for f in search(part.column("text"))]] = False
                yield part.filter(pa.array(clean))

    return docs.mapInArrow(run, docs.schema)


class FewWorded:
    """Items that say too little for a cosine: what each of their terms counts, and how much a passage must hold."""

    def __init__(self, items: Items, covered: float) -> None:
        self.need, term, item, count = {}, [], [], []
        for k, x in enumerate(items.words):
            own, n = np.unique(items.lookup(x)[1], return_counts=True)
            if len(own) < MIN_TERMS or len(x) <= FEW:  # so few words are all terms
                self.need[k] = covered * len(x) - 1e-9
                term.append(own)
                item.append(np.full(len(own), k))
                count.append(n)
        term, item, count = (np.concatenate(c) if c else np.zeros(0, np.int64) for c in (term, item, count))
        order = np.argsort(term, kind="stable")
        self.term, self.item, self.count = term[order], item[order], count[order]

    def of(self, some: set[int]) -> FewWorded:
        """Those of some items."""
        out = copy.copy(self)
        keep = np.isin(self.item, sorted(some))
        out.term, out.item, out.count = self.term[keep], self.item[keep], self.count[keep]
        return out

    def holders(self, row: np.ndarray, term: np.ndarray) -> np.ndarray:
        """(row, item) of the rows, given by their different terms, that hold enough of an item."""
        low, high = np.searchsorted(self.term, term, "left"), np.searchsorted(self.term, term, "right")
        n = high - low
        at = np.repeat(low - (np.cumsum(n) - n), n) + np.arange(n.sum())
        most = int(self.item.max()) + 1 if len(self.item) else 1
        key, inverse = np.unique(np.repeat(row, n) * most + self.item[at], return_inverse=True)
        held = np.bincount(inverse, self.count[at], minlength=len(key))
        need = np.array([self.need.get(k, 0.0) for k in range(most)])
        return np.stack([key // most, key % most], axis=1)[held >= need[key % most]]


def _searcher(docs: DataFrame, items: Items, cosine: float, covered: float):
    """Makes, on an executor, the function text column -> found (row, item_id, place, sizes, shares)."""
    items, idf, space = latent_space(docs, items)
    row, term, weight = tf_idf(*_item_rows(items), idf)
    queries = project(row, term, weight, space, len(items.ids))
    queries /= np.maximum(np.linalg.norm(queries, axis=1, keepdims=True), 1e-9)
    shared = docs.sparkSession.sparkContext.broadcast((items, idf, space, queries, FewWorded(items, covered)))

    def make():
        items, idf, space, queries, few = shared.value
        judge = Judge(items, covered)
        scales = []
        size = np.array([len(x) for x in items.words])
        half_of = np.select([size <= 2 * h for h in SHORT_HALVES], SHORT_HALVES, HALF)
        for half in (*SHORT_HALVES, HALF):
            own, least = half_of == half, MIN_TERMS - (2 * half <= BRIEF)
            some = set(np.flatnonzero(own).tolist())
            scales += [(half, np.array(sorted(some - few.need.keys()), np.int64), least, few.of(some))] if some else []

        def candidates(w: Words, at: np.ndarray, term: np.ndarray, half: int, which: np.ndarray, least: int, few: FewWorded) -> Iterator[tuple[int, int, int, float]]:
            """(row, first word, item, cosine) of the passages of two halves that are near an item."""
            base = np.concatenate([[0], np.cumsum(np.maximum(-(-(w.last - w.first) // half), 1))])
            own = (at - w.first[w.doc[at]]) // half
            place = base[w.doc[at]] + own  # a passage is numbered by its first half
            again = own > 0
            row, held, weight = tf_idf(np.concatenate([place, place[again] - 1]), np.concatenate([term, term[again]]), idf)
            enough = np.bincount(row) >= least
            pairs = few.holders(row, held)
            keep = enough.copy()
            keep[pairs[:, 0]] = True
            keep = keep[row]
            row, held, weight = row[keep], held[keep], weight[keep]
            numbers, row = np.unique(row, return_inverse=True)
            extra = np.stack([np.searchsorted(numbers, pairs[:, 0]), pairs[:, 1]], axis=1)
            wanted = queries[which].T
            for low in range(0, len(numbers), 4096):
                a, b = np.searchsorted(row, [low, low + 4096])
                z = project(row[a:b] - low, held[a:b], weight[a:b], space, min(4096, len(numbers) - low))
                z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
                close = z @ wanted
                near = close >= cosine
                near[~enough[numbers[low : low + 4096]]] = False
                p, k = np.nonzero(near)
                here = extra[(extra[:, 0] >= low) & (extra[:, 0] < low + 4096)]
                found = [(p, which[k], close[p, k]), (here[:, 0] - low, here[:, 1], np.einsum("ij,ij->i", z[here[:, 0] - low], queries[here[:, 1]]))]
                for ps, ks, cs in found:
                    number = numbers[low + ps]
                    doc = np.searchsorted(base, number, side="right") - 1
                    yield from zip(doc.tolist(), ((number - base[doc]) * half).tolist(), ks.tolist(), cs.tolist(), strict=True)

        def search(column: pa.Array) -> list[tuple]:
            _, w = plain_words(column)
            at, term = items.lookup(w.hash)
            if not len(at):
                return []
            out: dict[tuple[int, int], tuple] = {}
            lists: dict[int, list[int]] = {}
            for half, which, least, own_few in scales:
                for doc, first, item, close in candidates(w, at, term, half, which, least, own_few):
                    if doc not in lists:
                        lists[doc] = w.hash[w.first[doc] : w.last[doc]].tolist()
                    common, start, answer = judge.best(item, lists[doc], first, 2 * half)
                    length = judge.items[item][0]
                    share = common / length
                    if share >= SURE or share >= covered and answer >= ANSWER:
                        row_ = (doc, items.ids[item], start, length, common, share, answer, close)
                        if (doc, item) not in out or row_[4] > out[doc, item][4]:
                            out[doc, item] = row_
            return list(out.values())

        return search

    return make
