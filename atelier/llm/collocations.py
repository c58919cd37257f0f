"""Phrase collocations, counted in HAT-tries (Askitis and Sinha 2007).

Three passes read the texts. The first counts words. The second counts pairs of frequent words in hash buckets (Park, Chen
and Yu 1995), as many as the words need, up to a fixed number. The third counts stretches of up to five words whose
neighbouring pairs are all in buckets of enough pairs: a frequent phrase has frequent parts only, so nothing is
lost, and stretches end where they can no longer be part of one. What is frequent is known to tasks as a bit map of
fixed size (``MOST_BITS`` at most): a bit that stands for several words or pairs lets too much through, never too little.

Inside a task stretches go into a trie of word numbers with hash containers as leaves: a container that grows over
``BURST`` is dealt to children by its next word. Over ``ENTRIES`` entries, the largest subtrees leave whole, as a sorted run for
each prefix partition, which the first two words and, in ``SPLIT`` parts, the third decide. A partition's runs are shuffled together
and merged, and all prefixes counted at once (those of two words in part, so that a very common pair is no hot
task; the parts are added up after). There are as many partitions as the words need, so that one holds some 100,000 entries.

A word number is a 64-bit hash of the word and its language: of 10^6 frequent words and 10^9 others, some frequent
one would share its number with a chance of 5 in 100,000. Words come back from a table of frequent words.

Defined results: null and empty texts have no words, a null language is ``und``; only A-Z are lower-cased; texts of any
length are read in stretches of about ``CHUNK`` bytes, cut between words, and phrases run on over cuts; a null doc_id is as
good as any; repeated rows count each; equal scores go by count, then phrase; an empty table gives no rows; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from atelier.llm.common import materialise, release

LEAST = 100  # occurrences of a candidate
LONGEST = 5  # its words at most
TOP = 2_000  # of each language
BURST = 4_096  # entries of a container before it becomes a node
ENTRIES = 150_000  # entries of a task's trie before subtrees leave
CHUNK = 500_000  # bytes that are cut into words at once
MOST_BITS = 27  # log2 of a bit map's largest size: 16 MB
PAIR_BUCKETS = 24  # log2 of the largest number of buckets that pairs are counted in: 16 MB a task
SPLIT = 8  # parts that the stretches after one pair of words are dealt to
PART_WORDS, MOST_PARTS = 100_000, 1 << 22  # words of the texts for each prefix partition, about; partitions
MERGED = 500_000  # entries of runs that are merged at once
PIECE = 16  # log2 of the buckets that are added up at once
LONG_WORD = 256  # bytes of a word from which on it is hashed on its own

_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1  # between words
_CLASS[[*b".,;:!?\n\x0b\x0c\r"]] = 2  # between pieces
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_MIX = [np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9)]
_LETTER = np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_POWER = np.cumprod(np.full(LONG_WORD, _MIX[0]))


def _mixed(h: np.ndarray) -> np.ndarray:
    """Every bit of the result depends on every bit of ``h``; different numbers stay different."""
    h = (h ^ (h >> np.uint64(32))) * _MIX[1]
    return (h ^ (h >> np.uint64(29))) * _MIX[2]


def _number(name: bytes) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(name, digest_size=8).digest(), np.uint64)[0]


class Words:
    """Words of a stretch of bytes: numbers, their bytes' places, and the piece each is in (0: that which was open before)."""

    def __init__(self, data: np.ndarray, starts: np.ndarray, langs: np.ndarray) -> None:
        """``starts``: where texts begin in ``data``; ``langs``: number of the language at the stretch's begin and of each such text."""
        self.data = _LOWER[data]
        kind = _CLASS[data]
        word = kind == 0
        first = word.copy()
        first[1:] &= ~word[:-1]
        inner = starts[starts < len(data)]
        first[inner] = word[inner]
        last = word.copy()
        last[:-1] &= ~word[1:]
        before = inner[inner > 0] - 1
        last[before] = word[before]
        self.at, self.end = np.flatnonzero(first), np.flatnonzero(last) + 1
        cut = kind == 2
        pieces = np.cumsum(cut, dtype=np.int64)[self.at] if len(self.at) else np.zeros(0, np.int64)
        text = np.searchsorted(starts, self.at, "right")
        self.piece = pieces + text
        self.last_piece = int(cut.sum()) + len(starts)  # that which is open at the end
        self.lang = langs[text]
        size = self.end - self.at
        number = np.zeros(len(self.at), np.uint64)
        if len(self.at):
            place = np.arange(len(data)) - np.repeat(np.append(0, self.at), np.diff(np.append(np.append(0, self.at), len(data))))
            value = _LETTER[self.data]
            value *= _POWER[np.minimum(place, LONG_WORD - 1)]
            value[~word] = 0
            number = np.add.reduceat(value, self.at)
            for k in np.flatnonzero(size > LONG_WORD).tolist():
                number[k] = _number(self.data[self.at[k] : self.end[k]].tobytes())
        self.number = _mixed((number + size.astype(np.uint64)) ^ self.lang)

    def word(self, k: int) -> str:
        return self.data[self.at[k] : self.end[k]].tobytes().decode("utf-8", "replace")


def stretches(batches: Iterator[pa.RecordBatch], names: dict[int, str] | None = None) -> Iterator[tuple[Words, bool]]:
    """Words of all texts, and whether a stretch goes on in the text before. ``names`` gets the languages by number."""
    for batch in batches:
        if not batch.num_rows:
            continue
        text = batch.column("text").fill_null("").cast(pa.large_string())
        langs = batch.column("lang").fill_null("und").to_pylist()
        known = {x: _number(x.encode()) for x in set(langs)}
        if names is not None:
            names.update((int(v), k) for k, v in known.items())
        codes = np.array([known[x] for x in langs], np.uint64)
        _, offsets, values = text.buffers()
        edge = np.frombuffer(offsets, np.int64)[text.offset : text.offset + len(text) + 1]
        data = np.frombuffer(values, np.uint8) if values is not None else np.zeros(0, np.uint8)
        at, stop = int(edge[0]), int(edge[-1])
        while at < stop:
            end = min(stop, at + CHUNK)
            if end < stop:
                end = _cut(data, at, end, stop, edge)
            inside = edge[:-1][(edge[:-1] >= at) & (edge[:-1] < end)]
            begun = np.searchsorted(edge[:-1], at, "right") - 1  # the text that the stretch begins in
            lead = codes[begun : begun + 1]
            own = np.searchsorted(edge[:-1], at, "left")
            yield Words(data[at:end], inside - at, np.concatenate([lead, codes[own : own + len(inside)]])), at not in inside
            at = end


def _cut(data: np.ndarray, at: int, end: int, stop: int, edge: np.ndarray) -> int:
    """A place after ``at``, near ``end``, that no word runs over."""
    back = np.flatnonzero(_CLASS[data[at:end]])
    text = int(edge[np.searchsorted(edge, end, "right") - 1])  # where the text at ``end`` begins
    found = max(at + int(back[-1]) + 1 if len(back) else at, text)
    if found > at:
        return found
    close = int(edge[np.searchsorted(edge, end, "left")])
    while end < close:
        ahead = np.flatnonzero(_CLASS[data[end : min(close, end + CHUNK)]])
        if len(ahead):
            return end + int(ahead[0])
        end = min(close, end + CHUNK)
    return close


class HatTrie:
    """Counts of keys (big-endian word numbers): nodes by word above, hash containers below."""

    def __init__(self, burst: int = BURST, entries: int = ENTRIES) -> None:
        self.burst, self.most = burst, entries
        self.root: dict[bytes, list] = {}  # first word -> [entries, child]; a child is a container or a node
        self.size = 0

    def add(self, first: bytes, rests: list[bytes], counts: list[int]) -> None:
        """Keys that begin with one word, as what follows it."""
        slot = self.root.get(first)
        if slot is None:
            slot = self.root[first] = [0, Container()]
        before = slot[0]
        slot[1], slot[0] = self._put(slot[1], slot[0], rests, counts)
        self.size += slot[0] - before

    def _put(self, child, held: int, rests: list[bytes], counts: list[int]):
        if isinstance(child, Container):
            before = len(child)
            child.deep = child.deep or max(map(len, rests)) > 8
            for rest, n in zip(rests, counts, strict=True):
                child[rest] += n
            held += len(child) - before
            if len(child) > self.burst and child.deep:
                return self._burst(child), held
            return child, held
        by: dict[bytes, tuple[list, list]] = {}
        for rest, n in zip(rests, counts, strict=True):
            into = by.setdefault(rest[:8], ([], []))
            into[0].append(rest[8:])
            into[1].append(n)
        for word, (own, n) in by.items():
            below = child.get(word)
            if below is None:
                below = child[word] = [0, Container()]
            before = below[0]
            below[1], below[0] = self._put(below[1], below[0], own, n)
            held += below[0] - before
        return child, held

    def _burst(self, container: Container) -> Node:
        node = Node()
        for rest, n in container.items():
            below = node.get(rest[:8])
            if below is None:
                below = node[rest[:8]] = [0, Container()]
            below[1][rest[8:]] += n
            below[1].deep = below[1].deep or len(rest) > 16
        for below in node.values():
            below[0] = len(below[1])
        return node

    def full(self) -> bool:
        return self.size > self.most

    def spill(self, keep: int) -> Iterator[tuple[bytes, int]]:
        """Takes out the largest subtrees, until at most ``keep`` entries are left, as one run sorted by key."""
        leaving, left = [], self.size
        for word in sorted(self.root, key=lambda w: -self.root[w][0]):
            if left <= keep:
                break
            leaving.append(word)
            left -= self.root[word][0]
        for word in sorted(leaving):
            held, child = self.root.pop(word)
            self.size -= held
            yield from self._sorted(word, child)

    def _sorted(self, prefix: bytes, child) -> Iterator[tuple[bytes, int]]:
        if isinstance(child, Container):
            for rest in sorted(child):
                yield prefix + rest, child[rest]
        else:
            for word in sorted(child):
                yield from self._sorted(prefix + word, child[word][1])


class Container(dict):
    """A hash table of what follows a prefix. ``deep``: more than a last word does, so it can be dealt to children."""

    deep = False

    def __missing__(self, key: bytes) -> int:
        return 0


class Node(dict):
    """Next word -> [entries, child]."""


def _index(h: np.ndarray, bits: int) -> np.ndarray:
    return _mixed(h ^ _MIX[0]) >> np.uint64(64 - bits)


def _in_map(found: np.ndarray, h: np.ndarray) -> np.ndarray:
    bits = int(found.size).bit_length() + 2
    i = _index(h, bits)
    return (found[(i >> np.uint64(3)).astype(np.int64)] >> (i & np.uint64(7)).astype(np.uint8)) & 1 == 1


def _pairs(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return _mixed(a * _MIX[0] + b)


def word_counts(texts: DataFrame) -> DataFrame:
    """lang, word, number, n of every word in each task's runs; for all words of a language a row without word."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names: dict[int, str] = {}
        held: dict[int, list] = {}  # number -> [language's number, word, count]
        total: dict[int, int] = {}

        def flush() -> pa.RecordBatch:
            rows = [(names[lang], word, k, n) for k, (lang, word, n) in held.items()] + [(names[lang], None, 0, n) for lang, n in total.items()]
            held.clear()
            total.clear()
            lang, word, k, n = zip(*rows, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(lang), pa.array(word, pa.string()), pa.array(np.array(k, np.uint64).view(np.int64)), pa.array(n, pa.int64())], names=["lang", "word", "number", "n"])

        for words, _ in stretches(batches, names):
            if not len(words.number):
                continue
            numbers, first, counts = np.unique(words.number, return_index=True, return_counts=True)
            for k, i, n in zip(numbers.tolist(), first.tolist(), counts.tolist(), strict=True):
                own = held.get(k)
                if own is None:
                    held[k] = [int(words.lang[i]), words.word(i), n]
                else:
                    own[2] += n
            for lang, n in zip(*(x.tolist() for x in np.unique(words.lang, return_counts=True)), strict=True):
                total[lang] = total.get(lang, 0) + n
            if len(held) > ENTRIES:
                yield flush()
        if total:
            yield flush()

    runs = texts.mapInArrow(run, "lang string, word string, number long, n long")
    return runs.groupBy("lang", "word", "number").agg(F.sum("n").alias("n"))


def bit_map(numbers: DataFrame, column: str) -> np.ndarray:
    """A bit for each number of the column; 8 bits or more a number while ``MOST_BITS`` allow. Comes to the driver by bytes that have a bit set."""
    n = numbers.count()
    bits = min(MOST_BITS, max(16, int(n * 16).bit_length()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            i = _index(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64), bits)
            yield pa.RecordBatch.from_arrays([pa.array((i >> np.uint64(6)).view(np.int64)), pa.array(np.left_shift(np.uint64(1), i & np.uint64(63)).view(np.int64))], names=["at", "mask"])

    held = numbers.select(column).mapInArrow(run, "at long, mask long").groupBy("at").agg(F.bit_or("mask").alias("mask")).toArrow()
    found = np.zeros(1 << (bits - 6), np.uint64)
    found[held.column("at").to_numpy()] = held.column("mask").to_numpy().view(np.uint64)
    return found.view(np.uint8)


def pair_buckets(texts: DataFrame, frequent, words: int, least: int) -> np.ndarray:
    """A bit map of the buckets in which pairs of frequent words stand ``least`` times or more, taken together.

    Each task counts into a table of fixed size, whose pieces are added up one piece a group.
    """
    bits = min(PAIR_BUCKETS, max(PIECE, (words // 16).bit_length()))
    small = least <= 255
    most = 255 if small else 2**31 - 1

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = np.zeros(1 << bits, np.uint8 if small else np.uint32)
        for number, piece, keep in _joined(batches, 2):
            link = _links(number, piece, frequent.value)[: len(number) - max(keep, 1)]
            at = np.flatnonzero(link)
            bucket, n = np.unique(_index(_pairs(number[at], number[at + 1]), bits).view(np.int64), return_counts=True)
            table[bucket] = np.minimum(table[bucket].astype(np.int64) + n, most)
        pieces = table.reshape(-1, 1 << PIECE)
        used = np.flatnonzero(pieces.any(axis=1))
        for k in range(0, len(used), 64):
            yield pa.RecordBatch.from_arrays([pa.array(used[k : k + 64]), pa.array([pieces[i].tobytes() for i in used[k : k + 64]], pa.binary())], names=["piece", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, total = None, np.zeros(1 << PIECE, np.int64)
        full = lambda: pa.RecordBatch.from_arrays([pa.array([now]), pa.array([np.packbits(total >= least, bitorder="little").tobytes()])], names=["piece", "bits"])
        for batch in batches:
            for k, held in zip(batch.column("piece").to_pylist(), batch.column("counts"), strict=True):
                if k != now:
                    if now is not None:
                        yield full()
                    now, total[:] = k, 0
                total += np.frombuffer(held.as_buffer(), table_type)
        if now is not None:
            yield full()

    table_type = np.uint8 if small else np.uint32
    tables = texts.mapInArrow(count, "piece long, counts binary")
    held = tables.repartition("piece").sortWithinPartitions("piece").mapInArrow(add, "piece long, bits binary").toArrow()
    found = np.zeros((1 << (bits - PIECE), 1 << (PIECE - 3)), np.uint8)
    for k, bits_ in zip(held.column("piece").to_pylist(), held.column("bits").to_pylist(), strict=True):
        found[k] = np.frombuffer(bits_, np.uint8)
    return found.ravel()


def _joined(batches: Iterator[pa.RecordBatch], longest: int) -> Iterator[tuple[np.ndarray, np.ndarray, int]]:
    """(numbers, pieces, keep) of words; the last ``keep`` come again at the next's begin, for what follows them in their piece."""
    carried = np.zeros(0, np.uint64)  # last words of a piece that a cut runs through
    for words, goes_on in stretches(batches):
        lead = carried if goes_on else carried[:0]
        if len(carried) and not goes_on:
            yield carried, np.zeros(len(carried), np.int64), 0
        number, piece = np.concatenate([lead, words.number]), np.concatenate([np.zeros(len(lead), np.int64), words.piece])
        keep = int((piece[-(longest - 1) :] == words.last_piece).sum())
        carried = number[len(number) - keep :].copy()
        if len(number):
            yield number, piece, keep
    if len(carried):
        yield carried, np.zeros(len(carried), np.int64), 0


def _links(number: np.ndarray, piece: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Whether word i and the next are frequent words of one piece."""
    ok = _in_map(frequent, number)
    return ok[:-1] & ok[1:] & (piece[:-1] == piece[1:])


def _windows(batches: Iterator[pa.RecordBatch], frequent: np.ndarray, pairs: np.ndarray, longest: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(n x longest numbers, lengths) of the stretches of two words or more, from every word on, of which all pairs may be frequent."""
    for number, piece, keep in _joined(batches, longest):
        n = len(number)
        link = _links(number, piece, frequent)
        link[link] = _in_map(pairs, _pairs(number[:-1][link], number[1:][link]))
        size = np.ones(n, np.int64)
        run = np.append(link, False)
        for k in range(1, longest):
            size += run
            run = run & np.append(link[k:], np.zeros(min(k + 1, n), bool))[:n]
        start = np.flatnonzero(size[: n - keep] > 1)
        if len(start):
            index = start[:, None] + np.arange(longest)
            valid = np.arange(longest) < size[start][:, None]
            yield np.where(valid, number[np.minimum(index, n - 1)], np.uint64(0)), size[start]


def parts_of(rows: np.ndarray, parts: int) -> np.ndarray:
    """The prefix partition of each stretch: its first two words and, in ``SPLIT`` parts, the third decide."""
    return (_mixed(_pairs(rows[:, 0], rows[:, 1]) + rows[:, 2] % np.uint64(SPLIT)) % np.uint64(parts)).view(np.int64)


def stretch_runs(texts: DataFrame, frequent, pairs, parts: int, longest: int = LONGEST, burst: int = BURST, entries: int = ENTRIES) -> DataFrame:
    """part, keys, counts: what leaves the tasks' tries, a sorted run for each prefix partition. ``frequent`` and ``pairs``: broadcast bit maps."""
    width = 8 * longest

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = HatTrie(burst, entries)

        def out(keep: int) -> Iterator[pa.RecordBatch]:
            """Keys shorter than the longest end in zeros; a part's keys stay in order."""
            leaving = trie.spill(keep)
            while held := list(itertools.islice(leaving, entries)):
                rows = np.frombuffer(b"".join([k.ljust(width, b"\0") for k, _ in held]), ">u8").astype(np.uint64).reshape(-1, longest)
                counts = np.array([n for _, n in held], np.int64)
                part = parts_of(rows, parts)
                by = np.argsort(part, kind="stable")
                rows, counts, part = rows[by], counts[by], part[by]
                edge = np.append(np.flatnonzero(np.append(True, part[1:] != part[:-1])), len(part)).tolist()
                for k in range(0, len(edge) - 1, 1000):
                    own = list(zip(edge[k : k + 1000], edge[k + 1 : k + 1001], strict=False))
                    yield pa.RecordBatch.from_arrays([pa.array(part[[a for a, _ in own]]), pa.array([rows[a:b].tobytes() for a, b in own], pa.binary()), pa.array([counts[a:b].tobytes() for a, b in own], pa.binary())], names=["part", "keys", "counts"])

        for rows, size in _windows(batches, frequent.value, pairs.value, longest):
            mix = rows[:, 0].copy()
            for k in range(1, longest):
                mix = _mixed(mix) + rows[:, k] * _MIX[1]
            _, at, counts = np.unique(mix, return_index=True, return_counts=True)
            by = np.argsort(rows[at, 0], kind="stable")
            at, counts = at[by], counts[by].tolist()
            whole = rows[at].astype(">u8").tobytes()
            ends = (size[at] * 8).tolist()
            firsts = rows[at, 0]
            edge = np.append(np.flatnonzero(np.append(True, firsts[1:] != firsts[:-1])), len(firsts)).tolist()
            for a, b in zip(edge[:-1], edge[1:], strict=True):
                trie.add(whole[a * width : a * width + 8], [whole[k * width + 8 : k * width + ends[k]] for k in range(a, b)], counts[a:b])
                if trie.full():
                    yield from out(entries // 2)
        yield from out(0)

    return texts.mapInArrow(run, "part long, keys binary, counts binary")


def _summed(rows: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Runs merged: keys in order, each once."""
    by = np.lexsort(rows.T[::-1])
    rows, counts = rows[by], counts[by]
    first = np.flatnonzero(np.append(True, (rows[1:] != rows[:-1]).any(axis=1)))
    return rows[first], np.add.reduceat(counts, first)


def merged(runs: DataFrame, least: int, longest: int = LONGEST, most: int = MERGED) -> DataFrame:
    """key, n of all prefixes of two words or more that occur ``least`` times: the runs of each partition, merged.

    Prefixes of two words lie in up to ``SPLIT`` parts: each part's count goes on, and they are added up.
    """
    dealt = runs.repartition("part").sortWithinPartitions("part")

    def prefixes(rows: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
        keys, sums = [], []
        wide = np.ascontiguousarray(rows.astype(">u8"))
        change = np.zeros(len(rows), bool)
        change[0] = True
        for k in range(longest):
            change[1:] |= rows[1:, k] != rows[:-1, k]
            if k:
                first = np.flatnonzero(change)
                n = np.add.reduceat(counts, first)
                ok = (rows[first, k] != 0) & ((n >= least) | (k == 1))
                keys += [wide[i, : k + 1].tobytes() for i in first[ok].tolist()]
                sums.append(n[ok])
        return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(np.concatenate(sums))], names=["key", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, size = None, [], 0

        def joined() -> tuple[np.ndarray, np.ndarray]:
            return _summed(np.concatenate([r for r, _ in held]), np.concatenate([c for _, c in held]))

        for batch in batches:
            for part, keys, counts in zip(batch.column("part").to_pylist(), batch.column("keys"), batch.column("counts"), strict=True):
                if part != now and held:
                    yield prefixes(*joined())
                    held, size = [], 0
                now = part
                held.append((np.frombuffer(keys.as_buffer(), np.uint64).reshape(-1, longest), np.frombuffer(counts.as_buffer(), np.int64)))
                size += len(held[-1][1])
                if size > most:  # what is merged so far takes the room of its different keys only
                    held = [joined()]
                    size = len(held[0][1]) // 2
        if held:
            yield prefixes(*joined())

    found = dealt.mapInArrow(run, "key binary, n long")
    return found.groupBy("key").agg(F.sum("n").alias("n")).filter(F.col("n") >= least)


def scored(phrases: DataFrame, words: DataFrame, totals: DataFrame) -> DataFrame:
    """lang, key, a, l, r, n, score of each phrase by its lowest-scoring cut, without those that a longer one covers.

    ``phrases``: (key, n); ``words``: (lang, word, number, n), both frequent only; ``totals``: (lang, n).
    """
    as_key = F.unhex(F.lpad(F.hex("number"), 16, "0"))
    parts = words.select(as_key.alias("part"), F.col("n").alias("f")).union(phrases.select("key", "n"))
    cuts = phrases.select("key", F.col("n").alias("a"), F.explode(F.expr("sequence(1, cast(octet_length(key) / 8 as int) - 1)")).alias("k"))
    cuts = cuts.select("key", "a", "k", F.expr("substring(key, 1, 8 * k)").alias("left"), F.expr("substring(key, 8 * k + 1)").alias("right"), F.expr("substring(key, 1, 8)").alias("first"))
    known = cuts.join(parts.select(F.col("part").alias("left"), F.col("f").alias("l")), "left").join(parts.select(F.col("part").alias("right"), F.col("f").alias("r")), "right")
    langs = words.join(totals.withColumnRenamed("n", "all"), "lang").select(as_key.alias("first"), "lang", F.col("all").alias("n"))
    known = known.join(langs, "first")
    score = F.expr("(cast(1000 as decimal(38,0)) * a * n) div (cast(l as decimal(38,0)) * r)")
    best = known.groupBy("key", "a", "lang", "n").agg(F.min(F.struct(score.alias("score"), "k", "l", "r")).alias("b"))
    longer = phrases.filter("octet_length(key) > 16").select(F.explode(F.array(F.expr("substring(key, 1, octet_length(key) - 8)"), F.expr("substring(key, 9)"))).alias("key"), "n")
    covered = longer.groupBy("key").agg(F.max("n").alias("covered"))
    free = best.join(covered, "key", "left").filter("covered is null or covered < a")
    return free.select("lang", "key", "a", F.col("b.l").alias("l"), F.col("b.r").alias("r"), "n", F.col("b.score").alias("score"))


def collocations(docs: DataFrame, least: int = LEAST, top: int = TOP, burst: int = BURST, entries: int = ENTRIES) -> DataFrame:
    """lang, rank, phrase, a, l, r, n, score of each language's first phrases."""
    spark: SparkSession = docs.sparkSession
    held: list[DataFrame] = []
    texts = docs.select("text", F.coalesce(F.col("lang").cast("string"), F.lit("und")).alias("lang"))
    counted = materialise(word_counts(texts).filter((F.col("n") >= least) | F.col("word").isNull()), "phrase-words")
    words, totals = counted.filter("word is not null"), counted.filter("word is null").select("lang", "n")
    frequent = spark.sparkContext.broadcast(bit_map(words, "number"))
    n = totals.agg(F.sum("n")).first()[0] or 0
    pairs = spark.sparkContext.broadcast(pair_buckets(texts, frequent, n, least))
    phrases = materialise(merged(stretch_runs(texts, frequent, pairs, min(MOST_PARTS, n // PART_WORDS + 64), burst=burst, entries=entries), least), "phrases", held=held)
    ranked = materialise(scored(phrases, words, totals), "phrase-scores")
    for done in held:
        release(done)
    frequent.destroy()
    pairs.destroy()
    first = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"))
    best = ranked.withColumn("near", F.rank().over(first)).filter(F.col("near") <= top).drop("near")
    named = words.select(F.unhex(F.lpad(F.hex("number"), 16, "0")).alias("part"), "word")
    places = best.select("key", F.explode(F.expr("transform(sequence(1, cast(octet_length(key) / 8 as int)), k -> named_struct('k', k, 'part', substring(key, 8 * k - 7, 8)))")).alias("p"))
    spelled = places.select("key", "p.k", "p.part").join(named, "part").groupBy("key").agg(F.sort_array(F.collect_list(F.struct("k", "word"))).alias("w"))
    phrase = best.join(spelled.select("key", F.concat_ws(" ", F.col("w.word")).alias("phrase")), "key")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    return phrase.withColumn("rank", rank.cast("long")).filter(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations_sql(least: int = LEAST, top: int = TOP) -> str:
    """The same in DuckDB SQL, all phrases counted as texts."""
    piece = r"[.,;:!?\x0A-\x0D]"
    upper = "".join(map(chr, range(65, 91)))
    return f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), '{upper}', '{upper.lower()}'), '{piece}')) AS piece FROM documents
),
cut AS MATERIALIZED (
  SELECT lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') AS w FROM pieces
),
totals AS (
  SELECT lang, sum(len(w))::HUGEINT AS n FROM cut GROUP BY lang
),
places AS (
  SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM cut WHERE len(w) > 0
),
f AS MATERIALIZED (
  SELECT lang, p, count(*)::HUGEINT AS f FROM (
    {" UNION ALL ".join(f"SELECT lang, w[i : i + {k - 1}] AS p FROM places WHERE i + {k - 1} <= len(w)" for k in range(1, LONGEST + 1))})
  GROUP BY lang, p HAVING count(*) >= {least}
),
scores AS (
  SELECT f.lang, f.p, f.f AS a, k, l.f AS l, r.f AS r, n, 1000 * f.f * n // (l.f * r.f) AS score
  FROM f, range(1, {LONGEST}) t(k), f l, f r, totals
  WHERE len(f.p) > k AND l.lang = f.lang AND l.p = f.p[1 : k] AND r.lang = f.lang AND r.p = f.p[k + 1 :] AND totals.lang = f.lang
),
best AS MATERIALIZED (
  SELECT * FROM scores QUALIFY row_number() OVER (PARTITION BY lang, p ORDER BY score, k) = 1
),
covered AS MATERIALIZED (
  SELECT f.lang, f.p[i : i + j - 1] AS p, max(f.f) AS most FROM f, range(2, {LONGEST}) t(j), range(1, {LONGEST}) u(i) WHERE j < len(f.p) AND i + j - 1 <= len(f.p) GROUP BY ALL
)
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, array_to_string(p, ' '))::BIGINT AS rank, array_to_string(p, ' ') AS phrase,
  a::BIGINT AS a, l::BIGINT AS l, r::BIGINT AS r, n::BIGINT AS n, score::BIGINT AS score
FROM best LEFT JOIN covered USING (lang, p) WHERE most IS NULL OR 100 * most < 100 * a
QUALIFY rank <= {top}
"""
