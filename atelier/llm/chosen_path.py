"""N-gram Jaccard self-join by chosen paths (Christiani, Pagh and Sivertsen).

Texts are sets of five-word shingles; links are pairs of similarity 0.8 or more.

1. Texts with equal shingle sets fold into one representative (a pre-aggregated group).
2. Each representative is embedded as ``TOKENS`` MinHash tokens. A node of the search tree picks
   some token positions by a hash of its own path; sets that share a picked token share a child.
   Buckets of at most ``LEAF`` are brute-forced on the tokens. In larger ones a member chosen by hash
   is the head: what is close to it joins it, what is all but equal to it is settled, and the rest
   is split again; at ``DEPTH`` what is still large hangs together as it is. Runs with other seeds repeat this until
   the target recall (``runs_for``).
3. What hangs together, a superset of the links, forms clusters (distributed components). Texts move
   once: a cluster's texts meet in blocks of ``BLOCK``. A cluster of one block is compared there. In
   a larger one each text is written as its differences from the text of the cluster's root (shingles
   gone and new), and every pair of wider blocks of ``WIDE`` texts is compared by these: the
   common shingles of two texts are those of the root less what either lacks, plus what both lack
   or both have new. So what moves with the number of pairs of blocks is differences, not texts.
   All tasks are bounded (by texts and by shingles), and only counts per text leave them.

Joins by keys that may own a large share of all rows (a path, a cluster, a class, a set of
shingles) bring the few hot keys to their rows (``common.skew_join``).

Defined results: texts without words are never linked; null texts count as empty; repeated rows
are copies of each other, each with its own row; equal similarities need no rule, as all links
count; very long texts are read whole; an empty table gives no rows; only doc_id and text are read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from atelier.llm.common import components, grouped, materialise, pieces, reading, release, skew_join
from atelier.llm.words import U, mix, shingles

SHINGLE = 5
SIMILARITY = 0.8
TOKENS = 64
LEAF = 256
DEPTH = 4
BLOCK = 128  # texts of a block on average ...
BLOCK_SHINGLES = 200_000  # ... or fewer, if they have more shingles than this together
WIDE = 1024  # texts of a block of differences on average ...
WIDE_SHINGLES = 400_000  # ... or fewer, if they have more differences than this together
DENSE = 48  # shingles of at most so many holders are counted pair by pair, others by a matrix product
RECALL = 0.99
NEAR = 0.45  # members of a large bucket that hang together with its head
SETTLED = 0.75  # those that need no further splitting: what matches them (0.8) is NEAR the head as well
SKETCH_SLACK = 0.2  # tokens may show a similarity so much too low: four standard deviations

_RNG = np.random.default_rng(2017)
_FACTOR = _RNG.integers(1, 1 << 63, TOKENS, dtype=np.uint64) | U(1)
_SHIFT = _RNG.integers(1, 1 << 63, TOKENS, dtype=np.uint64)


def runs_for(recall: float = RECALL, depth: int = 3) -> int:
    """Runs that find a pair at the threshold with probability ``recall``, ``depth`` splits down.

    Such a pair shares on average one child at each node, so its line dies out with the
    probability of a critical branching process.
    """
    lost = 0.0
    for _ in range(depth):
        lost = math.exp(lost - 1)
    return math.ceil(math.log(1 - recall) / math.log(lost))


def tokens(value: np.ndarray, first: np.ndarray) -> np.ndarray:
    """MinHash tokens (rows x TOKENS, uint32) of the sets that start at ``first``."""
    out = np.empty((len(first), TOKENS), np.uint32)
    for k in range(TOKENS):
        out[:, k] = np.minimum.reduceat(((value * _FACTOR[k] + _SHIFT[k]) >> U(32)).astype(np.uint32), first)
    return out


def picks(path: np.ndarray, similarity: float = SIMILARITY) -> np.ndarray:
    """Positions that each node picks: each with probability 1 / (similarity * TOKENS) (bool matrix)."""
    return mix(path[:, None] + _SHIFT[None, :]) < U(int(2**64 / (similarity * TOKENS)))


def children(path: np.ndarray, sketch: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(row, child path) of each picked token."""
    row, position = np.nonzero(picks(path))
    child = mix(mix(path[row] + _FACTOR[position]) + sketch[row, position])
    return row, child


def profiles(docs: DataFrame, size: int, runs: int) -> DataFrame:
    """doc_id, text key, set key (f1, f2), tokens and first-level paths of each row."""
    roots = mix(np.arange(1, runs + 1, dtype=np.uint64) * U(0x9E3779B97F4A7C15))
    picked = [(roots[r], np.flatnonzero(p)) for r, p in enumerate(picks(roots))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in pieces(batch, "text"):
                value, row = shingles(part.column("text"), size)
                n = part.num_rows
                count = np.bincount(row, minlength=n)
                has = np.flatnonzero(count)
                first = np.searchsorted(row, has)
                f1, f2 = np.zeros(n, np.uint64), np.zeros(n, np.uint64)
                sketch = np.zeros((n, TOKENS), np.uint32)
                if len(has):
                    f1[has] = np.add.reduceat(mix(value + U(1)), first)
                    f2[has] = np.add.reduceat(mix(value ^ U(0x5555555555555555)), first)
                    sketch[has] = tokens(value, first)
                paths = np.concatenate([mix(mix(root + _FACTOR[at])[None, :] + sketch[:, at]) for root, at in picked], axis=1)
                width = paths.shape[1]
                empty = pa.array(count == 0)
                lists = pa.ListArray.from_arrays(pa.array(np.arange(0, n * width + 1, width, dtype=np.int32)), pa.array(paths.reshape(-1).view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id").cast(pa.int64()), part.column("key"), pa.array(f1.view(np.int64)), pa.array(f2.view(np.int64)), empty, pa.array(count, pa.int64()), pa.array([x.tobytes() for x in sketch], pa.binary()), lists],
                    names=["doc_id", "key", "f1", "f2", "empty", "size", "sketch", "paths"],
                )

    rows = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    return rows.mapInArrow(run, "doc_id long, key long, f1 long, f2 long, empty boolean, size long, sketch binary, paths array<long>")


def _split(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Members of large buckets against their bucket's head: edges for what is close to it; children
    for all but those so close that whatever they match is close to the head, too."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sketch, head = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, TOKENS) for c in ("sketch", "head_sketch"))
        alike = (sketch == head).mean(1)
        near, far = np.flatnonzero(alike >= NEAR), np.flatnonzero(alike < SETTLED)
        row, child = children(batch.column("path").to_numpy().view(np.uint64)[far], sketch[far])
        at = pa.array(far[row])
        yield pa.RecordBatch.from_arrays(
            [pa.array(child.view(np.int64)), batch.column("uid").take(at), batch.column("sketch").take(at), pa.nulls(len(row), pa.int64()), pa.nulls(len(row), pa.list_(pa.int64()))], names=["path", "uid", "sketch", "head", "members"]
        )
        uid, hub = (batch.column(c).to_numpy()[near] for c in ("uid", "head"))
        order = np.argsort(hub, kind="stable")
        hubs, first = np.unique(hub[order], return_index=True)
        n = len(hubs)
        members = pa.array(np.split(uid[order], first[1:]) if n else [], pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([pa.nulls(n, pa.int64()), pa.nulls(n, pa.int64()), pa.nulls(n, pa.binary()), pa.array(hubs), members], names=["path", "uid", "sketch", "head", "members"])


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest member of the component of each of n nodes, by minimum labels and pointer jumps."""
    label = np.arange(n)
    while len(a):
        low = np.minimum(label[a], label[b])
        new = label.copy()
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        new = new[new]
        new = new[new]
        if (new == label).all():
            break
        label = new
    return label


def _leaf_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Brute force on the tokens of each bucket of at most LEAF sets; a tree of edges per bucket."""
    least = (SIMILARITY - SKETCH_SLACK) * TOKENS
    a_out, b_out, held = [], [], 0
    for _, group in grouped(batches, ["path"]):
        uid = group.column("uid").to_numpy()
        sketch = np.frombuffer(b"".join(group.column("sketch").to_pylist()), np.uint32).reshape(-1, TOKENS)
        order = np.argsort(uid)
        uid, sketch = uid[order], sketch[order]
        x, y = np.triu_indices(len(uid), 1)
        close = (sketch[x] == sketch[y]).sum(1) >= least
        root = _roots(len(uid), x[close], y[close])
        moved = np.flatnonzero(root != np.arange(len(uid)))
        a_out.append(uid[moved])
        b_out.append(uid[root[moved]])
        held += len(moved)
        if held > 50_000:
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_out)), pa.array(np.concatenate(b_out))], names=["a", "b"])
            a_out, b_out, held = [], [], 0
    if held:
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(a_out)), pa.array(np.concatenate(b_out))], names=["a", "b"])


def candidate_edges(sets: DataFrame, scratch: list[DataFrame]) -> DataFrame:
    """Edges (a, b) over (uid, sketch, paths): every pair that some run brings into one bucket is connected."""
    spark = sets.sparkSession
    level = sets.select(F.explode("paths").alias("path"), "uid")
    sketches = sets.select("uid", "sketch")
    leaves, edges = [], []
    for depth in range(1, DEPTH + 1):
        drawn = F.xxhash64("uid", "path")
        sizes = materialise(level.groupBy("path").agg(F.count(F.lit(1)).alias("n"), F.min(drawn).alias("lowest")).filter("n > 1"), "sizes", narrow=True, held=scratch)
        sized = skew_join(level, sizes, ["path"], "n")
        if depth == 1:  # tokens only for what has company
            sized = sized.join(sketches, "uid")
        sized = materialise(sized, "paths", held=scratch)
        leaves.append(sized.filter(F.col("n") <= LEAF).select("path", "uid", "sketch"))
        large = sized.filter(F.col("n") > LEAF)
        if large.isEmpty():
            break
        heads = large.filter(drawn == F.col("lowest")).select("path", F.col("uid").alias("head"), F.col("sketch").alias("head_sketch"), "n")
        led = skew_join(large.select("path", "uid", "sketch"), heads, ["path"], "n").drop("n")
        if depth == DEPTH:
            edges.append(led.select(F.col("uid").alias("a"), F.col("head").alias("b")))
            break
        split = materialise(led.mapInArrow(_split, "path long, uid long, sketch binary, head long, members array<long>"), "split", held=scratch)
        edges.append(split.filter("path is null").select(F.explode("members").alias("a"), F.col("head").alias("b")))
        level = split.filter("path is not null").select("path", "uid", "sketch")
    width = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    buckets = reduce(DataFrame.union, leaves).repartition(width, "path").sortWithinPartitions("path")  # no path is in two levels
    return reduce(DataFrame.union, edges, buckets.mapInArrow(_leaf_edges, "a long, b long"))


def common_counts(term: np.ndarray, row: np.ndarray, n: int) -> np.ndarray:
    """n x n: in how many terms two rows meet (each term once a row; the diagonal is not meant)."""
    _, term, holders = np.unique(term, return_inverse=True, return_counts=True)
    met = holders[term] > 1  # what one row alone holds meets nothing
    row, term = row[met], (np.cumsum(holders > 1) - 1)[term[met]]
    holders = holders[holders > 1]
    shared = np.zeros((n, n), np.float32)
    order = np.argsort(term, kind="stable")
    term, row = term[order], row[order]
    first = np.cumsum(holders) - holders
    for h in np.unique(holders[holders <= DENSE]).tolist():
        x, y = np.triu_indices(h, 1)
        at = first[holders == h]
        step = max(1, 2_000_000 // len(x))
        for low in range(0, len(at), step):
            own = row[at[low : low + step, None] + np.arange(h)]
            pair, count = np.unique((own[:, x] * n + own[:, y]).ravel(), return_counts=True)
            shared[pair // n, pair % n] += count
            shared[pair % n, pair // n] += count
    dense = np.repeat(holders > DENSE, holders)
    term, row = (np.cumsum(holders > DENSE) - 1)[term[dense]], row[dense]
    step = max(1, 4_000_000 // max(n, 1))
    top = int(term[-1]) + 1 if len(term) else 0
    for low in range(0, top, step):
        a, b = np.searchsorted(term, [low, low + step])
        part = np.zeros((n, min(step, top - low)), np.float32)
        part[row[a:b], term[a:b] - low] = 1
        shared += part @ part.T
    return shared


def linked_pairs(shared: np.ndarray, size: np.ndarray, similarity: float) -> np.ndarray:
    linked = shared >= similarity * (size[:, None] + size[None, :] - shared) - 1e-3
    linked &= shared > 0
    np.fill_diagonal(linked, False)
    return linked


_NAMES = ["uid", "links", "text_links", "root", "whole", "cluster", "copies", "size", "base", "gone", "new"]
_MET = "uid long, links long, text_links long, root long, whole boolean, cluster long, copies long, size long, base long, gone array<long>, new array<long>"


def _counted(uid: np.ndarray, copies: np.ndarray, linked: np.ndarray, whole: bool) -> list[pa.Array]:
    """Links of each text, and a tree over what is linked."""
    root = _roots(len(uid), *np.nonzero(np.triu(linked)))
    return [pa.array(uid), pa.array((linked * copies[None, :]).sum(1).astype(np.int64)), pa.array(linked.sum(1).astype(np.int64)), pa.array(uid[root]), pa.array(np.full(len(uid), whole))]


def _lists(parts: list[np.ndarray]) -> pa.Array:
    ends = np.cumsum([0, *map(len, parts)])
    return pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate(parts).view(np.int64)))


def _meet(size: int, similarity: float):
    """A block of texts of one cluster: compared if it is all of the cluster, else written as differences from the root's text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (cluster, _), group in grouped(batches, ["cluster", "block"]):
            is_root = group.column("is_root").to_numpy()
            uid, keep = np.unique(np.where(is_root, -1, group.column("uid").to_numpy()), return_index=True)
            group = group.take(pa.array(keep))  # the root's text goes first, if it is there as such
            value, row = shingles(group.column("text"), size)
            copies, n = group.column("copies").to_numpy(), len(uid)
            count = np.bincount(row, minlength=n)
            if group.column("blocks")[0].as_py() == 1:
                columns = _counted(uid, copies, linked_pairs(common_counts(value, row, n), count, similarity), True)
                types = [pa.int64()] * 4 + [pa.list_(pa.int64())] * 2
                yield pa.RecordBatch.from_arrays(columns + [pa.nulls(n, t) for t in types], names=_NAMES)
                continue
            cut = np.cumsum(count) - count
            root = np.sort(value[: count[0]])
            gone, new = [], []
            for k in range(1, n):
                own = value[cut[k] : cut[k] + count[k]]
                gone.append(np.setdiff1d(root, own, assume_unique=True))
                new.append(np.setdiff1d(own, root, assume_unique=True))
            if n == 1:
                continue
            m = n - 1
            columns = [pa.array(uid[1:]), *(pa.nulls(m, pa.int64()) for _ in range(3)), pa.nulls(m, pa.bool_()), pa.array(np.full(m, cluster)), pa.array(copies[1:])]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(count[1:].astype(np.int64)), pa.array(np.full(m, len(root))), _lists(gone), _lists(new)], names=_NAMES)

    return run


def _compare(similarity: float):
    """Exact comparison of the texts of one pair of wide blocks by their differences; counts and trees per text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, left, right), group in grouped(batches, ["cluster", "left", "right"]):
            group = group.combine_chunks()
            n = group.num_rows
            uid, copies, block, size = (group.column(c).to_numpy() for c in ("uid", "copies", "block", "size"))
            terms, rows, lost = [], [], np.zeros(n, np.int64)
            for name in ("gone", "new"):
                lists = group.column(name).combine_chunks()
                lengths = lists.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
                terms.append(lists.flatten().to_numpy(zero_copy_only=False))
                rows.append(np.repeat(np.arange(n), lengths))
                if name == "gone":
                    lost = lengths
            base = group.column("base")[0].as_py()
            shared = common_counts(np.concatenate(terms), np.concatenate(rows), n)
            shared += base - lost[:, None] - lost[None, :]
            linked = linked_pairs(shared, size, similarity)
            if left != right:
                linked &= block[:, None] != block[None, :]
            yield pa.RecordBatch.from_arrays(_counted(uid, copies, linked, False), names=_NAMES[:5])

    return run


def jaccard_join(docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: doc_id, class_id, n_links, n_text_links, n_copies.

    class_id: smallest doc_id of the texts linked with it, over any number of links.
    n_links: other rows of similarity 0.8 or more, copies included; n_text_links: other shingle
    sets of that similarity; n_copies: rows with its shingle set.
    """
    return _joined(docs, size, similarity, recall).drop("key", "first")


def _joined(docs: DataFrame, size: int, similarity: float, recall: float) -> DataFrame:
    """The join's rows with the text's key, and whether the row is the first of its class; written, and all else released, also after a failure."""
    scratch: list[DataFrame] = []
    try:
        return _written(docs, size, similarity, recall, scratch)
    finally:
        for done in scratch:
            release(done)


def _written(docs: DataFrame, size: int, similarity: float, recall: float, scratch: list[DataFrame]) -> DataFrame:
    spark = docs.sparkSession
    width = max(12, int(spark.conf.get("spark.sql.shuffle.partitions")))
    n = F.count(F.lit(1))
    rows = materialise(profiles(docs, size, runs_for(recall)).withColumn("uid", F.monotonically_increasing_id()), "profiles", held=scratch)
    groups = materialise(
        rows.filter("not empty").groupBy("f1", "f2").agg(F.min(F.struct(F.coalesce("doc_id", F.lit(2**63 - 1)).alias("d"), "uid")).alias("m"), n.alias("copies")).select("f1", "f2", F.col("m.uid").alias("uid"), "copies"), "groups", held=scratch
    )
    heads = groups.select("uid", "copies")
    sets = rows.select("uid", "sketch", "paths").join(heads.select("uid"), "uid")
    clusters = components(candidate_edges(sets, scratch), "clusters", scratch).select(F.col("node").alias("uid"), F.col("root").alias("cluster"))
    clusters = materialise(clusters.join(rows.select("uid", "doc_id", "key", "size"), "uid").join(heads, "uid"), "members", held=scratch)
    sizes = clusters.groupBy("cluster").agg(n.alias("members"), F.sum("size").alias("total")).filter("members > 1")
    blocks = F.ceil(F.greatest(F.col("members") / BLOCK, F.col("total") / BLOCK_SHINGLES)).cast("int")
    sizes = materialise(sizes.select("cluster", "members", blocks.alias("blocks")), "clusters", narrow=True, held=scratch)
    members = skew_join(clusters.drop("size"), sizes, ["cluster"], "members")
    texts = docs.select(F.col("doc_id").alias("__d"), F.xxhash64("text").alias("__k"), "text")
    if not clusters.join(rows.groupBy("doc_id", "key").agg(n.alias("n")).filter("n > 1"), ["key"]).isEmpty():
        texts = texts.dropDuplicates(["__d", "__k"])  # rows that repeat doc_id and text: one stays, thinned before the shuffle
    held = members.join(texts, F.col("doc_id").eqNullSafe(F.col("__d")) & (F.col("key") == F.col("__k")))
    held = held.withColumn("own_block", F.pmod(F.xxhash64("uid", F.lit(5)), "blocks").cast("int"))
    is_root = (F.col("uid") == F.col("cluster")) & (F.col("blocks") > 1)
    dealt = held.withColumn("to", F.explode(F.when(is_root, F.sequence(F.lit(-1), F.col("blocks") - 1)).otherwise(F.array(F.lit(-1)))))  # the root's text goes to each block, too
    dealt = dealt.select("cluster", F.when(F.col("to") < 0, F.col("own_block")).otherwise(F.col("to")).alias("block"), (F.col("to") >= 0).alias("is_root"), "uid", "blocks", "copies", "text")
    dealt = dealt.repartition(width, "cluster", "block").sortWithinPartitions("cluster", "block")
    met = materialise(dealt.mapInArrow(_meet(size, similarity), _MET), "met", held=scratch)
    folded = met.filter("cluster is not null").drop("links", "text_links", "root", "whole")
    wide = folded.groupBy("cluster").agg(n.alias("members"), F.sum(F.size("gone") + F.size("new")).alias("total"))
    wide = materialise(wide.select("cluster", "members", F.ceil(F.greatest(F.col("members") / WIDE, F.col("total") / WIDE_SHINGLES)).cast("int").alias("blocks")), "wide", narrow=True, held=scratch)
    folded = skew_join(folded, wide, ["cluster"], "members").withColumn("block", F.pmod(F.xxhash64("uid", F.lit(6)), "blocks").cast("int"))
    dealt = folded.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    dealt = dealt.select("cluster", F.least("block", "other").alias("left"), F.greatest("block", "other").alias("right"), "uid", "block", "copies", "size", "base", "gone", "new")
    dealt = dealt.repartition(width, "cluster", "left", "right").sortWithinPartitions("cluster", "left", "right")
    parts = dealt.mapInArrow(_compare(similarity), "uid long, links long, text_links long, root long, whole boolean")
    compared = materialise(met.filter("whole").select("uid", "links", "text_links", "root", "whole").union(parts), "compared", held=scratch)
    counts = compared.groupBy("uid").agg(F.sum("links").alias("links"), F.sum("text_links").alias("text_links"))
    classes = compared.filter("whole").select(F.col("uid").alias("node"), "root")
    parts = compared.filter("not whole and uid <> root").select(F.col("uid").alias("a"), F.col("root").alias("b"))
    if not parts.isEmpty():  # clusters of several blocks: the blocks' trees are joined
        joined = components(parts, "classes", scratch)
        alone = compared.filter("not whole").select(F.col("uid").alias("node")).distinct().join(joined, "node", "left_anti")
        classes = classes.union(joined).union(alone.select("node", F.col("node").alias("root")))
    ids = rows.select(F.col("uid").alias("node"), "doc_id")
    named = materialise(classes.join(ids, "node"), "named", narrow=True, held=scratch)
    last_id = F.coalesce("doc_id", F.lit(2**63 - 1))
    smallest = named.groupBy("root").agg(F.min("doc_id").alias("class_id"), F.min(F.struct(last_id.alias("d"), "node"))["node"].alias("first_uid"), n.alias("n"))
    smallest = materialise(smallest, "firsts", narrow=True, held=scratch)
    of_head = skew_join(named.select("root", "node"), smallest, ["root"], "n").select(F.col("node").alias("uid"), "class_id", "first_uid").join(counts, "uid")
    heads_out = groups.join(of_head, "uid", "left").join(ids.select(F.col("node").alias("uid"), F.col("doc_id").alias("head_id")), "uid")
    heads_out = heads_out.select("f1", "f2", "copies", F.coalesce("class_id", "head_id").alias("class_id"), F.coalesce("first_uid", "uid").alias("first_uid"), F.coalesce("links", F.lit(0)).alias("links"), F.coalesce("text_links", F.lit(0)).alias("text_links"))
    heads_out = materialise(heads_out, "heads", narrow=True, held=scratch)
    of_row = rows.select("doc_id", "key", "uid", "f1", "f2", "empty")
    full = skew_join(of_row.filter("not empty").drop("empty"), heads_out, ["f1", "f2"], "copies")
    full = full.select("doc_id", F.coalesce("class_id", "doc_id").alias("class_id"), (F.col("links") + F.col("copies") - 1).alias("n_links"), F.col("text_links").alias("n_text_links"), F.col("copies").alias("n_copies"), "key", (F.col("uid") == F.col("first_uid")).alias("first"))
    empty = of_row.filter("empty").select("doc_id", F.col("doc_id").alias("class_id"), F.lit(0).cast("long").alias("n_links"), F.lit(0).cast("long").alias("n_text_links"), F.lit(1).cast("long").alias("n_copies"), "key", F.lit(True).alias("first"))
    return materialise(full.union(empty), "joined")


def keep_one_of_each(docs: DataFrame, size: int = SHINGLE, similarity: float = SIMILARITY, recall: float = RECALL) -> DataFrame:
    """The rows of ``docs``, all columns unchanged, that are the first of their class.

    First is the smallest doc_id (no doc_id comes last); of repeated rows one stays.
    """
    names = ("__of_class_id", "__of_class_key")
    joined = _joined(docs, size, similarity, recall)
    found = joined.groupBy(F.coalesce("doc_id", F.lit(-(2**63))).alias(names[0]), F.col("key").alias(names[1]))
    found = materialise(found.agg(F.max("first").alias("stays"), F.count(F.lit(1)).alias("n")).filter("not stays or n > 1"), "classes")
    release(joined)
    keyed = docs.withColumns({names[0]: F.coalesce(F.col("doc_id"), F.lit(-(2**63))), names[1]: F.xxhash64("text")})
    if not found.filter("n > 1").isEmpty():  # rows that repeat doc_id and text are thinned before the shuffle
        keyed = keyed.dropDuplicates(list(names))
    kept = keyed.join(found.filter("not stays").select(*names), list(names), "left_anti")
    return reading(kept.select(*docs.columns), found)


def jaccard_join_sql(size: int = SHINGLE, similarity: float = SIMILARITY) -> str:
    """The exact join in DuckDB SQL, for small tables with a key: every pair that shares a shingle is counted."""
    return f"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[ \\t\\n\\x0b\\f\\r]+'), lambda x: x <> '') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {size} THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - {size - 2}), lambda i: array_to_string(w[i:i + {size - 1}], ' '))) END AS s FROM words
), keyed AS (
  SELECT doc_id, s, len(s) AS n, md5(array_to_string(list_sort(s), chr(31))) AS k FROM sets
), heads AS (
  SELECT k, min(doc_id) AS head, count(*) AS copies FROM keyed WHERE n > 0 GROUP BY k
), terms AS (
  SELECT head, n, copies, unnest(s) AS t FROM heads JOIN keyed ON doc_id = head
), links AS (
  SELECT a.head AS a, b.head AS b, any_value(b.copies) AS copies FROM terms a JOIN terms b ON a.t = b.t AND a.head <> b.head
  GROUP BY a.head, a.n, b.head, b.n HAVING count(*) >= {similarity} * (a.n + b.n - count(*)) - 1e-3
), reach AS (
  SELECT a AS node, a AS other FROM links UNION SELECT node, b FROM reach JOIN links ON a = other
), classes AS (
  SELECT node, min(other) AS class_id FROM reach GROUP BY node
), counts AS (
  SELECT a, sum(copies) AS rows_, count(*) AS texts FROM links GROUP BY a
)
SELECT doc_id, coalesce(class_id, head, doc_id) AS class_id, (coalesce(rows_, 0) + coalesce(copies, 1) - 1)::BIGINT AS n_links, coalesce(texts, 0) AS n_text_links, coalesce(copies, 1) AS n_copies
FROM keyed LEFT JOIN heads ON heads.k = keyed.k AND keyed.n > 0 LEFT JOIN classes ON node = head LEFT JOIN counts ON a = head
"""
