"""Prefix trie of conversations by truncation peeling.

Every distinct sequence of first turns is a node. Peeling starts at the deepest end: conversations that
end at a depth are merged with the nodes that survive from below, each node's sums are closed as it is
found, its last turn is stripped, and what is left is grouped again one turn higher, up to the root.

A node is named by its depth and the combined 128-bit digests of its turns (each with its place), so the names of
all prefixes are running sums, taken in blocks however long a conversation is. Conversations with the same turns are
merged into one end before anything is peeled.

Where it runs: an end is peeled inside a task down to its anchor, the depth (a power of two) from which on few
enough turns share its node; tasks hold whole groups of such ends, up to ``HELD`` turns at once, and
peel them depth by depth in numpy. Above the anchors each depth is one grouping with partial sums, so a first
turn that a third of all conversations share is no hot task. An end alone under its anchor is a chain, needs no merging,
and is written as it stands, whatever its length. The number of groupings is the deepest anchor: it grows only with the
depth down to which more than a thousandth of all turns (``LEAST_GROUP`` at least) share a node.

Defined results: turns are ordered by turn (null first), ties by role, then text (null is empty in both); repeated
rows are turns of their own; rows without conv_id belong to no conversation and are left out; a
conversation left without turns ends at the root; texts of any length count whole; an empty table has no
root and gives no rows; other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from atelier.llm.common import group_rank, materialise, release, skew_join

LENT = 6  # a conversation takes fewer first turns than this from its hundred's first
BLOCK = 10  # a window holds so many turns of one conversation, as a power of two
MEMBERS = 10  # numbers of one block of a node's ends, as a power of two
LEAST_GROUP, MOST_GROUP = 2_000, 200_000  # turns under one anchor
HELD = 400_000  # turns that a task peels at once

NODE = "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
_EMPTY = hashlib.sha256(b"").hexdigest()


def ordered_turns(rows: DataFrame) -> DataFrame:
    """conv_id, place (from 0), a, b (digest of role and text), size (code points of the text) of every turn.

    A sort by ranges, in which even one conversation's rows of one turn number are dealt over tasks; only these
    narrow rows are written, with their number in the order.
    """
    texts = rows.filter("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id"), "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    ranges = texts.repartitionByRange("conv_id", F.col("turn").asc_nulls_first(), F.substring("role", 1, 16), F.substring("text", 1, 32))
    digest = F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text").cast("binary"), 256)
    half = lambda at: F.conv(F.substring(digest, at, 16), 16, -10).cast("long")
    numbered = ranges.sortWithinPartitions("conv_id", F.col("turn").asc_nulls_first(), "role", "text").select("conv_id", F.monotonically_increasing_id().alias("at"), half(1).alias("a"), half(17).alias("b"), F.length("text").cast("long").alias("size"))
    held = materialise(numbered, "trie-turns")
    return group_rank(held, ["conv_id"], F.shiftright("at", 33), [F.col("at")], "place").drop("at")


def rebuilt(turns: DataFrame) -> DataFrame:
    """conv_id, depth (from 1), a, b, size: the first h turns of conversation c - c % 100, then c's own after its first h."""
    convs = turns.select("conv_id").distinct().select("conv_id", F.expr(f"crc32(cast(cast(conv_id as string) as binary)) % {LENT}").alias("h"), F.expr("conv_id - conv_id % 100").alias("base"))
    first = turns.filter(f"conv_id % 100 = 0 and place < {LENT}").withColumnRenamed("conv_id", "base")
    lent = convs.join(first, "base").filter("place < h").select("conv_id", (F.col("place") + 1).alias("depth"), "a", "b", "size")
    found = first.groupBy("base").agg(F.count(F.lit(1)).alias("held"))
    known = convs.join(found, "base", "left").select("conv_id", "h", F.least("h", F.coalesce("held", F.lit(0))).alias("taken"))
    own = turns.join(known, "conv_id").filter("place >= h").select("conv_id", (F.col("taken") + F.col("place") - F.col("h") + 1).alias("depth"), "a", "b", "size")
    return lent.union(own)


def paths(turns: DataFrame) -> DataFrame:
    """conv_id, depth, a, b (name of the node), up_a, up_b (its parent's), size, sized (code points up to here).

    A node's name is the exclusive or of its turns' digests, each mixed with its depth: running sums by blocks.
    """
    place = turns.select("conv_id", "depth", F.xxhash64("depth", "a", "b").alias("x"), F.xxhash64("b", "depth", "a", F.lit("y")).alias("y"), "size", F.shiftright("depth", BLOCK).alias("block"))
    running = Window.partitionBy("conv_id", "block").orderBy("depth")
    inside = place.select("*", F.bit_xor("x").over(running).alias("a"), F.bit_xor("y").over(running).alias("b"), F.sum("size").over(running).alias("sized"))
    blocks = place.groupBy("conv_id", "block").agg(F.bit_xor("x").alias("x"), F.bit_xor("y").alias("y"), F.sum("size").alias("words"))
    before = Window.partitionBy("conv_id").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    earlier = lambda c: F.coalesce(c.over(before), F.lit(0))
    offsets = blocks.select("conv_id", "block", earlier(F.bit_xor("x")).alias("xa"), earlier(F.bit_xor("y")).alias("xb"), earlier(F.sum("words")).alias("words"))
    named = inside.join(offsets.withColumnRenamed("conv_id", "c").withColumnRenamed("block", "k"), (F.col("conv_id") == F.col("c")) & (F.col("block") == F.col("k")))
    own = [F.col("a").bitwiseXOR(F.col("xa")), F.col("b").bitwiseXOR(F.col("xb"))]
    return named.select("conv_id", "depth", own[0].alias("a"), own[1].alias("b"), own[0].bitwiseXOR(F.col("x")).alias("up_a"), own[1].bitwiseXOR(F.col("y")).alias("up_b"), "size", (F.col("sized") + F.col("words")).alias("sized"))


def merged_ends(path: DataFrame, convs: DataFrame) -> DataFrame:
    """conv_id (smallest), depth, a, b, sized, n, ends of each distinct whole sequence; ``ends`` is the digest of its members' ids.

    Ids are joined in blocks of 2 ** ``MEMBERS`` numbers, and a digest streams through a node's blocks.
    """
    last = path.groupBy("conv_id").agg(F.max_by(F.struct("depth", "a", "b", "sized"), "depth").alias("e"))
    none = lambda name: F.coalesce(F.col(f"e.{name}"), F.lit(0).cast("long")).alias(name)
    ended = convs.join(last, "conv_id", "left").select("conv_id", *(none(c) for c in ("depth", "a", "b", "sized")))
    block = F.shiftright("conv_id", MEMBERS).alias("block")
    ids = ended.groupBy("depth", "a", "b", "sized", block).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    joined = ids.select("depth", "a", "b", "sized", "block", F.element_at("ids", 1).alias("conv_id"), F.size("ids").cast("long").alias("n"), F.concat_ws(",", F.col("ids").cast("array<string>")).alias("text"))
    key = ["depth", "a", "b"]
    dealt = joined.repartition(*key).sortWithinPartitions(*key, "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "depth", "a", "b", "sized", "n", "ends"]
        done, now, digest = [], None, None
        for batch in batches:
            for depth, a, b, sized, conv, n, text in zip(*(batch.column(c).to_pylist() for c in ("depth", "a", "b", "sized", "conv_id", "n", "text")), strict=True):
                if now is not None and now[1:4] == [depth, a, b]:
                    now[5] += n
                    digest.update(b"," + text.encode())
                    continue
                if now is not None:
                    done.append((*now, digest.hexdigest()))
                now, digest = [conv, depth, a, b, sized, n], hashlib.sha256(text.encode())
            if len(done) > 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=names)
                done = []
        if now is not None:
            done.append((*now, digest.hexdigest()))
        if done:
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in zip(*done, strict=True)], names=names)

    return dealt.mapInArrow(run, "conv_id long, depth long, a long, b long, sized long, n long, ends string")


def anchored(ends: DataFrame, path: DataFrame, most: int, held: list[DataFrame]) -> tuple[DataFrame, int]:
    """Ends with ``anchor`` (depth down to which a task peels them), ``top_a``, ``top_b`` (node there) and ``alone``; the deepest anchor.

    An end no deeper than the anchors tried is its own anchor: no task peels it.
    """
    parts, waiting, anchor, deepest = [], ends.filter("depth > 0"), 1, 0
    while True:
        node = path.filter(F.col("depth") == anchor).select("conv_id", F.col("a").alias("top_a"), F.col("b").alias("top_b"))
        placed = materialise(waiting.join(node, "conv_id"), "trie-anchors", held=held)
        under = placed.groupBy("top_a", "top_b").agg(F.count(F.lit(1)).alias("under"), F.sum(F.col("depth") - anchor).alias("turns"))
        hot = under.filter((F.col("turns") > most) & (F.col("under") > 1)).select("top_a", "top_b", F.lit(True).alias("hot"))
        found = placed.agg(F.max("depth"), F.count(F.lit(1))).first()
        if not found[1]:
            return parts_of(parts, placed), deepest
        deepest = anchor
        counted = placed.join(under.withColumn("hot", (F.col("turns") > most) & (F.col("under") > 1)), ["top_a", "top_b"]).drop("turns")
        counted = counted.withColumn("alone", F.col("under") == 1).drop("under")
        stays = (F.col("depth") == anchor) | ~F.col("hot")
        parts.append(counted.filter(stays).withColumn("anchor", F.lit(anchor).cast("long")).drop("hot"))
        if found[0] <= anchor or hot.isEmpty():
            return parts_of(parts, placed), deepest
        waiting, anchor = counted.filter(~stays).drop("hot", "alone", "top_a", "top_b"), anchor * 2
        # ends between this anchor and the next are their own anchors
        short = waiting.filter(F.col("depth") < anchor).select("*", F.col("a").alias("top_a"), F.col("b").alias("top_b"), F.lit(True).alias("alone"), F.col("depth").alias("anchor"))
        parts.append(short)
        between = short.agg(F.max("depth")).first()[0]
        deepest, waiting = max(deepest, between or 0), waiting.filter(F.col("depth") >= anchor)


def parts_of(parts: list[DataFrame], like: DataFrame) -> DataFrame:
    """All parts together; none: an empty table."""
    if not parts:
        return like.filter("false").select("*", F.lit(True).alias("alone"), F.lit(0).cast("long").alias("anchor"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


PEELED = f"a long, b long, up_a long, up_b long, rep long, open boolean, {NODE}"


def _peel(table: pa.Table) -> Iterator[pa.RecordBatch]:
    """Nodes of whole groups, found from the deepest end up; rows are turns sorted by (conv_id, depth).

    Nodes right below an anchor stay ``open``: their parents' smallest member is not known here.
    """
    col = {c: table.column(c).to_numpy() for c in ("rep", "depth", "a", "b", "up_a", "up_b", "size", "anchor", "last", "n")}
    order = np.lexsort((col["depth"], col["rep"]))
    col = {c: v[order] for c, v in col.items()}
    texts = table.column("ends").take(pa.array(order))
    start = np.flatnonzero(np.append(True, col["rep"][1:] != col["rep"][:-1]))
    anchor, last, n, conv = (col[c][start] for c in ("anchor", "last", "n", "rep"))
    by_end = np.argsort(-last, kind="stable")
    ends = texts.take(pa.array(start)).to_pylist()

    live = {k: np.zeros(0, np.int64) for k in ("rep", "n", "conv", "leaves", "saved", "node")}  # survivors, stripped
    waiting: list[tuple] = []  # nodes whose parents are not grouped yet
    at = 0
    for depth in range(int(last.max()), int(anchor.min()), -1):
        upto = at + np.searchsorted(-last[by_end[at:]], -depth, "right")
        new = by_end[at:upto]
        at = upto
        kept = anchor[live["rep"]] < depth  # others have reached their anchors
        live = {k: v[kept] for k, v in live.items()}
        rep = np.concatenate([live["rep"], new])
        if not len(rep):
            continue
        row = start[rep] + depth - anchor[rep] - 1
        child = np.concatenate([np.ones(len(live["rep"]), np.int64), np.zeros(len(new), np.int64)])
        total = {"n": np.concatenate([live["n"], n[new]]), "leaves": np.concatenate([live["leaves"], np.zeros(len(new), np.int64)]), "saved": np.concatenate([live["saved"], np.zeros(len(new), np.int64)])}
        least = np.concatenate([live["conv"], conv[new]])
        ended = np.concatenate([np.full(len(live["rep"]), -1, np.int64), new])
        by = np.lexsort((col["b"][row], col["a"][row]))
        a, b = col["a"][row][by], col["b"][row][by]
        first = np.flatnonzero(np.append(True, (a[1:] != a[:-1]) | (b[1:] != b[:-1])))
        sums = {k: np.add.reduceat(v[by], first) for k, v in total.items()}
        children, least = np.add.reduceat(child[by], first), np.minimum.reduceat(least[by], first)
        ended, rows = np.maximum.reduceat(ended[by], first), row[by][first]
        leaves = np.where(children == 0, 1, sums["leaves"])
        saved = sums["saved"] + (sums["n"] - 1) * col["size"][rows]
        group = np.repeat(np.arange(len(first)), np.diff(np.append(first, len(by))))
        for k in np.flatnonzero(by < len(live["rep"])).tolist():
            node = int(live["node"][by[k]])
            waiting[node] = (*waiting[node][:-2], int(least[group[k]]), False)
        ids = np.arange(len(waiting), len(waiting) + len(first))
        for k in range(len(first)):
            waiting.append((int(a[first[k]]), int(b[first[k]]), int(col["up_a"][rows[k]]), int(col["up_b"][rows[k]]), int(col["rep"][rows[k]]), int(least[k]), depth, int(sums["n"][k]), int(children[k]), int(leaves[k]), int(saved[k]), ends[ended[k]] if ended[k] >= 0 else _EMPTY, None, True))
        live = {"rep": rep[by][first], "n": sums["n"], "conv": least, "leaves": leaves, "saved": saved, "node": ids}
    names = ["a", "b", "up_a", "up_b", "rep", "conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "parent_conv_id", "open"]
    types = dict.fromkeys(names, pa.int64()) | {"ends_sha256": pa.string(), "open": pa.bool_()}
    order = [c.split()[0] for c in PEELED.split(", ")]
    for k in range(0, len(waiting), 20_000):
        cols = dict(zip(names, zip(*waiting[k : k + 20_000], strict=True), strict=True))
        yield pa.RecordBatch.from_arrays([pa.array(cols[c], types[c]) for c in order], names=order)


def peeled_in_tasks(ends: DataFrame, path: DataFrame) -> DataFrame:
    """Nodes below the anchors of ends that share theirs with others."""
    info = ends.filter("not alone and depth > anchor").select(F.col("conv_id").alias("rep"), F.col("depth").alias("last"), "anchor", "top_a", "top_b", "n", "ends")
    rows = path.withColumnRenamed("conv_id", "rep").join(info, "rep").filter("depth > anchor")
    rows = rows.withColumn("ends", F.expr("if(depth = last or depth = anchor + 1, ends, null)"))
    dealt = rows.repartition("top_a", "top_b").sortWithinPartitions("top_a", "top_b", "rep", "depth")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            if not batch.num_rows:
                continue
            if size + batch.num_rows > HELD and held:
                # the groups that are whole: all before the last one's first row
                whole = pa.Table.from_batches([*held, batch])
                tops = whole.column("top_a").to_numpy(), whole.column("top_b").to_numpy()
                change = np.flatnonzero((tops[0][1:] != tops[0][:-1]) | (tops[1][1:] != tops[1][:-1]))
                if len(change):
                    cut = int(change[-1]) + 1
                    yield from _peel(whole.slice(0, cut))
                    held, size = whole.slice(cut).to_batches(), whole.num_rows - cut
                    continue
            held.append(batch)
            size += batch.num_rows
        if size:
            yield from _peel(pa.Table.from_batches(held))

    return dealt.mapInArrow(run, PEELED)


def chains(ends: DataFrame, path: DataFrame) -> DataFrame:
    """Nodes below the anchors of ends that are alone there: nothing to merge, so each row is a node."""
    info = ends.filter("alone and depth > anchor").select(F.col("conv_id").alias("rep"), F.col("depth").alias("last"), F.col("sized").alias("all"), "anchor", "n", "ends")
    rows = path.withColumnRenamed("conv_id", "rep").join(info, "rep").filter("depth > anchor")
    saved = (F.col("n") - 1) * (F.col("all") - F.col("sized") + F.col("size"))
    top = F.col("depth") == F.col("anchor") + 1
    return rows.select(
        "a", "b", "up_a", "up_b", "rep", top.alias("open"), F.col("rep").alias("conv_id"), "depth", F.when(~top, F.col("rep")).alias("parent_conv_id"), F.col("n").alias("n_convs"),
        (F.col("depth") < F.col("last")).cast("long").alias("n_children"), F.lit(1).cast("long").alias("n_leaves"), saved.alias("saved_tokens"), F.when(F.col("depth") == F.col("last"), F.col("ends")).otherwise(_EMPTY).alias("ends_sha256"),
    )


def prefix_trie(turns: DataFrame, convs: DataFrame, most: int | None = None) -> DataFrame:
    """A row per node from (conv_id, depth, a, b, size) rows of all turns and all conv_ids."""
    held: list[DataFrame] = []
    path = materialise(paths(turns), "trie-paths", held=held)
    ends = materialise(merged_ends(path, convs), "trie-ends", held=held)
    path = path.join(ends.select("conv_id"), "conv_id", "left_semi")  # one member speaks for all with the same turns
    if most is None:
        total = ends.agg(F.sum("depth")).first()[0] or 0
        most = min(MOST_GROUP, max(LEAST_GROUP, total // 1000))
    known, deepest = anchored(ends, path, most, held)
    known = materialise(known, "trie-known", held=held)
    low = materialise(peeled_in_tasks(known, path).unionByName(chains(known, path)), "trie-low")

    names = [c.split()[0] for c in NODE.split(", ")]
    out = low.filter("not open").select(names)
    open_ = low.filter("open")
    key = ["a", "b"]
    for depth in range(deepest, -1, -1):
        # nodes one deeper lose their last turn; ends of this depth come in with theirs
        stripped = open_.filter(F.col("depth") == depth + 1).select(F.col("up_a").alias("a"), F.col("up_b").alias("b"), "rep", F.lit(1).alias("child"), F.col("n_convs").alias("n"), "conv_id", "n_leaves", "saved_tokens", F.lit(None).cast("string").alias("ends"))
        here = ends.filter("depth = 0") if not depth else known.filter((F.col("depth") == depth) & (F.col("anchor") == depth))
        new = here.select("a", "b", F.col("conv_id").alias("rep"), F.lit(0).alias("child"), "n", "conv_id", F.lit(0).cast("long").alias("n_leaves"), F.lit(0).cast("long").alias("saved_tokens"), "ends")
        grouped = stripped.union(new).groupBy(*key).agg(F.min("rep").alias("rep"), F.sum("child").alias("n_children"), F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.max("ends").alias("ends"))
        if depth:
            turn = path.filter(F.col("depth") == depth).select(F.col("conv_id").alias("rep"), "up_a", "up_b", "size")
            grouped = grouped.join(turn, "rep")
        else:
            grouped = grouped.select("*", *(F.lit(0).cast("long").alias(c) for c in ("up_a", "up_b", "size")))
        nodes = grouped.select(
            *key, "up_a", "up_b", "rep", F.lit(True).alias("open"), "conv_id", F.lit(depth).cast("long").alias("depth"), F.lit(None).cast("long").alias("parent_conv_id"), "n_convs", "n_children",
            F.when(F.col("n_children") == 0, F.lit(1).cast("long")).otherwise(F.col("leaves")).alias("n_leaves"), (F.col("saved") + (F.col("n_convs") - 1) * F.col("size")).alias("saved_tokens"), F.coalesce("ends", F.lit(_EMPTY)).alias("ends_sha256"),
        )
        nodes = materialise(nodes, "trie-nodes")
        children = open_.filter(F.col("depth") == depth + 1).drop("parent_conv_id")
        parents = nodes.select(F.col("a").alias("up_a"), F.col("b").alias("up_b"), F.col("conv_id").alias("parent_conv_id"), F.col("n_children").alias("__n"))
        out = out.unionByName(skew_join(children, parents, ["up_a", "up_b"], "__n").select(names))
        open_ = nodes.unionByName(low.filter(f"open and depth <= {depth}"))
    for done in held:
        release(done)
    return out.unionByName(open_.filter("depth = 0").select(names))


def trie_of_conversations(conversations: DataFrame) -> DataFrame:
    """op12: the trie of all conversations, rebuilt with the first turns of their hundred's first."""
    turns = materialise(ordered_turns(conversations), "trie-places")
    out = prefix_trie(rebuilt(turns), turns.select("conv_id").distinct())
    release(turns)
    return out


def trie_of_conversations_sql() -> str:
    """The same in DuckDB SQL: nodes by their whole prefix, sums over subtrees as sums over members' own nodes below."""
    return f"""
WITH
crc_table AS (
  SELECT list(value ORDER BY n) AS crcs FROM (
    SELECT n, list_reduce(list_prepend(n, range(8)), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END) AS value
    FROM range(256) t(n))
),
turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS place, role, text
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL)
),
convs AS (
  SELECT conv_id, conv_id - conv_id % 100 AS base, xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(length(conv_id::VARCHAR)), lambda i: ascii(substr(conv_id::VARCHAR, i + 1, 1))::BIGINT)),
      lambda c, b: xor(c >> 8, crcs[(xor(c, b) & 255) + 1]))) % {LENT} AS h
  FROM (SELECT DISTINCT conv_id FROM turns), crc_table
),
known AS (
  SELECT conv_id, base, h, least(h, (SELECT count(*) FROM turns t WHERE t.conv_id = c.base)) AS taken FROM convs c
),
rebuilt AS (
  SELECT k.conv_id, place + 1 AS depth, role, text FROM known k JOIN turns t ON t.conv_id = k.base WHERE place < h
  UNION ALL
  SELECT k.conv_id, taken + place - h + 1, role, text FROM known k JOIN turns t ON t.conv_id = k.conv_id WHERE place >= h
),
pathed AS (
  SELECT conv_id, depth, length(text) AS size, string_agg(sha256(length(role) || ':' || role || text), '') OVER (PARTITION BY conv_id ORDER BY depth) AS path FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs
),
members AS (
  SELECT *, min(conv_id) OVER (PARTITION BY path) AS first_, count(*) OVER (PARTITION BY path) AS n, max(depth) OVER (PARTITION BY conv_id) AS last_,
    max(depth) OVER (PARTITION BY conv_id) = depth AS ended FROM pathed
),
nodes AS (
  SELECT path, min(depth) AS depth, min(first_) AS conv_id, min(n) AS n, min(size) AS size, bool_and(ended) AS leaf, string_agg(CASE WHEN ended THEN conv_id::VARCHAR END, ',' ORDER BY conv_id) AS ends FROM members GROUP BY path
),
children AS (
  SELECT substr(path, 1, length(path) - 64) AS path, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1
),
below AS (
  SELECT conv_id, path, sum(CASE WHEN conv_id = first_ THEN (n - 1) * size ELSE 0 END) OVER w AS saved, sum(CASE WHEN conv_id = first_ AND leaf THEN 1 ELSE 0 END) OVER w AS leaves
  FROM (SELECT m.*, d.leaf FROM members m JOIN nodes d USING (path)) WINDOW w AS (PARTITION BY conv_id ORDER BY depth DESC)
),
summed AS (
  SELECT path, sum(saved) AS saved, sum(leaves) AS leaves FROM below GROUP BY path
)
SELECT d.conv_id, d.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, d.n::BIGINT AS n_convs, coalesce(n_children, 0)::BIGINT AS n_children, leaves::BIGINT AS n_leaves, saved::BIGINT AS saved_tokens, sha256(coalesce(d.ends, '')) AS ends_sha256
FROM nodes d JOIN summed USING (path) LEFT JOIN children USING (path) LEFT JOIN nodes u ON d.depth > 0 AND u.path = substr(d.path, 1, length(d.path) - 64)
"""
