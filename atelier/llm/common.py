"""Shared pieces of the corpus operators: tables, shared folder, ranks, joins with hot keys, components."""

from __future__ import annotations

import itertools
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from atelier.functions.shared import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialise(df: DataFrame, name: str, narrow: bool = False, held: list[DataFrame] | None = None) -> DataFrame:
    """Write ``df`` once to the shared folder and read it back: cuts lineage and recomputation.

    A lost executor only costs the tasks of the stage that was running. ``narrow``: rows of a few
    numbers, written by an eighth of the shuffle's partitions. ``held`` collects what is to be
    released later.
    """
    spark = df.sparkSession
    if narrow:
        df = df.coalesce(max(12, int(spark.conf.get("spark.sql.shuffle.partitions")) // 8))
    path = f"{shared_dir(spark)}/atelier/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.parquet(path)
    out._shared_path = path
    if held is not None:
        held.append(out)
    return out


def reading(df: DataFrame, *written: DataFrame) -> DataFrame:
    """``df``, of which ``release`` is to delete these written tables, too: it reads them."""
    df._reads = written
    return df


def release(df: DataFrame) -> None:
    """Delete what ``materialise`` wrote for ``df``, and what it reads, once nothing will read it again."""
    for other in getattr(df, "_reads", ()):
        release(other)
    path = getattr(df, "_shared_path", None)
    if path:
        spark = df.sparkSession
        place = spark._jvm.org.apache.hadoop.fs.Path(path)
        place.getFileSystem(spark._jsc.hadoopConfiguration()).delete(place, True)


def group_rank(df: DataFrame, groups: list[str], block: Column, order: list[Column], name: str) -> DataFrame:
    """Gapless rank from 0 inside each group, with no task holding a whole group.

    Rows of a group are split over the values of ``block``; ranks run through block 0, then block 1
    and so on. Only the counts (groups x blocks rows, bounded by the caller) meet in a window.
    """
    b = f"__{name}_block"
    dealt = df.withColumn(b, block)
    counts = dealt.groupBy(*groups, b).agg(F.count(F.lit(1)).alias("__n"))
    before = Window.partitionBy(*groups).orderBy(b).rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select(*groups, b, F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    ranked = dealt.withColumn("__rn", F.row_number().over(Window.partitionBy(*groups, b).orderBy(*order)))
    joined = ranked.join(offsets, [*groups, b])  # dealt alike: only the offsets move, or are broadcast if small
    return joined.withColumn(name, (F.col("__before") + F.col("__rn") - 1).cast("long")).drop("__before", "__rn", b)


HOT_ROWS = 200  # a key of fewer rows is never treated as hot
HOT_KEYS = 1_000


def skew_join(left: DataFrame, right: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Inner join on ``keys``, unique in ``right``, whose column ``count`` says how many rows of ``left`` have them, or more.

    Keys that own over a thousandth of the rows are hot. There can be at most ``HOT_KEYS`` such, so
    they are broadcast, and their rows of ``left`` stay where they are; the rest are dealt by key.
    """
    total, top = right.agg(F.sum(count), F.max(count)).first()
    bound = max(HOT_ROWS, (total or 0) // HOT_KEYS)
    if (top or 0) <= bound:
        return left.join(right, keys)
    hot = right.filter(F.col(count) > bound)
    rest = left.join(F.broadcast(hot.select(*keys)), keys, "left_anti")
    return left.join(F.broadcast(hot), keys).unionByName(rest.join(right.filter(F.col(count) <= bound), keys))


def pieces(batch: pa.RecordBatch, column: str, most_bytes: int = 750_000):
    """Cut a batch into slices whose ``column`` holds about ``most_bytes`` (one row at least)."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for i, n in enumerate(sizes):
        if i > start and held + n > most_bytes:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def grouped(batches, keys: list[str]):
    """Groups of equal integer ``keys`` from batches sorted by them, as (key values, table).

    One group is held at a time, so it must be bounded by its maker.
    """
    held: list[pa.RecordBatch] = []
    key = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(k).to_numpy(zero_copy_only=False) for k in keys]
        change = np.zeros(batch.num_rows, bool)
        change[0] = True
        for c in columns:
            change[1:] |= c[1:] != c[:-1]
        starts = np.append(np.flatnonzero(change), batch.num_rows)
        for a, b in itertools.pairwise(starts.tolist()):
            now = tuple(c[a].item() for c in columns)
            if key is not None and now != key:
                yield key, pa.Table.from_batches(held)
                held = []
            key = now
            held.append(batch.slice(a, b - a))
    if held:
        yield key, pa.Table.from_batches(held)


def _all_stars(edges: DataFrame) -> bool:
    """True if every a has one b only, and no b is an a: each b is then its component's root."""
    ends = edges.select(F.col("a").alias("n"), F.lit(1).alias("up"), F.lit(0).alias("down")).union(edges.select("b", F.lit(0), F.lit(1)))
    held = ends.groupBy("n").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return held.filter("up > 1 or up = 1 and down = 1").isEmpty()


def components(edges: DataFrame, name: str, held: list[DataFrame] | None = None) -> DataFrame:
    """(node, root) of every node of the edges (a, b), both long: root is the smallest of its component.

    Alternating large-star and small-star steps (Kiveris et al. 2014). Hubs are safe: minima are
    pre-aggregated with the number of their rows, and joins bring those of hubs to the rows.
    """
    n = F.count(F.lit(1)).alias("n")
    kept = materialise(edges.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), name, narrow=True)
    while not _all_stars(kept):
        both = kept.select(F.col("a").alias("u"), F.col("b").alias("v")).union(kept.select("b", "a"))
        least_u = materialise(both.groupBy("u").agg(F.min("v").alias("m"), n).select("u", F.least("u", "m").alias("m"), "n"), name, narrow=True)
        large = materialise(skew_join(both.filter("v > u"), least_u, ["u"], "n").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct(), name, narrow=True)
        least = materialise(large.groupBy("a").agg(F.min("b").alias("m"), n), name, narrow=True)
        small = skew_join(large, least, ["a"], "n").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        last, kept = kept, materialise(small.union(least.select("a", F.col("m").alias("b"))).distinct(), name, narrow=True)
        for done in (last, least_u, large, least):
            release(done)
    if held is not None:
        held.append(kept)
    roots = kept.select(F.col("b").alias("node")).distinct()
    return kept.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots.select("node", "node"))
