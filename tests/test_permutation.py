import numpy as np
import pytest
from pyspark.sql import functions as F

from atelier.functions.permutation import MOST, Permutation
from atelier.operators import sampling


@pytest.mark.parametrize("n", [0, 1, 2, 3, 4, 5, 7, 16, 17, 99, 100, 101, 1023, 1024, 1025, 65_537])
def test_every_position_once(n):
    for seed in range(6):
        p = Permutation(n, seed)
        held = p.held_at(np.arange(n))
        assert sorted(held.tolist()) == list(range(n)) and (p.place_of(held) == np.arange(n)).all()
    if n > 90:
        assert len({tuple(Permutation(n, s).held_at(np.arange(n))) for s in range(6)}) == 6


def test_large_and_wrong_positions():
    p = Permutation(MOST, 3)
    x = np.array([0, 1, MOST - 1, MOST // 3])
    assert (p.place_of(p.held_at(x)) == x).all()
    for bad in ([-1], [10]):
        with pytest.raises(IndexError):
            Permutation(10, 1).held_at(np.array(bad))
    with pytest.raises(ValueError):
        Permutation(MOST + 1, 1)


def test_places_are_uniform():
    """Over 4000 keys, where a position goes, and the order of two neighbours: chi-square under its 0.999 quantiles."""
    n, keys = 20, 4000
    places = np.array([Permutation(n, s).place_of(np.arange(n)) for s in range(keys)])
    for position in (0, 7, 19):
        counts = np.bincount(places[:, position], minlength=n)
        assert ((counts - keys / n) ** 2 / (keys / n)).sum() < 43.8  # 19 degrees of freedom
    pairs = np.bincount(places[:, 3] * n + places[:, 4], minlength=n * n).reshape(n, n)
    off = pairs[~np.eye(n, dtype=bool)]
    want = keys / (n * (n - 1))
    assert (np.diag(pairs) == 0).all() and ((off - want) ** 2 / want).sum() < 379 + 3.3 * (2 * 379) ** 0.5


@pytest.mark.parametrize("n", [1, 5, 101, 4097])
def test_column_equals_numpy(spark, n):
    p = Permutation(n, 11)
    rows = spark.range(-1, n + 1).select("id", p.place_column(F.col("id")).alias("p")).orderBy("id").collect()
    assert [r["p"] for r in rows] == [None, *p.place_of(np.arange(n)).tolist(), None]


def test_batches_without_a_shuffle(spark):
    n, size = 1003, 10
    df = spark.range(0, n, 1, 4).select(F.col("id").alias("row_idx"), (F.col("id") * 7).alias("x"))
    everything = sampling.keyed_batches(df, "row_idx", n, size, 5, epoch=3)
    assert "Exchange" not in everything._jdf.queryExecution().executedPlan().toString()
    by = {}
    for r in everything.collect():
        by.setdefault(r["batch"], {})[r["place"]] = r["x"]
    assert sorted(by) == list(range(100)) and all(sorted(b) == list(range(size)) for b in by.values())
    one = sampling.keyed_batch(df, "row_idx", n, size, 5, 3, 42)
    assert {r["place"]: r["x"] for r in one.collect()} == by[42] and "Exchange" not in one._jdf.queryExecution().executedPlan().toString()
    later = sampling.keyed_batches(df, "row_idx", n, size, 5, epoch=3, first=42)  # resumed in the middle of an epoch
    assert {r["batch"] for r in later.collect()} == set(range(42, 100))
    assert {r["x"] for r in sampling.keyed_batch(df, "row_idx", n, size, 5, 4, 42).collect()} != set(by[42].values())
    for k in (-1, 100):
        with pytest.raises(IndexError):
            sampling.keyed_batch(df, "row_idx", n, size, 5, 3, k)
