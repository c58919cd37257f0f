import pytest
from pyspark.sql import functions as F

from atelier.operators import listing, novelty


def plain(df):
    return sorted(map(repr, df.collect()))


def test_filtered_novelty_equals_the_exact_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(novelty, "PART_KEYS", 4000)
    catalog = spark.range(20_000).select(F.concat(F.lit("id"), "id").alias("id"), F.lit(1).alias("x"))
    items = spark.range(19_700, 60_000, 1, 6).select(F.concat(F.lit("id"), "id").alias("id"), F.col("id").alias("n")).union(spark.createDataFrame([(None, 1), ("id5", 2), ("id5", 3), ("new", 4), ("new", 5)], "id string, n long"))
    known = novelty.KnownKeys.build(catalog, "id", str(tmp_path / "known"))
    assert known.filters().count() == 5
    got = novelty.new_items_filtered(items, catalog, "id", known)
    assert plain(got) == plain(listing.new_items(items, catalog, "id").select(*items.columns))
    maybe, new = known.split(items, "id")
    assert maybe.count() < 0.05 * items.count() and maybe.count() + new.count() == items.count()
    for part in (maybe, new):  # only the few filters move
        plan = part._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in plan and "hashpartitioning" not in plan and "Python" not in plan


def test_keys_are_added(spark, tmp_path):
    key = lambda a, b: spark.range(a, b).select(F.col("id").alias("k"))
    known = novelty.KnownKeys.build(key(0, 100), "k", str(tmp_path / "known"), expected=5000)
    before = {r["part"]: r["bits"] for r in known.filters().collect()}
    known.add(key(100, 2000), "k")
    known.add(key(1500, 2100).union(spark.createDataFrame([(None,)], "k long")), "k")
    now = {r["part"]: r["bits"] for r in known.filters().collect()}
    assert known.version() == 2 and all((x & y) == x for p in before for x, y in zip(before[p], now[p], strict=True))
    maybe, new = known.split(key(0, 10_000), "k")
    assert maybe.filter("k < 2100").count() == 2100 and new.count() > 0.95 * 7900
    with pytest.raises(FileNotFoundError):
        novelty.KnownKeys(spark, str(tmp_path / "none")).version()


def test_small_filters_of_large_catalogs_stay_exact(spark, tmp_path):
    catalog = spark.range(3000).select(F.col("id").alias("k"))
    known = novelty.KnownKeys.build(catalog, "k", str(tmp_path / "known"), most_bytes=64)
    assert len(known.filters().first()["bits"]) <= 8
    items = spark.range(2900, 3100).select(F.col("id").alias("k"))
    assert plain(novelty.new_items_filtered(items, catalog, "k", known)) == plain(listing.new_items(items, catalog, "k"))
    empty = novelty.KnownKeys.build(catalog.limit(0), "k", str(tmp_path / "empty"))
    assert empty.split(items, "k")[1].count() == 200
