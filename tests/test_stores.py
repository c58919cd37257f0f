import os
import random

import pytest
from pyspark.sql import functions as F

from atelier.operators import listing
from atelier.operators.catalog import rows_with
from atelier.sources import bucketed
from atelier.sources.trigrams import TrigramIndex, trigrams


def plain(df):
    return sorted(map(repr, df.collect()))


def files(path):
    return {f"{d}/{f}": os.path.getmtime(f"{d}/{f}") for d, _, names in os.walk(path) for f in names if f.endswith(".parquet")}


def test_upsert_rewrites_what_gets_new_keys(spark, tmp_path):
    path = str(tmp_path / "dict")
    rng = random.Random(2)
    known = spark.createDataFrame([(f"k{k}", f"old{k}") for k in range(0, 200, 2)], "id string, names string")
    held = bucketed.BucketedDictionary.create(known, path, "id", buckets=16)
    with pytest.raises(FileExistsError):
        bucketed.BucketedDictionary.create(known, path, "id")
    assert plain(held.read()) == plain(known)
    seen = [(rng.choice(["k1", "k3", "k0", "k10"]), k, f"new{k}") for k in range(50)] + [(None, 1, "x")]
    seen = spark.createDataFrame(seen, "id string, at long, names string")
    before, first = files(path), held.manifest()
    rewritten = held.upsert_first_wins(seen, ["at"])
    assert plain(held.read()) == plain(listing.upsert_first_wins(known, seen.filter("id is not null"), "id", ["at"]))
    now = held.manifest()
    assert 1 <= len(rewritten) <= 2 and held.version() == 1
    assert {b for b in now["folders"] if now["folders"][b] != first["folders"].get(b)} == {str(b) for b in rewritten}
    assert before.items() <= files(path).items()  # no file was touched
    assert plain(held.read(0)) == plain(known)
    assert held.upsert_first_wins(seen, ["at"]) == [] and held.version() == 1  # nothing new: nothing written
    assert [r["names"] for r in held.lookup(["k4", "absent"]).collect()] == ["old4"]
    held.upsert_first_wins(spark.createDataFrame([("z", 1, "zed")], "id string, at long, names string"), ["at"])
    want = plain(held.read())
    assert held.vacuum(keep=1) >= 1 and plain(held.read()) == want and held.version() == 2
    assert not os.listdir(f"{path}/_staging")


def test_two_writers_of_a_version(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "dict")
    held = bucketed.BucketedDictionary.create(spark.createDataFrame([("a", "1")], "id string, names string"), path, "id", buckets=4)
    seen = lambda k: spark.createDataFrame([(k, 1, k)], "id string, at long, names string")
    real = bucketed.BucketedDictionary._publish

    def late(self, manifest, version):
        monkeypatch.setattr(bucketed.BucketedDictionary, "_publish", real)
        bucketed.BucketedDictionary(spark, path).upsert_first_wins(seen("b"), ["at"])
        real(self, manifest, version)

    monkeypatch.setattr(bucketed.BucketedDictionary, "_publish", late)
    with pytest.raises(bucketed.Conflict):
        held.upsert_first_wins(seen("c"), ["at"])
    assert sorted(r["id"] for r in held.read().collect()) == ["a", "b"]
    held.upsert_first_wins(seen("c"), ["at"])
    assert sorted(r["id"] for r in held.read().collect()) == ["a", "b", "c"]


def test_an_empty_dictionary(spark, tmp_path):
    held = bucketed.BucketedDictionary.create(spark.createDataFrame([], "id string, names string"), str(tmp_path / "d"), "id")
    assert held.read().count() == 0 and held.lookup(["a"]).count() == 0
    held.upsert_first_wins(spark.createDataFrame([("a", 2, "late"), ("a", 1, "first")], "id string, at long, names string"), ["at"])
    assert [tuple(r) for r in held.read().collect()] == [("a", "first")]
    with pytest.raises(FileNotFoundError):
        bucketed.BucketedDictionary(spark, str(tmp_path / "none")).version()


def test_trigrams_of_bytes():
    assert trigrams(b"").tolist() == [] and trigrams(b"a").tolist() == [0x610000]
    assert trigrams(b"abab").tolist() == sorted({0x616261, 0x626162, 0x616200, 0x620000})
    long = bytes(random.Random(1).randrange(1, 256) for _ in range(3_000_000))
    x = {long[i : i + 3] for i in range(len(long) - 2)} | {long[-2:] + b"\0", long[-1:] + b"\0\0"}
    assert len(trigrams(long)) == len(x)


def test_substrings_as_a_scan_finds_them(spark, tmp_path):
    rng = random.Random(7)
    words = ["the", "grey", "Heron", "été", "日本", "a%b_c", "x", "", "\0", "ab\0cd", "ééé"]
    rows = [(k, None if k % 97 == 0 else " ".join(rng.choice(words) for _ in range(rng.randrange(6))) + (f" id{k}" if k % 3 else "")) for k in range(9000)]
    rows += [(9001, "ab"), (9002, "b"), (9003, "needle in " + "hay " * 30_000 + "stack"), (9001, "ab")]
    df = spark.createDataFrame(rows, "n long, title string").repartition(3, "n")
    found = TrigramIndex.build(df, str(tmp_path / "index"), "title")
    for needle in ["", "a", "é", "b", "ab", "日", "本", "\0", "b\0c", "Heron été", "heron", "id4567", "id45", "a%b_c", "y stack", "needle in hay", "absent", " ", "  ", "ééé", "x id8999"]:
        assert plain(found.find(needle)) == plain(rows_with(df, F.col("title"), needle, exact=False)), needle
    read, every = found.blocks_read("id4567")
    assert every >= 3 and read == 1
    assert found.blocks_read("")[0] == every and found.blocks_read("absent")[0] == 0


def test_trigrams_of_an_empty_table(spark, tmp_path):
    found = TrigramIndex.build(spark.createDataFrame([], "n long, title string"), str(tmp_path / "index"), "title")
    assert found.find("abc").count() == 0 and found.find("").count() == 0
