import json
import os
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from atelier.sources import index, latents
from atelier.sources.row_offsets import RowOffsets


def records(spark, n, parts=3):
    made = spark.range(0, n, 1, parts)
    return made.select(F.concat(F.lit("vec/"), "id").alias("src"), F.when(F.col("id") % 3 == 0, "thrée").when(F.col("id") % 3 == 1, "one").alias("caption"), F.lit("a").alias("author"), F.transform(F.sequence(F.lit(1), F.lit(6)), lambda k: (k * F.col("id")).cast("float")).alias("latent"), F.array(F.lit(2), F.lit(3)).alias("latent_shape"))


def test_latents_roundtrip(spark, tmp_path):
    path = str(tmp_path / "set")
    df = records(spark, 700)
    latents.write_latents(df, path)
    latents.write_latents(records(spark, 0), path)  # nothing: no part
    assert len([x for x in os.listdir(path) if x.endswith(".jsonl")]) == 3 and not [x for x in os.listdir(path) if x.endswith(".staged")]
    got = latents.read_latents(spark, path, range_bytes=1000).drop("npz")
    names = ["src", "caption", "author", "latent", "latent_shape"]
    assert sorted(map(repr, got.select(names).collect())) == sorted(map(repr, df.select(names).collect()))
    assert got.rdd.getNumPartitions() > 30  # an archive is read by many tasks


def test_latents_read_what_is_asked_for(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "set")
    latents.write_latents(records(spark, 60, 1), path)
    for f in os.listdir(path):
        if f.endswith(".npz"):
            os.rename(f"{path}/{f}", f"{path}/{f}.gone")
    texts = latents.read_latents(spark, path, "src string, caption string")
    assert texts.count() == 60  # no archive was opened: there is none
    plan = texts._jdf.queryExecution().executedPlan().toString()
    assert "latent" not in plan.replace("latents", "") and "src" in plan
    lost = latents.read_latents(spark, path, "src string, latent array<float>, error string")
    assert lost.filter("latent is null and error like 'FileNotFound%'").count() == 60
    # filters come before archives: of the records of one caption only their arrays are looked for
    some = latents.read_latents(spark, path, "src string, caption string, latent array<float>, error string").filter("caption = 'one' and src like 'vec/1%'")
    assert {r["src"] for r in some.collect()} == {f"vec/{k}" for k in range(60) if k % 3 == 1 and str(k).startswith("1")}


def test_pushed_filters_are_applied_to_lines(tmp_path):
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringStartsWith
    from pyspark.sql.types import StringType, StructField, StructType

    (tmp_path / "index.jsonl").write_text("".join(json.dumps({"npz": "x.npz", "src": f"s{k}", "caption": None if k == 5 else f"c{k % 2}"}) + "\n" for k in range(10)))
    reader = latents.LatentReader(StructType([StructField("src", StringType())]), {"path": str(tmp_path)})
    rest = list(reader.pushFilters([EqualTo(("caption",), "c1"), GreaterThan(("src",), "s1"), In(("src",), ("s1", "s3", "s5", "s7")), StringStartsWith(("src",), "s")]))
    assert rest == [GreaterThan(("src",), "s1")]
    got = [s for part in reader.partitions() for b in reader.read(part) for s in b.column("src").to_pylist()]
    assert got == ["s1", "s3", "s7"]


def test_latents_of_separate_archives(spark, tmp_path):
    """One archive a record, as an encoder leaves them; odd lines and members."""
    np.savez(tmp_path / "a.npz", latent=np.arange(12, dtype=np.float16).reshape(3, 4), text_emb=np.zeros((2, 2)), src=np.array("x"))
    np.savez(tmp_path / "f.npz", latent=np.asfortranarray(np.arange(6).reshape(2, 3)))
    (tmp_path / "bad.npz").write_bytes(b"PK no")
    lines = ['{"npz": "a.npz", "src": "s"}', "", '{"npz"', "[1]", '{"src": "none"}', '{"npz": null}', '{"npz": "bad.npz", "src": null}', '{"npz": "f.npz", "src": 7}', '{"npz": "gone.npz"}']
    (tmp_path / "index.jsonl").write_text("\n".join(lines))
    for size in (1, 7, 10_000):
        got = latents.read_latents(spark, str(tmp_path), "npz string, src string, latent array<float>, latent_shape array<int>, text_emb_shape array<int>, error string", range_bytes=size).collect()
        by = {r["npz"]: r for r in got}
        assert len(got) == 4 and by["a.npz"]["latent"] == list(range(12)) and by["a.npz"]["latent_shape"] == [3, 4] and by["a.npz"]["text_emb_shape"] == [2, 2]
        assert by["f.npz"]["latent"] == list(range(6)) and by["f.npz"]["src"] == "7" and "KeyError" in by["f.npz"]["error"]
        assert by["bad.npz"]["src"] is None and "BadZipFile" in by["bad.npz"]["error"] and by["gone.npz"]["src"] == "" and by["gone.npz"]["latent"] is None
    same = index.read_index(spark, str(tmp_path / "index.jsonl")).select("npz", "src").collect()
    assert {(r["npz"], r["src"]) for r in same} == {(r["npz"], r["src"]) for r in got}
    with pytest.raises(Exception, match="nowhere"):
        latents.read_latents(spark, str(tmp_path / "nowhere")).count()


def test_ten_thousand_members(spark, tmp_path):
    path = str(tmp_path / "set")
    latents.write_latents(records(spark, 10_000, 1), path)
    got = latents.read_latents(spark, path, "src string, latent array<float>, latent_shape array<int>", range_bytes=200_000)
    used = got.select(F.spark_partition_id().alias("p"), F.col("latent")[5].alias("x"), F.regexp_extract("src", r"(\d+)", 1).cast("float").alias("k"))
    assert used.filter("x <> 6 * k").count() == 0
    counts = [r["count"] for r in used.groupBy("p").count().collect()]
    assert sum(counts) == 10_000 and len(counts) >= 4 and max(counts) < 5000


@pytest.mark.parametrize("end", ["\n", "\r\n"])
def test_record_by_one_seek(spark, tmp_path, end):
    rng = random.Random(5)
    want = []
    os.makedirs(tmp_path / "set")
    for part in range(2):
        lines = []
        for k in range(900):
            kind = rng.random()
            if kind < 0.1:
                lines.append(rng.choice(["", "{", "[]", '{"src": "x"}', '{"npz": null}']))
                continue
            row = {"npz": f"{part}-{k}.npz", "src": "é" * rng.randrange(30), "caption": rng.choice([None, "c"])}
            want.append(row["npz"])
            lines.append(json.dumps(row, ensure_ascii=rng.random() < 0.5) + " " * rng.choice([0, 0, 300]))
        (tmp_path / "set" / f"{part}.jsonl").write_bytes((end.join(lines) + rng.choice(["", end])).encode())
    rows = RowOffsets(spark, str(tmp_path / "set"), block=8192)
    assert len(rows) == len(want) == index.read_index(spark, str(tmp_path / "set")).count() and rows.blocks.count() > 20
    for i in [0, 1, len(want) - 1, -1, -len(want), *rng.sample(range(len(want)), 12)]:
        before = rows.bytes_read
        assert rows.row(i)["npz"] == want[i]
        assert rows.bytes_read - before <= 8192 + (1 << 16)  # one block, and what is read at once after it
    for i in (len(want), -len(want) - 1):
        with pytest.raises(IndexError):
            rows.row(i)


def test_offsets_follow_the_file(spark, tmp_path):
    path = tmp_path / "index.jsonl"
    path.write_text('{"npz": "a"}\n{"npz": "b"}\n')
    rows = RowOffsets(spark, str(path))
    made = os.path.getmtime(tmp_path / "index.jsonl.rows" / "_SUCCESS")
    assert len(rows) == 2 and len(RowOffsets(spark, str(path))) == 2 and os.path.getmtime(tmp_path / "index.jsonl.rows" / "_SUCCESS") == made
    path.write_text('{"npz": "a"}\n{"npz": "b"}\n{"npz": "c", "caption": null}\n')
    assert RowOffsets(spark, str(path)).row(2).asDict() == {"npz": "c", "src": "", "caption": None, "author": ""}
    with pytest.raises(FileNotFoundError):
        RowOffsets(spark, str(tmp_path / "none"))
    path.write_text("")
    empty = RowOffsets(spark, str(path))
    assert len(empty) == 0
    with pytest.raises(IndexError):
        empty.row(0)
