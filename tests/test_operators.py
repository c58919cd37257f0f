import random
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from atelier.functions import ranking
from atelier.functions.ranking import KeyOrder, block_of, blocks_of, rank_by_key
from atelier.operators import arrays, captions, geometry, listing, metrics, sampling
from atelier.sources import arrays as files
from atelier.sources import html_pages, index, manifest, run_files


def test_ranking(spark):
    df = spark.range(0, 5000, 1, 7).select((F.col("id") * 37 % 5003).alias("k"))
    assert [r["row_idx"] for r in rank_by_key(df, "k").orderBy("k").collect()] == list(range(5000))
    held = KeyOrder(df, "k", blocks=30)
    keys = sorted(r["k"] for r in df.collect())
    for start, length in ((0, 1), (77, 1), (1234, 700), (4990, 10), (4999, 5), (6000, 3), (0, 5000)):
        got = [(r["row_idx"], r["k"]) for r in held.between(start, length).orderBy("row_idx").collect()]
        assert got == list(enumerate(keys))[start : start + length]
    assert held.count() == 5000 and KeyOrder(df.limit(0), "k").between(0, 5).count() == 0
    plan = KeyOrder(df, "k", blocks=30).between(2500, 1)._jdf.queryExecution().toString()
    assert "Filter" in plan and rank_by_key(df.limit(0), "k").count() == 0
    assert blocks_of(0) == 8 and blocks_of(10**7) == 40 and blocks_of(10**12) == 4096


def test_blocks_are_found_in_two_steps(spark):
    for n in (1, 2, 5, 16, 17, 100):
        cuts = [3 * k for k in range(n)]
        got = spark.range(-5, 3 * n + 5).select("id", block_of(F.col("id"), cuts).alias("b")).collect()
        assert all(r["b"] == sum(c < r["id"] for c in cuts) for r in got)


def test_cuts_of_a_sample(spark, monkeypatch):
    """Whatever the sample, ranks are exact."""
    monkeypatch.setattr(ranking, "CUT_ROWS", 100)
    df = spark.range(0, 20_000, 1, 5).select((F.col("id") * 37 % 20_011).alias("k"))
    held = KeyOrder(df, "k", blocks=12)
    keys = sorted(r["k"] for r in df.collect())
    assert len(held.cuts) > 5 and [(r["row_idx"], r["k"]) for r in held.between(9_990, 30).orderBy("row_idx").collect()] == list(enumerate(keys))[9_990:10_020]
    assert KeyOrder(df.limit(3), "k", blocks=12).between(0, 9).count() == 3


def test_tied_keys_keep_their_places(spark):
    df = spark.createDataFrame([(5,)] * 40 + [(None,)] * 3 + [(9,)] * 40, "k int")
    held = KeyOrder(df, "k", blocks=8)
    assert [r["k"] for r in held.between(0, 83).orderBy("row_idx").collect()] == [None] * 3 + [5] * 40 + [9] * 40
    assert [r["k"] for r in held.between(42, 2).orderBy("row_idx").collect()] == [5, 9]


def test_rows_are_read_from_their_blocks_only(spark):
    """A lookup by position filters the scan."""
    held = KeyOrder(spark.read.parquet("/root/testdata/sf0.001/orders.parquet"), "o_orderkey", blocks=16)
    plan = held.between(700, 1)._jdf.queryExecution().toString()
    assert "PushedFilters: [IsNotNull(o_orderkey), GreaterThan(o_orderkey" in plan


def test_page_rules(spark):
    row = spark.range(1).select(
        listing.page_count(F.array(F.lit("3"), F.lit("x"), F.lit("12"))).alias("n"), listing.page_count(F.array().cast("array<string>")).alias("none"), listing.page_urls(F.lit("s/search.html"), F.lit(2)).alias("s"),
        listing.page_urls(F.lit("b"), F.lit(0)).alias("b"), listing.item_id(F.lit("/t-12.html?x=-3.html")).alias("id"), listing.joined_names(F.array(F.lit(" a "), F.lit("..."), F.lit("b,"))).alias("names"),
    ).first()
    assert (row["n"], row["none"], row["s"], row["b"], row["id"], row["names"]) == (12, 0, ["s/search.html", "s/search.html#2"], ["b"], "12", "a, b")
    cells = spark.range(1).select(listing.zip_with_cells(F.array(F.lit("i"), F.lit("j")), F.array(F.array(*[F.lit(c) for c in "abcd"]))).alias("z")).first()["z"]
    assert [(z["item"], z["type"]) for z in cells] == [("i", "d"), ("j", "")]
    assert listing.image_rows(spark.createDataFrame([(0,), (3,)], "n int"), "n").count() == 3


def test_selectors():
    page = """<div class="g x"><h1><a href="/1"> One &amp; 1</a></h1><table class="d"><tr><td>a<td>b<br>c</table></div><div><h1><a href="/2">Two</a></h1></div><p id="q">z"""
    assert html_pages.elements_of(page, "div.g h1 a") == [("/1", "One & 1")]
    assert html_pages.elements_of(page, "h1 a") == [("/1", "One & 1"), ("/2", "Two")]
    assert html_pages.elements_of(page, "#q") == [(None, "z")]
    assert html_pages.elements_of(page, "ul a") == html_pages.elements_of(None, "a") == []


def test_reading_pages_is_linear():
    """Stray and unclosed tags; a nested match has its own text and its parent's holds it, too."""
    began = time.process_time()
    page = "<i>" * 30_000 + "</b>" * 30_000 + "<p>x</p>" * 10_000
    assert len(html_pages.elements_of(page, "i p")) == 10_000
    assert time.process_time() - began < 5
    assert html_pages.elements_of("<div class=a>1<div class=a>2</div>3</div><img class=a src=x>4", ".a") == [(None, "123"), (None, "2"), (None, "")]
    assert html_pages.elements_of("<ul><li><a href=1>x</a></ul><ol><li><a href=2>y</a></ol>", "ul li a") == [("1", "x")]


def test_run_files(spark, tmp_path):
    lines = spark.createDataFrame([(2, "ERR", "no page"), (1, "INFO", "begun"), (3, "INFO", "done")], "at int, level string, message string")
    for _ in range(2):  # written anew each time
        run_files.write_log(lines.repartition(3), str(tmp_path / "log"), "2024-01-01 00:00:00", "at")
    read = [x for p in sorted((tmp_path / "log").glob("part-*")) for x in p.read_text().splitlines()]
    assert read == ["2024-01-01 00:00:00", "[INFO] begun", "[ERR] no page", "[INFO] done"]
    assert sorted(r[0] for r in spark.read.text(str(tmp_path / "log")).select(listing.level_of(F.col("value"))).collect()) == ["", "ERR", "INFO", "INFO"]
    for text, want in (("0.1 2", (0.1, 2.0)), (" 1\n3 ", (1.0, 3.0)), ("3 1", None), ("1 1", None), ("1", None), ("1 2 3", None), ("a b", None), ("", None), ("nan 1", None)):
        (tmp_path / "range.txt").write_text(text)
        assert run_files.read_range(spark, str(tmp_path / "range.txt")) == want
    assert run_files.read_range(spark, str(tmp_path / "none.txt")) is None and run_files.read_range(spark, str(tmp_path)) is None


def test_resuming(spark, tmp_path):
    loaded = []

    def package(path):
        if "bare" in path:
            raise ValueError("no package")
        return {"global_step": 7, "opt_step": 3}

    assert run_files.resume(spark, None, package, loaded.append)["global_step"] == 0
    with pytest.raises(FileNotFoundError):
        run_files.resume(spark, str(tmp_path), package, loaded.append)
    for name in ("step_9.pth", "step_10.pt", "notes.txt", "bare.pth"):
        (tmp_path / name).write_text("x")
    with pytest.raises(FileNotFoundError):
        run_files.resume(spark, str(tmp_path / "gone.pth"), package, loaded.append)
    with pytest.raises(FileNotFoundError):
        run_files.resume(spark, str(tmp_path / "notes.txt"), package, loaded.append)
    assert run_files.resume(spark, str(tmp_path), package, loaded.append) == {"global_step": 7, "epoch": 0, "prediction_type": None, "opt_step": 3}
    assert run_files.resume_path(spark, str(tmp_path)).endswith("step_9.pth")  # by name
    assert not loaded and run_files.resume(spark, str(tmp_path / "bare.pth"), package, loaded.append)["global_step"] == 0 and loaded[0].endswith("bare.pth")
    names = spark.createDataFrame([("step_9", "raw"), ("step_10", "raw")], "name string, kind string")
    assert metrics.resume_from(names, ["ema", "raw"]) == "step_9"
    with pytest.raises(FileNotFoundError):
        metrics.resume_from(names, ["ema"])


def test_warm_up_and_tokens(spark):
    runs = spark.createDataFrame([("a", i, 1.0) for i in range(7)] + [("b", i, 1.0) for i in range(3)] + [(None, 1, 1.0), (None, 1, 1.0), (None, 2, 1.0), (None, 9, 1.0)], "s string, i int, v double")
    assert sorted((r["s"] or "", r["i"]) for r in metrics.after_warmup(runs, "s", ["i"], 3).collect()) == [("", 9), *(("a", i) for i in range(3, 7))]
    got = captions.token_counts(spark.createDataFrame([("a b",), (None,), ("x " * 100,)], "t string"), "t", "n", lambda: lambda text: len(text.split()))
    assert [r["n"] for r in got.collect()] == [2, 0, 77]


def test_novelty_and_dictionaries(spark):
    items = spark.createDataFrame([("1", 0, "a"), ("2", 1, "b"), ("2", 2, "c")], "id string, at int, v string")
    seen = spark.createDataFrame([("1", "old")], "id string, v string")
    assert listing.new_items(items, seen, "id").count() == 2  # seen twice, comes twice
    assert [r["v"] for r in listing.first_of(items, "id", ["at"]).orderBy("id").collect()] == ["a", "b"]
    assert {r["id"]: r["v"] for r in listing.upsert_first_wins(seen, items, "id", ["at"]).collect()} == {"1": "old", "2": "b"}
    assert {r["id"]: r["v"] for r in listing.last_wins(items, "id", "v", "at").collect()} == {"1": "a", "2": "c"}


def test_geometry(spark):
    sizes = [(100, 100), (100, 50), (33, 100), (7, 100), (5, 5), (511, 512)]
    df = spark.createDataFrame(sizes, "w int, h int")
    got = df.select("w", "h", *[c.alias(n) for n, c in geometry.fit_pad(F.col("w"), F.col("h"), 64).items()], *[c.alias(n) for n, c in zip("ab", geometry.align(F.col("w"), F.col("h")), strict=True)]).collect()
    for r in got:
        s = 64 / max(r["w"], r["h"])
        nw, nh = int(r["w"] * s), int(r["h"] * s)
        assert (r["new_w"], r["new_h"], r["pad_left"], r["pad_bottom"]) == (nw, nh, (64 - nw) // 2, 64 - nh - (64 - nh) // 2)
        a, b = r["w"] // 8 * 8, r["h"] // 8 * 8
        assert (r["a"], r["b"]) == ((max(8, r["w"]), max(8, r["h"])) if not a or not b else (a, b))


def test_quantising(spark):
    xs = np.linspace(-1.2, 1.2, 97)
    df = spark.createDataFrame([(xs.tolist(),)], "a array<double>")
    r = df.select(arrays.quantize_unit(F.col("a")).alias("u"), arrays.quantize_signed(F.col("a")).alias("s"), arrays.quantize_rounded(F.col("a")).alias("r")).first()
    assert r["u"] == (np.clip(xs, 0, 1) * 255).astype(int).tolist()
    assert r["s"] == (np.clip(xs / 2 + 0.5, 0, 1) * 255).astype(int).tolist()
    assert r["r"] == np.round((np.clip(xs, -1, 1) * 0.5 + 0.5) * 255).astype(int).tolist()


def test_ema_in_blocks(spark):
    r = np.random.default_rng(1)
    rows = [(s, i, float(r.random())) for s in ("a", "b") for i in range(700 if s == "a" else 1)]
    got = {(x["s"], x["i"]): x["ema"] for x in metrics.ema(spark.createDataFrame(rows, "s string, i long, v double"), "s", "i", "i", "v", 0.9, blocks=16).collect()}
    e = None
    for s, i, v in rows:
        e = v if i == 0 else 0.9 * e + (1 - 0.9) * v
        assert abs(got[s, i] - e) < 1e-12
    plain = metrics.ema(spark.createDataFrame(rows[:3], "s string, i long, v double"), "s", "i", "i", "v", 1.0).collect()
    assert [x["ema"] for x in plain] == [x["v"] for x in plain]


def test_ema_with_nulls(spark):
    """A null leaves the average as it was; before the first value there is none."""
    values = {"a": [None, None, 2.0, None, 4.0, None, 8.0] + [None] * 200 + [1.0], "b": [None] * 9, None: [3.0, None, 5.0]}
    rows = [(s, i, v) for s, own in values.items() for i, v in enumerate(own)]
    df = spark.createDataFrame(rows, "s string, i long, v double")
    got = {(r["s"], r["i"]): r["ema"] for r in metrics.ema(df, "s", "i", "i", "v", 0.5, blocks=5).collect()}
    assert len(got) == len(rows)
    for s, own in values.items():
        e = None
        for i, v in enumerate(own):
            e = e if v is None else v if e is None else 0.5 * e + 0.5 * v
            assert (got[s, i] is None) == (e is None) and (e is None or abs(got[s, i] - e) < 1e-12), (s, i)
    assert metrics.ema(df.limit(0), "s", "i", "i", "v", 0.5).count() == 0


def test_retention(spark):
    def names(ema, raw):
        rows = [(f"step_{i}_{k}", k, i) for k, n in (("ema", ema), ("raw", raw)) for i in range(n)]
        return {r["name"] for r in metrics.pruned(spark.createDataFrame(rows, "name string, kind string, mtime long")).collect()}

    assert names(12, 11) == {"step_0_ema", "step_1_ema", "step_0_raw"}
    assert names(10, 15) == set()


def test_nearest_ranks(spark):
    values = np.random.default_rng(2).integers(0, 50, 300).tolist()
    df = spark.createDataFrame([("g", float(v)) for v in values], "g string, v double")
    got = {r["share"]: r["value"] for r in metrics.nearest_ranks(df, "g", "v", [0.0, 0.5, 0.95, 0.99, 1.0], blocks=8).collect()}
    assert got == {q: float(sorted(values)[int(q * 299)]) for q in (0.0, 0.5, 0.95, 0.99, 1.0)}
    same = spark.createDataFrame([("g", 1.0)] * 200 + [("g", 2.0)] + [("h", 3.0)], "g string, v double")
    got = {(r["g"], r["share"]): r["value"] for r in metrics.nearest_ranks(same, "g", "v", [0.0, 0.5, 1.0]).collect()}
    assert got == {("g", 0.0): 1.0, ("g", 0.5): 1.0, ("g", 1.0): 2.0, ("h", 0.0): 3.0, ("h", 0.5): 3.0, ("h", 1.0): 3.0}


def test_batches_and_plans(spark):
    df = spark.range(103).withColumnRenamed("id", "k")
    got = sampling.train_batches(df, "k", 10, 1)
    assert got.count() == 100 and got.select("k").distinct().count() == 100
    assert sampling.train_batches(df, "k", 10, 1).orderBy("batch", "place").collect() != sampling.train_batches(df, "k", 10, 1, epoch=1).orderBy("batch", "place").collect()
    assert sampling.step_plan(1000, 16, 4, 10) == {"batches": 62, "steps_per_epoch": 16, "total_steps": 160, "warmup_steps": 100}


def test_index_lines(spark, tmp_path):
    lines = ['{"npz": "a.npz", "src": "s", "caption": "c", "author": "w"}', '{"npz": "b.npz"}', '{"npz": "c.npz", "caption": null}', '{"src": "s"}', "{broken", ""]
    df = spark.createDataFrame([(x,) for x in lines], "value string")
    got = {r["npz"]: (r["caption"], r["author"]) for r in index.parse_index(df).collect()}
    assert got == {"a.npz": ("c", "w"), "b.npz": ("", ""), "c.npz": (None, "")}
    out = str(tmp_path / "i")
    index.write_index(spark.createDataFrame([("é/x.png",)], "p string").select(index.index_line(F.col("p"), F.lit("ü"))), out)
    back = index.read_index(spark, out).first()
    assert (back["src"], back["caption"], back["author"]) == ("é/x.png", "ü", "")


def test_manifest_and_arrays(spark, tmp_path):
    (tmp_path / "in/sub").mkdir(parents=True)
    for n in ("a.PNG", "sub/b.webp", "c.txt"):
        (tmp_path / "in" / n).write_bytes(b"x")
    found = {r["path"].rsplit("/", 1)[1] for r in manifest.scan(spark, str(tmp_path / "in")).collect()}
    assert found == {"a.PNG", "b.webp"}
    assert manifest.scan(spark, str(tmp_path / "in"), fold_case=False).count() == 1
    (tmp_path / "list.txt").write_text(" p/b.webp \n\nq/x.webp\nr.png\n")
    have = spark.createDataFrame([("p/b.webp",), ("r.png",)], "path string")
    assert [r["path"] for r in manifest.from_list(spark, str(tmp_path / "list.txt"), have).collect()] == ["p/b.webp"]
    a = np.arange(12, dtype=np.float16).reshape(3, 4)
    np.save(tmp_path / "x.npy", a)
    np.savez(tmp_path / "y.npz", latent=a, src=np.bytes_("s"))
    got = sorted((r["name"], r["shape"], r["data"]) for r in files.read_arrays(spark, str(tmp_path)).collect())
    assert got == [("", [3, 4], a.ravel().tolist()), ("latent", [3, 4], a.ravel().tolist())]
    ok = files.apply_model(spark.createDataFrame([("p", [2], [1.0, 2.0]), ("q", [3], [1.0])], "path string, shape array<int>, data array<float>"), lambda s, x: x * 2).collect()
    assert ok[0]["data"] == [2.0, 4.0] and ok[1]["status"] != "ok"
    assert np.load(__import__("io").BytesIO(files.with_bytes(spark.createDataFrame([("p", [2], [1.0, 2.0])], "path string, shape array<int>, data array<float>")).first()["content"])).tolist() == [1.0, 2.0]


def test_image_models_boundary_refuses_pickles():
    import io

    import pytest

    out = io.BytesIO()
    np.save(out, np.array([{"a": 1}], dtype=object), allow_pickle=True)
    with pytest.raises(ValueError):
        files.decode(out.getvalue(), "p")


def test_sketched_ranks(spark):
    """Within the stated error of the exact ranks, in whatever order the sketches are merged; nulls are left out."""
    rng = random.Random(3)
    rows = [(rng.choice("aab"), rng.choice([rng.random(), rng.gauss(0, 1), 0.5]), k % 9) for k in range(30_000)] + [("a", None, 1), ("c", 1.0, 0)]
    df = spark.createDataFrame(rows, "g string, v double, part int")
    shares = [0.0, 0.1, 0.5, 0.9, 0.99, 1.0]
    sketches = metrics.quantile_sketches(df, ["g", "part"], "v")
    assert sketches.agg({"n": "sum"}).first()[0] == 30_001
    for merged in (sketches, sketches.orderBy("part"), sketches.orderBy(sketches["part"].desc()).coalesce(1), metrics.quantile_sketches(df, ["g"], "v")):
        for r in metrics.sketched_ranks(merged, "g", shares).collect():
            own = [v for g, v, _ in rows if g == r["g"] and v is not None]
            below, upto = sum(v < r["value"] for v in own) / len(own), sum(v <= r["value"] for v in own) / len(own)
            assert below - metrics.rank_error() <= r["share"] <= upto + metrics.rank_error()
    assert metrics.rank_error(200) < 0.0195 and metrics.rank_error() < 0.0046
