import csv
import io
import random

import pytest
from pyspark.sql import functions as F

from atelier.functions.text import fixed
from atelier.operators.catalog import Catalog
from atelier.sources import csv_table, run_files
from atelier.sources.csv_table import append_rows, read_captions, read_catalog, read_dictionary, read_rows, write_metrics


@pytest.fixture(scope="module")
def files(tmp_path_factory):
    d = tmp_path_factory.mktemp("csv")
    (d / "head.csv").write_text('id,name,id\n1,"a ""q"", b",x\n2,"two\nlines",y\n3,,z\n4,short\n')
    (d / "bare.csv").write_text("u,t,5\nv,,6\n")
    (d / "empty.csv").write_text("")
    return d


def test_header(spark, files):
    c = read_catalog(spark, str(files / "head.csv"))
    assert (c.rows_count(), c.cols_count(), c.summary()) == (4, 3, "<Catalog: 4 rows, 2 columns>")
    assert c.row(0) == ["1", 'a "q", b', "x"]
    assert c.row(1)[1] == "two\nlines"
    assert c.row(2) == ["3", "", "z"] and c.row(3) == ["4", "short"]
    assert c.value(0, "id") == "x"  # of equal names the last counts
    assert c.value_by_index(0, 0) == "1"
    with pytest.raises(IndexError):
        c.value(3, "id")  # the row is too short
    mixed = c.shuffled(3)
    assert (mixed.cols_count(), mixed.summary()) == (3, c.summary())
    at = next(r["row_idx"] for r in mixed.data().collect() if r["col0"] == "1")
    assert mixed.value(at, "id") == "x" and mixed.row(at) == c.row(0)


def rows_of(spark, path, **options):
    return [r["cells"] for r in read_rows(spark, str(path), **options).orderBy("row_idx").collect()]


def test_irregular_rows(spark, tmp_path):
    """Blank, short and long rows keep their places, as Python's own reader has them."""
    text = 'a,b,c\n1,2,3\n\n4,5\n6,7,8,9\n"x\n\ny","",\n,\n"q""q"z,a"b"c\r\n"open to, the end\nof it'
    (tmp_path / "r.csv").write_text(text, newline="")
    with open(tmp_path / "r.csv") as f:
        want = list(csv.reader(f))
    assert rows_of(spark, tmp_path / "r.csv") == want and [] in want and ["6", "7", "8", "9"] in want
    c = read_catalog(spark, str(tmp_path / "r.csv"))
    assert (c.rows_count(), c.cols_count()) == (8, 3) and [c.row(i) for i in range(4)] == want[1:5]
    assert c.value(3, "c") == "8" and c.has_value("c", "8") and not c.has_value("c", "9")
    assert [r["row_idx"] for r in c.rows_by_value("a", "6").collect()] == [3]
    (tmp_path / "l.csv").write_bytes("é,ü\n".encode("latin-1"))
    assert rows_of(spark, tmp_path / "l.csv", encoding="iso-8859-1") == [["é", "ü"]]


@pytest.mark.parametrize("size", [7, 40, 400])
def test_rows_across_splits(spark, tmp_path, size):
    """Files cut into many splits, quoted cells that run over several of them."""
    r = random.Random(size)
    for name in ("a.csv", "b.csv"):
        with open(tmp_path / name, "w", newline="") as f:
            writer = csv.writer(f, lineterminator="\n")
            for i in range(60):
                writer.writerow([f"{name}{i}", *(r.choice(["", "x", 'q"q', "two\nlines", "long\n" * 30, ",", '"']) for _ in range(r.randint(0, 4)))])
                if r.random() < 0.1:
                    f.write("\n")
    want = []
    for name in ("a.csv", "b.csv"):
        with open(tmp_path / name) as f:
            want += list(csv.reader(f))
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size * 10))
    spark.conf.set("spark.sql.files.openCostInBytes", "1")
    try:
        assert rows_of(spark, tmp_path) == want
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")


def test_errors_and_their_order(spark, files):
    c = read_catalog(spark, str(files / "bare.csv"), has_header=False)
    assert c.rows_count() == 2 and c.row(1) == ["v", "", "6"]
    for bad in (-1, 2):
        with pytest.raises(IndexError):
            c.row(bad)
    with pytest.raises(KeyError):
        c.value(99, "nope")
    with pytest.raises(IndexError):
        c.value_by_index(0, 3)
    with pytest.raises(IndexError):
        c.rows_by_range(1, 2)
    with pytest.raises(ValueError):
        c.rows_by_range(1, 0)
    with pytest.raises(StopIteration):
        read_catalog(spark, str(files / "empty.csv"))


def test_values(spark):
    df = spark.createDataFrame([(0, "a%b"), (1, "A_b"), (2, None)], "row_idx long, v string")
    c = Catalog.of(df)
    assert c.has_value("v", "") and not c.has_value("v", "a")
    assert c.rows_by_value("v", "%", exact=False).count() == 1
    assert c.rows_by_value("v", "", exact=False).count() == 3
    assert [r["col0"] for r in c.rows_by_range(1, 2).orderBy("row_idx").collect()] == ["A_b", ""]
    once, again = ([r[0] for r in c.shuffled(s).data().orderBy("row_idx").collect()] for s in (5, 5))
    assert once == again and sorted(once) == ["", "A_b", "a%b"]


def test_append_and_dictionary(spark, files, tmp_path):
    out = str(tmp_path / "d")
    append_rows(spark.createDataFrame([("1", 'x "y"'), ("2", "")], "id string, v string"), out)
    append_rows(spark.createDataFrame([("1", "later")], "id string, v string"), out)
    assert sorted((r["id"], r["value"]) for r in read_dictionary(spark, out).collect()) == [("1", "later"), ("1", 'x "y"'), ("2", "")]
    with pytest.raises(ValueError):
        read_dictionary(spark, str(files / "bare.csv"))
    (tmp_path / "c.csv").write_text("path,caption\np1,c1\n")
    assert [tuple(r)[:3] for r in read_captions(spark, str(tmp_path / "c.csv")).collect()] == [("p1", "c1", "")]


def test_metric_series_as_text(spark, tmp_path):
    """A header that names alpha, then lines in step order; the file is written anew each time."""
    df = spark.createDataFrame([(k, k / 4) for k in (3, 1, 2)], "step long, loss double").repartition(3)
    for _ in range(2):
        write_metrics(df, str(tmp_path / "m"), 0.98, F.concat_ws(",", F.col("step").cast("string"), fixed(F.col("loss"), 6), fixed(F.col("loss"), 6)))
    lines = [x for p in sorted((tmp_path / "m").glob("part-*")) for x in p.read_text().splitlines()]
    assert lines == ["step,loss,loss_ema(alpha=0.98)", "1,0.250000,0.250000", "2,0.500000,0.500000", "3,0.750000,0.750000"]


def test_cells_keep_all_characters(spark, tmp_path):
    """Against Python's reader: every line break that Python knows inside cells, quoted and bare, in splits of odd sizes."""
    rng = random.Random(6)
    marks = ["\u2028", "\u2029", "\x85", "\x0b", "\x0c", "\x1c", "\x1d", "\x1e", '"', ",", "a", "\u00e9", " "]
    text = '1,"two\nlines",sep\u2028here,last\n'
    for _ in range(300):
        cells = ["".join(rng.choice(marks) for _ in range(rng.randrange(6))) for _ in range(rng.randrange(5))]
        cells = ['"' + c.replace('"', '""') + rng.choice(["", "\n", "\n\n"]) + '"' if rng.random() < 0.4 else c.replace('"', "").replace(",", "") for c in cells]
        text += ",".join(cells) + "\n"
    (tmp_path / "a.csv").write_text(text, newline="")
    want = list(csv.reader(io.StringIO(text, newline="")))
    for size in (97, 1024, 1 << 20):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        got = [list(r["cells"]) for r in csv_table.read_rows(spark, str(tmp_path / "a.csv")).orderBy("row_idx").collect()]
        assert got == want
    spark.conf.unset("spark.sql.files.maxPartitionBytes")


def test_range_file_is_read_whole(spark, tmp_path):
    path = tmp_path / "range"
    for text, want in (("0 1", (0.0, 1.0)), ("0\n1\n", (0.0, 1.0)), ("0 1" + "\n" * 100 + "7", None), ("\n" * 5000 + "-2\u2003" + "\n" * 300 + "1e3", (-2.0, 1000.0)), ("1 0", None), ("a b", None), ("", None), ("3", None)):
        path.write_text(text)
        assert run_files.read_range(spark, str(path)) == want
    run_files.write_range(spark, str(path), 5, 50)
    assert run_files.read_range(spark, str(path)) == (5.0, 50.0)
