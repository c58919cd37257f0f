"""Every query with SQL against DuckDB, on the smallest tables."""

import os

import duckdb
import pytest

from atelier.plans.registry import ORACLES, QUERIES, flagship

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(repr(round(r[i], 9) if isinstance(r[i], float) else r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, duck, name):
    got = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in got.collect()]
    if name in ORACLES:
        want = duck.sql(ORACLES[name])
        assert sorted(got.columns) == sorted(want.columns)
        assert plain(rows, got.columns) == plain(want.fetchall(), want.columns)


def test_flagship(spark):
    assert flagship(spark, SF).count() > 0


def test_not_vacuous(spark):
    kept = QUERIES["caption_exclude_counts"](spark, SF).first()
    assert 0 < kept["n_after"] < kept["n_before"]
    assert QUERIES["tag_select"](spark, SF).count() > 0
    assert QUERIES["rejected_links"](spark, SF).count() > 0
