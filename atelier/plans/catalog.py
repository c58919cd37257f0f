"""Catalog queries."""

import uuid

from pyspark.sql import functions as F

from atelier.functions.shared import shared_dir
from atelier.operators import catalog as op
from atelier.operators.catalog import Catalog, OrderedCatalog
from atelier.plans.common import Family, table, uniform_sql
from atelier.sources.csv_table import read_rows
from atelier.sources.trigrams import TrigramIndex

family = Family()
SEED = 1234


def orders(spark, d):
    return OrderedCatalog(table(spark, d, "orders"), "o_orderkey")


NUMBERED = "(SELECT *, row_number() OVER (ORDER BY o_orderkey) - 1 AS row_idx FROM orders)"
CELLS = "o_orderkey::VARCHAR AS col0, o_custkey::VARCHAR AS col1, o_orderstatus AS col2, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S') AS col4, o_orderpriority AS col5"


@family.add("catalog_row_count", "SELECT count(*) AS n_rows FROM orders")
def catalog_row_count(spark, d):
    return table(spark, d, "orders").agg(F.count(F.lit(1)).alias("n_rows"))


@family.add("catalog_col_count", "SELECT count(*) AS n_cols FROM (DESCRIBE SELECT * FROM orders)")
def catalog_col_count(spark, d):
    return spark.range(1).select(F.lit(len(table(spark, d, "orders").columns)).cast("long").alias("n_cols"))


@family.add("catalog_scan", "SELECT c_custkey::VARCHAR AS col0, c_name AS col1, c_nationkey::VARCHAR AS col2, c_mktsegment AS col4 FROM customer")
def catalog_scan(spark, d):
    return Catalog.of(table(spark, d, "customer").withColumn("row_idx", F.col("c_custkey"))).data().select("col0", "col1", "col2", "col4")


@family.add("generated_columns", "SELECT r_regionkey::VARCHAR AS col0, r_name AS col1 FROM region")
def generated_columns(spark, d):
    return Catalog.of(table(spark, d, "region").withColumn("row_idx", F.col("r_regionkey"))).data().select("col0", "col1")


@family.add("row_at", f"SELECT {CELLS} FROM {NUMBERED} WHERE row_idx = 100")
def row_at(spark, d):
    return orders(spark, d).row_frame(100).select("col0", "col1", "col2", "col4", "col5")


@family.add("value_at_name", f"SELECT o_orderpriority AS value FROM {NUMBERED} WHERE row_idx = 77")
def value_at_name(spark, d):
    c = orders(spark, d)
    return c.row_frame(77).select(F.col(f"col{c.positions['o_orderpriority']}").alias("value"))


@family.add("value_at_pos", f"SELECT o_orderstatus AS value FROM {NUMBERED} WHERE row_idx = 1234")
def value_at_pos(spark, d):
    return orders(spark, d).row_frame(1234).select(F.col("col2").alias("value"))


IRREGULAR = """CASE p_partkey % 5 WHEN 0 THEN []::VARCHAR[] WHEN 1 THEN [p_partkey::VARCHAR, replace(p_name, ' ', '"')] WHEN 2 THEN [p_partkey::VARCHAR, p_name, p_type, 'x,y', '']
  WHEN 3 THEN [p_name || chr(10) || p_type, p_partkey::VARCHAR] ELSE [p_partkey::VARCHAR] END"""


@family.add("irregular_rows", f"SELECT row_number() OVER (ORDER BY p_partkey) - 1 AS row_idx, len(c) AS n_cells, array_to_string(c, '|') AS cells FROM (SELECT p_partkey, {IRREGULAR} AS c FROM part)")
def irregular_rows(spark, d):
    """A file with blank, short, long, quoted and broken rows, written and read by the CSV source."""
    k, name = F.col("p_partkey"), F.col("p_name")
    key = k.cast("string")
    quoted = F.concat(key, F.lit(',"'), F.replace(name, F.lit(" "), F.lit('""')), F.lit('"'))
    long, broken = F.concat(key, F.lit(","), name, F.lit(","), F.col("p_type"), F.lit(',"x,y",')), F.concat(F.lit('"'), name, F.lit("\n"), F.col("p_type"), F.lit('",'), key)
    line = F.when(k % 5 == 0, "").when(k % 5 == 1, quoted).when(k % 5 == 2, long).when(k % 5 == 3, broken).otherwise(key)
    path = f"{shared_dir(spark)}/atelier/irregular-{uuid.uuid4().hex}"
    table(spark, d, "part").orderBy(k).select(line.alias("value")).write.text(path)
    return read_rows(spark, path).select("row_idx", F.size("cells").cast("long").alias("n_cells"), F.array_join("cells", "|").alias("cells"))


PROBES = ["BUILDING", "MACHINERY", "building", "ABSENT"]


@family.add("has_value", "SELECT p AS probe, p IN (SELECT c_mktsegment FROM customer) AS found FROM (VALUES ('BUILDING'), ('MACHINERY'), ('building'), ('ABSENT')) v(p)")
def has_value(spark, d):
    return op.probe(table(spark, d, "customer"), F.col("c_mktsegment"), PROBES)


@family.add("has_value_index", "SELECT p AS probe, p IN (SELECT c_custkey::VARCHAR FROM customer) AS found FROM (VALUES ('17'), ('-1'), ('017')) v(p)")
def has_value_index(spark, d):
    return op.probe(table(spark, d, "customer"), F.col("c_custkey").cast("string"), ["17", "-1", "017"])


@family.add("rows_eq", "SELECT p_partkey, p_name, p_type FROM part WHERE p_type = 'PROMO'")
def rows_eq(spark, d):
    return op.rows_with(table(spark, d, "part"), F.col("p_type"), "PROMO").select("p_partkey", "p_name", "p_type")


@family.add("rows_contains", "SELECT p_partkey, p_name FROM part WHERE contains(p_name, 'd w')")
def rows_contains(spark, d):
    return op.rows_with(table(spark, d, "part"), F.col("p_name"), "d w", exact=False).select("p_partkey", "p_name")


@family.add("shuffled_rows", f"SELECT c_custkey, c_name, row_number() OVER (ORDER BY {uniform_sql('c_custkey', SEED)}, c_custkey) - 1 AS position FROM customer")
def shuffled_rows(spark, d):
    return op.shuffle(table(spark, d, "customer").select("c_custkey", "c_name"), "c_custkey", SEED, "position")


@family.add("rows_range", f"SELECT row_idx, {CELLS} FROM {NUMBERED} WHERE row_idx BETWEEN 500 AND 549")
def rows_range(spark, d):
    return orders(spark, d).rows_by_range(500, 50).select("row_idx", "col0", "col1", "col2", "col4", "col5")


@family.add("catalog_summary", "SELECT '<Catalog: ' || count(*) || ' rows, 6 columns>' AS summary FROM orders")
def catalog_summary(spark, d):
    t = table(spark, d, "orders")
    return t.agg(F.format_string("<Catalog: %d rows, %d columns>", F.count(F.lit(1)), F.lit(len(set(t.columns)))).alias("summary"))


@family.add("rows_by_trigram", "SELECT doc_id, source FROM documents WHERE contains(text, 'ing the') OR contains(text, 'zq')")
def rows_by_trigram(spark, d):
    """Documents that hold either of two strings, through an index of all their texts."""
    index = TrigramIndex.build(table(spark, d, "documents").select("doc_id", "source", "text"), f"{shared_dir(spark)}/atelier/trigrams-{uuid.uuid4().hex}", "text")
    return index.find("ing the").unionByName(index.find("zq").filter(~F.col("text").contains("ing the"))).select("doc_id", "source")
