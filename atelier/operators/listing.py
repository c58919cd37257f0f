"""Listing pages and novelty: links, page counts, ids, new and known items, first-wins dictionaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ID_PATTERN = r"-(\d+)\.html"


def links(html: Column) -> Column:
    """array<struct<href, text>> of plain anchors, in page order."""
    pattern = r'<a href="([^"]*)">([^<]*)</a>'
    return F.arrays_zip(F.regexp_extract_all(html, F.lit(pattern), 1).alias("href"), F.regexp_extract_all(html, F.lit(pattern), 2).alias("text"))


def zip_with_cells(items: Column, cells: Column, wanted: int = 3) -> Column:
    """Item i with cell ``wanted`` of its own cell list, empty where there is none."""
    return F.transform(F.arrays_zip(items.alias("item"), cells.alias("cells")), lambda z: F.struct(z["item"].alias("item"), F.coalesce(F.try_element_at(z["cells"], F.lit(wanted + 1)), F.lit("")).alias("type")))


def page_count(numbers: Column) -> Column:
    """Largest page number among link texts; 0 without any."""
    return F.greatest(F.lit(0), F.coalesce(F.array_max(F.transform(numbers, lambda x: x.try_cast("int"))), F.lit(0)))


def page_urls(base: Column, pages: Column) -> Column:
    """URLs of pages 1..n: the base itself, then with a fragment or a query."""
    numbered = lambda n: F.when(n == 1, base).when(base.contains("/search.html"), F.concat(base, F.lit("#"), n.cast("string"))).otherwise(F.concat(base, F.lit("?page="), n.cast("string")))
    return F.transform(F.sequence(F.lit(1), F.greatest(F.lit(1), pages)), numbered)


def item_id(link: Column, pattern: str = ID_PATTERN) -> Column:
    """First match, as a string; empty if there is none."""
    return F.regexp_extract(link, pattern, 1)


def allowed(items: DataFrame, kind: str, types: list[str]) -> DataFrame:
    """Items of the types that are wanted; the case of letters counts, and no type is none of them."""
    return items.filter(F.col(kind).isin(types))


def new_items(items: DataFrame, catalog: DataFrame, key: str) -> DataFrame:
    """Items that the catalog's snapshot lacks. An item seen twice comes twice."""
    return items.join(catalog.select(key).distinct(), key, "left_anti")


def known_items(items: DataFrame, catalogs: list[DataFrame], key: str) -> DataFrame:
    seen = catalogs[0].select(key)
    for c in catalogs[1:]:
        seen = seen.union(c.select(key))
    return items.join(seen.distinct(), key, "left_semi")


def first_of(items: DataFrame, key: str, order: list[str]) -> DataFrame:
    """The first sighting of each key: a pre-aggregated minimum, so a hot key is no hot task."""
    rest = [c for c in items.columns if c not in (key, *order)]
    least = F.min(F.struct(*order, *rest)).alias("__first")
    return items.groupBy(key).agg(least).select(key, *[F.col(f"__first.{c}").alias(c) for c in (*order, *rest)]).select(*items.columns)


def upsert_first_wins(dictionary: DataFrame, seen: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Existing keys stay as they are; of new ones the first sighting is added."""
    fresh = first_of(seen, key, order).join(dictionary.select(key), key, "left_anti")
    return dictionary.unionByName(fresh.select(*dictionary.columns))


def last_wins(rows: DataFrame, key: str, value: str, order: str) -> DataFrame:
    return rows.groupBy(key).agg(F.max_by(value, order).alias(value))


def joined_names(names: Column) -> Column:
    """Trimmed names but for "...", joined; commas and spaces are then stripped as characters."""
    kept = F.filter(F.transform(names, lambda x: F.trim(x)), lambda x: x != "...")
    return F.trim(F.array_join(kept, ", "), F.lit(", "))


def image_rows(items: DataFrame, count: str) -> DataFrame:
    """A row for each image, numbered from 1; none without images."""
    n = F.col(count)
    return items.withColumn("img_index", F.explode(F.when(n > 0, F.sequence(F.lit(1), n)).otherwise(F.array().cast("array<int>"))))


def image_name(url: Column, index: Column) -> Column:
    return F.concat(F.lit("image_"), index.cast("string"), F.lit("."), F.substring_index(url, ".", -1))


def valid_page(items: Column) -> Column:
    """A page counts if it has items and the first has a text."""
    return F.coalesce((F.size(items) > 0) & (F.try_element_at(items, F.lit(1))["text"] != ""), F.lit(False))


def level_of(line: Column) -> Column:
    return F.regexp_extract(line, r"^\[([A-Z]+)\]", 1)
