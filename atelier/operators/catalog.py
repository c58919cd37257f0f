"""Catalog: a table of strings in a fixed order, looked up by position and by value."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from atelier.functions.ranking import KeyOrder, rank_by_uniform
from atelier.functions.text import uniform


class Catalog:
    """``df`` has columns col0.. (strings) and row_idx; ``names`` are the columns' names by position.

    If rows differ in length, ``df`` has their ``cells``, too, and a column is null where a row is too short for it.
    """

    def __init__(self, df: DataFrame, names: list[str]) -> None:
        self.df, self.width, self.names = df, len(names), names
        self.positions = {n: i for i, n in enumerate(names)}  # of equal names the last counts
        self._count: int | None = None

    @classmethod
    def of(cls, df: DataFrame, row_idx: str = "row_idx") -> Catalog:
        """From a table with a position column; other columns become strings, null becomes empty."""
        names = [c for c in df.columns if c != row_idx]
        cells = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"col{i}") for i, c in enumerate(names)]
        return cls(df.select(*cells, F.col(row_idx).alias("row_idx")), names)

    @classmethod
    def of_cells(cls, df: DataFrame, names: list[str]) -> Catalog:
        """From rows of any length: (cells, row_idx)."""
        return cls(df.select(*[F.try_element_at("cells", F.lit(i + 1)).alias(f"col{i}") for i in range(len(names))], "cells", "row_idx"), names)

    def rows_count(self) -> int:
        """Counted once: a catalog is a snapshot."""
        if self._count is None:
            self._count = self.df.count()
        return self._count

    def cols_count(self) -> int:
        return self.width

    def data(self) -> DataFrame:
        return self.df

    def _row_check(self, row: int) -> None:
        if row < 0 or row >= self.rows_count():
            raise IndexError("row index out of range")

    def _position(self, name: str) -> int:
        if name not in self.positions:
            raise KeyError(name)
        return self.positions[name]

    def row_frame(self, row: int) -> DataFrame:
        return self.df.filter(F.col("row_idx") == row)

    def row(self, row: int) -> list[str]:
        self._row_check(row)
        found = self.row_frame(row).first()
        return list(found["cells"]) if "cells" in self.df.columns else [found[f"col{i}"] for i in range(self.width)]

    def value(self, row: int, name: str) -> str:
        """The name is checked before the row."""
        return self.value_by_index(row, self._position(name))

    def value_by_index(self, row: int, column: int) -> str:
        """The row is checked before the column. A row that is too short for the column is an error."""
        self._row_check(row)
        if column < 0 or column >= self.width:
            raise IndexError("column index out of range")
        found = self.row_frame(row).select(f"col{column}").first()[0]
        if found is None:
            raise IndexError("the row is too short")
        return found

    def has_value(self, name: str, value: str) -> bool:
        """Rows that are too short for the column hold no value of it."""
        return self.has_value_index(self._position(name), value)

    def has_value_index(self, column: int, value: str) -> bool:
        if column < 0 or column >= self.width:
            raise IndexError("column index out of range")
        return not self.df.filter(F.col(f"col{column}") == value).isEmpty()

    def rows_by_value(self, name: str, value: str, exact: bool = True) -> DataFrame:
        return rows_with(self.df, F.col(f"col{self._position(name)}"), value, exact)

    def rows_by_range(self, start: int, length: int) -> DataFrame:
        """No clamping: a range beyond the end is an error, checked before the length."""
        if start < 0 or start + length > self.rows_count():
            raise IndexError("row range out of range")
        if length <= 0:
            raise ValueError("length must be positive")
        return self._range(start, length)

    def _range(self, start: int, length: int) -> DataFrame:
        return rows_between(self.df, start, length)

    def shuffled(self, seed: int) -> Catalog:
        return Catalog(shuffle(self.df.withColumnRenamed("row_idx", "__old"), "__old", seed, "row_idx").drop("__old"), self.names)

    def summary(self) -> str:
        return f"<Catalog: {self.rows_count()} rows, {len(self.positions)} columns>"


class OrderedCatalog(Catalog):
    """A catalog in the order of a numeric key. Rows are looked up by position without ranking the whole table."""

    def __init__(self, df: DataFrame, key: str) -> None:
        self.order = KeyOrder(df, key)
        names = df.columns
        self.cells = [F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"col{i}") for i, c in enumerate(names)]
        super().__init__(self._rows(0, self.order.count()), names)
        self._count = self.order.count()

    def _rows(self, start: int, length: int) -> DataFrame:
        return self.order.between(start, length).select(*self.cells, "row_idx")

    def row_frame(self, row: int) -> DataFrame:
        return self._rows(row, 1)

    def _range(self, start: int, length: int) -> DataFrame:
        return self._rows(start, length)


def contains(c: Column, value: str) -> Column:
    """Plain substring: no wildcards, case counts, the empty string is everywhere."""
    return c.contains(value)


def rows_with(df: DataFrame, c: Column, value: str, exact: bool = True) -> DataFrame:
    """Rows whose cell is the value, or holds it."""
    return df.filter(c == value if exact else contains(c, value))


def rows_between(df: DataFrame, start: int, length: int) -> DataFrame:
    return df.filter(F.col("row_idx").between(start, start + length - 1))


def shuffle(df: DataFrame, key: str, seed: int, name: str) -> DataFrame:
    """Reproducible shuffle: ``name`` is the new position."""
    return rank_by_uniform(df, uniform(F.col(key), seed), key, name)


def probe(df: DataFrame, c: Column, values: list[str]) -> DataFrame:
    """(probe, found) for many values at once: one pass over the column."""
    hits = df.select(c.alias("probe")).filter(F.col("probe").isin(values)).distinct()
    asked = df.sparkSession.createDataFrame([(v,) for v in values], "probe string")
    return asked.join(F.broadcast(hits.withColumn("__hit", F.lit(True))), "probe", "left").select("probe", F.coalesce("__hit", F.lit(False)).alias("found"))
