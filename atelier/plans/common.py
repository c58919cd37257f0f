"""Registration of queries with their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


class Family:
    """Queries of one part of the engine; ``sql`` is None where only rows can be checked."""

    def __init__(self) -> None:
        self.queries: dict[str, Query] = {}
        self.oracles: dict[str, str] = {}

    def add(self, name: str, sql: str | None) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            self.queries[name] = query
            if sql:
                self.oracles[name] = sql
            return query

        return register


#: DuckDB SQL for functions.text.uniform(key, seed).
def uniform_sql(key: str, seed: int) -> str:
    return f"(('0x' || substr(sha1(({key})::VARCHAR || ':{seed}'), 1, 13))::BIGINT / 4503599627370496.0::DOUBLE)"


def strip_sql(x: str) -> str:
    return f"regexp_replace({x}, '^[\\s\\p{{Z}}\\x0b\\x85]+|[\\s\\p{{Z}}\\x0b\\x85]+$', '', 'g')"
