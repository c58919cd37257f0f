"""All queries of the engine's own operators, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from atelier.plans import captions, catalog, listing, streams, training, vectors
from atelier.plans.common import Query

FAMILIES = (catalog.family, listing.family, captions.family, vectors.family, training.family, streams.family)
QUERIES: dict[str, Query] = {name: q for f in FAMILIES for name, q in f.queries.items()}
ORACLES: dict[str, str] = {name: sql for f in FAMILIES for name, sql in f.oracles.items()}


def flagship(spark: SparkSession, sf_dir: str) -> DataFrame:
    """New items against the catalog's snapshot."""
    return QUERIES["new_items_snapshot"](spark, sf_dir)
