"""A dictionary in hash buckets: an upsert rewrites the buckets that get new keys, and a manifest swaps them all at once.

``<path>/version=<n>`` holds the manifest of a version: for each bucket, the folder with its rows. Folders are never written again. A
version is published by one rename that refuses a taken name, so readers see a version or the next, and of two writers that
began with the same version one must try again.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from atelier.operators.listing import first_of
from atelier.sources.published import STAGING, exists, place_of, publish, published, remove

BUCKETS = 256
_BUCKET = "__bucket"


class Conflict(RuntimeError):
    """Another writer has published the next version."""


class BucketedDictionary:
    def __init__(self, spark: SparkSession, path: str) -> None:
        self.spark, self.path = spark, path.rstrip("/")

    @classmethod
    def create(cls, rows: DataFrame, path: str, key: str, buckets: int = BUCKETS) -> BucketedDictionary:
        """Version 0, from rows with unique keys."""
        out = cls(rows.sparkSession, path)
        if published(out.spark, out.path, "version"):
            raise FileExistsError(path)
        manifest = {"key": key, "buckets": buckets, "schema": rows.schema.json(), "folders": {}}
        out._publish(manifest | {"folders": out._write(rows.withColumn(_BUCKET, out._bucket(key, buckets)))}, 0)
        return out

    @staticmethod
    def _bucket(key: str, buckets: int) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets)).cast("int")

    def version(self) -> int:
        """The last version published."""
        found = published(self.spark, self.path, "version")
        if not found:
            raise FileNotFoundError(self.path)
        return max(map(int, found))

    def manifest(self, version: int | None = None) -> dict:
        version = self.version() if version is None else version
        place, store = place_of(self.spark, f"{self.path}/version={version}/manifest.json")
        stream = store.open(place)
        try:
            return json.loads(bytes(stream.readAllBytes()))
        finally:
            stream.close()

    def _publish(self, manifest: dict, version: int) -> None:
        staged = f"{self.path}/{STAGING}/{uuid.uuid4().hex}"
        place, store = place_of(self.spark, f"{staged}/manifest.json")
        out = store.create(place, True)
        out.write(json.dumps(manifest, sort_keys=True).encode())
        out.close()
        if not publish(self.spark, staged, f"{self.path}/version={version}"):
            raise Conflict(f"version {version} of {self.path} is there")

    def _write(self, rows: DataFrame) -> dict[str, str]:
        """Bucket -> folder of rows that have their bucket's number; one file a bucket, written by all tasks."""
        name = f"data/{uuid.uuid4().hex}"
        rows.repartition(_BUCKET).write.partitionBy(_BUCKET).parquet(f"{self.path}/{name}")
        place, store = place_of(self.spark, f"{self.path}/{name}")
        found = [f.getPath().getName() for f in store.listStatus(place)]
        return {x.split("=")[1]: f"{name}/{x}" for x in found if x.startswith(f"{_BUCKET}=")}

    def _rows(self, manifest: dict, some: list[int] | None = None) -> DataFrame:
        schema = StructType.fromJson(json.loads(manifest["schema"]))
        folders = [f"{self.path}/{f}" for b, f in sorted(manifest["folders"].items()) if some is None or int(b) in some]
        return self.spark.read.schema(schema).parquet(*folders) if folders else self.spark.createDataFrame([], schema)

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows(self.manifest(version))

    def lookup(self, keys: list) -> DataFrame:
        """Rows of a few keys: only their buckets are read."""
        m = self.manifest()
        kind = StructType.fromJson(json.loads(m["schema"]))[m["key"]].dataType
        asked = self.spark.createDataFrame([(k,) for k in keys], StructType().add(m["key"], kind))
        some = [r[0] for r in asked.select(self._bucket(m["key"], m["buckets"])).distinct().collect()]
        return self._rows(m, some).filter(F.col(m["key"]).isin(keys))

    def upsert_first_wins(self, seen: DataFrame, order: list[str]) -> list[int]:
        """Adds the first sighting of each new key; existing keys stay as they are. The buckets that were rewritten.

        Only buckets that sightings fall into are read, and of these only those that get new keys are written.
        """
        version = self.version()
        m = self.manifest(version)
        key, columns = m["key"], [f["name"] for f in json.loads(m["schema"])["fields"]]
        bucket = self._bucket(key, m["buckets"])
        first = first_of(seen.filter(F.col(key).isNotNull()), key, order).select(*columns)
        touched = sorted(r[0] for r in first.select(bucket.alias("b")).distinct().collect())  # at most as many as there are buckets
        fresh = first.join(self._rows(m, touched).select(key), key, "left_anti").select(*columns).withColumn(_BUCKET, bucket)
        staged = f"{self.path}/{STAGING}/{uuid.uuid4().hex}"
        fresh.write.parquet(staged)
        try:
            fresh = self.spark.read.parquet(staged)
            rewritten = sorted(r[0] for r in fresh.select(_BUCKET).distinct().collect())
            if not rewritten:
                return []
            old = self._rows(m, rewritten).withColumn(_BUCKET, bucket)
            folders = self._write(old.unionByName(fresh))
        finally:
            remove(self.spark, staged)
        try:
            self._publish(m | {"folders": m["folders"] | folders}, version + 1)
        except Conflict:
            remove(self.spark, f"{self.path}/{next(iter(folders.values())).rpartition('/')[0]}")
            raise
        return rewritten

    def vacuum(self, keep: int = 2) -> int:
        """Deletes all but the last ``keep`` versions and the bucket folders that none of these names; how many folders went."""
        versions = sorted(map(int, published(self.spark, self.path, "version")))
        used = {f for v in versions[-keep:] for f in self.manifest(v)["folders"].values()}
        gone = 0
        for v in versions[:-keep]:
            for f in self.manifest(v)["folders"].values():
                if f not in used and exists(self.spark, f"{self.path}/{f}"):
                    remove(self.spark, f"{self.path}/{f}")
                    gone += 1
        for v in versions[:-keep]:
            remove(self.spark, f"{self.path}/version={v}")
        return gone
