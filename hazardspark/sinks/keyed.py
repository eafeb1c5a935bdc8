"""A table kept by key in hash buckets, merged bucket by bucket.

Rows lie in ``path/data/v=<version>/keyed_bucket=<n>``; a manifest per version says which folder holds each bucket now.
A merge reads and replaces only the buckets that hold keys of the source and leaves every other folder as it is. It
becomes visible when its manifest is renamed into place, so a reader sees one version as a whole, a failed merge leaves
nothing behind that is read, and a repeated one (``version`` given) writes the same again. The manifest has a number per
bucket, never a row per key. One writer at a time.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from hazardspark.operators.dedupe import keep_last
from hazardspark.operators.upsert import upsert
from hazardspark.session import cut_lineage

BUCKET = "keyed_bucket"


@dataclass(frozen=True)
class KeyedTable:
    """``buckets`` is fixed by the first merge; choose it so that a bucket stays within a task's memory."""

    spark: SparkSession
    path: str
    key: str
    buckets: int = 64

    # --- files ----------------------------------------------------------------------------------

    def _fs(self, path: str):
        jvm = self.spark._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        return p.getFileSystem(self.spark._jsc.hadoopConfiguration()), p

    def _folder(self, bucket: int | str, version: int) -> str:
        return f"{self.path}/data/v={version:09d}/{BUCKET}={bucket}"

    def versions(self) -> list[int]:
        """Completed versions."""
        fs, path = self._fs(f"{self.path}/manifests")
        if not fs.exists(path):
            return []
        names = [status.getPath().getName() for status in fs.listStatus(path)]
        return sorted(int(n.removesuffix(".json")) for n in names if n.endswith(".json"))

    def manifest(self, version: int | None = None, below: int | None = None) -> dict | None:
        """Of a version, or of the newest one (``below`` a number)."""
        done = [v for v in self.versions() if (version is None or v == version) and (below is None or v < below)]
        if not done:
            return None
        fs, path = self._fs(f"{self.path}/manifests/{done[-1]:09d}.json")
        stream = fs.open(path)
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def _publish(self, manifest: dict) -> None:
        name = f"{self.path}/manifests/{manifest['version']:09d}.json"
        fs, draft = self._fs(f"{name}.draft")
        stream = fs.create(draft, True)
        try:
            stream.write(bytearray(json.dumps(manifest).encode()))
        finally:
            stream.close()
        _, final = self._fs(name)
        fs.delete(final, False)
        if not fs.rename(draft, final):
            raise OSError(f"cannot publish {name}")

    # --- rows -----------------------------------------------------------------------------------

    def bucket_of(self, key: Column, buckets: int | None = None) -> Column:
        return F.pmod(F.xxhash64(key), F.lit(buckets or self.buckets)).cast("int")

    def read(self, version: int | None = None, buckets: list[int] | None = None) -> DataFrame | None:
        """The rows of a version (default: the newest), of some buckets only if asked; None before the first merge."""
        found = self.manifest(version)
        return None if found is None else self._rows(found, buckets)

    def _rows(self, manifest: dict, buckets: list[int] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(manifest["schema"])
        wanted = manifest["folders"] if buckets is None else [str(b) for b in buckets if str(b) in manifest["folders"]]
        paths = [self._folder(b, manifest["folders"][b]) for b in wanted]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def near(self, keys: DataFrame, below: int | None = None) -> DataFrame | None:
        """Rows of the buckets that the keys (column ``key``) fall into, of the newest version (``below`` a number)."""
        found = self.manifest(below=below)
        if found is None:
            return None
        return self._rows(found, self._touched(keys, found["buckets"]))

    def _touched(self, rows: DataFrame, buckets: int) -> list[int]:
        # At most one number per bucket comes to the driver.
        return sorted(r[0] for r in rows.select(self.bucket_of(F.col(self.key), buckets)).distinct().collect())

    def merge(
        self, source: DataFrame, update_cols: list[str] | None = None, order: list[str] | None = None,
        updated_at: Column | None = None, version: int | None = None, keep: int = 2,
    ) -> int:
        """Merge as ``upsert`` does and return the version.

        With ``order`` a row does not replace one of a greater order, whichever came first; ``order`` columns are
        updated too. Rows without a key are left out. Versions below but the newest ``keep`` go, with the folders that
        none of the others names.
        """
        before = self.manifest(below=version)
        number = version if version is not None else (before["version"] + 1 if before else 0)
        buckets = before["buckets"] if before else self.buckets
        source = source.where(F.col(self.key).isNotNull())
        source = cut_lineage(keep_last(source, [self.key], order or [c for c in source.columns if c != self.key]))
        touched = self._touched(source, buckets)
        target = self._rows(before, touched) if before else source.limit(0)
        folders = dict(before["folders"]) if before else {}
        if touched:
            changed = update_cols
            if order:
                source = _not_late(source, target, self.key, order)
                changed = None if update_cols is None else [*update_cols, *(c for c in order if c not in update_cols)]
            merged = upsert(target, source, self.key, changed, order, updated_at)
            merged = merged.withColumn(BUCKET, self.bucket_of(F.col(self.key), buckets)).repartition(F.col(BUCKET))
            merged.write.mode("overwrite").partitionBy(BUCKET).parquet(f"{self.path}/data/v={number:09d}")
            folders |= {str(b): number for b in touched}
        schema = json.loads(target.schema.json())
        self._publish({"version": number, "key": self.key, "buckets": buckets, "schema": schema, "folders": folders})
        self.expire(number, keep)
        return number

    def expire(self, version: int, keep: int) -> None:
        """Drop the manifests below ``version`` but the newest ``keep``, and folders that no manifest names."""
        below = [v for v in self.versions() if v < version]
        gone = below[: max(0, len(below) - keep)]
        if not gone:
            return
        dropped = [self.manifest(v) for v in gone]
        for v in gone:
            fs, path = self._fs(f"{self.path}/manifests/{v:09d}.json")
            fs.delete(path, False)
        named = {(b, v) for m in map(self.manifest, self.versions()) for b, v in m["folders"].items()}
        for b, v in {(b, v) for m in dropped for b, v in m["folders"].items()} - named:
            fs, path = self._fs(self._folder(b, v))
            fs.delete(path, True)


def _not_late(source: DataFrame, target: DataFrame, key: str, order: list[str]) -> DataFrame:
    """Rows whose order is not below that of the row the target has; a null order is below all others."""
    rank = lambda: F.struct(*[x for c in order for x in (F.col(c).isNotNull(), F.col(c))])
    known = target.select(F.col(key).alias("_key"), rank().alias("_order"))
    joined = source.join(known, source[key] == known["_key"], "left")
    return joined.where(F.col("_order").isNull() | (rank() >= F.col("_order"))).select(*source.columns)
