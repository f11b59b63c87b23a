"""Keyed tables: upserts and deletes on stored Parquet, bucket by bucket.

Rows lie in buckets by the hash of their key. A change reads and rewrites the
buckets that its keys fall into and no others; what it writes is a new folder, and
it takes effect by one small file: the version's rows (version, bucket, folder) in
the manifest. Readers follow the manifest, so they see a version whole, older
versions stay readable, and a writer that fails before the last step leaves
nothing but an unused folder. One writer at a time: a commit that finds a newer
version than the one it has read fails.

The driver handles bucket numbers and folder names, never rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from mercato.operators.clean import dedupe

MANIFEST = "version bigint, bucket int, folder string"
BUCKET = "bucket"


class ConflictError(RuntimeError):
    """Another writer has committed in between."""


class KeyedTable:
    """A table at ``path`` with unique ``keys`` (NULL counts as a value)."""

    def __init__(self, spark: SparkSession, path: str, keys: Sequence[str], buckets: int = 64):
        self.spark, self.path, self.keys, self.buckets = spark, path.rstrip("/"), list(keys), buckets

    # ---- reading ---------------------------------------------------------
    def manifest(self) -> DataFrame:
        """Every bucket of every version that was written: (version, bucket, folder);
        a bucket that became empty has no folder."""
        try:
            return self.spark.read.schema(MANIFEST).parquet(f"{self.path}/manifest")
        except AnalysisException:
            return self.spark.createDataFrame([], MANIFEST)

    def version(self) -> int:
        """The newest version; 0 before the first write."""
        return self.manifest().agg(F.max("version")).first()[0] or 0

    def _folders(self, version: int | None, only: Sequence[int] | None = None) -> list[str]:
        """Folders of the buckets (of ``only`` these) as of a version."""
        rows = self.manifest().where(F.col("bucket") >= 0)
        if version is not None:
            rows = rows.where(F.col("version") <= version)
        if only is not None:
            rows = rows.where(F.col("bucket").isin(list(only)))
        newest = rows.groupBy("bucket").agg(F.max_by("folder", "version").alias("folder"))
        return sorted(r.folder for r in newest.where("folder IS NOT NULL").collect())

    def _load(self, folders: Sequence[str]) -> DataFrame | None:
        # columns may have been added over time
        return self.spark.read.option("mergeSchema", "true").parquet(*folders) if folders else None

    def read(self, version: int | None = None, schema: StructType | str | None = None) -> DataFrame:
        """The table, the newest version or an older one. An empty table needs
        ``schema`` to be read."""
        found = self._load(self._folders(version))
        if found is None:
            if schema is None:
                raise ValueError(f"{self.path} has no rows: a schema is needed to read it")
            return self.spark.createDataFrame([], schema)
        return found

    def read_keys(self, keys: DataFrame) -> DataFrame | None:
        """The rows of the given keys; only their buckets are read."""
        found = self._load(self._folders(None, self._touched(keys)))
        return None if found is None else found.join(self._renamed(keys), self._same(), "left_semi")

    # ---- writing ---------------------------------------------------------
    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*[F.col(k) for k in self.keys]), F.lit(self.buckets)).cast("int")

    def _touched(self, rows: DataFrame) -> list[int]:
        """Buckets that the keys of ``rows`` fall into; at most ``buckets`` numbers."""
        return [r[0] for r in rows.select(self.bucket().alias("b")).distinct().collect()]

    def _renamed(self, rows: DataFrame) -> DataFrame:
        return rows.select(*[F.col(k).alias(f"__{k}") for k in self.keys]).distinct()

    def _same(self) -> Column:
        out = F.lit(True)
        for k in self.keys:
            out = out & F.col(k).eqNullSafe(F.col(f"__{k}"))
        return out

    def _write(self, rows: DataFrame, touched: Sequence[int], base: int) -> int:
        """Write ``rows`` as the new contents of the touched buckets; the new version."""
        folder = f"{self.path}/data/{base + 1}-{uuid.uuid4().hex[:12]}"
        rows.withColumn(BUCKET, self.bucket()).write.partitionBy(BUCKET).parquet(folder)
        try:
            held = {r[0] for r in self.spark.read.parquet(folder).select(BUCKET).distinct().collect()}
        except AnalysisException:  # nothing was written: all touched buckets became empty
            held = set()
        return self._commit([(b, f"{folder}/{BUCKET}={b}" if b in held else None) for b in sorted(touched)], base)

    def _commit(self, buckets: list[tuple[int, str | None]], base: int) -> int:
        now = self.version()
        if now != base:
            raise ConflictError(f"{self.path}: version {now} was written while a change of version {base} was prepared")
        # one file: the version appears whole. A change that touches nothing counts as well (bucket -1).
        rows = [(base + 1, b, f) for b, f in buckets] or [(base + 1, -1, None)]
        self.spark.createDataFrame(rows, MANIFEST).coalesce(1).write.mode("append").parquet(f"{self.path}/manifest")
        return base + 1

    def overwrite(self, rows: DataFrame, order_by: Sequence[str] = ()) -> int:
        """Replace all rows. Of several rows of a key the last by ``order_by`` stays."""
        return self._write(dedupe(rows, self.keys, order_by, "last"), range(self.buckets), self.version())

    def upsert(self, rows: DataFrame, order_by: Sequence[str] = ()) -> int:
        """Insert rows, or replace those of the same key. Columns that either side
        lacks are NULL there. Returns the new version."""
        base = self.version()
        new = dedupe(rows, self.keys, order_by, "last")
        touched = self._touched(new)
        old = self._load(self._folders(base, touched))
        if old is not None:
            new = old.join(self._renamed(new), self._same(), "left_anti").unionByName(new, allowMissingColumns=True)
        return self._write(new, touched, base)

    def delete(self, keys: DataFrame) -> int:
        """Delete the rows of the given keys. Returns the new version."""
        base = self.version()
        touched = self._touched(keys)
        old = self._load(self._folders(base, touched))
        if old is None:
            return self._commit([], base)
        return self._write(old.join(self._renamed(keys), self._same(), "left_anti"), touched, base)
