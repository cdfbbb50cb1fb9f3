"""Tables in buckets with a manifest per version: a change rewrites the buckets it touches, and readers keep their version.

Rows lie in buckets of the hash of some columns (``by``). Every write goes to a folder of its own; a
version is a small list of (bucket, folder). A change writes its buckets' new contents first and the new list last, as
one file, so it is there as a whole or not at all; folders of older versions stay as they are. One writer at a
time; a version that another writer has taken is an error.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from rankloom.scale import broadcast_if_small, cut_lineage
from rankloom.sources.store import dealt_by

#: Rows of a bucket that are aimed at, and buckets at most.
BUCKET_ROWS, MOST_BUCKETS = 1_000_000, 4096
#: Up to so many rows are dealt to their buckets by a shuffle, for fewer files; more are written where they are made.
DEALT_ROWS = 1_000_000
_MANIFEST = "bucket int, folder string, batch long"


@dataclass
class VersionedTable:
    """A table below ``path``; make one with ``create`` or ``open_table``."""

    spark: SparkSession
    path: str
    by: list[str]
    buckets: int
    schema: S.StructType

    # ------------------------------------------------------------------- reading
    def latest(self) -> int:
        return self.spark.read.parquet(f"{self.path}/manifest").agg(F.max("version")).first()[0]

    def manifest(self, version: int | None = None) -> list[tuple[int, str]]:
        """(bucket, folder) of a version, the newest if none is named."""
        version = self.latest() if version is None else version
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/version={version}")
        return sorted((r.bucket, r.folder) for r in rows.collect() if r.bucket is not None)

    def last_batch(self) -> int:
        """The number of the last stream batch that has been applied; -1 if there is none."""
        rows = self.spark.read.schema(_MANIFEST).parquet(f"{self.path}/manifest/version={self.latest()}")
        found = rows.agg(F.max("batch")).first()[0]
        return -1 if found is None else found

    def rows(self, version: int | None = None, buckets: Sequence[int] | None = None) -> DataFrame:
        """The rows of a version, or of some of its buckets; other folders are not read."""
        entries = self.manifest(version)
        folders = [folder for bucket, folder in entries if buckets is None or bucket in set(buckets)]
        return self._of(folders)

    def _of(self, folders: Sequence[str]) -> DataFrame:
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*[f"{self.path}/data/{folder}" for folder in folders])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.by), F.lit(self.buckets)).cast("int")

    def touched_by(self, changes: DataFrame) -> list[int]:
        return sorted(r[0] for r in changes.select(self.bucket()).distinct().collect())  # at most MOST_BUCKETS

    # ------------------------------------------------------------------- writing
    def _write(self, rows: DataFrame, about: int) -> list[tuple[int, str]]:
        """Writes ``about`` so many rows."""
        folder = uuid.uuid4().hex
        path = f"{self.path}/data/{folder}"
        named = rows.select(*self.schema.names).withColumn("bucket", self.bucket())
        if about <= DEALT_ROWS:
            named, held = dealt_by(named, ["bucket"])
            named.write.partitionBy("bucket").parquet(path)
        else:
            named.write.option("compression", "zstd").partitionBy("bucket").parquet(path)
            held = self.spark.read.schema("bucket int").parquet(path).distinct().collect()  # at most MOST_BUCKETS
        return [(bucket, f"{folder}/bucket={bucket}") for (bucket,) in held]

    def _switch(self, version: int, entries: Sequence[tuple[int, str]], batch: int | None) -> int:
        rows = [(b, f, batch) for b, f in entries] or [(None, None, batch)]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.parquet(f"{self.path}/manifest/version={version}")
        return version

    def rewrite(
        self, touched: DataFrame, change: Callable[[DataFrame], DataFrame], base: int | None = None, batch: int | None = None
    ) -> int:
        """A new version of ``base`` in which the buckets of the rows ``touched`` (by) hold ``change`` of their rows.

        ``change`` must only make rows of these buckets. Returns the version; the others stay readable.
        """
        newest = self.latest()
        entries = self.manifest(newest if base is None else base)
        buckets = set(self.touched_by(touched))
        current = self._of([folder for bucket, folder in entries if bucket in buckets])
        written = self._write(change(current), current.count() + touched.count()) if buckets else []
        return self._switch(newest + 1, [e for e in entries if e[0] not in buckets] + written, batch)

    def append_new(self, rows: DataFrame, key: Sequence[str], batch: int | None = None) -> int:
        """Add the rows whose key the table doesn't have (one of each, if several come); returns how many.

        Only the keys of the buckets concerned are read, and nothing stored is written again. Without new rows there is
        no new version.
        """
        key, newest = list(key), self.latest()
        entries = self.manifest(newest)
        buckets = set(self.touched_by(rows))
        known = self._of([folder for bucket, folder in entries if bucket in buckets]).select(*key)
        # keys alone are compared; whole rows are only moved where they are new
        missing = cut_lineage(rows.select(*key).distinct().join(known, key, "left_anti"))
        n = missing.count()
        if n:
            missing = broadcast_if_small(missing.toDF(*[f"_{c}" for c in key]))
            fresh = rows.join(missing, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in key], "left_semi").dropDuplicates(key)
            self._switch(newest + 1, entries + self._write(cut_lineage(fresh), n), batch)
        return n


def create(df: DataFrame, by: Sequence[str], path: str, buckets: int | None = None) -> VersionedTable:
    """Write ``df`` as version 0; the number of buckets follows the number of rows unless it is given."""
    spark = df.sparkSession
    n = df.count()
    if buckets is None:
        buckets = min(MOST_BUCKETS, max(8, -(-n // BUCKET_ROWS)))
    table = VersionedTable(spark, path, list(by), buckets, df.schema)
    about = spark.createDataFrame([(list(by), buckets, df.schema.json())], "by array<string>, buckets int, schema string")
    about.coalesce(1).write.parquet(f"{path}/about")
    table._switch(0, table._write(df, n), None)
    return table


def open_table(spark: SparkSession, path: str) -> VersionedTable:
    about = spark.read.parquet(f"{path}/about").first()
    return VersionedTable(spark, path, list(about.by), about.buckets, S._parse_datatype_json_string(about.schema))
