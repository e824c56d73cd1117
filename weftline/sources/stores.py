"""Stores and sinks: an index and its annotations as versioned parquet tables, and append-only outputs."""

from __future__ import annotations

from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from weftline.functions import urls as u
from weftline.operators import index as ix
from weftline.scratch import scratch  # noqa: F401
from weftline.sources.readers import URL_RECORD, done_urls


class ParquetStore:
    """`urls` and `annotations`; each change writes a new version, so a reader never sees half a change.

    Rows of `urls` are laid out by `Confirmed`, and keyed by `_id`, the hash of the url.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root, self._urls, self._notes, self._version = spark, root.rstrip("/"), None, None, 0

    def _write(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        self._version += 1
        path = f"{self.root}/{name}/v{self._version:06d}"
        writer = df.write.mode("errorifexists")
        (writer.partitionBy(by) if by else writer).parquet(path)
        return self.spark.read.parquet(path)

    def urls(self) -> DataFrame:
        return self.spark.createDataFrame([], URL_RECORD) if self._urls is None else self._urls.drop("_id")

    def upsert(self, batch: DataFrame, present: tuple[str, ...] = ("namespace", "page_template_type"), last_only: bool = False) -> dict[str, int]:
        """Merge a batch (seq, url, ...) and count what was added and updated."""
        merged = ix.merge(self.urls(), batch, present, last_only).persist()
        try:
            stats = ix.merge_stats(merged).first()
            rows = merged.drop("batch_rows", "existed").withColumn("_id", u.document_id(F.col("url")))
            self._urls = self._write(rows, "urls", "Confirmed")
            return {"added": stats["added"] or 0, "updated": stats["updated"] or 0}
        finally:
            merged.unpersist()

    def pending(self, only_confirmed: bool = True, force: bool = False) -> DataFrame:
        return ix.pending(self.urls(), self.annotated(), only_confirmed, force)

    def annotated(self) -> DataFrame | None:
        return None if self._notes is None else self._notes.select("url").distinct()

    def save_annotations(self, docs: DataFrame) -> None:
        """Replace documents by key and stamp their urls; a url that isn't known stays unknown."""
        self._notes = self._write(docs if self._notes is None else ix.replace_by(self._notes, docs, "_id"), "annotations")
        if self._urls is not None:
            stamped = ix.stamp(self.urls(), docs).withColumn("_id", u.document_id(F.col("url")))
            self._urls = self._write(stamped, "urls", "Confirmed")

    def count(self) -> int:
        return self.urls().count()

    def assert_unique(self) -> None:
        if not self.urls().groupBy("url").count().where("count > 1").isEmpty():
            raise ValueError("a url has several rows")


def append_json(docs: DataFrame, path: str) -> None:
    """Documents as JSON lines beside what is there; a failed write leaves nothing behind."""
    docs.write.mode("append").json(path)


def write_index(index: DataFrame, path: str) -> None:
    """The index as JSON lines in the order of (namespace, url), range-partitioned, for any size."""
    index.orderBy(F.coalesce("namespace", F.lit("")), "url").write.mode("overwrite").json(path)


#: Rows that a store in memory holds, at most.
MEMORY_ROWS = 100_000


class MemoryStore(ParquetStore):
    """The same store with its tables on the driver, for trials and tests; more than MEMORY_ROWS rows raise."""

    def __init__(self, spark: SparkSession):
        super().__init__(spark, "")

    def _write(self, df: DataFrame, name: str, by: str | None = None) -> DataFrame:
        rows = df.limit(MEMORY_ROWS + 1).collect()
        if len(rows) > MEMORY_ROWS:
            raise ValueError(f"more than {MEMORY_ROWS} rows for a store in memory")
        return self.spark.createDataFrame(rows, df.schema)


class Sink(Protocol):
    """Where documents of a run go."""

    def done(self) -> DataFrame | None:
        """(url) of documents that are there already, None without any."""

    def write(self, docs: DataFrame) -> None:
        """Add documents."""


class JsonSink:
    """Documents as JSON lines in a folder."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path

    def done(self) -> DataFrame | None:
        where = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(self.path)
        if not where.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).exists(where):
            return None
        return done_urls(self.spark, self.path)

    def write(self, docs: DataFrame) -> None:
        append_json(docs, self.path)


class StoreSink:
    """Documents in a store, which also stamps their urls."""

    def __init__(self, store: ParquetStore):
        self.store = store

    def done(self) -> DataFrame | None:
        return self.store.annotated()

    def write(self, docs: DataFrame) -> None:
        self.store.save_annotations(docs)
