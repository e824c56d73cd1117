"""What the operators share: table access, durable intermediates and labelled samples."""

from __future__ import annotations

import atexit
import contextlib
import contextvars
import ctypes
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Rows and bytes of text in a training sample for each class, at most; a text of more than a sixteenth
#: of these bytes isn't learnt from.
SAMPLE_PER_CLASS = 4000
SAMPLE_BYTES = 32_000_000
#: Bytes of a batch that a Python worker gets at once, but for a single row of more, unless the session says otherwise.
BATCH_BYTES = 4_000_000
#: Rows that the parquet reader decodes at once, where a query asks for that: Spark's 4,096 are 13 MB of documents in one array.
READ_ROWS = 256


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    bounded(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded(spark: SparkSession) -> None:
    """Bound the session's Arrow batches by BATCH_BYTES where it has no bound of its own.

    Spark's default counts rows only: 10,000 texts of any length, held in the JVM and in a worker at once.
    """
    setting = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(setting, None) is None:
        spark.conf.set(setting, BATCH_BYTES)


def read_in_small_batches(spark: SparkSession) -> None:
    """Let the session's parquet reader decode READ_ROWS rows at once where it has no number of its own.

    Arrays of many MB go past the JVM's young generation, so its heap grows to the whole of what it may have.
    The setting stays in the session.
    """
    setting = "spark.sql.parquet.columnarReaderBatchSize"
    if spark.conf.get(setting, None) is None:
        spark.conf.set(setting, READ_ROWS)


def shared_dir(spark: SparkSession) -> str:
    """The folder that the driver and all executors see (spark.checkpoint.dir).

    A folder of its own is made only where the setting is absent, which is the case on one machine.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        found = f"file://{tempfile.mkdtemp(prefix='weftline-')}"
        spark.conf.set("spark.checkpoint.dir", found)
    return found.rstrip("/")


#: The durable tables made in the innermost `collecting` block of this thread, or None outside of any.
_made: contextvars.ContextVar[list[str] | None] = contextvars.ContextVar("made", default=None)


@contextlib.contextmanager
def collecting() -> Iterator[list[str]]:
    """The paths of the durable tables made inside the block, in order; blocks of other threads have their own."""
    paths: list[str] = []
    token = _made.set(paths)
    try:
        yield paths
    finally:
        _made.reset(token)


def release(spark: SparkSession, paths: list[str]) -> None:
    """Remove durable tables that nothing reads any more."""
    for path in paths:
        _remove(spark, path)


def durable(df: DataFrame, label: str) -> DataFrame:
    """Write `df` as a table in the shared folder and read it back.

    Lineage ends there: a lost executor costs the tasks that read the files, not the plan before
    them, and rows keep the values they had when written. The files go when the session ends.
    """
    spark = df.sparkSession
    bounded(spark)
    path = f"{shared_dir(spark)}/weftline/{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    paths = _made.get()
    if paths is not None:
        paths.append(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        where = jvm.org.apache.hadoop.fs.Path(path)
        where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)
    except Exception:  # the session may be gone
        return


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores before them where `df` has such a column (Spark ignores case)."""
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name = "_" + name
        taken.add(name.lower())
        out.append(name)
    return out


def slices(batches: Iterator[pa.RecordBatch], rows: int = 1000) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of so many rows, which is what a worker holds as Python objects at once."""
    for batch in handed_back(batches):
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def handed_back(batches: Iterator) -> Iterator:
    """The batches; at the end of each task the memory that its worker has freed goes back to the machine.

    Workers live on between tasks, and what their allocators keep counts as the executor's.
    """
    try:
        yield from batches
    finally:
        pa.default_memory_pool().release_unused()
        with contextlib.suppress(OSError, AttributeError):  # only where the C library can
            ctypes.CDLL(None).malloc_trim(0)


def held_out(doc_id="doc_id"):
    """True for one fifth of the ids: crc32 of the id as text is a multiple of five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 5 == 0, F.lit(False))


def labelled_sample(docs: DataFrame, labels: DataFrame, target: str, per_class: int = SAMPLE_PER_CLASS, most_bytes: int = SAMPLE_BYTES) -> DataFrame:
    """(doc_id, text, y) of at most `per_class` rows and `most_bytes` of text for each class, none held out.

    Ids are taken in the order of a hash, so the sample is the same at every run. Rows without an id
    or without the label take no part; several labels of one id count as their maximum, and of several
    rows of one id the shortest text counts (the smallest of these). An empty table gives no rows.
    """
    known = (
        labels.where(F.col("doc_id").isNotNull() & F.col(target).isNotNull() & ~held_out())
        .groupBy("doc_id").agg(F.max(target).cast("int").alias("y"))
    )
    order = F.xxhash64(F.col("doc_id"), F.lit(target))
    ids = None
    for y in (0, 1):
        part = known.where(F.col("y") == y).orderBy(order, "doc_id").limit(per_class)
        ids = part if ids is None else ids.unionByName(part)
    text = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    found = text.join(F.broadcast(ids), "doc_id")  # two times per_class ids at most
    sized = F.struct(F.octet_length("text").cast("long").alias("bytes"), F.col("text"))
    one = found.groupBy("doc_id").agg(F.min("y").alias("y"), F.min(sized).alias("t")).select("doc_id", "y", "t.bytes", "t.text")
    one = durable(one.where(F.col("bytes") <= most_bytes // 16), f"sample-{target}")
    upto = F.sum("bytes").over(Window.partitionBy("y").orderBy(order, "doc_id"))  # per_class rows at most
    kept = one.select("doc_id", "y", upto.alias("upto")).where(F.col("upto") <= most_bytes).select("doc_id", "y")
    return one.select("doc_id", "text").join(F.broadcast(kept), "doc_id")
