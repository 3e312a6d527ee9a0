"""Helpers that the operators of this package share."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import re
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space of the word rule ``[^\x20\x09-\x0D]+``; bytes.split() uses the same six.
SPACES = " \t\n\x0b\x0c\r"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Unset, a local session gets one here; a cluster has to name it."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    held = spark.sparkContext._jsc.sc().getCheckpointDir()
    if held.isDefined():
        return held.get().rstrip("/")
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise ValueError("spark.checkpoint.dir is unset; it has to name a folder that driver and executors share")
    spark.sparkContext.setCheckpointDir("file://" + tempfile.mkdtemp(prefix="shared-"))
    return spark.sparkContext._jsc.sc().getCheckpointDir().get().rstrip("/")


def work_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Tables written within each open ``scratch`` block.
_SCRATCH: contextvars.ContextVar[list[DataFrame] | None] = contextvars.ContextVar("scratch", default=None)
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Bytes of an Arrow batch; rows alone are no bound where texts are long.
BATCH_BYTES = ("spark.sql.execution.arrow.maxBytesPerBatch", str(4 << 20))


def bound_batches(spark: SparkSession) -> None:
    """Bound the batches that go to Python workers by bytes, unless the session has a bound of its own."""
    if spark.conf.get(BATCH_BYTES[0], None) is None:
        spark.conf.set(*BATCH_BYTES)


def written(df: DataFrame, name: str, lasting: bool = False) -> DataFrame:
    """Write df as Parquet in the shared folder and read it back: cuts the lineage, survives lost executors.

    The shuffle files of the write go as soon as it is done; the table itself goes with ``discard``, or with the ``scratch``
    block around unless it is ``lasting``.
    """
    spark = df.sparkSession
    bound_batches(spark)
    path = work_path(spark, name)
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.unset(CLEANUP) if before is None else spark.conf.set(CLEANUP, before)
    out = spark.read.schema(df.schema).parquet(path)
    out._written_to = path
    if (held := _SCRATCH.get()) is not None and not lasting:
        held.append(out)
    return out


def discard(*tables: DataFrame) -> None:
    """Delete tables of ``written`` whose readers are all written themselves."""
    for df in tables:
        if path := df.__dict__.pop("_written_to", None):
            where = df.sparkSession._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(df.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


@contextlib.contextmanager
def scratch() -> Iterator[None]:
    """What is written within goes at the end, so nothing read from it may be left unwritten."""
    token = _SCRATCH.set([])
    try:
        yield
    finally:
        discard(*_SCRATCH.get())
        _SCRATCH.reset(token)


def release() -> None:
    """Give back to the system what a Python worker's earlier tasks have freed: workers are used again by later stages, and the C library
    and Arrow keep freed memory for themselves."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def spread(df: DataFrame) -> DataFrame:
    """Deal rows out evenly if there are fewer input partitions than task slots."""
    bound_batches(df.sparkSession)
    slots = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(slots) if df.rdd.getNumPartitions() < slots // 2 else df


def byte_batches(batch: pa.RecordBatch, column: str, most: int = 1 << 20):
    """Slices of a batch whose texts have about ``most`` bytes together; a longer text is a slice of its own, without empty ones.

    Yields (first row, one past the last row).
    """
    lengths = np.asarray(pc.fill_null(pc.binary_length(batch.column(column)), 0))
    start, held = 0, 0
    for i, n in enumerate(lengths.tolist()):
        if i > start and held + n > most:
            yield start, i
            start, held = i, 0
        held += n
    if start < len(lengths):
        yield start, len(lengths)


def utf8_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null counts as empty."""
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    off = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[off[0] : off[-1]] if len(off) else whole[:0], off - off[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash (SplitMix64 constants), element by element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def binned_quantile(df: DataFrame, keys: list[str], value: str, share: float, out: str) -> DataFrame:
    """Per key, the smallest integer ``value`` whose cumulated count reaches ``share`` of the rows.

    Counts are pre-aggregated per (key, value), so no group of rows is gathered; a key keeps one row per distinct
    value, which the caller bounds by binning.
    """
    counts = df.groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    pairs = F.array_sort(F.collect_list(F.struct(F.col(value).alias("v"), F.col("_n").alias("n"))))
    folded = F.aggregate(
        "_pairs",
        F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast(df.schema[value].dataType).alias("at")),
        lambda acc, x: F.struct(
            (acc["seen"] + x["n"]).alias("seen"),
            F.when(acc["at"].isNull() & (acc["seen"] + x["n"] >= F.col("_need")), x["v"]).otherwise(acc["at"]).alias("at"),
        ),
        lambda acc: acc["at"],
    )
    return (
        counts.groupBy(*keys)
        .agg(pairs.alias("_pairs"), F.ceil(F.sum("_n") * share).alias("_need"))
        .select(*keys, folded.alias(out))
    )
