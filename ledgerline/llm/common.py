"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import contextlib
import ctypes
import os
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.session import scratch_path

# Arrow batches handed to Python are bounded in bytes, not only in rows: a
# batch of very long texts stays small.
BATCH_BYTES = "8m"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def map_arrow(df: DataFrame, fn: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]],
              schema: str) -> DataFrame:
    """``mapInArrow`` with byte-bounded input batches; a task gives its
    memory back when it ends, since its worker goes on to other operators."""
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from fn(batches)
        finally:
            give_back_memory()

    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
    return df.mapInArrow(task, schema)


def give_back_memory() -> None:
    """Return freed memory of Arrow's pool and of the C heap to the system."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):       # not the GNU C library
        pass


def free_finished_shuffles(spark: SparkSession) -> None:
    """Let the driver collect its garbage, upon which Spark deletes the
    shuffle files of plans that nobody holds any more.  Spark does so by itself
    now and then; a job with several large shuffles need not wait for it."""
    spark.sparkContext._jvm.System.gc()


def give_back_driver_memory(spark: SparkSession) -> None:
    """``free_finished_shuffles``, and return to the system what the driver's
    JVM and its Python have freed of their C heaps.  Planning job after job
    leaves much there (the JVM's compiler above all), and neither gives it back
    by itself.  A JVM without that command keeps it."""
    free_finished_shuffles(spark)
    jvm, gateway = spark.sparkContext._jvm, spark.sparkContext._gateway
    server = jvm.java.lang.management.ManagementFactory.getPlatformMBeanServer()
    # the server's class is closed to py4j, its interface is not
    methods = jvm.java.lang.Class.forName("javax.management.MBeanServer").getMethods()
    args = gateway.new_array(jvm.java.lang.Object, 4)
    args[0], args[1] = jvm.javax.management.ObjectName("com.sun.management:type=DiagnosticCommand"), "systemTrimNativeHeap"
    with contextlib.suppress(Py4JJavaError):
        next(m for m in methods if m.getName() == "invoke").invoke(server, args)
    give_back_memory()


def saved(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared scratch folder and read it back: the
    lineage is cut there, so a lost executor re-reads files instead of
    repeating the work above."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def held_out(doc_id, modulus: int, remainder: int):
    """crc32 of the id's decimal text, mod ``modulus``, equals ``remainder``;
    NULL ids are held out of nothing."""
    crc = F.crc32(F.col(doc_id).cast("string").cast("binary"))
    return F.coalesce(F.pmod(crc, F.lit(modulus)) == F.lit(remainder), F.lit(False))


def shuffle_partitions(spark: SparkSession) -> int:
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def batch_of(schema: pa.Schema, **cols: Iterable) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, (pa.Array, pa.ChunkedArray)) else pa.array(c, type=schema.field(n).type)
         for n, c in cols.items()], schema=schema)


def texts_of(batch: pa.RecordBatch, name: str = "text") -> list[str]:
    """The column's strings; NULL is the empty string."""
    return ["" if t is None else t for t in batch.column(name).to_pylist()]


def filesystem(uri: str):
    """(pyarrow filesystem, path) of a folder in the shared store.  Plain
    paths and ``file:`` are local mounts; ``hdfs:``, ``s3:`` and ``gs:`` go
    through pyarrow's own clients."""
    from pyarrow import fs
    if uri.startswith("file:"):
        return fs.LocalFileSystem(), "/" + uri[len("file:"):].lstrip("/")
    if uri.startswith("/"):
        return fs.LocalFileSystem(), uri
    return fs.FileSystem.from_uri(uri)


def publish(folder: str, name: str, parts: Iterable[bytes]) -> None:
    """Write one file under ``folder`` atomically: the bytes go to a name of
    this attempt's own and are renamed when complete, so a retried or
    speculative task replaces the file with the same content."""
    fs, base = filesystem(folder)
    fs.create_dir(base, recursive=True)
    tmp = f"{base}/_{name}.{os.urandom(6).hex()}"
    with fs.open_output_stream(tmp) as out:
        for p in parts:
            out.write(p)
    fs.move(tmp, f"{base}/{name}")


