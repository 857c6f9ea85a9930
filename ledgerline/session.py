"""Session construction and the shared checkpoint folder."""

from __future__ import annotations

import contextlib
import os
import tempfile
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession

# Settings that matter for the plans this library builds.  AQE re-plans joins
# from runtime sizes (sort-merge -> broadcast only when the materialised side
# is measured small), coalesces small shuffle partitions and splits skewed
# join partitions.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # AQE merges small shuffle partitions up to this size; skew splitting
    # uses the same unit
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
}

# Shuffle sizing for a given input volume: about one initial shuffle
# partition per 256 MB of input (projections and partial aggregation shrink
# shuffle data well below the input), 200 at least; AQE then coalesces
# toward the advisory size, so over-provisioning costs little and spills stay rare.
INPUT_BYTES_PER_SHUFFLE_PARTITION = 256 * 1024 * 1024
MIN_SHUFFLE_PARTITIONS = 200


def shuffle_partitions_for(input_bytes: int) -> int:
    n = -(-int(input_bytes) // INPUT_BYTES_PER_SHUFFLE_PARTITION)
    return max(MIN_SHUFFLE_PARTITIONS, n)


def get_spark(master: str | None = None, app: str = "ledgerline",
              shuffle_partitions: int | None = None, input_bytes: int | None = None,
              **conf: str) -> SparkSession:
    """Build (or reuse) a session with the library defaults.  Give either
    ``shuffle_partitions`` or the expected ``input_bytes`` (e.g. ~100 TB on
    a cluster: 409,600 initial partitions, coalesced by AQE)."""
    if shuffle_partitions is None and input_bytes:
        shuffle_partitions = shuffle_partitions_for(input_bytes)
    b = SparkSession.builder.appName(app)
    if master:
        b = b.master(master)
        if master.startswith("local"):
            # a local session (tests, bench): keep Spark's default-database
            # folder out of the working directory; a cluster sets its own
            b = b.config("spark.sql.warehouse.dir",
                         tempfile.mkdtemp(prefix="ledgerline-warehouse-"))
    for k, v in DEFAULTS.items():
        b = b.config(k, v)
    if shuffle_partitions:
        b = b.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for k, v in conf.items():
        b = b.config(k.replace("__", "."), v)
    spark = b.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def input_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` reads, 0 if it reads none: one listing
    per folder that holds some of them."""
    spark = df.sparkSession
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    files, total = set(df.inputFiles()), 0
    for folder in sorted({f.rsplit("/", 1)[0] for f in files}):
        hp = jvm.org.apache.hadoop.fs.Path(jvm.java.net.URI(folder))
        total += sum(st.getLen() for st in hp.getFileSystem(conf).listStatus(hp)
                     if st.getPath().toUri().toString() in files)
    return total


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder for checkpoints and intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``; it is read from the
    session.  Where it is unset, a local session gets a fresh scratch folder
    and any other one is refused: a folder of one machine is not shared.
    """
    d = spark.conf.get("spark.checkpoint.dir", None)
    if not d:
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError(f"set spark.checkpoint.dir to a shared folder (master {master})")
        d = tempfile.mkdtemp(prefix="ledgerline-ckpt-")
        spark.conf.set("spark.checkpoint.dir", d)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path under the shared checkpoint folder, with its file system
    named: a plain path means the cluster's default one, also to code in a
    task that opens files by itself."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(checkpoint_dir(spark))
    fs = folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    base = fs.makeQualified(folder).toString().rstrip("/")
    token = os.urandom(6).hex()
    return f"{base}/ledgerline/{name}-{token}"


def materialise(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once to the shared checkpoint folder and read it back."""
    path = scratch_path(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch_table(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """``materialise`` for the length of a block: the table is deleted at its
    end, so what is built on it must be written inside the block."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    try:
        df.write.mode("overwrite").parquet(path)
        yield spark.read.schema(df.schema).parquet(path)
    finally:
        hp = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(hp, True)
