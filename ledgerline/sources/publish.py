"""Several outputs that appear together.

A run writes each of its outputs to a folder of its own and, when all are
complete, replaces one small marker file that names the run in force.  The
marker is renamed into place in one step, so a reader sees either every output
of the earlier run or every output of the new one; a run that fails leaves the
earlier outputs in force and removes what it had written.

    folder/_current            JSON: the run in force and its output names
    folder/run-<token>/<name>  one header CSV folder per output
"""

from __future__ import annotations

import json
import os
import posixpath

from pyspark.sql import DataFrame, SparkSession

from ledgerline.sources import sinks

MARKER = "_current"


def publish(spark: SparkSession, folder: str, outputs: dict[str, DataFrame]) -> dict[str, str]:
    """Write every output as header CSV and put them in force together;
    returns {output: its folder}."""
    run = f"run-{os.urandom(6).hex()}"
    home = posixpath.join(folder, run)
    try:
        paths = {name: sinks.write_csv(df, posixpath.join(home, name)) for name, df in outputs.items()}
        _replace_marker(spark, folder, json.dumps({"run": run, "outputs": list(outputs)}))
    except BaseException:
        _delete(spark, home)
        raise
    return paths


def published(spark: SparkSession, folder: str) -> dict[str, str]:
    """{output: its folder} of the run in force; empty before the first."""
    jvm, fs, marker = _at(spark, posixpath.join(folder, MARKER))
    if not fs.exists(marker):
        return {}
    stream = fs.open(marker)
    try:
        now = json.loads(bytes(stream.readAllBytes()).decode("utf-8"))
    finally:
        stream.close()
    return {name: posixpath.join(folder, now["run"], name) for name in now["outputs"]}


def drop_earlier_runs(spark: SparkSession, folder: str) -> int:
    """Delete the runs that are not in force, and return how many.  For a
    time when neither a writer nor a reader of an earlier run is at work."""
    in_force = {posixpath.basename(posixpath.dirname(p)) for p in published(spark, folder).values()}
    if not in_force:
        return 0
    _, fs, base = _at(spark, folder)
    old = [st.getPath() for st in fs.listStatus(base)
           if st.isDirectory() and st.getPath().getName().startswith("run-")
           and st.getPath().getName() not in in_force]
    for path in old:
        fs.delete(path, True)
    return len(old)


def _at(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    hp = jvm.org.apache.hadoop.fs.Path(path)
    return jvm, hp.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hp


def _delete(spark: SparkSession, path: str) -> None:
    _, fs, hp = _at(spark, path)
    fs.delete(hp, True)


def _replace_marker(spark: SparkSession, folder: str, text: str) -> None:
    """Write the marker under a name of its own, then rename it over the old
    one (atomic on HDFS and local disks)."""
    jvm, fs, target = _at(spark, posixpath.join(folder, MARKER))
    fresh = jvm.org.apache.hadoop.fs.Path(posixpath.join(folder, f"{MARKER}.{os.urandom(6).hex()}"))
    out = fs.create(fresh, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()
    options = jvm.org.apache.hadoop.fs.Options.Rename
    over = spark.sparkContext._gateway.new_array(options, 1)
    over[0] = options.OVERWRITE
    target, fresh = fs.makeQualified(target), fs.makeQualified(fresh)
    jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()).rename(fresh, target, over)
