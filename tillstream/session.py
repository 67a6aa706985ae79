"""Session settings, and the shared folders a job may write intermediate data to."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# Runtime SQL settings every operator here relies on.
RUNTIME_CONF = {
    # Hashes are taken over timestamps as text, so the zone must be fixed.
    "spark.sql.session.timeZone": "UTC",
    # Zone-free Parquet times are read as instants (in UTC), so that filters still reach the scan.
    "spark.sql.parquet.inferTimestampNTZ.enabled": "false",
    # Written times keep min/max statistics, so that readers can skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    # Most rows end in a hash of 64 hexadecimal digits: only an entropy coder halves them.
    "spark.sql.parquet.compression.codec": "zstd",
    "spark.sql.adaptive.enabled": "true",
    # Shuffle files go as soon as their query is done, not when the driver collects its garbage.
    "spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true",
    # Split a hot join partition even if a later stage must shuffle again.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # Keep streaming state off the heap: dedup state grows with an hour of keys.
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    "spark.sql.streaming.stateStore.rocksdb.compression": "zstd",
    "spark.sql.streaming.stateStore.rocksdb.blockSizeKB": "32",
}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in RUNTIME_CONF.items():
        spark.conf.set(key, value)
    return spark


def build(app: str = "tillstream", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**RUNTIME_CONF, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def empty_frame(spark: SparkSession, schema: StructType) -> DataFrame:
    """No rows; known to be empty by the optimizer, which then drops joins with it."""
    return spark.range(1).filter(F.lit(False)).select(
        *[F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields])


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as named by ``spark.checkpoint.dir``.

    Only a local session, where every task runs on this machine, may fall back to a
    temporary folder; a cluster without the setting is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="tillstream-")
    spark.sparkContext.setCheckpointDir(folder)
    return folder


def run_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder for one run below the shared folder."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/{label}-{uuid.uuid4().hex[:12]}"


_settled: list[str] = []


def settle(df: DataFrame, label: str) -> DataFrame:
    """Compute ``df`` once into a table below the shared folder and read that.

    Cuts the lineage, fixes results that depend on sampling or arrival, and survives the loss
    of any executor. The table stays until :func:`discard`, as results may still read it.
    """
    path = run_dir(df.sparkSession, label)
    _settled.append(path)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder, wherever it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).delete(at, True)


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of what a folder holds; none if it is not there."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def replace_folder(spark: SparkSession, new: str, old: str) -> None:
    """Put the folder ``new`` in the place of ``old``, in the same file system."""
    at, to = (spark._jvm.org.apache.hadoop.fs.Path(p) for p in (new, old))
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    fs.delete(to, True)
    if not fs.rename(at, to):
        raise OSError(f"{new} could not be moved to {old}")


def discard(spark: SparkSession) -> int:
    """Delete all tables settled so far; call it when the results made of them are written."""
    paths = _settled[:]
    for path in paths:
        remove(spark, path)
        _settled.remove(path)
    return len(paths)
