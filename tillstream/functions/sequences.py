"""Sequences that go on from run to run: ranges of numbers reserved in a folder kept with the table.

Each reservation is one small file named by its first number, made by a create that fails where the file is
there: of two runs that want one range, one gets it and the other looks again. Numbers of a run that died
stay reserved, so there may be gaps, but no number is given twice. That takes a file system whose create
without overwrite is exclusive, as HDFS's is. Hadoop's local one is not, so there only the runs of one
driver, which take turns, are kept apart.
"""

from __future__ import annotations

import json
import threading
import time
from collections.abc import Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.functions.ids import assign_sequence, business_id
from tillstream.session import settle

_DIGITS = 20
_TURN = threading.Lock()
RESERVATION = "run string, first long, size long"


def reservations(spark: SparkSession, folder: str) -> DataFrame:
    """(run, first, size) of all ranges given so far; run and size are null while one is being written."""
    root = spark._jvm.org.apache.hadoop.fs.Path(folder)
    if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
        return spark.createDataFrame([], RESERVATION)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "0*").load(folder)
    return files.select(F.from_json(F.decode("content", "UTF-8"), RESERVATION).alias("held"), "path").select(
        "held.run", F.regexp_extract("path", r"(\d+)$", 1).cast("long").alias("first"), "held.size")


def reserve(spark: SparkSession, folder: str, run: str, size: int, start: int = 1, patience: float = 60) -> int:
    """First number of a range of ``size`` numbers that is ``run``'s own, above all given so far and not
    below ``start``. The same run with the same size gets its range again; another size is refused.

    How long a range is that another run is just writing is not known: it is waited for. If it stays so for
    ``patience`` seconds, its run has died there, and its file must be deleted by hand.
    """
    if size < 0 or start < 0:
        raise ValueError("a range has no negative size or start")
    with _TURN:
        return _reserve(spark, folder, run, size, start, time.monotonic() + patience)


def _reserve(spark: SparkSession, folder: str, run: str, size: int, start: int, deadline: float) -> int:
    own = F.col("run") == run
    while True:
        failure = None
        try:
            seen = reservations(spark, folder).agg(
                F.count_if(F.col("size").isNull()).alias("writing"),
                F.max(F.col("first") + F.greatest("size", F.lit(1))).alias("top"),
                F.max(F.when(own, F.col("first"))).alias("first"), F.max(F.when(own, F.col("size"))).alias("size")
            ).first()
            if seen["first"] is not None:
                if seen["size"] != size:
                    raise ValueError(f"run {run} holds {seen['size']} numbers, not {size}")
                return seen["first"]
            first = max(start, seen["top"] or 0)
            if not seen["writing"] and _take(spark, f"{folder}/{first:0{_DIGITS}d}", {
                    "run": run, "first": first, "size": size}):
                return first
        except Py4JJavaError as exc:         # a file that grows while it is read
            failure = exc
        # Another run holds the range, and may not have said yet how long it is.
        if time.monotonic() > deadline:
            raise RuntimeError(f"unfinished reservation in {folder}") from failure
        time.sleep(0.2)


def _take(spark: SparkSession, path: str, content: dict) -> bool:
    """Write a file that is not there yet; False if it is."""
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = at.getFileSystem(spark._jsc.hadoopConfiguration())
    try:
        out = fs.create(at, False)
    except Py4JJavaError:
        if fs.exists(at):
            return False
        raise
    try:
        out.write(bytearray(json.dumps(content).encode()))
    finally:
        out.close()
    return True


def continue_sequence(df: DataFrame, column: str, order_by: Sequence[str], folder: str, run: str,
                      start: int = 1) -> DataFrame:
    """Number the rows in the order of ``order_by`` from where the sequence in ``folder`` stands.

    A run that is repeated on the same rows gets the same numbers, provided that ``order_by`` leaves no two
    different rows equal. No rows take no number; null order columns come first.
    """
    rows = settle(df, "numbered")
    first = reserve(df.sparkSession, folder, run, rows.count(), start)
    return assign_sequence(rows, column, order_by, first)


def continue_business_id(df: DataFrame, column: str, prefix: str, width: int, order_by: Sequence[str], folder: str,
                         run: str, start: int = 1) -> DataFrame:
    numbered = continue_sequence(df, "_number", order_by, folder, run, start)
    return numbered.withColumn(column, business_id(prefix, width, F.col("_number"))).drop("_number")
