"""Incremental extracts that catch rows committed late, with their state kept between runs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.operators.joins import lookup_join

MARKS = "newest timestamp, run int"


def extract_overlap(df: DataFrame, ts: str, folder: str, run: int, overlap: str = "1 day") -> DataFrame:
    """Rows of ``df`` that no earlier run has extracted, written to ``folder``/rows/run=N and returned.

    A run reads what is newer than the newest time of the runs before it, less ``overlap``, and leaves out
    rows that an earlier run has, by a hash of the whole row. So a row whose commit came late is found
    as long as its time is within the overlap; a row that has changed is extracted again. Rows without a time
    are looked at in every run. Equal rows are extracted once. Run numbers count up from 0; a run that is
    repeated replaces its rows and its mark and sees only the runs before it. The first run takes all rows.
    No column may be called ``_hash`` or ``run``.
    """
    spark = df.sparkSession
    # As JSON, a null differs from an empty text, and no value can pass for two.
    hashed = df.withColumn("_hash", F.sha2(F.to_json(F.struct(*df.columns)), 256))
    at, rows, marks = F.col(ts), f"{folder}/rows", f"{folder}/marks"
    newest = None
    if run > 0:
        newest = spark.read.schema(MARKS).parquet(marks).filter(F.col("run") < run).agg(F.max("newest")).first()[0]
        since = F.lit(newest) - F.expr(f"interval {overlap}")
        recent = (at > since) | at.isNull() if newest is not None else F.lit(True)
        known = (spark.read.schema(hashed.withColumn("run", F.lit(run)).schema).parquet(rows)
                 .filter((F.col("run") < run) & recent).select("_hash").distinct())
        hashed = lookup_join(hashed.filter(recent), known, "_hash", "left_anti")
    hashed.dropDuplicates(["_hash"]).write.mode("overwrite").parquet(f"{rows}/run={run}")
    made = spark.read.schema(hashed.schema).parquet(f"{rows}/run={run}")
    (made.agg(F.greatest(F.max(ts), F.lit(newest).cast("timestamp")).alias("newest"))
     .write.mode("overwrite").parquet(f"{marks}/run={run}"))
    return made.drop("_hash")
