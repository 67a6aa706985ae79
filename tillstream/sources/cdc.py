"""Change-message sources: a broker topic, or a folder of JSON lines. Column: ``value``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def _kafka(reader, source: dict, defaults: dict) -> DataFrame:
    return reader.format("kafka").options(**{**defaults, **source}).load()


def cdc_stream(spark: SparkSession, source: str | dict, max_files: int | None = None) -> DataFrame:
    """Unbounded messages from the earliest offset on.

    ``source`` is a folder, or Kafka options such as ``kafka.bootstrap.servers`` and
    ``subscribe`` (needs the Kafka connector on the class path).
    """
    if isinstance(source, dict):
        return _kafka(spark.readStream, source, {"startingOffsets": "earliest"})
    reader = spark.readStream
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.text(source)


def cdc_batch(spark: SparkSession, source: str | dict) -> DataFrame:
    """The same messages as a bounded frame, earliest to latest."""
    if isinstance(source, dict):
        return _kafka(spark.read, source,
                      {"startingOffsets": "earliest", "endingOffsets": "latest"})
    return spark.read.text(source)
