"""JSON message streams; text that is not JSON passes through unchanged."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def message_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """One row per line of the files that arrive below ``path``."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(path)


def parse_messages(df: DataFrame, column: str = "value") -> DataFrame:
    """Add ``message`` (variant, null when unparsable) and ``text`` (raw form otherwise).

    Works on a batch frame and on a stream, whatever the source.
    """
    parsed = F.try_parse_json(F.col(column))
    return df.withColumn("message", parsed).withColumn(
        "text", F.when(F.col("message").isNull(), F.col(column))
    )
