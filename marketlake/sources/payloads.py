"""Landed API payloads: text files holding one JSON envelope each."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlake.session import remove_folder, shared_path


def landed_payloads(spark: SparkSession, path: str, per_file: bool = True) -> DataFrame:
    """Landed envelopes as ``payload`` and where they came from: one per file, or else one per line."""
    return (
        spark.read.text(path, wholetext=per_file)
        .select(F.col("value").alias("payload"), F.col("_metadata.file_path").alias("source_file"))
    )


def parse_payload(df: DataFrame, schema: str, column: str = "payload") -> DataFrame:
    """Parse the envelope and drop failed responses and those without data.

    The parsed body is generated rather than projected, so that it is computed
    once however many of its fields are used afterwards.
    """
    body = F.from_json(F.col(column), schema)
    parsed = df.select("*", F.explode(F.array(body)).alias("body"))
    usable = F.col("body.Data").isNotNull()
    if schema.startswith("Response "):
        usable &= ~F.col("body.Response").eqNullSafe("Error")
    return parsed.where(usable)


@contextmanager
def staged(parsed: DataFrame, label: str) -> Iterator[DataFrame]:
    """Write typed records once to the shared folder and give them back, for as many tables as are made of them.

    The text is parsed once; each table then reads only the fields it needs.
    The folder goes when the block ends.
    """
    spark, path = parsed.sparkSession, shared_path(parsed.sparkSession, f"staged-{label}")
    try:
        parsed.write.parquet(path)
        yield spark.read.schema(parsed.schema).parquet(path)
    finally:
        remove_folder(spark, path)


def payload_records(df: DataFrame, field: str = "body.Data", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per record of an array-valued payload, as column ``d``."""
    return df.select(*keep, F.explode(field).alias("d"))


def payload_entries(df: DataFrame, field: str = "body.Data", keep: tuple[str, ...] = ()) -> DataFrame:
    """One row per entry of a map-valued payload, as columns ``name`` and ``d``."""
    return df.select(*keep, F.explode(field).alias("name", "d"))


def is_complete(pages: DataFrame) -> DataFrame:
    """Compare the collected records of all pages with the announced total."""
    collected: Column = F.coalesce(F.sum(F.size("body.Data.LIST").cast("bigint")), F.lit(0))
    announced: Column = F.max("body.Data.STATS.TOTAL_ASSETS")
    return pages.agg(
        F.count(F.lit(1)).alias("pages"),
        collected.alias("collected"),
        announced.alias("announced"),
        (collected >= F.coalesce(announced, F.lit(0))).alias("complete"),
    )
