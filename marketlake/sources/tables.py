"""Table, file and database scans."""

from __future__ import annotations

from datetime import datetime
from typing import Any

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql import types as T

from marketlake.schemas import TABLES


def scan(spark: SparkSession, sql: str, params: dict[str, Any] | None = None, **frames: DataFrame) -> DataFrame:
    """Run a query with bound named parameters (``:name``).

    Frames passed by keyword are referred to as ``{name}`` in the text.
    """
    return spark.sql(sql, args=params, **frames) if frames else spark.sql(sql, args=params)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(path)


def read_csv(
    spark: SparkSession,
    path: str,
    schema: T.StructType | str,
    header: bool = True,
    timestamp_format: str | None = None,
) -> DataFrame:
    """CSV payload with a known schema; malformed rows fail the read."""
    reader = spark.read.schema(schema).option("header", header).option("mode", "FAILFAST").option("escape", '"')
    if timestamp_format:
        reader = reader.option("timestampNTZFormat", timestamp_format)
    return reader.csv(path)


def read_json_records(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """One record per line; without a schema the types are inferred by a full pass."""
    if schema is None:
        return spark.read.json(path)
    return spark.read.schema(schema).json(path)


def conform_records(df: DataFrame, table: str) -> DataFrame:
    """Columns of ``table`` in declared order and type; absent ones are null."""
    present = set(df.columns)
    return df.select(
        *[
            (F.col(f.name) if f.name in present else F.lit(None)).cast(f.dataType).alias(f.name)
            for f in TABLES[table].schema.fields
        ]
    )


def read_database(
    spark: SparkSession,
    url: str,
    table: str,
    start: datetime,
    end: datetime,
    column: str = "datetime",
    partitions: int = 64,
    overrides: str | None = None,
    properties: dict[str, str] | None = None,
) -> DataFrame:
    """Half-open time range of a database table, read in parallel ranges.

    ``overrides`` is a DDL fragment that forces column types.
    """
    options = {
        "url": url,
        "dbtable": table,
        "partitionColumn": column,
        "lowerBound": start.strftime("%Y-%m-%d %H:%M:%S"),
        "upperBound": end.strftime("%Y-%m-%d %H:%M:%S"),
        "numPartitions": str(partitions),
        **(properties or {}),
    }
    if overrides:
        options["customSchema"] = overrides
    df = spark.read.format("jdbc").options(**options).load()
    return df.where((F.col(column) >= F.lit(start)) & (F.col(column) < F.lit(end)))


def table_columns(df: DataFrame) -> list[str]:
    """Column names without the ranking helper ``rn``."""
    return [c for c in df.columns if c != "rn"]
