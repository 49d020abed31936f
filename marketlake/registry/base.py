"""Registration and the stand-in views shared by the queries."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F

from marketlake.session import configure

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


class Tables:
    """The driver's tables, by attribute."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = configure(spark)
        self.sf_dir = sf_dir.rstrip("/")

    def path(self, name: str) -> str:
        return f"{self.sf_dir}/{name}.parquet"

    def __getattr__(self, name: str) -> DataFrame:
        frame = self.spark.read.parquet(self.path(name))
        setattr(self, name, frame)
        return frame


def register(name: str, sql: str | None = None):
    """Register ``fn(tables) -> DataFrame`` as a query, with its SQL twin if there is one."""

    def wrap(fn: Callable[[Tables], DataFrame]):
        QUERIES[name] = lambda spark, sf_dir: fn(Tables(spark, sf_dir))
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return wrap


def rounded(df: DataFrame, digits: int = 4, skip: Sequence[str] = ()) -> DataFrame:
    """Round double columns, whose sums depend on the order of addition."""
    return df.selectExpr(
        *[f"round(`{c}`, {digits}) AS `{c}`" if t == "double" and c not in skip else f"`{c}`" for c, t in df.dtypes]
    )


def trades(t: Tables) -> DataFrame:
    """Events as trades of five markets and one instrument per event type."""
    side = F.element_at(F.array(F.lit("BUY"), F.lit("SELL"), F.lit("UNKNOWN")), (F.col("event_id") % 3 + 1).cast("int"))
    return t.events.select(
        F.concat(F.lit("m"), F.col("user_id") % 5).alias("market"),
        F.col("event_type").alias("instrument"),
        "ts",
        F.col("event_id").alias("seq"),
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("quantity"),
        side.alias("side"),
    )


TRADES_SQL = """
trades AS (
  SELECT 'm' || (user_id % 5) AS market, event_type AS instrument, ts, event_id AS seq, value AS price,
         CAST(json_extract_string(props, '$.k') AS DOUBLE) AS quantity,
         CASE event_id % 3 WHEN 0 THEN 'BUY' WHEN 1 THEN 'SELL' ELSE 'UNKNOWN' END AS side
  FROM events)
"""
KEYS = ["market", "instrument"]
