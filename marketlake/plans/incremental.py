"""Incremental series: what to request, and storing what arrived."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from marketlake.operators.fetchplan import fetch_plan, newer_than_stored
from marketlake.operators.select import UPDATE_COLUMNS, futures_instruments
from marketlake.plans.refresh import candle_batch
from marketlake.plans.store import Store

# Payload kind and table per futures data type.
SERIES = {
    "ohlcv": ("futures_ohlcv", "futures_ohlcv_{}"),
    "funding-rate": ("funding_rate", "futures_funding_rate_ohlc_{}"),
    "open-interest": ("open_interest", "futures_open_interest_ohlc_{}"),
}


def series_table(data_type: str, interval: str) -> str:
    if data_type not in SERIES or interval not in ("1d", "1h", "1m"):
        raise ValueError(f"Unsupported series: {data_type} {interval}")
    return SERIES[data_type][1].format(interval)


def futures_plan(
    spark: SparkSession,
    store: Store,
    data_type: str,
    interval: str,
    now: Column,
    statuses: Sequence[str] = ("ACTIVE",),
    exchanges: Sequence[str] = (),
    symbols: Sequence[str] = (),
) -> DataFrame:
    """Requests for all selected instruments, from the stored tables.

    Without ``exchanges`` every stored futures exchange is used.
    """
    _, last, first = UPDATE_COLUMNS[data_type]
    venues: Sequence[str] | DataFrame = [e.strip() for e in exchanges]
    if not venues:
        venues = store.read(spark, "exchanges_futures_details")
    chosen = futures_instruments(store.read(spark, "instruments_futures"), venues, statuses, data_type, symbols)
    wanted = chosen.select(
        F.col("exchange_internal_name").alias("market"),
        F.col("mapped_instrument_symbol").alias("mapped_instrument"),
        F.col(first).alias("first_update"),
        F.col(last).alias("last_update"),
        F.col("instrument_status_on_exchange").alias("status"),
    )
    return fetch_plan(wanted, store.marks(spark, series_table(data_type, interval)), interval, now)


def store_candles(
    spark: SparkSession, path: str, store: Store, data_type: str, interval: str, run_ts: Column
) -> None:
    """Upsert the landed candles that are newer than what is stored for their key."""
    table = series_table(data_type, interval)
    batch = candle_batch(spark, path, SERIES[data_type][0], run_ts)
    fresh = newer_than_stored(batch, store.marks(spark, table), ["market", "mapped_instrument"])
    store.upsert(fresh, table)
