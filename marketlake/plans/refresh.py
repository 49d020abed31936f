"""Landed payloads to stored tables: assets, exchanges, instruments, usage limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession

from marketlake import schemas as S
from marketlake.operators import flatten
from marketlake.plans.store import Store
from marketlake.sources import landed_payloads, parse_payload, payload_entries, payload_records, staged


def refresh_assets(spark: SparkSession, path: str, store: Store, run_ts: Column, per_file: bool = True) -> None:
    """All eight tables of the landed asset pages, parsed once; market data is appended, the rest upserted."""
    pages = parse_payload(landed_payloads(spark, path, per_file), S.ASSET_PAGE)
    with staged(payload_records(pages, "body.Data.LIST"), "assets") as records:
        for table, rows in flatten.asset_tables(records, run_ts).items():
            store.upsert(rows, table)


def refresh_exchanges(
    spark: SparkSession, path: str, store: Store, run_ts: Column, kind: str, per_file: bool = True
) -> None:
    """Exchanges and instruments of a landed spot or futures tree, parsed once."""
    plans = {
        "spot": (S.SPOT_TREE, flatten.spot_exchange_rows, flatten.spot_instrument_rows),
        "futures": (S.FUTURES_TREE, flatten.futures_exchange_rows, flatten.futures_instrument_rows),
    }
    tables = {
        "spot": ("exchange_spot_details", "instruments_spot"),
        "futures": ("exchanges_futures_details", "instruments_futures"),
    }
    schema, exchange_rows, instrument_rows = plans[kind]
    with staged(payload_entries(parse_payload(landed_payloads(spark, path, per_file), schema)), kind) as entries:
        store.upsert(exchange_rows(entries, run_ts), tables[kind][0])
        store.upsert(instrument_rows(entries, run_ts), tables[kind][1])


def refresh_gradings(spark: SparkSession, path: str, store: Store, run_ts: Column, per_file: bool = True) -> None:
    """Graded venues of the landed payloads."""
    entries = payload_entries(parse_payload(landed_payloads(spark, path, per_file), S.EXCHANGE_GENERAL))
    store.upsert(flatten.exchange_general_rows(entries, run_ts), "exchanges_general")


def record_usage(
    spark: SparkSession, path: str, store: Store, use_case: str, timing: str, run_ts: Column, per_file: bool = True
) -> None:
    """Append the landed usage limits, taken before or after a job."""
    payloads = parse_payload(landed_payloads(spark, path, per_file), S.RATE_LIMIT)
    store.append(flatten.rate_limit_rows(payloads, use_case, timing, run_ts), "rate_limit_status")


def candle_batch(spark: SparkSession, path: str, kind: str, run_ts: Column, **request: Column) -> DataFrame:
    """Rows of the landed candle payloads of one kind."""
    payloads = parse_payload(landed_payloads(spark, path), S.candle_envelope(kind))
    return flatten.candle_rows(payload_records(payloads), kind, run_ts, **request)
