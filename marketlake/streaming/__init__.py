"""Structured Streaming forms of the incremental jobs."""

from marketlake.streaming.live import (
    closed_candles,
    drain,
    live_candles,
    open_trade_stream,
    unique_live_trades,
    upsert_stream,
)

__all__ = [
    "closed_candles",
    "drain",
    "live_candles",
    "open_trade_stream",
    "unique_live_trades",
    "upsert_stream",
]
