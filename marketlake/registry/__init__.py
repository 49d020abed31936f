"""Operators run on the driver's tables, each with its SQL twin.

The driver's tables stand in for market data: events are trades, customers are
assets, orders are snapshots, requests or futures instruments, parts and
suppliers are spot instruments.
"""

from marketlake.registry import (  # noqa: F401
    linking,
    maintenance,
    payloads,
    planning,
    refreshes,
    selection,
    series,
    streams,
)
from marketlake.registry.base import ORACLES, QUERIES

__all__ = ["ORACLES", "QUERIES"]
