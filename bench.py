"""Time the headline queries; prints one JSON line.

Each query runs once to warm up and once measured, into a sink that reads every
column of every row.
"""

from __future__ import annotations

import json
import os
import time

from marketlake.registry import QUERIES
from marketlake.session import local_session

HEADLINE = [
    "latest_per_key",
    "top_assets",
    "top_pairs",
    "upsert",
    "newer_than_hwm",
    "fetch_plan_1m",
    "date_chunks",
    "reconcile",
    "candles_1m",
    "candles_1h",
    "candles_n",
    "candles_filled",
    "mapped_inverted",
    "latest_tick",
    "price_matrix",
    "metric_ranks",
    "conform_futures_ohlcv",
    "array_children_asset_industries_map",
    "kv_pivot",
    "cascade_match",
    "fuzzy_match",
    "chunk_export_import",
    "stream_candles_1h",
]


def timed(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = local_session(os.environ.get("BENCH_CPUS", "8"), "bench")
    seconds = {}
    for name in names:
        timed(spark, name, sf_dir)
        seconds[name] = round(timed(spark, name, sf_dir), 3)
    result = {
        "metric": "headline_queries_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result), flush=True)


if __name__ == "__main__":
    main()
