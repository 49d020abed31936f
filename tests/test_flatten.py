"""Landed payload files to stored tables, on small hand-written payloads."""

import json
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from moments import at
from marketlake import schemas as S
from marketlake.operators import flatten
from marketlake.plans import refresh
from marketlake.plans.store import Store
from marketlake.session import remove_folder
from marketlake.sources import is_complete, landed_payloads, parse_messages, parse_payload, payload_entries, payload_records

RUN = "2024-05-01 00:00:00"


def run_ts():
    return F.lit(RUN).cast("timestamp_ntz")


@pytest.fixture
def landed(tmp_path):
    def write(*payloads):
        folder = tmp_path / "landed"
        folder.mkdir(exist_ok=True)
        for i, p in enumerate(payloads):
            (folder / f"{i}.json").write_text(p if isinstance(p, str) else json.dumps(p, indent=1))
        return str(folder)

    return write


def asset(i, **more):
    return {"ID": i, "SYMBOL": f"S{i}", "ID_LEGACY": i, "CREATED_ON": 1, "UPDATED_ON": 2} | more


def page(*assets, total=4):
    return {"Data": {"STATS": {"PAGE": 1, "PAGE_SIZE": 2, "TOTAL_ASSETS": total}, "LIST": list(assets)}, "Err": {}}


def test_pages_are_concatenated_and_counted(spark, landed):
    path = landed(page(asset(1), asset(2)), page(asset(3)), page(), {"Err": {"type": 1}}, "not json")
    pages = parse_payload(landed_payloads(spark, path), S.ASSET_PAGE)
    assert is_complete(pages).first().asDict() == {"pages": 3, "collected": 3, "announced": 4, "complete": False}
    assert payload_records(pages, "body.Data.LIST").count() == 3


def test_error_responses_are_dropped(spark, landed):
    path = landed({"Response": "Error", "Data": {"x": {"Name": "n"}}}, {"Response": "Success", "Data": {"y": {"Name": "m"}}})
    entries = payload_entries(parse_payload(landed_payloads(spark, path), S.EXCHANGE_GENERAL))
    assert [r["name"] for r in entries.collect()] == ["y"]


def test_asset_children(spark, landed):
    rich = asset(
        1,
        LAUNCH_DATE=None,
        PREVIOUS_ASSET_SYMBOLS=[{"SYMBOL": "OLD"}, {"SYMBOL": ""}, ["a", 1], "plain", 5, 1.5],
        ASSET_ALTERNATIVE_IDS=[
            {"NAME": "CMC", "ID": "1"},
            {"NAME": "CMC", "ID": "2"},
            {"NAME": "CG", "ID": ""},
            {"NAME": "ASSET", "ID": "9"},
            {"NAME": "NEW", "ID": "9"},
            {"NAME": None, "ID": "9"},
        ],
        ASSET_INDUSTRIES=[{"ASSET_INDUSTRY": "PAY", "JUSTIFICATION": "j"}],
        CONSENSUS_MECHANISMS=[],
        CONSENSUS_ALGORITHM_TYPES=None,
        PRICE_USD_LAST_UPDATE_TS=0,
    )
    path = landed(page(rich, asset(0), asset(2, PRICE_USD_LAST_UPDATE_TS=1700000000, PRICE_USD=1)))
    records = payload_records(parse_payload(landed_payloads(spark, path), S.ASSET_PAGE), "body.Data.LIST")
    tables = flatten.asset_tables(records, run_ts())
    assert set(tables) == {t for t in S.TABLES if t.startswith("asset") and t != "asset_coin_uid_map"}
    for name, df in tables.items():
        assert df.dtypes == [(f.name, f.dataType.simpleString()) for f in S.TABLES[name].schema.fields]
    ids = {r["asset_id"]: r for r in tables["asset_alternative_ids"].collect()}
    assert set(ids) == {1, 2}  # id 0 counts as missing
    assert (ids[1]["cmc_id"], ids[1]["cg_id"], ids[2]["cmc_id"]) == ("2", None, None)
    symbols = [r["previous_symbol"] for r in tables["asset_previous_symbols_map"].collect()]
    assert sorted(symbols) == sorted(["OLD", '{"SYMBOL":""}', '["a",1]', "plain", "5", "1.5"])
    assert tables["asset_industries_map"].first()["industry_name"] == "PAY"
    assert tables["asset_consensus_mechanisms_map"].count() == tables["asset_consensus_algorithm_types_map"].count() == 0
    snapshots = {r["asset_id"]: r["snapshot_ts"] for r in tables["asset_market_data"].collect()}
    assert snapshots == {1: None, 0: None, 2: at("2023-11-14T22:13:20")}


def test_refresh_assets_twice(spark, landed, tmp_path):
    store = Store(str(tmp_path / "store"))
    path = landed(page(asset(1, NAME="a"), asset(2, ASSET_INDUSTRIES=[{"ASSET_INDUSTRY": "X"}])))
    refresh.refresh_assets(spark, path, store, run_ts())
    (tmp_path / "landed" / "0.json").write_text(json.dumps(page(asset(1, NAME="b"), asset(3))))
    refresh.refresh_assets(spark, path, store, F.lit("2024-05-02").cast("timestamp_ntz"))
    got = {r["asset_id"]: r["name"] for r in store.read(spark, "assets").collect()}
    assert got == {1: "b", 2: None, 3: None}
    assert store.read(spark, "asset_market_data").count() == 4  # append only
    assert store.read(spark, "asset_industries_map").count() == 1


SPOT = {
    "Data": {
        "one": {
            "TYPE": "9",
            "INSTRUMENT_STATUS": {"ACTIVE": 3},
            "HAS_ORDERBOOK_L2_MINUTE_SNAPSHOTS_ENABLED": True,
            "TOTAL_TRADES_SPOT": 6890000000000000000,
            "instruments": {
                "A-USD": {
                    "INSTRUMENT_STATUS": "ACTIVE",
                    "INSTRUMENT_MAPPING": {"BASE": "A", "BASE_ID": 1, "QUOTE": "USD", "CREATED_ON": 0},
                    "HAS_TRADES_SPOT": True,
                    "FIRST_TRADE_SPOT_TIMESTAMP": 0,
                    "LAST_TRADE_SPOT_TIMESTAMP": 1700000000,
                },
                "B-USD": {"INSTRUMENT_STATUS": "RETIRED"},
            },
        },
        "empty": {"TYPE": "9", "instruments": {}},
        "bare": {"TYPE": "9"},
    }
}


def test_spot_tree(spark, landed, tmp_path):
    store = Store(str(tmp_path / "store"))
    refresh.refresh_exchanges(spark, landed(SPOT), store, run_ts(), "spot")
    venues = {r["exchange_internal_name"]: r for r in store.read(spark, "exchange_spot_details").collect()}
    assert set(venues) == {"one", "empty", "bare"}
    assert venues["one"]["instruments_active_count"] == 3 and venues["one"]["instruments_expired_count"] is None
    assert venues["one"]["has_orderbook_l2_snapshots"] is True and venues["bare"]["has_orderbook_l2_snapshots"] is None
    assert venues["one"]["total_trades_exchange_level"] == 6890000000000000000
    found = {r["mapped_instrument_symbol"]: r for r in store.read(spark, "instruments_spot").collect()}
    assert set(found) == {"A-USD", "B-USD"}
    assert found["A-USD"]["first_trade_datetime"] is None and found["A-USD"]["instrument_mapping_created_datetime"] is None
    assert found["A-USD"]["last_trade_datetime"] == at("2023-11-14T22:13:20")


def futures(first, last, status="ACTIVE"):
    return {
        "INSTRUMENT_STATUS": status,
        "INSTRUMENT_MAPPING": {"INDEX_UNDERLYING": "A", "INDEX_UNDERLYING_ID": 1},
        "HAS_TRADES_FUTURES": "True",
        "FIRST_TRADE_FUTURES_TIMESTAMP": first,
        "LAST_TRADE_FUTURES_TIMESTAMP": last,
        "HAS_OPEN_INTEREST_UPDATES": False,
    }


def test_futures_tree_plan_and_candles(spark, landed, tmp_path):
    """Instruments, then the request plan, then two candle deliveries."""
    from marketlake.plans import incremental

    store = Store(str(tmp_path / "store"))
    day = 86400
    start = 1704067200  # 2024-01-01
    tree = {"Data": {"ex": {"TYPE": "9", "instruments": {
        "A-PERP": futures(start, start + 30 * day),
        "B-PERP": futures(start, start + 2 * day, "EXPIRED"),
        "C-PERP": futures(start, start, "IGNORED"),
    }}}}
    refresh.refresh_exchanges(spark, landed(tree), store, run_ts(), "futures")
    row = store.read(spark, "instruments_futures").where("mapped_instrument_symbol = 'A-PERP'").first()
    assert (row["has_trades"], row["has_open_interest_updates"], row["has_funding_rate_updates"]) == (True, False, False)
    assert store.read(spark, "exchanges_futures_details").first()["has_orderbook_l2_snapshots"] is False

    now = F.lit("2024-01-11 08:00:00")
    plan = incremental.futures_plan(spark, store, "ohlcv", "1d", now, ["ACTIVE", "EXPIRED"])
    points = {r["mapped_instrument"]: r["points"] for r in plan.collect()}
    assert points == {"A-PERP": 10, "B-PERP": 3}
    assert incremental.futures_plan(spark, store, "open-interest", "1d", now).count() == 0

    def candle(i, close):
        return {
            "TIMESTAMP": start + i * day, "MARKET": "ex", "INSTRUMENT": "A_P", "MAPPED_INSTRUMENT": "A-PERP",
            "CLOSE": close, "NUMBER_OF_CONTRACTS": 1, "FIRST_TRADE_TIMESTAMP": 0, "LAST_TRADE_TIMESTAMP": None,
        }

    folder = tmp_path / "candles"
    folder.mkdir()
    (folder / "a.json").write_text(json.dumps({"Data": [candle(0, 1), candle(1, 2), candle(1, 2)]}))
    incremental.store_candles(spark, str(folder), store, "ohlcv", "1d", run_ts())
    (folder / "a.json").write_text(json.dumps({"Data": [candle(1, 99), candle(2, 3)]}))
    incremental.store_candles(spark, str(folder), store, "ohlcv", "1d", run_ts())
    stored = store.read(spark, "futures_ohlcv_1d").orderBy("datetime").collect()
    assert [r["close"] for r in stored] == [1, 2, 3]  # stored bars are not asked for again
    assert stored[0]["first_trade_timestamp"] == at("1970-01-01") and stored[0]["last_trade_timestamp"] is None
    plan = incremental.futures_plan(spark, store, "ohlcv", "1d", now, symbols=["A-PERP"])
    assert [(str(r["batch_start"]), r["points"]) for r in plan.collect()] == [("2024-01-04 00:00:00", 7)]


def test_usage_and_gradings(spark, landed, tmp_path):
    store = Store(str(tmp_path / "store"))
    unit = {"SECOND": 1, "MINUTE": 2, "HOUR": 3, "DAY": 4, "MONTH": 5}
    refresh.record_usage(spark, landed({"Data": {"API_KEY": {"USED": unit, "MAX": unit}}}), store, "job", "pre", run_ts())
    row = store.read(spark, "rate_limit_status").first()
    assert (row["api_key_used_day"], row["api_key_remaining_day"], row["auth_key_max_hour"]) == (4, None, None)
    general = {"Response": "Success", "Data": {"12": {"Name": "n", "Grade": "AA", "ItemType": None, "SortOrder": "x",
               "GradePointsSplit": {"Legal": 1.5}, "Rating": {"Avg": 4, "TotalUsers": 2}, "TOTALVOLUME24H": {"USD": 3}}}}
    refresh.refresh_gradings(spark, landed(general), store, run_ts())
    row = store.read(spark, "exchanges_general").first()
    assert (row["item_types"], row["grade_points_legal"], row["grade_points_team"]) == ("[]", 1.5, None)
    assert (row["sort_order"], row["rating_avg"], row["total_volume_24h_usd"]) == (None, 4.0, 3.0)


def test_messages(rows):
    df = rows([('{"TYPE": "5", "PRICE": 1.5}',), ("plain text",), ("",)], "value string")
    got = parse_messages(df).select(F.try_variant_get("message", "$.PRICE", "double").alias("p"), "text").collect()
    assert [tuple(r) for r in got] == [(1.5, None), (None, "plain text"), (None, "")]


def test_body_is_parsed_once(spark, landed):
    path = landed(page(asset(1)))
    rows_ = flatten.asset_rows(payload_records(parse_payload(landed_payloads(spark, path), S.ASSET_PAGE), "body.Data.LIST"), run_ts())
    plan = rows_._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1


def test_a_refresh_parses_once(spark, landed, tmp_path, monkeypatch):
    """Tables are made of staged records: no plan of theirs parses text, and the staged folder is gone afterwards."""
    plans, store = [], Store(str(tmp_path / "store"))
    upsert = Store.upsert

    def noted(self, rows, table):
        plans.append(rows._jdf.queryExecution().optimizedPlan().toString())
        upsert(self, rows, table)

    monkeypatch.setattr(Store, "upsert", noted)
    removed = []
    monkeypatch.setattr("marketlake.sources.payloads.remove_folder", lambda s, path: removed.append(path))
    refresh.refresh_assets(spark, landed(page(asset(1, NAME="a"))), store, run_ts())
    assert len(plans) == 8 and not any("from_json" in p or "JsonToStructs" in p for p in plans)
    assert len(removed) == 1 and spark.read.parquet(removed[0]).count() == 1
    monkeypatch.undo()
    remove_folder(spark, removed[0])
    assert not Path(removed[0].removeprefix("file:")).exists()


def test_payloads_one_per_line(spark, landed, tmp_path):
    path = landed("\n".join(json.dumps(page(asset(i, NAME=f"n{i}"))) for i in range(3)))
    store = Store(str(tmp_path / "store"))
    refresh.refresh_assets(spark, path, store, run_ts(), per_file=False)
    assert {r["name"] for r in store.read(spark, "assets").collect()} == {"n0", "n1", "n2"}
