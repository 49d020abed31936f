"""Run registered queries next to their SQL twins and compare."""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _canonical(df: pd.DataFrame, whole: set[str]) -> list[tuple]:
    df = df[sorted(df.columns)]
    columns = []
    for c in df.columns:
        s = df[c]
        if str(s.dtype).startswith("datetime"):
            s = s.astype("datetime64[us]").astype("string")
        elif c in whole:  # nulls turn whole numbers into floats on one side
            s = s.astype("Int64")
        elif s.dtype == float:
            s = s.map(lambda v: None if pd.isna(v) else repr(round(float(v), 9) + 0.0))
        columns.append([("" if pd.isna(v) else str(v)) for v in s])
    return sorted(zip(*columns)) if columns else []


def compare(spark, con, name: str, query, sql: str, sf_dir: str) -> str | None:
    """None when both sides agree, else what differs."""
    got_df = query(spark, sf_dir)
    types = {c: DUCK_TYPES.get(t, t) for c, t in got_df.dtypes}
    relation = con.sql(sql)
    expected_types = {c: str(t).split("_")[0] for c, t in zip(relation.columns, relation.types)}
    got, want = got_df.toPandas(), relation.df()
    if sorted(types.items()) != sorted(expected_types.items()):
        return f"types differ: {sorted(set(types.items()) ^ set(expected_types.items()))}"
    if len(got) != len(want):
        return f"rows differ: {len(got)} vs {len(want)}"
    whole = {c for c, t in types.items() if t in ("BIGINT", "INTEGER")}
    left, right = _canonical(got, whole), _canonical(want, whole)
    if left != right:
        diff = [(a, b) for a, b in zip(left, right) if a != b][:2]
        return f"values differ in {sum(a != b for a, b in zip(left, right))} rows: {diff}"
    return None if len(got) else "no rows on either side"


def main(argv: list[str]) -> int:
    from marketlake.registry import ORACLES, QUERIES
    from marketlake.session import local_session

    sf_dir = "/root/testdata/sf0.01"
    names = argv or list(QUERIES)
    spark, con, bad = local_session(), connect(sf_dir), 0
    for name in names:
        start = time.time()
        try:
            if name in ORACLES:
                problem = compare(spark, con, name, QUERIES[name], ORACLES[name], sf_dir)
            else:
                problem = None if QUERIES[name](spark, sf_dir).count() else "no rows"
        except Exception as e:  # report and go on with the next query
            problem = f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{'ok  ' if problem is None else 'FAIL'} {name} {time.time() - start:.1f}s {problem or ''}", flush=True)
    print(f"{len(names) - bad}/{len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    raise SystemExit(main(sys.argv[1:]))
