"""Compare each registered query with its DuckDB oracle (row count, columns, values).

usage: python tools/check.py [sf_dir] [name-prefix ...]
"""

from __future__ import annotations

import hashlib
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import duckdb  # noqa: E402
import pandas as pd  # noqa: E402

from senslake.session import get_session  # noqa: E402
from senslake.sources.tables import TABLES  # noqa: E402


def _cell(v):
    try:
        if v is None or pd.isna(v):
            return None
    except (TypeError, ValueError):
        pass
    if isinstance(v, float):
        return round(v, 6)
    if hasattr(v, "isoformat"):
        return pd.Timestamp(v).isoformat()
    return str(v)


def _norm(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        df[c] = df[c].map(_cell)
        df[c] = df[c].astype(str)
    return df.sort_values(list(df.columns)).reset_index(drop=True)


def _hash(df: pd.DataFrame) -> str:
    return hashlib.sha1(df.to_csv(index=False).encode()).hexdigest()


def main() -> int:
    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    prefixes = sys.argv[2:]
    import importlib.util
    spec = importlib.util.spec_from_file_location("entry", os.path.join(
        os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    spark = get_session("local[8]", shuffle_partitions=8)
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    qs, sqls = mod.queries(), mod.oracle_sql()
    bad = 0
    for name, fn in qs.items():
        if prefixes and not any(name.startswith(p) for p in prefixes):
            continue
        t0 = time.time()
        try:
            sdf = fn(spark, sf_dir).toPandas()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: spark error {str(e)[:800]}")
            bad += 1
            continue
        ts = time.time() - t0
        spark.catalog.clearCache()
        if name not in sqls:
            print(f"ROWS {name}: {len(sdf)} rows (no oracle) {ts:.1f}s")
            continue
        try:
            ddf = con.execute(sqls[name]).df()
        except Exception as e:  # noqa: BLE001
            print(f"FAIL {name}: duckdb error {str(e)[:800]}")
            bad += 1
            continue
        if sorted(sdf.columns) != sorted(ddf.columns):
            print(f"FAIL {name}: columns {sorted(sdf.columns)} vs {sorted(ddf.columns)}")
            bad += 1
            continue
        a, b = _norm(sdf), _norm(ddf)
        if len(a) != len(b) or _hash(a) != _hash(b):
            bad += 1
            print(f"FAIL {name}: rows {len(a)} vs {len(b)}")
            m = a.merge(b, how="outer", indicator=True)
            print(m[m["_merge"] != "both"].head(8).to_string())
            continue
        print(f"OK   {name}: {len(a)} rows {ts:.1f}s")
    print(f"{bad} failing")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
