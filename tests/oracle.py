"""Side-by-side check of a registered query against its DuckDB SQL twin.

Same rule as the driver's gate: equal column names (sorted), equal row
count, equal multiset of rows. Values are compared exactly (floats by
their repr), since the driver hashes them.

Usage: python tests/oracle.py [sf_dir] [query ...]
"""

from __future__ import annotations

import math
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    import duckdb
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return ("~null",)
    if isinstance(v, float):
        if math.isnan(v):
            return ("~null",)
        return ("f", repr(v + 0.0))
    if hasattr(v, "item"):
        return _norm(v.item())
    return (type(v).__name__ if not isinstance(v, (int,)) else "i", str(v))


def rows_of(pdf):
    cols = sorted(pdf.columns)
    pdf = pdf[cols]
    out = []
    for rec in pdf.itertuples(index=False, name=None):
        out.append(tuple(_norm(None if (v is not None and not isinstance(v, str) and _isna(v)) else v) for v in rec))
    return cols, sorted(out)


def _isna(v):
    try:
        import pandas as pd
        r = pd.isna(v)
        return bool(r) if not hasattr(r, "__len__") else False
    except Exception:
        return False


def compare(spark, name: str, sf_dir: str, con=None) -> tuple[bool, str]:
    import gable.ml.queries  # noqa: F401  (registers the model-side queries)
    from gable.plans.catalog import ORACLE, QUERIES
    con = con or duck(sf_dir)
    t0 = time.time()
    sdf = QUERIES[name](spark, sf_dir)
    s_pdf = sdf.toPandas()
    t1 = time.time()
    d_pdf = con.execute(ORACLE[name]).df()
    s_cols, s_rows = rows_of(s_pdf)
    d_cols, d_rows = rows_of(d_pdf)
    if s_cols != d_cols:
        return False, f"columns differ: spark={s_cols} sql={d_cols}"
    if len(s_rows) != len(d_rows):
        return False, f"row count differs: spark={len(s_rows)} sql={len(d_rows)}"
    if s_rows != d_rows:
        bad = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        return False, f"values differ ({sum(a != b for a, b in zip(s_rows, d_rows))} rows), e.g. {bad}"
    return True, f"ok rows={len(s_rows)} spark={t1 - t0:.2f}s"


if __name__ == "__main__":
    from gable.session import get_spark
    import gable.ml.queries  # noqa: F401
    from gable.plans.catalog import ORACLE
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:] or sorted(ORACLE)
    spark = get_spark("local[8]", shuffle_partitions=8)
    con = duck(sf)
    failed = 0
    for n in names:
        try:
            ok, msg = compare(spark, n, sf, con)
        except Exception as e:  # report and continue
            ok, msg = False, f"error: {type(e).__name__}: {str(e)[:400]}"
        failed += not ok
        print(f"{'PASS' if ok else 'FAIL'} {n}: {msg}", flush=True)
    print(f"{len(names) - failed}/{len(names)} passed")
