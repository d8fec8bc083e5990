"""Run queries against their SQL twins: ``python tests/oracle.py [sf_dir] [name ...]``."""

import sys
import time
from pathlib import Path

import duckdb
import numpy as np
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def canonical(df: pd.DataFrame) -> pd.DataFrame:
    """Columns by name, rows sorted, plain Python values."""
    df = df[sorted(df.columns)].copy()
    for c in df.columns:
        if pd.api.types.is_float_dtype(df[c]):
            df[c] = df[c].astype("float64")
            if df[c].isna().any() and (df[c].dropna() % 1 == 0).all():
                df[c] = df[c].astype("Int64")  # whole numbers with nulls, which one side reads as floats
        elif pd.api.types.is_integer_dtype(df[c]):
            df[c] = df[c].astype("Int64")
        else:
            df[c] = df[c].map(lambda v: str(v.tolist()) if isinstance(v, np.ndarray) else v)
    keyed = df.astype("string").fillna("~")
    return df.loc[keyed.sort_values(list(df.columns)).index].reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """None if equal, else a short account of what differs."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}"
    a, b = canonical(got), canonical(want)
    problems = []
    for c in a.columns:
        x, y = a[c], b[c]
        if pd.api.types.is_numeric_dtype(x) and pd.api.types.is_numeric_dtype(y):
            if pd.api.types.is_float_dtype(x) != pd.api.types.is_float_dtype(y):
                problems.append(f"{c}: {x.dtype} / {y.dtype}")
                continue
            xf, yf = x.astype("float64").to_numpy(na_value=np.nan), y.astype("float64").to_numpy(na_value=np.nan)
            bad = ~((xf == yf) | (np.isnan(xf) & np.isnan(yf)))
        else:
            bad = ~((x.astype("string") == y.astype("string")).fillna(False) | (x.isna() & y.isna())).to_numpy(dtype=bool)
        if bad.any():
            i = int(np.flatnonzero(bad)[0])
            problems.append(f"{c}: {int(bad.sum())} differ, e.g. {x.iloc[i]!r} / {y.iloc[i]!r}")
    return "; ".join(problems[:4]) or None


def main() -> None:
    import __spark_entry__ as entry
    from starloom.session import local_session

    args = sys.argv[1:]
    sf_dir = args.pop(0) if args and args[0].startswith("/") else "/root/testdata/sf0.01"
    spark, con = local_session(8), connect(sf_dir)
    queries, oracles = entry.queries(), entry.oracle_sql()
    names = [n for n in queries if not args or any(n.startswith(a) for a in args)]
    failed = 0
    for name in names:
        start = time.time()
        try:
            got = queries[name](spark, sf_dir).toPandas()
            spent = time.time() - start
            if name not in oracles:
                print(f"rows  {name} {got.shape} {spent:.1f}s", flush=True)
                failed += len(got) == 0
                continue
            verdict = difference(got, con.execute(oracles[name]).df())
        except Exception as error:  # report and go on with the next query
            verdict, spent, got = f"{type(error).__name__}: {str(error)[:900]}", time.time() - start, pd.DataFrame()
        failed += verdict is not None
        print(f"{'ok   ' if verdict is None else 'WRONG'} {name} {got.shape} {spent:.1f}s {verdict or ''}", flush=True)
    print(f"{len(names)} queries, {failed} wrong")


if __name__ == "__main__":
    main()
