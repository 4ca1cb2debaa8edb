"""Compare queries with their SQL in DuckDB, value by value.

    python tests/oracle_check.py /root/testdata/sf0.01 [query ...]
"""

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _canonical(frame: pd.DataFrame) -> list[tuple]:
    frame = frame[sorted(frame.columns)]
    rows = [
        tuple(None if v is None or v is pd.NA or v != v else v for v in row)
        for row in frame.astype(object).itertuples(index=False, name=None)
    ]
    return sorted(rows, key=lambda row: tuple((v is not None, str(v)) for v in row))


def differences(spark_frame: pd.DataFrame, sql_frame: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(spark_frame.columns) != sorted(sql_frame.columns):
        return f"columns {sorted(spark_frame.columns)} != {sorted(sql_frame.columns)}"
    ours, theirs = _canonical(spark_frame), _canonical(sql_frame)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows != {len(theirs)}"
    for a, b in zip(ours, theirs):
        if a != b or [type(x) for x in a] != [type(x) for x in b]:
            return f"{a} != {b}"
    return None


def rows_of_spark(frame) -> pd.DataFrame:
    return pd.DataFrame([tuple(r) for r in frame.collect()], columns=frame.columns, dtype=object)


def rows_of_sql(con: duckdb.DuckDBPyConnection, sql: str) -> pd.DataFrame:
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return pd.DataFrame(cursor.fetchall(), columns=names, dtype=object)


if __name__ == "__main__":
    from tests.conftest import session

    import __spark_entry__ as entry

    sf_dir, *names = sys.argv[1:]
    spark, con = session(), connect(sf_dir)
    queries, oracle = entry.queries(), entry.oracle_sql()
    print("without oracle:", sorted(set(queries) - set(oracle)), "without query:", sorted(set(oracle) - set(queries)))
    bad = 0
    for name in names or [name for name in queries if name in oracle]:
        start = time.time()
        try:
            frame = rows_of_spark(queries[name](spark, sf_dir))
            took = time.time() - start
            problem = differences(frame, rows_of_sql(con, oracle[name]))
        except Exception as e:  # noqa: BLE001 - report and go on
            took, frame, problem = time.time() - start, [], f"{type(e).__name__}: {str(e)[:600]}"
        bad += problem is not None
        print(f"{name:45s} {len(frame):7d} rows {took:6.2f}s  {problem or 'ok'}", flush=True)
    print("bad:", bad)
