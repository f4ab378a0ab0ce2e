"""Run registered queries next to their SQL in DuckDB and compare every value.

    python -m checks.compare [folder] [name ...]
"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd

from pulsegrid.session import build_session

from . import QUERIES, SQL

FOLDER = "/root/testdata/sf0.01"


def sql_frame(name: str, folder: str) -> pd.DataFrame:
    connection = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        connection.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return connection.sql(SQL[name]).to_arrow_table().to_pandas()


def _plain(frame: pd.DataFrame) -> pd.DataFrame:
    frame = frame[sorted(frame.columns)].copy()
    for column in frame.columns:
        if str(frame[column].dtype).startswith("datetime64"):
            frame[column] = frame[column].astype("datetime64[us]").astype(str)
        else:
            frame[column] = frame[column].map(lambda v: "" if pd.isna(v) else repr(v))
    return frame.sort_values(list(frame.columns), ignore_index=True)


def differences(name: str, spark, folder: str) -> str | None:
    """What differs between the query and its SQL, or None."""
    ours = QUERIES[name](spark, folder).toArrow().to_pandas()
    theirs = sql_frame(name, folder)
    if sorted(ours.columns) != sorted(theirs.columns):
        return f"columns {sorted(ours.columns)} != {sorted(theirs.columns)}"
    kinds = {
        c: (str(ours[c].dtype), str(theirs[c].dtype))
        for c in ours.columns
        if str(ours[c].dtype) != str(theirs[c].dtype)
    }
    left, right = _plain(ours), _plain(theirs)
    if len(left) != len(right):
        return f"rows {len(left)} != {len(right)}"
    if not left.equals(right):
        bad = (left != right).any(axis=1)
        return f"{bad.sum()} rows differ\n{left[bad].head(3)}\n{right[bad].head(3)}\n{kinds}"
    if kinds:
        return f"types {kinds}"
    return None


def main() -> int:
    folder = sys.argv[1] if len(sys.argv) > 1 else FOLDER
    names = sys.argv[2:] or list(QUERIES)
    spark = build_session(
        master="local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.sql.shuffle.partitions": "8",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    bad = 0
    for name in names:
        start = time.time()
        try:
            if name in SQL:
                verdict = differences(name, spark, folder)
            else:
                verdict = None
                print(f"     {name}: {QUERIES[name](spark, folder).count()} rows, no SQL")
        except Exception as error:
            verdict = f"{type(error).__name__}: {str(error)[:600]}"
        bad += verdict is not None
        mark = "ok  " if verdict is None else "BAD "
        print(f"{mark} {name} {time.time() - start:.2f}s", flush=True)
        if verdict:
            print(verdict)
    print(f"{len(names) - bad} of {len(names)} agree")
    return 1 if bad else 0


if __name__ == "__main__":
    sys.exit(main())
