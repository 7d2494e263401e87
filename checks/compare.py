"""Run queries next to their oracle SQL: python -m checks.compare SF_DIR [query ...]"""

from __future__ import annotations

import sys
import time
from pathlib import Path

import duckdb
import pandas as pd
from pyspark.sql import SparkSession

from checks.oracle import ORACLE
from checks.spark_queries import QUERIES


def oracle_frame(sf_dir: str, sql: str) -> pd.DataFrame:
    with duckdb.connect() as connection:
        for path in Path(sf_dir).glob("*.parquet"):
            connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
        return connection.execute(sql).df()


def canonical(frame: pd.DataFrame) -> list[tuple]:
    """Rows as sorted tuples with columns by name, so that order does not matter."""

    def plain(value):
        if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
            return (0, "")
        if isinstance(value, float):
            return (1, repr(value))
        return (1, str(pd.Timestamp(value)) if hasattr(value, "year") else str(value))

    columns = sorted(frame.columns)
    return sorted(tuple(plain(value) for value in row) for row in frame[columns].astype(object).itertuples(index=False))


def differences(spark: SparkSession, sf_dir: str, name: str) -> str | None:
    """What differs between a query and its oracle, or None."""
    mine = QUERIES[name](spark, sf_dir).toPandas()
    theirs = oracle_frame(sf_dir, ORACLE[name])
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} != {sorted(theirs.columns)}"
    left, right = canonical(mine), canonical(theirs)
    if left != right:
        extra = [row for row in left if row not in set(right)][:3]
        lacking = [row for row in right if row not in set(left)][:3]
        return f"{len(left)} rows != {len(right)} rows; only here {extra}; only there {lacking}"
    return None if len(left) else "no rows"


def main() -> None:
    from shopmart.session import build_session

    sf_dir, *names = sys.argv[1:]
    spark = build_session(
        "compare", "local[8]", **{"spark.sql.shuffle.partitions": "8", "spark.ui.showConsoleProgress": "false"}
    )
    spark.sparkContext.setLogLevel("ERROR")
    for name in names or QUERIES:
        start = time.time()
        try:
            found = differences(spark, sf_dir, name)
        except Exception as error:  # keep going: every query gets a line
            found = f"{type(error).__name__}: {str(error)[:1500]}"
        print(f"{'ok  ' if found is None else 'FAIL'} {name} {time.time() - start:.2f}s {found or ''}", flush=True)


if __name__ == "__main__":
    main()
