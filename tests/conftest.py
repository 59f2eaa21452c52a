import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"
DATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from ledgerloom.session import SETTINGS

    s = SparkSession.builder.master("local[4]").config(map=SETTINGS | {"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"}).getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def duck():
    """A DuckDB connection with a view of every table of one scale, by scale."""
    import duckdb

    def connect(scale: str):
        con = duckdb.connect()
        for p in sorted((DATA / scale).glob("*.parquet")):
            con.execute(f"create view {p.stem} as select * from read_parquet('{p}')")
        return con

    return connect


def plain(value):
    """A value as the comparison sees it: no width, rounded doubles, lists as tuples."""
    if value is None or value != value:
        return None
    if isinstance(value, bool) or type(value).__name__ == "bool_":
        return bool(value)
    if isinstance(value, (list, tuple)) or type(value).__name__ == "ndarray":
        return tuple(map(plain, value))
    if isinstance(value, str):
        return value
    try:
        return float(f"{float(value):.6g}")
    except (TypeError, ValueError):
        return str(value)


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda k: columns[k])
    return sorted((tuple(plain(r[k]) for k in order) for r in rows), key=repr)
