from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
DATA = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    s = (
        SparkSession.builder.master("local[4]").appName("tests").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.driver.memory", "3g").config("spark.ui.showConsoleProgress", "false").getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    return s


@pytest.fixture(scope="session")
def oracle():
    import duckdb

    con = duckdb.connect()
    for p in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}'")
    return con


def rows_of(df) -> list:
    """Rows as comparable tuples, columns and rows sorted."""
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.collect()), key=repr)


def oracle_rows(con, sql: str) -> tuple[list[str], list]:
    got = con.execute(sql)
    names = [d[0] for d in got.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted((tuple(r[i] for i in order) for r in got.fetchall()), key=repr)
