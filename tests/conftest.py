import os
import sys
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
DATA = Path(os.environ.get("TESTDATA_DIR", "/root/testdata"))


@pytest.fixture(scope="session")
def spark():
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.local.dir", tempfile.mkdtemp(prefix="spark-", dir="/tmp"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small():
    path = DATA / "sf0.001"
    if not path.is_dir():
        pytest.skip("no test tables here")
    return str(path)


@pytest.fixture(scope="session")
def duck(small):
    import duckdb

    con = duckdb.connect()
    for p in Path(small).iterdir():
        con.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM read_parquet('{p if p.is_file() else f'{p}/*.parquet'}')")
    return con


def canon(v):
    if isinstance(v, float):
        return None if v != v else float(f"{v:.9g}")
    if hasattr(v, "isoformat"):
        return v.isoformat()[:19].replace("T00:00:00", "")
    return v


def rows_of(records, columns, names):
    at = [columns.index(n) for n in names]
    return sorted((tuple(canon(r[i]) for i in at) for r in records), key=lambda r: tuple(map(str, r)))
