import os
import sys

import pandas
import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
os.environ["PYTHONPATH"] = os.pathsep.join([sys.path[0], os.environ.get("PYTHONPATH", "")])


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.driver.memory", "3g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def small():
    return SMALL


@pytest.fixture(scope="session")
def oracle():
    """Run SQL over the small tables; rows as sorted lists of comparable cells."""
    import duckdb

    con = duckdb.connect()
    for file in sorted(os.listdir(SMALL)):
        if file.endswith(".parquet"):
            con.execute(f"CREATE VIEW {file.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SMALL}/{file}')")
    return con


def cell(value):
    if value is None or value is pandas.NA or (isinstance(value, float) and value != value):
        return ""
    if isinstance(value, bool):
        return str(value)
    if isinstance(value, (int, float)) or hasattr(value, "dtype") and value.ndim == 0:
        return f"{float(value):.6f}"
    return str(value.tolist() if hasattr(value, "tolist") else value)


def rows_of(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted(tuple(cell(v) for v in row) for row in frame.itertuples(index=False))
