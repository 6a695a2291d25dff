import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture(scope="session")
def sf():
    return "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def duck():
    """Runs DuckDB SQL over the tables of a folder."""
    import duckdb

    def run(folder, sql):
        con = duckdb.connect()
        for t in "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split():
            p = f"{folder}/{t}.parquet"
            con.execute(f"create view {t} as select * from '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
        return con.sql(sql).df()

    return run


@pytest.fixture(scope="session")
def canon():
    """Rows as sorted tuples of text, columns by name."""

    def one(v):
        if v is None or v != v if isinstance(v, float) else v is None:
            return "-"
        if isinstance(v, (float,)):
            return repr(round(v, 6) + 0.0)
        if hasattr(v, "tolist"):
            v = v.tolist()
        if isinstance(v, (list, tuple)):
            return "[" + ",".join(map(one, v)) + "]"
        if isinstance(v, bool):
            return str(v)
        try:
            return repr(round(float(v), 6) + 0.0) if not isinstance(v, str) else v
        except (TypeError, ValueError):
            return str(v)

    def run(df):
        cols = sorted(df.columns)
        return sorted(tuple(one(None if x is not x else x) for x in r) for r in df[cols].astype(object).where(df[cols].notna(), None).itertuples(index=False))

    return run
