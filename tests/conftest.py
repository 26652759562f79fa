import math
import os

import duckdb
import pandas as pd
import pytest

from lodeweave.session import build_session

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    return build_session("local[4]", 4, **{"spark.sql.autoBroadcastJoinThreshold": "1m"})


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF):
        pytest.skip("no test tables")
    return SF


@pytest.fixture(scope="session")
def duck(sf_dir):
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for name in os.listdir(sf_dir):
        path = f"{sf_dir}/{name}" if os.path.isfile(f"{sf_dir}/{name}") else f"{sf_dir}/{name}/*.parquet"
        con.execute(f"create view {name[:-8]} as select * from '{path}'")
    return con


def plain(value):
    """Values of both engines in one comparable form."""
    if value is None or value is pd.NaT:
        return None
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(map(plain, value))
    if isinstance(value, dict):
        return tuple(sorted((k, plain(v)) for k, v in value.items()))
    if hasattr(value, "isoformat"):
        t = pd.Timestamp(value)
        return t.tz_convert("UTC").tz_localize(None) if t.tzinfo else t
    if type(value).__name__ == "Decimal":
        return round(float(value), 6)
    return value


@pytest.fixture(scope="session")
def agree(spark, sf_dir, duck):
    def check(query, sql):
        df = query(spark, sf_dir)
        names = sorted(df.columns)
        mine = sorted((tuple(plain(r[c]) for c in names) for r in (row.asDict(recursive=True) for row in df.collect())), key=repr)
        cursor = duck.execute(sql)
        columns = [d[0] for d in cursor.description]
        assert sorted(columns) == names
        at = [columns.index(c) for c in names]
        theirs = sorted((tuple(plain(r[i]) for i in at) for r in cursor.fetchall()), key=repr)
        assert mine == theirs

    return check
