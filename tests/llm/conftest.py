import glob
import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))

import duckdb  # noqa: E402
import pytest  # noqa: E402

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="session")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        path = f"{SF}/{name}.parquet"
        path = f"{path}/*" if os.path.isdir(path) else path
        assert glob.glob(path)
        con.execute(f"create view {name} as select * from read_parquet('{path}')")
    return con
