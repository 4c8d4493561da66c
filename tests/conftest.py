import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from daylake.session import get_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"

# Policy landing files from FIXTURES.md (our sample rows).
HEADER = ("operation,policy_id,expiry_date,location_name,state_code,region_name,"
          "insured_value,business_type,earthquake,flood")
FILES = {
    "full-load/policy_20240201.csv": [
        "I,1,2024-12-31,Urban,NY,East,100.5,Retail,N,N",
        "I,2,2024-12-31,Rural,TX,South,200,Farm,Y,N",
    ],
    "cdc-load/policy_20240202.csv": [
        "U,1,2025-12-31,Urban,NY,East,101.5,Retail,N,Y",
        "I,3,2025-06-30,Urban,CA,West,300,Retail,N,N",
        "I,3,2025-06-30,Urban,CA,West,301,Retail,N,N",
        "I,x,02/03/2024,,,,abc,,Yes,",
        "I,,2024-01-01,Rural,TX,South,5,Farm,N,N",
    ],
    "cdc-load/policy_20240203.csv": [
        "D,2,2024-12-31,Rural,TX,South,200,Farm,Y,N",
        "U,1,2026-12-31,Urban,NY,East,102.5,Retail,N,Y",
    ],
    # not dated / wrong suffix: never read
    "cdc-load/policy_nodate.csv": ["I,9,2024-12-31,Urban,NY,East,9,Retail,N,N"],
    "cdc-load/policy_20240202.txt": ["I,8,2024-12-31,Urban,NY,East,8,Retail,N,N"],
}


@pytest.fixture(scope="session")
def spark():
    s = get_session("local[4]", app="daylake-tests",
                    extra={"spark.sql.shuffle.partitions": "4",
                           "spark.default.parallelism": "4"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


def write_files(root, files):
    for rel, rows in files.items():
        path = os.path.join(root, rel)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as fh:
            fh.write("\n".join([HEADER, *rows]) + "\n")


@pytest.fixture()
def policy_landing(tmp_path):
    root = str(tmp_path / "landing")
    write_files(root, FILES)
    return root


@pytest.fixture()
def lake(spark, tmp_path):
    """A fresh database under the test's folder."""
    import uuid
    from daylake.plans.publish import create_database
    name = f"t_{uuid.uuid4().hex[:8]}"
    create_database(spark, name, str(tmp_path / name))
    return name
