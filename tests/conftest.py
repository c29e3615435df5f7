import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    from compare import session

    from corpusloom.session import ship_package

    active = session()
    ship_package(active)
    yield active
    active.stop()


@pytest.fixture(scope="session")
def sf():
    return SF


@pytest.fixture(scope="session")
def con():
    from compare import connect

    return connect(SF)


@pytest.fixture(scope="session")
def sentences(spark):
    """Document lines short enough for the public trainers to keep."""
    rows = spark.read.parquet(f"{SF}/documents.parquet").selectExpr("explode(split(text, '\\n')) AS text")
    lines = [r["text"] for r in rows.filter("octet_length(text) < 4000 AND trim(text) <> ''").collect()]
    return lines, spark.createDataFrame([(t,) for t in lines], "text string").repartition(4).persist()
