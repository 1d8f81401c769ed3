import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ.setdefault("PYSPARK_PYTHON", sys.executable)

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark():
    from parcelmill.session import build_session

    session = build_session(
        "local[8]", spark__sql__shuffle__partitions="8", spark__ui__enabled="false"
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture
def frame(spark):
    """Build a frame from rows and a schema text."""
    return lambda rows, schema: spark.createDataFrame(rows, schema)


@pytest.fixture
def one(spark):
    """Value of one expression over one row of text columns a, b, c."""

    def evaluate(make, *texts):
        names = ["a", "b", "c"][: len(texts)] or ["a"]
        row = tuple(texts) if texts else (None,)
        df = spark.createDataFrame([row], ", ".join(f"{n} string" for n in names))
        from pyspark.sql import functions as F

        return df.select(make(*[F.col(n) for n in names]).alias("v")).first()["v"]

    return evaluate
