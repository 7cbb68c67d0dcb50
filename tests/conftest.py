import pathlib
import sys

import pytest

sys.path.insert(0, str(pathlib.Path(__file__).resolve().parent.parent))

from catalogflow.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "4", 4, "4g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def column(spark):
    """Evaluate a Column expression over a list of values."""

    def run(values, build, kind="string"):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, c {kind}")
        return [r[0] for r in df.select("i", build("c").alias("x")).orderBy("i").select("x").collect()]

    return run


@pytest.fixture
def rows():
    def collect(df, *names):
        chosen = df.select(*names) if names else df
        return sorted((tuple(r) for r in chosen.collect()), key=repr)

    return collect
