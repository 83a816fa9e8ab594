import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from lexiloom.functions.stopwords import HEBREW, StopWords  # noqa: E402
from lexiloom.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, app="tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def stop():
    return StopWords.of(["the", "of", "and"], HEBREW)


@pytest.fixture
def lines(spark):
    """Text lines as a frame with the column ``value``."""
    return lambda *values: spark.createDataFrame([(v,) for v in values], "value string")


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.fixture(name="rows")
def rows_fixture():
    return rows
