import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from clientpulse.session import build_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_session("tests", "local[8]", spark__ui__enabled="false", spark__sql__shuffle__partitions="4",
                            spark__driver__memory="6g")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows(spark):
    """Frame from row tuples and a flat schema text."""
    from clientpulse.sources.schemas import _schema

    def make(data, columns):
        return spark.createDataFrame(data, _schema(columns))
    return make


def as_set(df, *columns):
    """Rows as a set of tuples."""
    return {tuple(r) for r in (df.select(*columns) if columns else df).collect()}


def as_dict(df, key, value):
    return {r[key]: r[value] for r in df.select(key, value).collect()}
