from __future__ import annotations

import pytest

from tablework.session import build_session

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[8]",
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__sql__shuffle__partitions="4",
        spark__sql__maxMetadataStringLength="2000",  # plan texts show all pushed filters
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")),
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


def sorted_rows(df):
    return sorted((tuple(row) for row in df.collect()), key=str)


@pytest.fixture(scope="session")
def rows_of():
    return sorted_rows
