import os
import sys
from uuid import uuid4

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from loadweir.session import local_session, shared_dir  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", 4, shuffle_partitions=4)
    yield session
    session.stop()


@pytest.fixture
def folder(spark):
    """A path nothing has been written to yet."""
    return shared_dir(spark, "test")


@pytest.fixture
def schema(spark):
    """A fresh catalog schema."""
    name = f"s_{uuid4().hex[:8]}"
    spark.sql(f"CREATE DATABASE {name} LOCATION '{shared_dir(spark, 'db')}'")
    yield name
    spark.sql(f"DROP DATABASE {name} CASCADE")


@pytest.fixture
def rows():
    """Rows of a frame as a sorted list of plain tuples."""

    def collect(df, *names):
        df = df.select(*names) if names else df
        return sorted((tuple(r) for r in df.collect()), key=repr)

    return collect
