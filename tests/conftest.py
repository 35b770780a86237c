import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from millrace.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session("tests", "4", **{
        "spark.sql.shuffle.partitions": "4",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    })
    yield session
    session.stop()


@pytest.fixture
def frame(spark):
    """``frame(ddl, *rows)`` builds a small DataFrame."""
    return lambda ddl, *rows: spark.createDataFrame(list(rows), ddl)


@pytest.fixture
def rows():
    """Sorted tuples of a DataFrame."""
    def read(df, *columns):
        picked = df.select(*columns) if columns else df
        order = lambda v: (v is None, 0 if v is None else str(v) if isinstance(v, dict) else v)
        return sorted((tuple(r) for r in picked.collect()), key=lambda r: tuple(order(v) for v in r))
    return read
