import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from compare import session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    s = session()
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def frame(spark):
    """Literal rows with a DDL schema."""
    return lambda ddl, *rows: spark.createDataFrame(list(rows), ddl)


def rows(df, *columns):
    """Rows as plain tuples, sorted by text so that the order does not matter."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
