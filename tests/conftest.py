import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tradegrain.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests", "local[8]", spark__sql__shuffle__partitions="4", spark__ui__enabled="false",
        spark__driver__memory="6g", spark__default__parallelism="4",
        # Small tables must go through several tasks here, as large ones would.
        spark__sql__adaptive__coalescePartitions__enabled="false",
        spark__checkpoint__dir=str(tmp_path_factory.mktemp("shared")))
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def rows():
    """A frame's rows as sorted tuples."""
    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in df.collect()), key=repr)
    return collect


@pytest.fixture
def same(rows):
    def check(left, right):
        right = right.select(*left.columns)
        right = right.select(*[right[f.name].cast(f.dataType) for f in left.schema])
        assert rows(left) == rows(right)
    return check
