import sys
from datetime import date
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))
sys.path.insert(0, str(Path(__file__).resolve().parent))

from tallybook.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folders = {
        "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
    }
    session = build_session("tests", "local[4]", shuffle_partitions=4, settings=folders)
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def rows():
    """Rows of a DataFrame as a sorted list of tuples, dates as ISO text."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        out = [
            tuple(v.isoformat() if isinstance(v, date) else v for v in r) for r in picked.collect()
        ]
        return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))

    return collect
