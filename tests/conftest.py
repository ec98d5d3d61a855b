import os
import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))
os.environ["PYTHONPATH"] = f"{ROOT}:{os.environ.get('PYTHONPATH', '')}"


@pytest.fixture(scope="session")
def spark():
    from spotweave.session import local_session

    s = local_session(4, "4g")
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def rows():
    """The rows of a DataFrame as a sorted list of tuples."""

    def collect(df, *columns):
        return sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)

    return collect
