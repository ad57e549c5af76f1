import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parents[1]
for folder in (ROOT, ROOT / "tools"):
    if str(folder) not in sys.path:
        sys.path.insert(0, str(folder))

from tidemark.session import local_session  # noqa: E402

TESTDATA = Path("/root/testdata")


@pytest.fixture(scope="session")
def spark():
    session = local_session(cpus=4, partitions=4)
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    path = TESTDATA / "sf0.001"
    if not path.exists():
        pytest.skip("test tables are not here")
    return str(path)


@pytest.fixture(scope="session")
def duck(sf_dir):
    from check_oracle import connect

    return connect(sf_dir)


def rows(df, *order):
    """Rows as sorted tuples, NULLs first."""
    picked = df.select(*order) if order else df
    return sorted((tuple(r) for r in picked.collect()), key=lambda t: [(x is not None, str(x)) for x in t])
