from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from lakeloom.session import build_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[8]", spark__sql__shuffle__partitions="8", spark__driver__memory="8g",
                            spark__checkpoint__dir=f"file://{tmp_path_factory.mktemp('shared')}")
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def data():
    return SMALL


def rows(df):
    """Rows as a sorted list of texts, to compare as multisets."""
    names = sorted(df.columns)
    return sorted(str(tuple(r[n] for n in names)) for r in df.collect())
