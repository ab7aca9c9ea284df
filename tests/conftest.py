from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from truegrain.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    shared = tmp_path_factory.mktemp("shared")
    return local_session(4, app="tests", spark__checkpoint__dir=str(shared))


@pytest.fixture
def outcome():
    """(status, violations) of a one-row result."""

    def read(result):
        rows = result.collect()
        assert len(rows) == 1
        return rows[0]["status"], rows[0]["violations"]

    return read
