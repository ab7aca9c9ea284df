"""Every registered query against its SQL, on the smallest tables."""

from __future__ import annotations

from pathlib import Path

import pytest

import __spark_entry__ as entry_point
import check_queries
from truegrain.catalog.queries import QUERIES

FOLDER = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no supplied tables")

ROWS_ONLY = {"column_checksum_hash"}


@pytest.fixture(scope="module")
def connection():
    return check_queries.connect(FOLDER)


# The queries of the llm subpackage have tests of their own.
@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, connection, name):
    verdict, _ = check_queries.compare(spark, connection, FOLDER, name)
    assert verdict == ("rows only" if name in ROWS_ONLY else "equal")


def test_entry_has_rows(spark):
    assert entry_point.entry(spark).count() == 15
