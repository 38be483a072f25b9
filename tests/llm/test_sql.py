"""Queries with comparison SQL give the rows that SQL gives."""

import pytest

from tests.compare import compare, connect
from ticketry.llm.catalog import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.01"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows(spark, name):
    ok, _, note = compare(spark, connect(FOLDER), FOLDER, QUERIES[name], ORACLES[name])
    assert ok, note
