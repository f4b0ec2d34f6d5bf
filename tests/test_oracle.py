"""Every registered query next to its SQL, on the smallest tables."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import TESTDATA, database, differences

FOLDER = TESTDATA / "sf0.001"
# These train models; tests/test_models.py covers them on planted labels.
TRAINED = {name for name in queries() if name.startswith(("m6_", "m7_", "m8_", "m9_", "m12_"))}


@pytest.fixture(scope="module")
def connection():
    return database(FOLDER)


def test_names_agree():
    assert set(oracle_sql()) <= set(queries())


@pytest.mark.parametrize("name", sorted(set(oracle_sql()) - TRAINED))
def test_query_equals_sql(spark, connection, name):
    result = queries()[name](spark, str(FOLDER))
    assert differences(result, connection, oracle_sql()[name]) == []


def test_entry(spark):
    rows = entry(spark)
    assert rows.count() > 0
    assert rows.columns == ["query_id", "rank", "song_name", "artist_name", "page_link", "song_id", "score"]
