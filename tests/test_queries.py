"""Registered queries against their SQL at the smallest scale.

A cross-section by default; ``ALL_QUERIES=1`` runs every one.
"""

import os

import pytest

from checks.compare import connect, difference
from checks.oracle import ORACLE
from checks.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"
SOME = ("read_responses drop_incomplete_questions survey_frequency pre_post_report latest_valid_per_name "
        "matched_pre_post translate_call contacts_upsert").split()


@pytest.fixture(scope="module")
def connection():
    return connect(SF_DIR)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test data")
@pytest.mark.parametrize("name", list(QUERIES) if os.environ.get("ALL_QUERIES") else SOME)
def test_query_equals_sql(spark, connection, name):
    assert difference(spark, connection, name, SF_DIR) in (None, "no rows")
