"""Every registered query against its SQL oracle."""

import os

import pytest

from strata.plans.oracles import ORACLES
from strata.plans.queries import QUERIES
from tests.oracle_check import differences, duck

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return duck(SF_DIR)


def test_every_query_has_an_oracle():
    assert sorted(ORACLES) == sorted(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    assert differences(QUERIES[name](spark, SF_DIR), ORACLES[name], con) == []
