"""Every registered query against its SQL on the checking engine."""

from __future__ import annotations

import pytest
from compare import checking_engine, differences

from sleevework.plans.catalog import all_checks, all_queries

CHECKS = all_checks()


@pytest.fixture(scope="module")
def engine(sf_dir):
    con = checking_engine(sf_dir)
    yield con
    con.close()


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_agrees_with_sql(spark, engine, sf_dir, name):
    assert name in CHECKS, "every query has a checking SQL"
    assert differences(spark, engine, sf_dir, all_queries()[name], CHECKS[name]) == []
