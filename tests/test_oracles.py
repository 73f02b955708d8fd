"""Every registered query against its SQL oracle, on whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry

from . import compare

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def oracle():
    return compare.duck(SF)


@pytest.mark.parametrize("name", sorted(entry.QUERIES))
def test_query_equals_oracle(spark, oracle, name):
    assert compare.difference(entry.queries()[name](spark, SF), oracle, entry.oracle_sql()[name]) is None


def test_every_query_has_an_oracle():
    assert set(entry.QUERIES) <= set(entry.oracle_sql()) <= set(entry.queries())


def test_flagship(spark):
    rows = entry.entry(spark).collect()
    assert len(rows) == 10
    assert [r["revenue_rank"] for r in rows] == list(range(1, 11))


def test_fixture_counts(spark):
    funnel = {r["rule"]: (r["n_in"], r["n_kept"]) for r in entry.queries()["quality_funnel"](spark, SF).collect()}
    assert funnel == {
        "R1": (6000, 5902), "R2": (5902, 5637), "R3": (5637, 5294), "R4": (1000, 578), "R5": (1500, 1467),
    }
    assert entry.queries()["orders_enriched"](spark, SF).count() == 5602
