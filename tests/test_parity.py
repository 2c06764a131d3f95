"""Every registered query beside its SQL, on the smallest tables."""

import pytest

import __spark_entry__ as entry_point
from parity.check import mismatch, open_tables
from parity.queries import QUERIES
from parity.sql import SQL

from .conftest import plan_of

SF = "/root/testdata/sf0.001"
# Their plan only reads what a stream has stored.
STREAMS = {"live_slot_buckets", "live_slot_alerts", "keyed_slot_alerts", "silent_slots"}

@pytest.fixture(scope="module")
def tables():
    return open_tables(SF)


def test_every_query_is_covered():
    assert set(QUERIES) == set(SQL)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal(spark, tables, name):
    assert mismatch(spark, tables, SF, name) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMS))
def test_no_pairwise_join(spark, name):
    plan = plan_of(QUERIES[name](spark, SF))
    assert "CartesianProduct" not in plan and "NestedLoopJoin" not in plan


def test_entry(spark):
    df = entry_point.entry(spark)
    assert df.count() == 7 and df.columns[:3] == ["date", "dau", "new_users"]
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


def test_medians_are_those_of_drawn_pairs(spark, tables):
    """One median a replica at the study's number of replicas, not a closed form beside them."""
    assert "md5" in SQL["bootstrap_ab_median"]
    df = QUERIES["bootstrap_ab_median"](spark, SF)
    assert df.columns == ["replica", "stat"] and df.count() == 10_000


TEST = ["replicas", "mean", "sigma", "ci_low", "ci_high", "z", "p_value"]


def test_poisson_test_is_that_of_drawn_weights(spark, tables):
    """The interval and the p-value of the study's number of replicas, not a closed form beside them."""
    assert "md5" in SQL["bootstrap_ab_poisson"]
    df = QUERIES["bootstrap_ab_poisson"](spark, SF)
    # Of 15 users, the seven of a group get no weight at all in one of a thousand replicas.
    assert df.columns == TEST and 9_900 < df.first()["replicas"] <= 10_000


def test_poisson_replicas_of_rates_are_drawn(spark, tables):
    """A row for each of the study's replicas, not a closed form beside them."""
    assert "md5" in SQL["bootstrap_unit_rates_poisson"]
    df = QUERIES["bootstrap_unit_rates_poisson"](spark, SF)
    assert df.columns == ["replica", "stat"] and df.count() == 2_000
