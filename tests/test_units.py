from datetime import date, timedelta

import pytest

from actionlens.plans import units

from .conftest import rows_of

SCHEMA = "dwarf_id long, hired_date date, reported_date date, gold_mined double, hammer_date string"


def report(dwarf, hired, tenure, gold, generation):
    return (dwarf, hired, hired + timedelta(days=tenure), gold, generation)


@pytest.fixture
def reports(spark):
    a, b = date(2014, 1, 10), date(2015, 1, 1)
    return spark.createDataFrame(
        [
            report(1, a, 10, 5.0, "2014-01-01"),
            report(1, a, 40, 15.0, "2014-01-01"),
            report(2, a, 10, 7.0, "2014-01-01"),
            report(3, a, 0, 9.0, "2014-01-01"),
            report(4, date(2014, 8, 30), 0, 1.0, "2014-01-01"),
            report(4, date(2014, 8, 30), 1, 100.0, "2014-01-01"),  # on the bound: left out
            report(5, b, 0, 100.0, "2015-01-01"),  # on the bound: left out
            report(5, b, 2, 8.0, "2015-01-01"),
            report(6, b, 4, None, "2015-01-01"),
            report(7, b, 4, 1.0, "2016-01-01"),
        ],
        SCHEMA,
    )


def test_tenure_curve(reports):
    assert rows_of(units.tenure_curve(reports)) == [
        ("2014-01-01", 0, 5.0),
        ("2014-01-01", 10, 6.0),
        ("2014-01-01", 40, 15.0),
        ("2015-01-01", 2, 8.0),
        ("2015-01-01", 4, None),
    ]


def test_rates(reports):
    rates = units.unit_rates(reports)
    assert rows_of(rates) == [
        ("2014-01-01", 1, 20.0, 40, 0.5),
        ("2014-01-01", 2, 7.0, 10, 0.7),
        ("2014-01-01", 3, 9.0, 0, None),
        ("2014-01-01", 4, 1.0, 0, None),
        ("2015-01-01", 5, 8.0, 2, 4.0),
        ("2015-01-01", 6, 0.0, 4, 0.0),
    ]
    assert rows_of(units.unit_rate_by_cohort(rates)) == [("2014-01-01", 4, 2, 0.6), ("2015-01-01", 2, 0, 2.0)]


def test_early_rates_use_early_output_and_tenure(reports):
    early = {r["dwarf_id"]: r for r in units.unit_rates(reports, max_tenure=30).collect()}
    assert (early[1]["gold"], early[1]["tenure"], early[1]["rate"]) == (5.0, 10, 0.5)
