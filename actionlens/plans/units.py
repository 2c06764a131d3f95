"""Unit productivity: tenure curve, daily rate per unit, and the mean rate of each cohort.

A cohort is a tool generation together with the report dates that count for it.
"""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import ratio


@dataclass(frozen=True)
class Cohort:
    """Reports of one tool generation, strictly before or strictly after a date."""

    generation: str
    before: date | None = None
    after: date | None = None


# The two cohorts of the study.
STUDY_COHORTS = (
    Cohort("2014-01-01", before=date(2014, 8, 31)),
    Cohort("2015-01-01", after=date(2015, 1, 1)),
)

# Fixed value: the length of early tenure in days.
EARLY_TENURE_DAYS = 30


def _in_cohort(cohort: Cohort):
    matches = F.col("hammer_date") == cohort.generation
    if cohort.before is not None:
        matches = matches & (F.col("reported_date") < F.lit(cohort.before))
    if cohort.after is not None:
        matches = matches & (F.col("reported_date") > F.lit(cohort.after))
    return matches


def cohort_reports(reports: DataFrame, cohorts: tuple[Cohort, ...] = STUDY_COHORTS) -> DataFrame:
    """Reports that belong to a cohort, with ``cohort`` and ``tenure_days``."""
    belongs = reduce(lambda a, b: a | b, [_in_cohort(c) for c in cohorts])
    return reports.filter(belongs).select(
        F.col("hammer_date").alias("cohort"),
        "dwarf_id",
        F.date_diff("reported_date", "hired_date").cast("long").alias("tenure_days"),
        "gold_mined",
    )


def tenure_curve(reports: DataFrame, cohorts: tuple[Cohort, ...] = STUDY_COHORTS) -> DataFrame:
    """Mean output by days since hire, per cohort."""
    return (
        cohort_reports(reports, cohorts)
        .filter(F.col("tenure_days").isNotNull())
        .groupBy("cohort", "tenure_days")
        .agg(ratio(F.sum("gold_mined"), F.count("gold_mined")).alias("mean_gold"))
    )


def unit_rates(
    reports: DataFrame,
    cohorts: tuple[Cohort, ...] = STUDY_COHORTS,
    max_tenure: int | None = None,
) -> DataFrame:
    """``(cohort, dwarf_id, gold, tenure, rate)``: output per day of tenure.

    ``max_tenure`` restricts both the output and the tenure to the first days. A unit whose
    longest tenure is zero has no rate.
    """
    counted = cohort_reports(reports, cohorts).filter(F.col("dwarf_id").isNotNull())
    if max_tenure is not None:
        counted = counted.filter(F.col("tenure_days") <= max_tenure)
    return (
        counted.groupBy("cohort", "dwarf_id")
        .agg(
            F.coalesce(F.sum("gold_mined").cast("double"), F.lit(0.0)).alias("gold"),
            F.max("tenure_days").alias("tenure"),
        )
        .withColumn("rate", ratio("gold", "tenure"))
    )


def unit_rate_by_cohort(rates: DataFrame) -> DataFrame:
    """Mean rate per cohort; ``n_excluded`` counts the units without a rate."""
    return rates.groupBy("cohort").agg(
        F.count("*").alias("n_units"),
        F.count_if(F.col("rate").isNull()).alias("n_excluded"),
        F.avg("rate").alias("mean_rate"),
    )
