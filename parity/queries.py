"""One callable ``(spark, sf_dir) -> DataFrame`` per job and operator, over the whole test tables.

Ratios and means are rounded to a fixed scale where the order of a floating-point sum could show.
"""

from __future__ import annotations

import math
from collections.abc import Callable
from datetime import date

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from actionlens.functions import (
    day_of,
    epoch_to_timestamp,
    month_of,
    slot_seconds_of,
    slot_start,
    whole_days,
    year_month_text,
)
from actionlens.operators import audit, distinct, distribution, first_seen, profile, rank_test, replica_state, resample, value_sketches
from actionlens.session import cut_lineage, scratch_folder
from actionlens.plans import activity_bits, audience, daily, experiment, ingame, publish, retention, slots, units
from actionlens.sources import fixtures, readers
from actionlens.streaming import keyed_monitor, slot_monitor

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

AS_OF = date(2024, 1, 31)
COHORTS = (
    units.Cohort("2014-01-01", before=date(1999, 1, 1)),
    units.Cohort("2015-01-01", after=date(1996, 1, 1)),
)
OUTLIER_CUT = 200.0
HORIZON = 14
REGISTERED = (date(1995, 3, 1), date(1995, 10, 1))
GROUPS = experiment.GROUPS
GENERATIONS = ("2014-01-01", "2015-01-01")


def register(query: Query) -> Query:
    QUERIES[query.__name__] = query
    return query


def rounded(df: DataFrame, *columns: str, scale: int = 6) -> DataFrame:
    return df.withColumns({c: F.round(c, scale) for c in columns})


def _feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.feed(spark, sf_dir)


def _actions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return readers.all_actions(fixtures.feed(spark, sf_dir), fixtures.messages(spark, sf_dir))


# Daily reports


@register
def app_weekly_series(spark, sf_dir):
    return daily.app_series(_actions(spark, sf_dir), AS_OF)


@register
def app_first_days_series(spark, sf_dir):
    """The first days of the log, in which users are new."""
    return daily.app_series(_actions(spark, sf_dir), date(2024, 1, 5))


@register
def app_daily_report(spark, sf_dir):
    return daily.app_report(_actions(spark, sf_dir), AS_OF)


@register
def app_series_from_maintained(spark, sf_dir):
    """The weekly series on a first-seen table that was built in two batches."""
    actions = _actions(spark, sf_dir)
    border = F.expr("timestamp_ntz'2024-01-15 00:00:00'")
    known = first_seen.first_seen(actions.filter(F.col("time") < border))
    known = first_seen.merge_first_seen(known, actions.filter(F.col("time") >= border))
    return daily.app_series(actions, date(2024, 1, 5), known_first_seen=known)


@register
def app_report_text(spark, sf_dir):
    return daily.app_report_text(daily.app_report(_actions(spark, sf_dir), AS_OF))


@register
def feed_weekly_series(spark, sf_dir):
    return daily.feed_series(_feed(spark, sf_dir), AS_OF)


@register
def feed_daily_report(spark, sf_dir):
    return daily.feed_report(_feed(spark, sf_dir), AS_OF)


@register
def feed_report_text(spark, sf_dir):
    return daily.feed_report_text(daily.feed_report(_feed(spark, sf_dir), AS_OF))


@register
def union_actions(spark, sf_dir):
    return _actions(spark, sf_dir).groupBy("action").agg(F.count("*").alias("n"))


@register
def first_seen_users(spark, sf_dir):
    return first_seen.first_seen(_actions(spark, sf_dir))


@register
def first_seen_bucketed(spark, sf_dir):
    """The maintained table in buckets by user, brought up to date twice."""
    actions, folder = _actions(spark, sf_dir), scratch_folder(spark)
    table, previous = f"first_seen_{folder.rpartition('/')[2]}", None
    for as_of in (date(2024, 1, 3), date(2024, 1, 10), date(2024, 2, 1)):
        users = publish.publish_first_seen_buckets(actions, as_of, folder, table, previous, buckets=8)
        previous = as_of
    return users


@register
def label_new_actions(spark, sf_dir):
    labelled = daily.label_new(_actions(spark, sf_dir))
    return labelled.groupBy(day_of("time").alias("date"), "category").agg(
        F.count("*").alias("n"), F.max("distance").alias("max_distance")
    )


@register
def conditional_distinct(spark, sf_dir):
    conditions = {"users": None, "likers": F.col("action") == "like"}
    return distinct.distinct_by_condition(_feed(spark, sf_dir), [day_of("time").alias("date")], "user_id", conditions)


@register
def distinct_users_28_days(spark, sf_dir):
    """Windows of 1, 7 and 28 days for each day, from states that were stored in three runs."""
    actions, folder = _actions(spark, sf_dir), scratch_folder(spark)
    first, last = date(2024, 1, 1), date(2024, 1, 31)
    audience.publish_audience_days(actions, first, date(2024, 1, 10), folder)
    audience.publish_audience_days(actions, date(2024, 1, 11), date(2024, 1, 20), folder, previous=date(2024, 1, 10))
    # The last run repeats a day.
    states = audience.publish_audience_days(actions, date(2024, 1, 20), last, folder, previous=date(2024, 1, 20))
    return audience.audience_series(states, first, last)


@register
def distinct_users_of_two_weeks(spark, sf_dir):
    """Users of the first week who are back in the third."""
    actions, folder = _actions(spark, sf_dir), scratch_folder(spark)
    states = audience.publish_audience_days(actions, date(2024, 1, 1), date(2024, 1, 31), folder)
    return distinct.distinct_in_both(states, (date(2024, 1, 1), date(2024, 1, 7)), (date(2024, 1, 15), date(2024, 1, 21)))


@register
def sql_query(spark, sf_dir):
    """SQL text over DataFrames, as a report author writes it."""
    return readers.read_query(
        spark,
        """SELECT CAST(time AS DATE) AS date, count(DISTINCT user_id) AS dau,
                  count_if(action = 'view') AS view, count_if(action = 'like') AS like
           FROM {feed} GROUP BY CAST(time AS DATE)
           HAVING CAST(time AS DATE) >= DATE '2024-01-24' AND CAST(time AS DATE) < DATE '2024-01-31'""",
        feed=_feed(spark, sf_dir),
    )


# Slot monitor


@register
def bucket15(spark, sf_dir):
    start = slot_start(day_of("time"), slot_seconds_of("time"))
    return (
        _feed(spark, sf_dir)
        .groupBy(start.alias("time"), slot_seconds_of("time").alias("slot"))
        .agg(F.count("*").alias("n"))
    )


@register
def slot_series(spark, sf_dir):
    return slots.slot_series(_feed(spark, sf_dir))


@register
def slot_series_as_of(spark, sf_dir):
    return slots.slot_series(_feed(spark, sf_dir), date(2024, 1, 30))


def _rounded_bands(df: DataFrame) -> DataFrame:
    return rounded(df, "value", "rolling_mean", "residual", "sigma", "mean", "upper", "lower", "deviation")


@register
def slot_bands(spark, sf_dir):
    return _rounded_bands(slots.slot_bands(_feed(spark, sf_dir)))


@register
def slot_anomalies(spark, sf_dir):
    return _rounded_bands(slots.slot_anomalies(_feed(spark, sf_dir)))


@register
def slot_alerts(spark, sf_dir):
    alerts = slots.alert_records(slots.slot_anomalies(_feed(spark, sf_dir)))
    return rounded(alerts, "value", "mean", "deviation")


@register
def slot_bands_all_slots(spark, sf_dir):
    """Every slot of the day. A narrow band makes the high and the low branch occur."""
    return _rounded_bands(slots.all_slot_bands(_feed(spark, sf_dir), z=1.1))


@register
def slot_alerts_all(spark, sf_dir):
    """Records of all slots with a narrow band, so that alarms and their text occur."""
    return rounded(slots.alert_records(slots.all_slot_bands(_feed(spark, sf_dir), z=1.1)), "value", "mean", "deviation")


@register
def live_slot_buckets(spark, sf_dir):
    """Closed buckets of the streaming monitor after it has read the whole table."""
    buckets, _ = slot_monitor.replay(spark, sf_dir)
    return spark.read.parquet(buckets).drop("day")


@register
def slot_series_past_day(spark, sf_dir):
    """A day inside the log: later days are not looked at."""
    return slots.slot_series(_feed(spark, sf_dir), date(2024, 1, 20))


@register
def live_slot_alerts(spark, sf_dir):
    """Alerts of the streaming monitor on every closed bucket."""
    _, alerts = slot_monitor.replay(spark, sf_dir)
    return rounded(spark.read.parquet(alerts).drop("day"), "value", "mean", "deviation")


@register
def keyed_slot_alerts(spark, sf_dir):
    """The same alerts from the detector's own state."""
    alerts = keyed_monitor.replay_detector(spark, sf_dir)
    return rounded(alerts.filter(~F.col("message").startswith("No action")), "value", "mean", "deviation")


@register
def silent_slots(spark, sf_dir):
    """Alarms for slots without any action."""
    alerts = keyed_monitor.replay_detector(spark, sf_dir)
    return rounded(alerts.filter(F.col("message").startswith("No action")), "value", "mean", "deviation")


# Retention


def _orders_input(spark, sf_dir):
    return fixtures.registrations(spark, sf_dir), fixtures.sessions(spark, sf_dir)


def _events_input(spark, sf_dir):
    return fixtures.event_registrations(spark, sf_dir), fixtures.event_sessions(spark, sf_dir)


@register
def retention_overall(spark, sf_dir):
    return retention.retention_overall(*_events_input(spark, sf_dir))


def _bits_of_two_runs(registrations, sessions, border: date) -> DataFrame:
    """The activity state of the sessions before a day, then of the others."""
    at = F.lit(retention.epoch_of(border))
    before = activity_bits.activity_bits(registrations, sessions.filter(F.col("auth_ts") < at))
    return activity_bits.merge_bits(cut_lineage(before), activity_bits.activity_bits(registrations, sessions.filter(F.col("auth_ts") >= at)))


@register
def retention_overall_bits(spark, sf_dir):
    return activity_bits.retention_curve(_bits_of_two_runs(*_events_input(spark, sf_dir), date(2024, 1, 20)))


@register
def retention_cohorts_bits(spark, sf_dir):
    return activity_bits.cohort_curves(_bits_of_two_runs(*_orders_input(spark, sf_dir), date(1996, 1, 1)), HORIZON)


@register
def retention_overall_sparse(spark, sf_dir):
    return retention.retention_overall(*_orders_input(spark, sf_dir))


@register
def retention_cohorts(spark, sf_dir):
    return retention.retention_cohorts(*_orders_input(spark, sf_dir), horizon=HORIZON)


@register
def retention_cohorts_since(spark, sf_dir):
    return retention.retention_cohorts(*_orders_input(spark, sf_dir), HORIZON, date(1996, 1, 1))


@register
def retention_cohort_matrix(spark, sf_dir):
    long = retention.retention_cohorts(*_events_input(spark, sf_dir), horizon=HORIZON)
    return retention.retention_matrix(long, HORIZON)


@register
def retention_range(spark, sf_dir):
    return retention.retention_range(*_orders_input(spark, sf_dir), HORIZON, *REGISTERED)


@register
def retention_range_inclusive(spark, sf_dir):
    return retention.retention_range(
        *_orders_input(spark, sf_dir), HORIZON, *REGISTERED, inclusive_instant=True
    )


@register
def whole_days_since_registration(spark, sf_dir):
    actions = fixtures.events(spark, sf_dir).select("user_id", F.col("ts").alias("time"))
    # Backwards too: a negative part of a day must round down.
    forward, backward = whole_days("first_time", "time"), whole_days("time", "first_time")
    return (
        first_seen.with_first_seen(actions)
        .groupBy(forward.alias("days"), backward.alias("days_back"))
        .agg(F.count("*").alias("n"))
    )


@register
def month_cohort(spark, sf_dir):
    registered = epoch_to_timestamp("reg_ts")
    return (
        fixtures.registrations(spark, sf_dir)
        .groupBy(month_of(registered).alias("month"), year_month_text(registered).alias("label"))
        .agg(F.count("*").alias("n"))
    )


# Unit productivity


def _units(spark, sf_dir):
    return fixtures.unit_reports(spark, sf_dir)


@register
def tenure_curve(spark, sf_dir):
    return units.tenure_curve(_units(spark, sf_dir), COHORTS)


@register
def tenure_curve_head(spark, sf_dir):
    return tenure_curve(spark, sf_dir).orderBy("cohort", "tenure_days").limit(5)


@register
def unit_rates(spark, sf_dir):
    return units.unit_rates(_units(spark, sf_dir), COHORTS)


@register
def unit_rate_by_cohort(spark, sf_dir):
    rates = units.unit_rates(_units(spark, sf_dir), COHORTS)
    return rounded(units.unit_rate_by_cohort(rates), "mean_rate")


@register
def unit_rates_early(spark, sf_dir):
    return units.unit_rates(_units(spark, sf_dir), COHORTS, units.EARLY_TENURE_DAYS)


@register
def unit_rate_early_by_cohort(spark, sf_dir):
    rates = units.unit_rates(_units(spark, sf_dir), COHORTS, units.EARLY_TENURE_DAYS)
    return rounded(units.unit_rate_by_cohort(rates), "mean_rate")


@register
def unit_rate_histogram(spark, sf_dir):
    rates = units.unit_rates(_units(spark, sf_dir), COHORTS)
    return rounded(distribution.histogram(rates, "cohort", GENERATIONS, "rate", 50), "low", "high")


@register
def latest_report(spark, sf_dir):
    return _units(spark, sf_dir).agg(F.max("reported_date").alias("latest"))


# Experiment


def _experiment(spark, sf_dir):
    return fixtures.experiment(spark, sf_dir)


@register
def ab_summary(spark, sf_dir):
    return rounded(experiment.ab_summary(_experiment(spark, sf_dir)), "arppu", "arpu")


@register
def ab_summary_text(spark, sf_dir):
    return experiment.ab_summary_text(experiment.ab_summary(_experiment(spark, sf_dir)))


@register
def ab_describe_payers(spark, sf_dir):
    described = experiment.describe_payers(_experiment(spark, sf_dir))
    return rounded(described, "mean", "std", "q25", "q50", "q75")


@register
def ab_describe_payers_ranged(spark, sf_dir):
    """The same with ranks found range by range, the way that large inputs take."""
    described = experiment.describe_payers(_experiment(spark, sf_dir), max_in_task=20)
    return rounded(described, "mean", "std", "q25", "q50", "q75")


@register
def ab_outlier_sensitivity(spark, sf_dir):
    compared = experiment.outlier_sensitivity(_experiment(spark, sf_dir), OUTLIER_CUT)
    return rounded(compared, "arpu", "q25", "q50", "q75")


@register
def histogram_users(spark, sf_dir):
    table = _experiment(spark, sf_dir)
    return rounded(distribution.histogram(table, "testgroup", GROUPS, "revenue", 30), "low", "high")


@register
def histogram_payers(spark, sf_dir):
    payers = _experiment(spark, sf_dir).filter(F.col("revenue") > 0)
    return rounded(distribution.histogram(payers, "testgroup", GROUPS, "revenue", 30), "low", "high")


@register
def box_payers(spark, sf_dir):
    payers = _experiment(spark, sf_dir).filter(F.col("revenue") > 0)
    return rounded(distribution.box_summary(payers, "testgroup", GROUPS, "revenue"), "q25", "q50", "q75")


@register
def box_payers_cut(spark, sf_dir):
    payers = experiment.without_outliers(_experiment(spark, sf_dir).filter(F.col("revenue") > 0), OUTLIER_CUT)
    return rounded(distribution.box_summary(payers, "testgroup", GROUPS, "revenue"), "q25", "q50", "q75")


@register
def mann_whitney_ab(spark, sf_dir):
    return _rank_test(_experiment(spark, sf_dir))


def _rank_test(table: DataFrame) -> DataFrame:
    test = rank_test.mann_whitney(table, "testgroup", "revenue", GROUPS)
    return rounded(rounded(test, "sigma_u", "z"), "p_value", scale=8)


@register
def mann_whitney_all_days(spark, sf_dir):
    """An experiment that lasts as long as the log."""
    return _rank_test(fixtures.experiment(spark, sf_dir, first=None))


# Bootstrap


# The study's numbers of replicas.
AB_REPLICAS, UNIT_REPLICAS = 10_000, 2_000


def _rounded_test(replicas: DataFrame, scale: int = 8) -> DataFrame:
    test = resample.summarise_replicas(replicas)
    return rounded(test, "mean", "sigma", "ci_low", "ci_high", "z", "p_value", scale=scale)


def _ab_pairs(spark, sf_dir, table: DataFrame | None = None, **options) -> DataFrame:
    table = _experiment(spark, sf_dir) if table is None else table
    options = {"replicas": AB_REPLICAS, "method": "paired", "seed": 7} | options
    return resample.bootstrap_replicas(table, "testgroup", "revenue", GROUPS, **options)


@register
def bootstrap_ab(spark, sf_dir):
    """Pairs of drawn positions, mean of the differences, all users."""
    return _rounded_test(_ab_pairs(spark, sf_dir))


@register
def bootstrap_ab_cut(spark, sf_dir):
    return _rounded_test(_ab_pairs(spark, sf_dir, experiment.without_outliers(_experiment(spark, sf_dir), OUTLIER_CUT)))


@register
def bootstrap_ab_paired(spark, sf_dir):
    """An experiment that lasts as long as the log."""
    return _rounded_test(_ab_pairs(spark, sf_dir, fixtures.experiment(spark, sf_dir, first=None)))


def _beside_closed_form(replicas: DataFrame, table: DataFrame, group: str, value: str, labels, draws: str = "max") -> DataFrame:
    """Mean and sigma of drawn replicas beside what the draws must give: the difference of means, and
    the root of the summed population variances over the number of draws. Draws of the own size are by Poisson
    weights, whose sum varies: sigma is off by a share of two rows of the smaller group at most."""
    of = lambda f, label: f(F.when(F.col(group) == label, F.col(value)))
    a, b = labels
    larger = F.greatest(of(F.count, a), of(F.count, b))
    size = {label: larger if draws == "max" else of(F.count, label) for label in labels}
    expected = table.agg(
        (of(F.avg, a) - of(F.avg, b)).alias("expected_mean"),
        F.sqrt(of(F.var_pop, a) / size[a] + of(F.var_pop, b) / size[b]).alias("expected_sigma"),
        (F.lit(0.0) if draws == "max" else 2 / F.least(*size.values())).alias("slack"),
    )
    return _beside(replicas, expected)


def _beside(replicas: DataFrame, expected: DataFrame) -> DataFrame:
    """Replicas beside the one row of ``expected(expected_mean, expected_sigma, slack)``. ``*_fits`` tells
    whether mean and sigma are within five standard errors, and ``slack`` times sigma."""
    drawn = replicas.agg(F.count("*").alias("replicas"), F.avg("stat").alias("mean"), F.stddev_pop("stat").alias("sigma"))
    # Both are one row; they become one by an aggregate over their union.
    both = drawn.unionByName(expected, allowMissingColumns=True)
    names = ("replicas", "mean", "sigma", "expected_mean", "expected_sigma", "slack")
    row = both.agg(*[F.max(c).alias(c) for c in names])
    error = F.col("expected_sigma") / F.sqrt("replicas")
    slack = F.col("expected_sigma") * F.col("slack")
    return rounded(
        row.select(
            "replicas",
            "expected_mean",
            "expected_sigma",
            (F.abs(F.col("mean") - F.col("expected_mean")) <= 5 * error).alias("mean_fits"),
            (F.abs(F.col("sigma") - F.col("expected_sigma")) <= 5 * error + slack).alias("sigma_fits"),
        ),
        "expected_mean",
        "expected_sigma",
    )


@register
def bootstrap_ab_multinomial(spark, sf_dir):
    """Draws by distinct value."""
    table = _experiment(spark, sf_dir)
    replicas = resample.bootstrap_replicas(table, "testgroup", "revenue", GROUPS, replicas=AB_REPLICAS)
    return _beside_closed_form(replicas, table, "testgroup", "revenue", GROUPS)


def _beside_order_statistic(spark, sf_dir, probability: float) -> DataFrame:
    """Replicas of a quantile of the differences beside the closed form: a replica is at or below the
    quantile of all pairs of users if enough of its draws are, whose number is binomial. ``share_fits`` tells
    whether as many replicas are as must be, within five standard errors and the step of one draw."""
    table = _experiment(spark, sf_dir)
    replicas = resample.bootstrap_replicas(table, "testgroup", "revenue", GROUPS, replicas=AB_REPLICAS, method="order", statistic=probability, seed=7)
    both = replica_state.collapsed(table, "testgroup", "revenue", GROUPS)
    quantile = float(both.difference_quantiles(np.array([probability]))[0])
    share, draws = both.share_up_to(quantile), int(max(both.first_up_to[-1], both.second_up_to[-1]))
    z = (draws * share - draws * probability) / math.sqrt(max(draws * share * (1 - share), 1e-12))
    expected = 0.5 * (1 + math.erf(z / math.sqrt(2)))
    slack = 2.5 / math.sqrt(AB_REPLICAS) + 1 / math.sqrt(draws)
    found = replicas.agg(F.count("stat").alias("replicas"), F.avg((F.col("stat") <= quantile).cast("double")).alias("found"))
    return found.select(
        "replicas",
        F.round(F.lit(quantile), 6).alias("pair_quantile"),
        F.round(F.lit(share), 6).alias("pair_share"),
        (F.abs(F.col("found") - expected) <= slack).alias("share_fits"),
    )


@register
def bootstrap_ab_median(spark, sf_dir):
    """The median of the paired differences of every replica."""
    return rounded(_ab_pairs(spark, sf_dir, statistic="median"), "stat", scale=5)


@register
def bootstrap_ab_quantile(spark, sf_dir):
    return _beside_order_statistic(spark, sf_dir, 0.9)


@register
def bootstrap_ab_statistic(spark, sf_dir):
    """A statistic in Python: the share of pairs in which the first user spent more."""
    table = _experiment(spark, sf_dir)
    replicas = resample.bootstrap_replicas(
        table, "testgroup", "revenue", GROUPS, replicas=AB_REPLICAS, method="vector", statistic=lambda d: (d > 0).mean(), seed=7
    )
    both = replica_state.collapsed(table, "testgroup", "revenue", GROUPS)
    more, draws = 1 - both.share_up_to(0.0), int(max(both.first_up_to[-1], both.second_up_to[-1]))
    return _beside(replicas, spark.range(1).select(F.lit(more).alias("expected_mean"), F.lit(math.sqrt(more * (1 - more) / draws)).alias("expected_sigma"), F.lit(0.0).alias("slack")))


@register
def bootstrap_ab_poisson(spark, sf_dir):
    """Weights by user, the whole test."""
    return _rounded_test(_ab_pairs(spark, sf_dir, method="poisson", draws="own", key="user_id"))


def _unit_test(spark, sf_dir, max_tenure, **options):
    rates = units.unit_rates(_units(spark, sf_dir), COHORTS, max_tenure)
    return resample.bootstrap_replicas(rates, "cohort", "rate", GENERATIONS, **options)


@register
def bootstrap_unit_rates(spark, sf_dir):
    return _rounded_test(_unit_test(spark, sf_dir, None, replicas=UNIT_REPLICAS, method="paired", seed=7), 5)


@register
def bootstrap_unit_rates_early(spark, sf_dir):
    early = _unit_test(spark, sf_dir, units.EARLY_TENURE_DAYS, replicas=UNIT_REPLICAS, method="paired", seed=7)
    return _rounded_test(early, 5)


@register
def bootstrap_unit_rates_multinomial(spark, sf_dir):
    """Draws by distinct value."""
    rates = units.unit_rates(_units(spark, sf_dir), COHORTS)
    replicas = resample.bootstrap_replicas(rates, "cohort", "rate", GENERATIONS, replicas=UNIT_REPLICAS)
    return _beside_closed_form(replicas, rates, "cohort", "rate", GENERATIONS)


@register
def bootstrap_unit_rates_poisson(spark, sf_dir):
    """Weights by unit, a row per replica."""
    options = {"replicas": UNIT_REPLICAS, "method": "poisson", "draws": "own", "key": "dwarf_id", "seed": 3}
    return rounded(_unit_test(spark, sf_dir, None, **options), "stat")


@register
def bootstrap_histogram(spark, sf_dir):
    """The replicas in 50 bins, as the study draws them."""
    replicas = rounded(_ab_pairs(spark, sf_dir), "stat", scale=8)
    bins = distribution.histogram(replicas.withColumn("all", F.lit("all")), "all", ("all",), "stat", 50)
    return rounded(bins, "low", "high", scale=8)


@register
def ab_summary_all_days(spark, sf_dir):
    """An experiment that lasts as long as the log."""
    whole = fixtures.experiment(spark, sf_dir, first=None)
    return rounded(experiment.ab_summary(whole), "conversion", "arppu", "arpu")


# Landed files: written as delimited text to the shared folder and read back


def _landed(df: DataFrame, sep: str) -> str:
    path = scratch_folder(df.sparkSession)
    df.write.option("header", True).option("sep", sep).option("dateFormat", "yyyy-MM-dd").csv(path)
    return path


@register
def csv_registrations(spark, sf_dir):
    path = _landed(fixtures.registrations(spark, sf_dir).select("reg_ts", "uid"), ";")
    return readers.read_registrations_csv(spark, path)


@register
def csv_sessions(spark, sf_dir):
    path = _landed(fixtures.sessions(spark, sf_dir).select("auth_ts", "uid"), ";")
    return readers.read_sessions_csv(spark, path)


@register
def csv_experiment(spark, sf_dir):
    path = _landed(fixtures.experiment(spark, sf_dir).select("user_id", "revenue", "testgroup"), ";")
    return readers.read_experiment_csv(spark, path)


@register
def csv_unit_reports(spark, sf_dir):
    columns = ("dwarf_id", "hired_date", "reported_date", "gold_mined", "hammer_date")
    path = _landed(fixtures.unit_reports(spark, sf_dir).select(*columns), ",")
    return readers.read_unit_reports_csv(spark, path)


# Input checks


@register
def audit_nulls(spark, sf_dir):
    return audit.null_counts(fixtures.events(spark, sf_dir))


@register
def audit_types(spark, sf_dir):
    return audit.column_types(fixtures.events(spark, sf_dir))


@register
def audit_duplicates(spark, sf_dir):
    """Over all columns. Every third unit is delivered a second time, so that there are copies."""
    reports = _units(spark, sf_dir)
    return audit.duplicate_rows(reports.unionByName(reports.filter("dwarf_id % 3 = 0")))


def _profiled(spark, sf_dir) -> tuple[DataFrame, DataFrame]:
    """Reports and their profile, from states of two halves."""
    reports = _units(spark, sf_dir)
    twice = reports.unionByName(reports.filter("dwarf_id % 3 = 0"))
    halves = [profile.profile_state(twice.filter(F.col("reported_date") < F.lit(date(1996, 1, 1))), ["dwarf_id"]), profile.profile_state(twice.filter(F.col("reported_date") >= F.lit(date(1996, 1, 1))), ["dwarf_id"])]
    return twice, profile.merge_states(*halves)


@register
def audit_profile(spark, sf_dir):
    """Rows, duplicates and uniqueness of the key from one state."""
    state = cut_lineage(_profiled(spark, sf_dir)[1])
    counted, unique = profile.duplicates_of(state), profile.uniqueness_of(state)
    # Both are one row.
    return counted.join(F.broadcast(unique), counted["rows"] == unique["n_rows"]).drop("n_rows")


@register
def audit_profile_columns(spark, sf_dir):
    events = fixtures.events(spark, sf_dir)
    return profile.profile(events)[0]


@register
def audit_key_unique(spark, sf_dir):
    unique = audit.key_uniqueness(fixtures.registrations(spark, sf_dir), "uid")
    repeated = audit.key_uniqueness(fixtures.sessions(spark, sf_dir), "uid")
    return unique.withColumn("input", F.lit("registrations")).unionByName(
        repeated.withColumn("input", F.lit("sessions"))
    )


@register
def audit_unmatched(spark, sf_dir):
    """Sessions without a registration, and customers that never ordered."""
    sessions, registrations = fixtures.sessions(spark, sf_dir), fixtures.registrations(spark, sf_dir)
    customers = fixtures.customers(spark, sf_dir).select(F.col("c_custkey").alias("uid"))
    checks = {"sessions": sessions, "customers": customers}
    counted = [audit.unmatched_rows(df, registrations, "uid").withColumn("input", F.lit(n)) for n, df in checks.items()]
    return counted[0].unionByName(counted[1])


# In-game event


def _event_actions(spark, sf_dir):
    return fixtures.events(spark, sf_dir).select(
        "user_id", F.col("ts").alias("time"), "event_type", F.col("value").cast("decimal(18,2)").alias("amount")
    )


EVENT_DAYS = (date(2024, 1, 3), date(2024, 1, 5))


def _saw_event() -> Column:
    return (F.col("event_type") == "view") & daily.in_days("time", *EVENT_DAYS)


def _first_step() -> Column:
    return (F.col("event_type") == "click") & daily.in_days("time", *EVENT_DAYS)


def _exposed(spark, sf_dir, with_step=True):
    step = _first_step() if with_step else None
    return ingame.exposed_users(_event_actions(spark, sf_dir), _saw_event(), step)


@register
def event_exposed(spark, sf_dir):
    return _exposed(spark, sf_dir)


def _activity(spark, sf_dir, with_step):
    gap = 4 * 3600  # long, for the test users act rarely
    actions = _event_actions(spark, sf_dir)
    in_reach = ingame.reachable(actions, *EVENT_DAYS, horizon=max(ingame.ACTIVITY_DAYS), session_gap=gap)
    return ingame.event_activity_by_day(in_reach, _exposed(spark, sf_dir, with_step), session_gap=gap)


@register
def event_activity_by_day(spark, sf_dir):
    return _activity(spark, sf_dir, False)


@register
def event_split_activity(spark, sf_dir):
    return _activity(spark, sf_dir, True)


def _event_retention(spark, sf_dir, with_step):
    actions = _event_actions(spark, sf_dir)
    in_reach = ingame.reachable(actions, *EVENT_DAYS, horizon=max(ingame.RETENTION_DAYS))
    return ingame.event_retention(in_reach, _exposed(spark, sf_dir, with_step))


@register
def event_retention(spark, sf_dir):
    return _event_retention(spark, sf_dir, False)


@register
def event_split_retention(spark, sf_dir):
    return _event_retention(spark, sf_dir, True)


def _payments(spark, sf_dir):
    paid = _event_actions(spark, sf_dir).filter(F.col("event_type") == "purchase")
    return ingame.reachable(paid, *EVENT_DAYS, horizon=30)


@register
def ltv_30(spark, sf_dir):
    return ingame.event_revenue(_payments(spark, sf_dir), _exposed(spark, sf_dir, False))


@register
def event_split_ltv(spark, sf_dir):
    return ingame.event_revenue(_payments(spark, sf_dir), _exposed(spark, sf_dir), (7, 14, 30))


@register
def reactivated_users(spark, sf_dir):
    return ingame.reactivated_users(_event_actions(spark, sf_dir), 3)


@register
def event_participation(spark, sf_dir):
    return ingame.event_participation(_exposed(spark, sf_dir))


@register
def event_funnel(spark, sf_dir):
    steps = [(name, F.col("event_type") == name) for name in ("view", "click", "purchase")]
    return ingame.event_funnel(_event_actions(spark, sf_dir), steps)


@register
def event_funnel_days(spark, sf_dir):
    """The same funnel from stored days, for the days of one week."""
    steps = {name: F.col("event_type") == name for name in ("view", "click", "purchase")}
    days = cut_lineage(ingame.funnel_days(_event_actions(spark, sf_dir), list(steps.items())))
    week = days.filter(F.col("day").between(F.lit(date(2024, 1, 8)), F.lit(date(2024, 1, 14))))
    return ingame.funnel_of_days(week, list(steps))


@register
def revenue_box_of_days(spark, sf_dir):
    """Boxes of amounts from sketches by day, for a span of days. ``q<p>_fits`` tells whether the rank of the sketched
    quantile is off by no more than stated; a tie covers a range of ranks."""
    first, last = date(2024, 1, 5), date(2024, 1, 25)
    events = fixtures.events(spark, sf_dir)
    boxes = value_sketches.box_of_days(cut_lineage(value_sketches.day_sketches(events, "event_type", day_of("ts"), "value")), first, last)
    in_span = events.filter(daily.in_days("ts", first, last) & F.col("value").isNotNull() & ~F.isnan("value"))
    ranks = in_span.select(F.col("event_type").alias("group"), "value").join(F.broadcast(boxes), "group").groupBy("group", "n", "low", "high").agg(
        *(F.count_if(F.col("value") < F.col(q)).alias(f"below_{q}") for q in ("q25", "q50", "q75")),
        *(F.count_if(F.col("value") <= F.col(q)).alias(f"up_to_{q}") for q in ("q25", "q50", "q75")),
    )
    slack = value_sketches.RANK_ERROR * F.col("n") + 1
    fits = [
        ((F.col(f"below_{q}") - slack <= F.col("n") * p) & (F.col(f"up_to_{q}") + slack >= F.col("n") * p)).alias(f"{q}_fits")
        for q, p in (("q25", 0.25), ("q50", 0.5), ("q75", 0.75))
    ]
    return ranks.select(F.col("group").alias("event_type"), "n", "low", "high", *fits)


@register
def choice_share(spark, sf_dir):
    return ingame.choice_share(_event_actions(spark, sf_dir), "event_type")


@register
def event_churn(spark, sf_dir):
    """Two events of a day each, taken part in by a purchase, and the day after the second."""
    spans = [(date(2024, 1, a), date(2024, 1, b)) for a, b in ((9, 9), (10, 10), (11, 11))]
    return ingame.event_churn(_event_actions(spark, sf_dir), F.col("event_type") == "purchase", *spans)
