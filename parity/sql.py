"""The registered queries in SQL, in the most literal form rather than the fastest."""

from __future__ import annotations

from actionlens.operators.resample import poisson_thresholds

ACTIONS_CTE = """
feed AS (
  SELECT user_id, ts AS time, CASE event_type WHEN 'click' THEN 'like' ELSE event_type END AS action
  FROM events WHERE event_type <> 'purchase'),
actions AS (
  SELECT user_id, time, action FROM feed
  UNION ALL
  SELECT user_id, ts AS time, 'mess' AS action FROM events WHERE event_type = 'purchase')
"""

# Users of each day by what they did.
SEEN_CTE = """
seen AS (
  SELECT DISTINCT day, user_id, segment FROM (
    SELECT CAST(time AS DATE) AS day, user_id,
           unnest(['users', CASE action WHEN 'view' THEN 'viewers' WHEN 'like' THEN 'likers' WHEN 'mess' THEN 'writers' END]) AS segment
    FROM actions WHERE user_id IS NOT NULL)
  WHERE segment IS NOT NULL)
"""

ORDERS_CTE = """
regs AS (
  SELECT o_custkey AS uid, CAST(floor(epoch(min(o_orderdate))) AS BIGINT) AS reg_ts
  FROM orders GROUP BY o_custkey),
auths AS (SELECT o_custkey AS uid, CAST(floor(epoch(o_orderdate)) AS BIGINT) AS auth_ts FROM orders)
"""

EVENTS_CTE = """
regs AS (
  SELECT user_id AS uid, CAST(floor(epoch(min(ts))) AS BIGINT) AS reg_ts FROM events GROUP BY user_id),
auths AS (SELECT user_id AS uid, CAST(floor(epoch(ts)) AS BIGINT) AS auth_ts FROM events)
"""

UNITS_CTE = """
reports AS (
  SELECT o_custkey AS dwarf_id,
         CAST(min(o_orderdate) OVER (PARTITION BY o_custkey) AS DATE) AS hired_date,
         CAST(o_orderdate AS DATE) AS reported_date,
         CAST(o_totalprice AS DECIMAL(18,2)) AS gold_mined,
         CASE WHEN o_custkey % 2 = 0 THEN '2014-01-01' ELSE '2015-01-01' END AS hammer_date
  FROM orders),
counted AS (
  SELECT hammer_date AS cohort, dwarf_id, CAST(reported_date - hired_date AS BIGINT) AS tenure_days, gold_mined
  FROM reports
  WHERE (hammer_date = '2014-01-01' AND reported_date < DATE '1999-01-01')
     OR (hammer_date = '2015-01-01' AND reported_date > DATE '1996-01-01'))
"""

EXPERIMENT_CTE = """
experiment AS (
  SELECT user_id, CASE WHEN user_id % 2 = 0 THEN 'a' ELSE 'b' END AS testgroup,
         coalesce(CAST(sum(CASE WHEN event_type = 'purchase' AND ts >= TIMESTAMP '2024-01-28 00:00:00'
                                THEN CAST(value AS DECIMAL(18,2)) END) AS DOUBLE), 0.0) AS revenue
  FROM events GROUP BY user_id)
"""


ALL_DAYS_CTE = EXPERIMENT_CTE.replace(" AND ts >= TIMESTAMP '2024-01-28 00:00:00'", "")


def _two_sided_p(z: str) -> str:
    """Complementary error function of |z| over the root of two, by the series of the error function."""
    x = f"least(abs({z}) / sqrt(2), 6)"
    term = f"exp(k * ln(2 * {x} * {x} + 1e-300) - lgamma(2 * k + 2) + k * ln(2) + lgamma(k + 1))"
    return f"1 - 2 / sqrt(pi()) * exp(-{x} * {x}) * {x} * list_sum(list_transform(range(0, 300), lambda k: {term}))"


# Daily reports


def _app(day_condition: str) -> str:
    return f"""
WITH {ACTIONS_CTE},
registered AS (SELECT user_id, min(time) AS date_reg FROM actions GROUP BY user_id),
labelled AS (
  SELECT a.user_id, a.time, a.action,
         CASE WHEN floor(epoch(a.time)) = floor(epoch(r.date_reg)) THEN 'new' ELSE 'old' END AS category
  FROM actions a LEFT JOIN registered r ON a.user_id = r.user_id)
SELECT CAST(time AS DATE) AS date,
       count(DISTINCT user_id) AS dau,
       count(DISTINCT CASE WHEN category = 'new' THEN user_id END) AS new_users,
       count(action) AS actions,
       floor(CAST(count(action) AS DOUBLE) / count(DISTINCT user_id) * 100) / 100 AS mean_user_actions,
       floor(CAST(count(*) FILTER (action = 'view') AS DOUBLE) / count(DISTINCT user_id) * 100) / 100 AS mean_user_views,
       floor(CAST(count(*) FILTER (action = 'like') AS DOUBLE) / count(DISTINCT user_id) * 100) / 100 AS mean_user_likes,
       floor(CAST(count(*) FILTER (action = 'mess') AS DOUBLE) / count(DISTINCT user_id) * 100) / 100 AS mean_user_messages
FROM labelled GROUP BY CAST(time AS DATE) HAVING {day_condition}
"""


def _feed(day_condition: str) -> str:
    return f"""
WITH {ACTIONS_CTE}
SELECT CAST(time AS DATE) AS date,
       count(DISTINCT user_id) AS dau,
       count(*) FILTER (action = 'view') AS view,
       count(*) FILTER (action = 'like') AS "like",
       floor(CAST(count(*) FILTER (action = 'like') AS DOUBLE)
             / nullif(count(*) FILTER (action = 'view'), 0) * 100 * 100) / 100 AS ctr
FROM feed GROUP BY CAST(time AS DATE) HAVING {day_condition}
"""


LAST_WEEK = "date >= DATE '2024-01-24' AND date < DATE '2024-01-31'"
YESTERDAY = "date = DATE '2024-01-30'"
FIRST_DAYS = "date >= DATE '2023-12-29' AND date < DATE '2024-01-05'"

DAILY = {
    "app_weekly_series": _app(LAST_WEEK),
    "app_first_days_series": _app(FIRST_DAYS),
    "app_series_from_maintained": _app(FIRST_DAYS),
    "app_daily_report": _app(YESTERDAY),
    "app_report_text": f"""
SELECT date,
       printf('App report for %s\nDaily audience: %d\nNew users: %d\nAll actions: %d\n'
              || 'Actions per user: %.2f\nViews per user: %.2f\nLikes per user: %.2f\nMessages per user: %.2f',
              CAST(date AS VARCHAR), dau, new_users, actions, mean_user_actions, mean_user_views,
              mean_user_likes, mean_user_messages) AS message
FROM ({_app(YESTERDAY)})
""",
    "feed_weekly_series": _feed(LAST_WEEK),
    "feed_daily_report": _feed(YESTERDAY),
    "feed_report_text": f"""
SELECT date, printf('Feed report for %s\ndau - %d\nview - %d\nlike - %d\nctr - %.2f%%',
                    CAST(date AS VARCHAR), dau, view, "like", ctr) AS message
FROM ({_feed(YESTERDAY)})
""",
    "union_actions": f"WITH {ACTIONS_CTE} SELECT action, count(*) AS n FROM actions GROUP BY action",
    "first_seen_users": f"WITH {ACTIONS_CTE} SELECT user_id, min(time) AS first_time FROM actions GROUP BY user_id",
    "first_seen_bucketed": f"WITH {ACTIONS_CTE} SELECT user_id, min(time) AS first_time FROM actions GROUP BY user_id",
    "label_new_actions": f"""
WITH {ACTIONS_CTE},
registered AS (SELECT user_id, min(time) AS date_reg FROM actions GROUP BY user_id),
labelled AS (
  SELECT a.time, CAST(floor(epoch(a.time)) - floor(epoch(r.date_reg)) AS BIGINT) AS distance
  FROM actions a LEFT JOIN registered r ON a.user_id = r.user_id)
SELECT CAST(time AS DATE) AS date, CASE WHEN distance = 0 THEN 'new' ELSE 'old' END AS category,
       count(*) AS n, max(distance) AS max_distance
FROM labelled GROUP BY 1, 2
""",
    "conditional_distinct": f"""
WITH {ACTIONS_CTE}
SELECT CAST(time AS DATE) AS date, count(DISTINCT user_id) AS users,
       count(DISTINCT user_id) FILTER (action = 'like') AS likers
FROM feed GROUP BY 1
""",
    "distinct_users_28_days": f"""
WITH {ACTIONS_CTE}, {SEEN_CTE},
ends AS (SELECT CAST(unnest(range(DATE '2024-01-01', DATE '2024-02-01', INTERVAL 1 DAY)) AS DATE) AS date)
SELECT date, segment, count(DISTINCT user_id) FILTER (day = date) AS users_1,
       count(DISTINCT user_id) FILTER (day > date - 7) AS users_7, count(DISTINCT user_id) AS users_28
FROM ends JOIN seen ON day BETWEEN date - 27 AND date
GROUP BY date, segment
""",
    "distinct_users_of_two_weeks": f"""
WITH {ACTIONS_CTE}, {SEEN_CTE},
both_weeks AS (
  SELECT segment, user_id FROM seen WHERE day BETWEEN DATE '2024-01-01' AND DATE '2024-01-07'
  INTERSECT SELECT segment, user_id FROM seen WHERE day BETWEEN DATE '2024-01-15' AND DATE '2024-01-21')
SELECT segment, count(*) AS users FROM both_weeks GROUP BY segment
""",
    "sql_query": f"""
WITH {ACTIONS_CTE}
SELECT CAST(time AS DATE) AS date, count(DISTINCT user_id) AS dau,
       count(*) FILTER (action = 'view') AS view, count(*) FILTER (action = 'like') AS "like"
FROM feed GROUP BY 1 HAVING {LAST_WEEK}
""",
}

# Slot monitor

BUCKETS_CTE = """
buckets AS (
  SELECT time_bucket(INTERVAL '15 minutes', time) AS time,
         count(DISTINCT user_id) AS activ_users,
         count(action) AS actions,
         count(*) FILTER (action = 'view') AS views,
         count(*) FILTER (action = 'like') AS likes,
         CAST(count(*) FILTER (action = 'like') AS DOUBLE)
           / nullif(count(*) FILTER (action = 'view'), 0) AS ctr
  FROM feed GROUP BY 1)
"""


def _slot_series(first_day: str) -> str:
    """Slot list joined to the bucket aggregates, as the report states it."""
    return f"""
{ACTIONS_CTE}, {BUCKETS_CTE},
marks AS (
  SELECT DISTINCT CAST(time AS DATE) AS day, time_bucket(INTERVAL '15 minutes', time) AS bucket,
         epoch(time_bucket(INTERVAL '15 minutes', time)) - epoch(CAST(CAST(time AS DATE) AS TIMESTAMP)) AS slot
  FROM feed),
anchor AS (SELECT max(bucket) - INTERVAL '15 minutes' AS bucket FROM marks),
series AS (
  SELECT m.bucket AS time, b.activ_users, b.actions, b.views, b.likes, b.ctr
  FROM marks m LEFT JOIN buckets b ON m.bucket = b.time
  WHERE m.slot = (SELECT slot FROM marks WHERE bucket = (SELECT bucket FROM anchor))
    AND m.day >= {first_day})
"""


DEFAULT_FIRST_DAY = "(SELECT CAST(bucket AS DATE) - 13 FROM anchor)"


def _bands(series: str, keys: str, partition: str, z: str) -> str:
    """Bands and verdicts over ``series``, one row per key and metric."""
    metrics = " UNION ALL ".join(
        f"SELECT {keys}, '{m}' AS metric, CAST({m} AS DOUBLE) AS value FROM {series}"
        for m in ("activ_users", "views", "likes", "ctr")
    )
    return f"""
long AS ({metrics}),
rolled AS (
  SELECT *, CASE WHEN count(value) OVER w < 3 THEN NULL
                 WHEN min(value) OVER w = max(value) OVER w THEN value ELSE avg(value) OVER w END AS rolling_mean
  FROM long WINDOW w AS (PARTITION BY {partition} ORDER BY time ROWS BETWEEN 2 PRECEDING AND CURRENT ROW)),
residuals AS (SELECT *, rolling_mean - value AS residual FROM rolled),
spread AS (
  SELECT *, stddev_pop(residual) OVER s AS sigma, avg(value) OVER s AS mean
  FROM residuals WINDOW s AS (PARTITION BY {partition})),
banded AS (SELECT *, rolling_mean + sigma * {z} AS upper, rolling_mean - sigma * {z} AS lower FROM spread),
judged AS (
  SELECT *, CASE WHEN value > upper THEN 'high' WHEN value < lower THEN 'low' ELSE 'none' END AS status
  FROM banded),
verdicts AS (
  SELECT *, CASE status WHEN 'high' THEN (value - mean) / nullif(mean, 0)
                        WHEN 'low' THEN (mean - value) / nullif(value, 0) END AS deviation
  FROM judged)
"""


BAND_COLUMNS = """metric, time, round(value, 6) AS value, round(rolling_mean, 6) AS rolling_mean,
round(residual, 6) AS residual, round(sigma, 6) AS sigma, round(mean, 6) AS mean,
round(upper, 6) AS upper, round(lower, 6) AS lower, status, round(deviation, 6) AS deviation"""

ALERT_COLUMNS = """metric, time, status, round(value, 6) AS value, round(mean, 6) AS mean,
round(deviation, 6) AS deviation"""

PAST_EVENTS = "FROM (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-21 00:00:00')"

ALERT_MESSAGE = """CASE WHEN status = 'none' THEN printf('metric %s: no anomaly', metric)
            ELSE printf('Anomaly found\nMetric: %s at %s\n%s the mean of the last 14 days by: %s\n'
                        || 'value now: %.2f\nmean: %.2f',
                        metric, strftime(time, '%Y-%m-%d %H:%M:%S'),
                        CASE status WHEN 'high' THEN 'above' ELSE 'below' END,
                        coalesce(printf('%.2f%%', round(deviation * 100, 2)), 'n/a'), round(value, 2), round(mean, 2)) END AS message"""

SLOT_BANDS = _bands("series", "time", "metric", "2.576")
LATEST = "time = (SELECT max(time) FROM series)"

LIVE_ALERTS = f"""
WITH {ACTIONS_CTE}, {BUCKETS_CTE},
closed AS (
  SELECT * FROM buckets
  WHERE time + INTERVAL '15 minutes' <= (SELECT max(time) - INTERVAL '15 minutes' FROM feed)),
series AS (
  SELECT c.time AS closed_at, b.*
  FROM closed c JOIN closed b
    ON b.time <= c.time AND b.time > c.time - INTERVAL '14 days'
   AND CAST(b.time AS TIME) = CAST(c.time AS TIME)),
{_bands("series", "closed_at, time", "closed_at, metric", "2.576")}
SELECT {ALERT_COLUMNS}, {ALERT_MESSAGE} FROM verdicts WHERE time = closed_at
"""

SLOTS = {
    "bucket15": f"""
WITH {ACTIONS_CTE}
SELECT time_bucket(INTERVAL '15 minutes', time) AS time,
       CAST(epoch(time_bucket(INTERVAL '15 minutes', time))
            - epoch(CAST(CAST(time AS DATE) AS TIMESTAMP)) AS BIGINT) AS slot,
       count(*) AS n
FROM feed GROUP BY 1, 2
""",
    "slot_series": f"WITH {_slot_series(DEFAULT_FIRST_DAY)} SELECT * FROM series",
    "slot_series_past_day": f"WITH {_slot_series("DATE '2024-01-20' - 13").replace("FROM events", PAST_EVENTS)} SELECT * FROM series",
    "slot_series_as_of": f"WITH {_slot_series("DATE '2024-01-30' - 13")} SELECT * FROM series",
    "slot_bands": f"WITH {_slot_series(DEFAULT_FIRST_DAY)}, {SLOT_BANDS} SELECT {BAND_COLUMNS} FROM verdicts",
    "slot_anomalies": f"""
WITH {_slot_series(DEFAULT_FIRST_DAY)}, {SLOT_BANDS} SELECT {BAND_COLUMNS} FROM verdicts WHERE {LATEST}
""",
    "slot_alerts": f"""
WITH {_slot_series(DEFAULT_FIRST_DAY)}, {SLOT_BANDS} SELECT {ALERT_COLUMNS}, {ALERT_MESSAGE} FROM verdicts WHERE {LATEST}
""",
    "slot_alerts_all": f"""
WITH {ACTIONS_CTE}, {BUCKETS_CTE},
series AS (
  SELECT *, CAST(epoch(time) - epoch(CAST(CAST(time AS DATE) AS TIMESTAMP)) AS BIGINT) AS slot FROM buckets),
{_bands("series", "slot, time", "slot, metric", "1.1")}
SELECT {ALERT_COLUMNS}, {ALERT_MESSAGE} FROM verdicts
""",
    "slot_bands_all_slots": f"""
WITH {ACTIONS_CTE}, {BUCKETS_CTE},
series AS (
  SELECT *, CAST(epoch(time) - epoch(CAST(CAST(time AS DATE) AS TIMESTAMP)) AS BIGINT) AS slot FROM buckets),
{_bands("series", "slot, time", "slot, metric", "1.1")}
SELECT slot, {BAND_COLUMNS} FROM verdicts
""",
    "live_slot_buckets": f"""
WITH {ACTIONS_CTE}, {BUCKETS_CTE}
SELECT * FROM buckets
WHERE time + INTERVAL '15 minutes' <= (SELECT max(time) - INTERVAL '15 minutes' FROM feed)
""",
    "live_slot_alerts": LIVE_ALERTS,
    "keyed_slot_alerts": LIVE_ALERTS,
    "silent_slots": f"""
WITH {ACTIONS_CTE}, {BUCKETS_CTE},
clock AS (SELECT date_trunc('second', max(time)) - INTERVAL '15 minutes' AS watermark FROM feed),
closed AS (SELECT * FROM buckets WHERE time + INTERVAL '15 minutes' <= (SELECT watermark FROM clock)),
days AS (SELECT unnest(range(CAST(min(time) AS DATE), CAST(max(time) AS DATE) + 2, INTERVAL 1 DAY)) AS day FROM closed),
expected AS (
  SELECT DISTINCT d.day + (c.time - CAST(CAST(c.time AS DATE) AS TIMESTAMP)) AS time
  FROM days d, closed c),
silent AS (
  SELECT time FROM expected
  WHERE time NOT IN (SELECT time FROM closed) AND time + INTERVAL '30 minutes' <= (SELECT watermark FROM clock)),
before AS (
  SELECT s.time, b.activ_users, b.views, b.likes, b.ctr
  FROM silent s JOIN closed b ON b.time < s.time AND b.time > s.time - INTERVAL '14 days' AND CAST(b.time AS TIME) = CAST(s.time AS TIME)),
means AS (
  SELECT time, unnest(['activ_users', 'views', 'likes', 'ctr']) AS metric, unnest([avg(activ_users), avg(views), avg(likes), avg(ctr)]) AS mean
  FROM before GROUP BY time HAVING count(*) >= 3)
SELECT metric, time, 'low' AS status, CAST(0 AS DOUBLE) AS value, round(mean, 6) AS mean, CAST(NULL AS DOUBLE) AS deviation,
       printf('No action at all\nMetric: %s at %s\nmean of the days before: %s', metric, strftime(time, '%Y-%m-%d %H:%M:%S'),
              coalesce(printf('%.2f', round(mean, 2)), 'n/a')) AS message
FROM means
""",
}

# Retention

DAY_NUMBER = "CAST(floor((a.auth_ts - r.reg_ts) / 86400.0) AS BIGINT)"


def _overall(cte: str) -> str:
    return f"""
WITH {cte},
per_day AS (
  SELECT {DAY_NUMBER} AS day_number, count(DISTINCT a.uid) AS unique_id
  FROM auths a JOIN regs r ON a.uid = r.uid WHERE {DAY_NUMBER} >= 0
  GROUP BY 1 ORDER BY 1 LIMIT 30)
SELECT day_number, unique_id,
       round_even(CAST(unique_id AS DOUBLE)
                  / (SELECT unique_id FROM per_day WHERE day_number = 0) * 100 * 100, 0) / 100 AS retention
FROM per_day
"""


def _cohorts(cte: str, cohort: str, reg_condition: str = "true") -> str:
    return f"""
WITH {cte},
per_cohort AS (
  SELECT {cohort} AS cohort, {DAY_NUMBER} AS day_number, count(DISTINCT a.uid) AS unique_id
  FROM auths a LEFT JOIN regs r ON a.uid = r.uid
  WHERE {reg_condition} AND {DAY_NUMBER} BETWEEN 0 AND 14
  GROUP BY 1, 2)
SELECT cohort, day_number, unique_id,
       CAST(unique_id AS DOUBLE) / max(CASE WHEN day_number = 0 THEN unique_id END) OVER (PARTITION BY cohort) AS share
FROM per_cohort
"""


MONTH = "CAST(date_trunc('month', TIMESTAMP '1970-01-01' + to_seconds(r.reg_ts)) AS DATE)"
LABEL = "strftime(TIMESTAMP '1970-01-01' + to_seconds(r.reg_ts), '%Y-%m')"
RANGE_FROM = "r.reg_ts >= epoch(TIMESTAMP '1995-03-01')"

RETENTION = {
    "retention_overall": _overall(EVENTS_CTE),
    "retention_overall_sparse": _overall(ORDERS_CTE),
    "retention_overall_bits": _overall(EVENTS_CTE),
    "retention_cohorts_bits": _cohorts(ORDERS_CTE, MONTH),
    "retention_cohorts": _cohorts(ORDERS_CTE, MONTH),
    "retention_cohorts_since": _cohorts(ORDERS_CTE, MONTH, "r.reg_ts >= epoch(TIMESTAMP '1996-01-01')"),
    "retention_cohort_matrix": "SELECT cohort, "
    + ", ".join(f"max(share) FILTER (day_number = {d}) AS day_{d}" for d in range(15))
    + f" FROM ({_cohorts(EVENTS_CTE, MONTH)}) GROUP BY cohort",
    "retention_range": _cohorts(ORDERS_CTE, LABEL, f"{RANGE_FROM} AND r.reg_ts < epoch(TIMESTAMP '1995-10-01')"),
    "retention_range_inclusive": _cohorts(
        ORDERS_CTE, LABEL, f"{RANGE_FROM} AND r.reg_ts <= epoch(TIMESTAMP '1995-10-01')"
    ),
    "whole_days_since_registration": """
WITH firsts AS (SELECT user_id, min(ts) AS first_time FROM events GROUP BY user_id)
SELECT CAST(floor((floor(epoch(ts)) - floor(epoch(first_time))) / 86400) AS BIGINT) AS days,
       CAST(floor((floor(epoch(first_time)) - floor(epoch(ts))) / 86400) AS BIGINT) AS days_back,
       count(*) AS n
FROM events JOIN firsts USING (user_id) GROUP BY 1, 2
""",
    "month_cohort": f"WITH {ORDERS_CTE} SELECT {MONTH} AS month, {LABEL} AS label, count(*) AS n FROM regs r GROUP BY 1, 2",
}

# Unit productivity


def _rates(condition: str = "true") -> str:
    return f"""
SELECT cohort, dwarf_id, coalesce(CAST(sum(gold_mined) AS DOUBLE), 0) AS gold, max(tenure_days) AS tenure,
       coalesce(CAST(sum(gold_mined) AS DOUBLE), 0) / nullif(max(tenure_days), 0) AS rate
FROM counted WHERE {condition} GROUP BY cohort, dwarf_id
"""


def _rounded_rates(condition: str = "true") -> str:
    return f"""
WITH {UNITS_CTE}
SELECT cohort, dwarf_id, gold, tenure, rate FROM ({_rates(condition)})
"""


def _rate_by_cohort(condition: str = "true") -> str:
    return f"""
WITH {UNITS_CTE}
SELECT cohort, count(*) AS n_units, count(*) FILTER (rate IS NULL) AS n_excluded, round(avg(rate), 6) AS mean_rate
FROM ({_rates(condition)}) GROUP BY cohort
"""


def _histogram(table: str, group: str, value: str, bins: int, scale: int) -> str:
    """Body of a histogram query; ``table`` is a CTE with the group and the value."""
    return f"""
limits AS (
  SELECT g, CASE WHEN lo = hi THEN lo - 0.5 ELSE lo END AS lo,
         CASE WHEN lo = hi THEN 1.0 ELSE hi - lo END / {bins} AS width
  FROM (SELECT {group} AS g, min({value}) AS lo, max({value}) AS hi
        FROM {table} WHERE {value} IS NOT NULL GROUP BY 1)),
binned AS (
  SELECT g, lo, width,
         CAST(least({bins}, floor(({value} - lo) / width) + 1) AS BIGINT) AS bin
  FROM {table} JOIN limits ON {group} = g WHERE {value} IS NOT NULL)
SELECT g AS {group}, bin, round(lo + width * (bin - 1), {scale}) AS low, round(lo + width * bin, {scale}) AS high,
       count(*) AS n
FROM binned GROUP BY g, bin, lo, width
"""


UNITS = {
    "tenure_curve": f"""
WITH {UNITS_CTE} SELECT cohort, tenure_days, CAST(sum(gold_mined) AS DOUBLE) / count(gold_mined) AS mean_gold FROM counted GROUP BY 1, 2
""",
    "tenure_curve_head": f"""
WITH {UNITS_CTE} SELECT cohort, tenure_days, CAST(sum(gold_mined) AS DOUBLE) / count(gold_mined) AS mean_gold FROM counted GROUP BY 1, 2
ORDER BY 1, 2 LIMIT 5
""",
    "unit_rates": _rounded_rates(),
    "unit_rate_by_cohort": _rate_by_cohort(),
    "unit_rates_early": _rounded_rates("tenure_days <= 30"),
    "unit_rate_early_by_cohort": _rate_by_cohort("tenure_days <= 30"),
    "unit_rate_histogram": f"WITH {UNITS_CTE}, rates AS ({_rates()}), {_histogram('rates', 'cohort', 'rate', 50, 6)}",
    "latest_report": f"WITH {UNITS_CTE} SELECT max(reported_date) AS latest FROM reports",
}

# Experiment

QUARTILES = """round(quantile_cont(revenue, 0.25), 6) AS q25, round(quantile_cont(revenue, 0.5), 6) AS q50,
round(quantile_cont(revenue, 0.75), 6) AS q75"""

DESCRIBE = f"""
WITH {EXPERIMENT_CTE}
SELECT testgroup, count(*) AS n, round(avg(revenue), 6) AS mean, round(stddev_samp(revenue), 6) AS std,
       min(revenue) AS min, {QUARTILES}, max(revenue) AS max
FROM experiment WHERE revenue > 0 GROUP BY testgroup
"""

AB_SUMMARY = """
SELECT testgroup, count(*) AS users, count(*) FILTER (revenue > 0) AS payers,
       CAST(count(*) FILTER (revenue > 0) AS DOUBLE) / count(*) AS conversion,
       avg(revenue) FILTER (revenue > 0) AS arppu, avg(revenue) AS arpu
FROM experiment GROUP BY testgroup
"""


def _variant(name: str, condition: str) -> str:
    return f"""
SELECT testgroup, '{name}' AS variant, count(*) AS users, count(*) FILTER (revenue > 0) AS payers,
       CAST(count(*) FILTER (revenue > 0) AS DOUBLE) / count(*) AS conversion, round(avg(revenue), 6) AS arpu,
       round(quantile_cont(revenue, 0.25) FILTER (revenue > 0), 6) AS q25,
       round(quantile_cont(revenue, 0.5) FILTER (revenue > 0), 6) AS q50,
       round(quantile_cont(revenue, 0.75) FILTER (revenue > 0), 6) AS q75
FROM experiment WHERE {condition} GROUP BY testgroup
"""


def _box(condition: str) -> str:
    return f"""
WITH {EXPERIMENT_CTE},
payers AS (SELECT * FROM experiment WHERE revenue > 0 AND {condition}),
q AS (
  SELECT testgroup, quantile_cont(revenue, 0.25) AS q25, quantile_cont(revenue, 0.5) AS q50,
         quantile_cont(revenue, 0.75) AS q75
  FROM payers GROUP BY testgroup),
marked AS (
  SELECT *, revenue BETWEEN q25 - 1.5 * (q75 - q25) AND q75 + 1.5 * (q75 - q25) AS inside
  FROM payers JOIN q USING (testgroup))
SELECT testgroup, round(q25, 6) AS q25, round(q50, 6) AS q50, round(q75, 6) AS q75,
       min(revenue) FILTER (inside) AS whisker_low, max(revenue) FILTER (inside) AS whisker_high,
       count(*) FILTER (NOT inside) AS n_outliers
FROM marked GROUP BY testgroup, q25, q50, q75
"""


RANK_TEST = f"""
WITH {EXPERIMENT_CTE},
ranked AS (
  SELECT testgroup, revenue,
         rank() OVER (ORDER BY revenue) + (count(*) OVER (PARTITION BY revenue) - 1) / 2.0 AS r,
         count(*) OVER (PARTITION BY revenue) AS t
  FROM experiment),
sums AS (
  SELECT CAST(count(*) FILTER (testgroup = 'a') AS DOUBLE) AS n1, CAST(count(*) FILTER (testgroup = 'b') AS DOUBLE) AS n2,
         CAST(sum(r) FILTER (testgroup = 'a') AS DOUBLE) AS rank_sum, CAST(sum(t * t - 1) AS DOUBLE) AS ties
  FROM ranked),
stat AS (
  SELECT *, rank_sum - n1 * (n1 + 1) / 2 AS u, n1 * n2 / 2 AS mean_u,
         sqrt(n1 * n2 / 12 * (n1 + n2 + 1 - ties / ((n1 + n2) * (n1 + n2 - 1)))) AS sigma_u
  FROM sums)
SELECT CAST(n1 AS BIGINT) AS n_first, CAST(n2 AS BIGINT) AS n_second, rank_sum, u, mean_u,
       round(sigma_u, 6) AS sigma_u, round(greatest(abs(u - mean_u) - 0.5, 0) / sigma_u, 6) AS z,
       round({_two_sided_p('(greatest(abs(u - mean_u) - 0.5, 0) / sigma_u)')}, 8) AS p_value
FROM stat
"""

EXPERIMENT = {
    "ab_summary": f"""
WITH {EXPERIMENT_CTE}
SELECT testgroup, users, payers, conversion, round(arppu, 6) AS arppu, round(arpu, 6) AS arpu FROM ({AB_SUMMARY})
""",
    "ab_summary_all_days": f"""
WITH {ALL_DAYS_CTE}
SELECT testgroup, users, payers, round(conversion, 6) AS conversion, round(arppu, 6) AS arppu, round(arpu, 6) AS arpu
FROM ({AB_SUMMARY})
""",
    "ab_summary_text": f"""
WITH {EXPERIMENT_CTE}
SELECT testgroup, printf('Conversion of group %s: %.2f%%, revenue per payer: %.2f, revenue per user: %.2f',
                         testgroup, conversion * 100, arppu, arpu) AS message
FROM ({AB_SUMMARY})
""",
    "ab_describe_payers": DESCRIBE,
    "ab_describe_payers_ranged": DESCRIBE,
    "ab_outlier_sensitivity": f"WITH {EXPERIMENT_CTE} {_variant('all', 'true')} UNION ALL {_variant('cut', 'revenue < 200')}",
    "histogram_users": f"WITH {EXPERIMENT_CTE}, {_histogram('experiment', 'testgroup', 'revenue', 30, 6)}",
    "histogram_payers": f"""
WITH {EXPERIMENT_CTE}, payers AS (SELECT * FROM experiment WHERE revenue > 0),
{_histogram('payers', 'testgroup', 'revenue', 30, 6)}
""",
    "box_payers": _box("true"),
    "box_payers_cut": _box("revenue < 200"),
    "mann_whitney_ab": RANK_TEST,
    "mann_whitney_all_days": RANK_TEST.replace(EXPERIMENT_CTE, ALL_DAYS_CTE),
}

# Bootstrap


def _uniform(text: str) -> str:
    return f"((('0x' || substr(md5({text}), 1, 13))::BIGINT + 0.5) / 4503599627370496.0::DOUBLE)"


def _paired_replicas(replicas: int, seed: int, statistic: str, labels: tuple[str, str] = ("a", "b")) -> str:
    first, second = labels
    sizes = "(SELECT count(*) FROM experiment WHERE testgroup = '{}')"

    def position(label: str) -> str:
        text = f"'{seed}|{label}|' || CAST(replica AS VARCHAR) || '|' || CAST(i AS VARCHAR)"
        return f"CAST(floor({_uniform(text)} * {sizes.format(label)}) AS BIGINT)"

    return f"""
ordered AS (
  SELECT testgroup, revenue, row_number() OVER (PARTITION BY testgroup ORDER BY revenue) - 1 AS position
  FROM experiment),
grid AS (
  SELECT CAST(r.range AS BIGINT) AS replica, CAST(p.range AS BIGINT) AS i
  FROM range({replicas}) r, range(greatest({sizes.format(first)}, {sizes.format(second)})) p),
picked AS (SELECT replica, {position(first)} AS pa, {position(second)} AS pb FROM grid),
replicas AS (
  SELECT replica, {statistic}(a.revenue - b.revenue) AS stat
  FROM picked
  JOIN ordered a ON a.testgroup = '{first}' AND a.position = pa
  JOIN ordered b ON b.testgroup = '{second}' AND b.position = pb
  GROUP BY replica)
"""


def _test_row(scale: int) -> str:
    z = "avg(stat) / nullif(stddev_pop(stat), 0)"
    return f""", test AS (
  SELECT count(*) AS replicas, avg(stat) AS mean, stddev_pop(stat) AS sigma, quantile_cont(stat, 0.025) AS ci_low,
         quantile_cont(stat, 0.975) AS ci_high, {z} AS z FROM replicas)
SELECT replicas, round(mean, {scale}) AS mean, round(sigma, {scale}) AS sigma, round(ci_low, {scale}) AS ci_low,
       round(ci_high, {scale}) AS ci_high, round(z, {scale}) AS z, round({_two_sided_p('z')}, {scale}) AS p_value
FROM test
"""


TEST_ROW = _test_row(8)


def _poisson_replicas(table: str, group: str, value: str, key: str, labels: tuple[str, str], replicas: int, seed: int) -> str:
    """Body of a Poisson bootstrap; one draw per row on average. No statistic where a group gets no weight."""
    weight = " + ".join(f"(u >= {t!r}::DOUBLE)::BIGINT" for t in poisson_thresholds(1.0))
    return f"""
drawn AS (
  SELECT {group} AS g, CAST({value} AS DOUBLE) AS x, replica,
         {_uniform(f"'{seed}|' || CAST({key} AS VARCHAR) || '|' || CAST(replica AS VARCHAR)")} AS u
  FROM {table}, (SELECT CAST(range AS BIGINT) AS replica FROM range({replicas})) WHERE {value} IS NOT NULL),
weighted AS (SELECT g, x, replica, {weight} AS w FROM drawn),
means AS (SELECT replica, g, sum(w * x) / nullif(sum(w), 0) AS mean FROM weighted GROUP BY replica, g),
replicas AS (
  SELECT replica, max(mean) FILTER (g = '{labels[0]}') - max(mean) FILTER (g = '{labels[1]}') AS stat
  FROM means GROUP BY replica)
"""


def _closed_form(replicas: int, table: str, group: str, value: str, labels: tuple[str, str], draws: str = "max") -> str:
    """What drawn replicas must give."""
    of = lambda f, label: f"{f}({value}) FILTER ({group} = '{label}')"
    a, b = labels
    larger = f"greatest({of('count', a)}, {of('count', b)})"
    size = {x: larger if draws == "max" else of("count", x) for x in labels}
    return f"""
SELECT CAST({replicas} AS BIGINT) AS replicas, round({of('avg', a)} - {of('avg', b)}, 6) AS expected_mean,
       round(sqrt({of('var_pop', a)} / {size[a]} + {of('var_pop', b)} / {size[b]}), 6) AS expected_sigma,
       true AS mean_fits, true AS sigma_fits
FROM {table}
"""


GENERATIONS = ("2014-01-01", "2015-01-01")


def _unit_pairs(condition: str = "") -> str:
    rates = _rates(condition) if condition else _rates()
    return f"""
WITH {UNITS_CTE}, rates AS ({rates}),
experiment AS (SELECT cohort AS testgroup, rate AS revenue FROM rates WHERE rate IS NOT NULL),
{_paired_replicas(2000, 7, 'avg', GENERATIONS)} {_test_row(5)}
"""


AB_REPLICAS = f"WITH {EXPERIMENT_CTE}, {_paired_replicas(10_000, 7, 'avg')}"

# Every pair of users of the two groups, pairs of equal values counted.
PAIRS_CTE = f"""{EXPERIMENT_CTE},
spent AS (SELECT testgroup, revenue, count(*) AS n FROM experiment GROUP BY testgroup, revenue),
pairs AS (
  SELECT a.revenue - b.revenue AS difference, CAST(a.n * b.n AS DOUBLE) AS n
  FROM spent a JOIN spent b ON a.testgroup = 'a' AND b.testgroup = 'b')"""


def _pair_quantile(probability: float) -> str:
    return f"""
WITH {PAIRS_CTE}, up_to AS (
  SELECT difference, sum(sum(n)) OVER (ORDER BY difference) / sum(sum(n)) OVER () AS share FROM pairs GROUP BY difference)
SELECT CAST(10000 AS BIGINT) AS replicas, round(min(difference), 6) AS pair_quantile, round(min(share), 6) AS pair_share, true AS share_fits
FROM up_to WHERE share >= {probability} - 1e-15
"""


BOOTSTRAP = {
    "bootstrap_ab": f"{AB_REPLICAS} {TEST_ROW}",
    "bootstrap_ab_cut": f"""
WITH {EXPERIMENT_CTE.replace("experiment AS", "everyone AS")}, experiment AS (SELECT * FROM everyone WHERE revenue < 200),
{_paired_replicas(10_000, 7, 'avg')} {TEST_ROW}
""",
    "bootstrap_ab_multinomial": f"WITH {EXPERIMENT_CTE} {_closed_form(10_000, 'experiment', 'testgroup', 'revenue', ('a', 'b'))}",
    "bootstrap_unit_rates": _unit_pairs(),
    "bootstrap_unit_rates_early": _unit_pairs("tenure_days <= 30"),
    "bootstrap_unit_rates_multinomial": f"""
WITH {UNITS_CTE}, rates AS ({_rates()}) {_closed_form(2000, 'rates', 'cohort', 'rate', GENERATIONS)}
""",
    "bootstrap_histogram": f"""
{AB_REPLICAS}, drawn AS (SELECT 'all' AS "all", round(stat, 8) AS stat FROM replicas),
{_histogram('drawn', '"all"', 'stat', 50, 8)}
""",
    "bootstrap_ab_paired": f"WITH {ALL_DAYS_CTE}, {_paired_replicas(10_000, 7, 'avg')} {TEST_ROW}",
    "bootstrap_ab_median": f"""
WITH {EXPERIMENT_CTE}, {_paired_replicas(10_000, 7, 'median')} SELECT replica, round(stat, 5) AS stat FROM replicas
""",
    "bootstrap_ab_quantile": _pair_quantile(0.9),
    "bootstrap_ab_statistic": f"""
WITH {PAIRS_CTE}, more AS (SELECT CAST(sum(n) FILTER (difference > 0) AS DOUBLE) / sum(n) AS p FROM pairs)
SELECT CAST(10000 AS BIGINT) AS replicas, round(p, 6) AS expected_mean,
       round(sqrt(p * (1 - p) / (SELECT max(rows) FROM (SELECT count(*) AS rows FROM experiment GROUP BY testgroup))), 6) AS expected_sigma,
       true AS mean_fits, true AS sigma_fits
FROM more
""",
    "bootstrap_ab_poisson": f"""
WITH {EXPERIMENT_CTE}, {_poisson_replicas('experiment', 'testgroup', 'revenue', 'user_id', ('a', 'b'), 10_000, 7)}
{TEST_ROW.replace("count(*) AS replicas", "count(stat) AS replicas")}
""",
    "bootstrap_unit_rates_poisson": f"""
WITH {UNITS_CTE}, rates AS ({_rates()}),
{_poisson_replicas('rates', 'cohort', 'rate', 'dwarf_id', GENERATIONS, 2000, 3)}
SELECT replica, round(stat, 6) AS stat FROM replicas
""",
}

# Landed files

CSV = {
    "csv_registrations": f"WITH {ORDERS_CTE} SELECT reg_ts, uid FROM regs",
    "csv_sessions": f"WITH {ORDERS_CTE} SELECT auth_ts, uid FROM auths",
    "csv_experiment": f"WITH {EXPERIMENT_CTE} SELECT user_id, revenue, testgroup FROM experiment",
    "csv_unit_reports": f"""
WITH {UNITS_CTE} SELECT dwarf_id, hired_date, reported_date, CAST(gold_mined AS DOUBLE) AS gold_mined, hammer_date FROM reports
""",
}

# Input checks

EVENT_TYPES = {
    "event_id": "bigint",
    "ts": "timestamp_ntz",
    "user_id": "bigint",
    "event_type": "string",
    "value": "double",
    "props": "string",
}

# Every third unit is delivered a second time.
DELIVERED_CTE = "delivered AS (SELECT * FROM reports UNION ALL SELECT * FROM reports WHERE dwarf_id % 3 = 0)"

AUDIT = {
    "audit_nulls": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) FILTER ({c} IS NULL) AS nulls FROM events" for c in EVENT_TYPES
    ),
    "audit_types": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count({c}) AS non_null FROM events"
        for c, t in EVENT_TYPES.items()
    ),
    "audit_duplicates": f"""
WITH {UNITS_CTE}, {DELIVERED_CTE}
SELECT CAST(sum(n - 1) AS BIGINT) AS duplicates FROM (SELECT count(*) AS n FROM delivered GROUP BY ALL)
""".replace("GROUP BY ALL", "GROUP BY dwarf_id, hired_date, reported_date, gold_mined, hammer_date"),
    "audit_profile": f"""
WITH {UNITS_CTE}, {DELIVERED_CTE}
SELECT count(*) AS rows, (SELECT count(*) FROM (SELECT DISTINCT * FROM delivered)) AS distinct_rows,
       count(*) - (SELECT count(*) FROM (SELECT DISTINCT * FROM delivered)) AS duplicates,
       count(DISTINCT dwarf_id) AS n_keys, count(*) = count(DISTINCT dwarf_id) AS is_unique
FROM delivered
""",
    "audit_profile_columns": " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, '{t}' AS data_type, count(*) - count({c}) AS nulls, count({c}) AS non_null FROM events"
        for c, t in EVENT_TYPES.items()
    ),
    "audit_key_unique": f"""
WITH {ORDERS_CTE}
SELECT count(*) AS n_rows, count(DISTINCT uid) AS n_keys, count(*) = count(DISTINCT uid) AS is_unique,
       'registrations' AS input FROM regs
UNION ALL
SELECT count(*), count(DISTINCT uid), count(*) = count(DISTINCT uid), 'sessions' FROM auths
""",
    "audit_unmatched": f"""
WITH {ORDERS_CTE}
SELECT count(*) FILTER (r.reg_ts IS NULL) AS unmatched, 'sessions' AS input
FROM auths a LEFT JOIN regs r ON a.uid = r.uid
UNION ALL
SELECT count(*) FILTER (r.reg_ts IS NULL), 'customers' FROM customer c LEFT JOIN regs r ON c.c_custkey = r.uid
""",
}

# In-game event

EVENT_SPAN = "ts >= TIMESTAMP '2024-01-03' AND ts < TIMESTAMP '2024-01-06'"


def _exposed(with_step: bool) -> str:
    segment = (
        "CASE WHEN last_step >= exposed_at THEN 'participant' ELSE 'spectator' END" if with_step else "'all'"
    )
    return f"""
exposed AS (
  SELECT user_id, exposed_at, {segment} AS segment
  FROM (SELECT user_id,
               min(CAST(floor(epoch(ts)) AS BIGINT)) FILTER (event_type = 'view') AS exposed_at,
               max(CAST(floor(epoch(ts)) AS BIGINT)) FILTER (event_type = 'click') AS last_step
        FROM events WHERE {EVENT_SPAN} GROUP BY user_id)
  WHERE exposed_at IS NOT NULL),
acts AS (
  SELECT user_id, CAST(floor(epoch(ts)) AS BIGINT) AS s, event_type, CAST(value AS DECIMAL(18,2)) AS amount
  FROM events),
sizes AS (SELECT segment, count(*) AS exposed FROM exposed GROUP BY segment)
"""


def _activity(with_step: bool) -> str:
    return f"""
WITH {_exposed(with_step)},
gaps AS (
  SELECT user_id, s, lead(s) OVER (PARTITION BY user_id ORDER BY s) - s AS gap
  FROM (SELECT DISTINCT user_id, s FROM acts)),
per_day AS (
  SELECT segment, CAST(floor((s - exposed_at) / 86400.0) AS BIGINT) AS day_number, sum(gap) AS seconds
  FROM gaps JOIN exposed USING (user_id) WHERE gap <= 14400 GROUP BY 1, 2)
SELECT z.segment, d.day_number, z.exposed, CAST(coalesce(p.seconds, 0) AS BIGINT) AS seconds,
       CAST(coalesce(p.seconds, 0) AS DOUBLE) / z.exposed AS mean_seconds
FROM sizes z CROSS JOIN (SELECT CAST(unnest([0, 1, 7, 14]) AS BIGINT) AS day_number) d
LEFT JOIN per_day p ON p.segment = z.segment AND p.day_number = d.day_number
"""


def _event_retention(with_step: bool) -> str:
    return f"""
WITH {_exposed(with_step)},
per_day AS (
  SELECT segment, CAST(floor((s - exposed_at) / 86400.0) AS BIGINT) AS day_number,
         count(DISTINCT user_id) AS returned
  FROM acts JOIN exposed USING (user_id) GROUP BY 1, 2)
SELECT z.segment, d.day_number, z.exposed, coalesce(p.returned, 0) AS returned,
       CAST(coalesce(p.returned, 0) AS DOUBLE) / z.exposed AS retention
FROM sizes z CROSS JOIN (SELECT CAST(unnest([1, 7, 14]) AS BIGINT) AS day_number) d
LEFT JOIN per_day p ON p.segment = z.segment AND p.day_number = d.day_number
"""


def _ltv(with_step: bool, horizons: list[int]) -> str:
    return f"""
WITH {_exposed(with_step)},
paid AS (
  SELECT segment, user_id, s - exposed_at AS since, amount
  FROM acts JOIN exposed USING (user_id) WHERE event_type = 'purchase')
SELECT z.segment, z.exposed, h.horizon, count(DISTINCT p.user_id) AS payers,
       coalesce(CAST(sum(p.amount) AS DOUBLE), 0.0) AS revenue,
       coalesce(CAST(sum(p.amount) AS DOUBLE), 0.0) / z.exposed AS ltv
FROM sizes z CROSS JOIN (SELECT CAST(unnest({horizons}) AS BIGINT) AS horizon) h
LEFT JOIN paid p ON p.segment = z.segment AND p.since >= 0 AND p.since < h.horizon * 86400
GROUP BY z.segment, z.exposed, h.horizon
"""


def _step_count(k: int) -> str:
    order = ["t0 IS NOT NULL", "t1 >= t0", "t2 >= t1"][:k]
    return f"count(*) FILTER ({' AND '.join(order)})"


INGAME = {
    "event_exposed": f"WITH {_exposed(True)} SELECT user_id, exposed_at, segment FROM exposed",
    "event_activity_by_day": _activity(False),
    "event_split_activity": _activity(True),
    "event_retention": _event_retention(False),
    "event_split_retention": _event_retention(True),
    "ltv_30": _ltv(False, [30]),
    "event_split_ltv": _ltv(True, [7, 14, 30]),
    "reactivated_users": """
SELECT CAST(ts AS DATE) AS date, count(DISTINCT user_id) AS reactivated
FROM (SELECT user_id, ts, floor(epoch(ts)) - floor(epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts))) AS away
      FROM events)
WHERE away >= 3 * 86400 GROUP BY 1
""",
    "event_participation": f"""
WITH {_exposed(True)}
SELECT count(*) AS exposed, count(*) FILTER (segment = 'participant') AS participants,
       CAST(count(*) FILTER (segment = 'participant') AS DOUBLE) / nullif(count(*), 0) AS share
FROM exposed
""",
    "event_funnel": """
WITH log AS (SELECT user_id, date_trunc('second', ts) AS sec, event_type FROM events),
viewed AS (SELECT user_id, min(sec) AS sec FROM log WHERE event_type = 'view' GROUP BY user_id),
clicked AS (
  SELECT v.user_id, min(l.sec) AS sec FROM viewed v JOIN log l ON l.user_id = v.user_id AND l.sec >= v.sec
  WHERE l.event_type = 'click' GROUP BY v.user_id),
bought AS (
  SELECT c.user_id, min(l.sec) AS sec FROM clicked c JOIN log l ON l.user_id = c.user_id AND l.sec >= c.sec
  WHERE l.event_type = 'purchase' GROUP BY c.user_id),
n AS (SELECT (SELECT count(*) FROM viewed) AS n0, (SELECT count(*) FROM clicked) AS n1, (SELECT count(*) FROM bought) AS n2)
SELECT 1::BIGINT AS step_number, 'view' AS step, n0 AS users, CAST(n0 AS DOUBLE) / n0 AS share_of_first, 0::BIGINT AS drop_off FROM n
UNION ALL SELECT 2, 'click', n1, CAST(n1 AS DOUBLE) / n0, n0 - n1 FROM n
UNION ALL SELECT 3, 'purchase', n2, CAST(n2 AS DOUBLE) / n0, n1 - n2 FROM n
""",
    "event_funnel_days": """
WITH log AS (SELECT user_id, date_trunc('second', ts) AS sec, event_type FROM events
             WHERE ts >= TIMESTAMP '2024-01-08' AND ts < TIMESTAMP '2024-01-15'),
viewed AS (SELECT user_id, min(sec) AS sec FROM log WHERE event_type = 'view' GROUP BY user_id),
clicked AS (
  SELECT v.user_id, min(l.sec) AS sec FROM viewed v JOIN log l ON l.user_id = v.user_id AND l.sec >= v.sec
  WHERE l.event_type = 'click' GROUP BY v.user_id),
bought AS (
  SELECT c.user_id, min(l.sec) AS sec FROM clicked c JOIN log l ON l.user_id = c.user_id AND l.sec >= c.sec
  WHERE l.event_type = 'purchase' GROUP BY c.user_id),
n AS (SELECT (SELECT count(*) FROM viewed) AS n0, (SELECT count(*) FROM clicked) AS n1, (SELECT count(*) FROM bought) AS n2)
SELECT 1::BIGINT AS step_number, 'view' AS step, n0 AS users, CAST(n0 AS DOUBLE) / n0 AS share_of_first, 0::BIGINT AS drop_off FROM n
UNION ALL SELECT 2, 'click', n1, CAST(n1 AS DOUBLE) / n0, n0 - n1 FROM n
UNION ALL SELECT 3, 'purchase', n2, CAST(n2 AS DOUBLE) / n0, n1 - n2 FROM n
""",
    "revenue_box_of_days": """
SELECT event_type, count(value) AS n, min(value) AS low, max(value) AS high, true AS q25_fits, true AS q50_fits, true AS q75_fits
FROM events WHERE ts >= TIMESTAMP '2024-01-05' AND ts < TIMESTAMP '2024-01-26' AND value IS NOT NULL AND event_type IS NOT NULL
GROUP BY event_type
""",
    "choice_share": """
SELECT event_type AS choice, count(*) AS n, CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM events) AS share
FROM events GROUP BY event_type
""",
    "event_churn": """
WITH took_part AS (
  SELECT DISTINCT user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-10' AND event_type = 'purchase'),
labelled AS (
  SELECT p.user_id,
         p.user_id IN (SELECT user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-09' AND event_type = 'purchase') AS veteran,
         p.user_id IN (SELECT user_id FROM events WHERE CAST(ts AS DATE) = DATE '2024-01-11') AS seen
  FROM took_part p)
SELECT CASE WHEN veteran THEN 'veteran' ELSE 'newcomer' END AS segment, count(*) AS users,
       count(*) FILTER (NOT seen) AS churned, CAST(count(*) FILTER (NOT seen) AS DOUBLE) / count(*) AS churn
FROM labelled GROUP BY 1
""",
}

SQL: dict[str, str] = {
    name: text.strip()
    for part in (DAILY, SLOTS, RETENTION, UNITS, EXPERIMENT, BOOTSTRAP, CSV, AUDIT, INGAME)
    for name, text in part.items()
}
