"""Retention from stored bitsets of active days.

``(uid, reg_ts, word, bits)``: of each registered user, which of the 64 day numbers of a word had a
session. States of different days merge by OR; curve and cohort matrix are sums of single bits over users.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.columns import epoch_to_timestamp, month_of, ratio, round2_even
from .retention import epoch_of, user_day_numbers

WORD_DAYS = 64


def activity_bits(registrations: DataFrame, sessions: DataFrame) -> DataFrame:
    """The state of ``sessions``, which may be those of one day. Sessions without a registration, or before it, have no
    day number."""
    numbered = user_day_numbers(registrations, sessions)
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("day_number") % WORD_DAYS).cast("int"))
    word = F.floor(F.col("day_number") / WORD_DAYS)
    return numbered.groupBy("uid", "reg_ts", word.alias("word")).agg(F.bit_or(bit).alias("bits"))


def merge_bits(known: DataFrame, new: DataFrame) -> DataFrame:
    """Both states as one. Repeating a merge changes nothing."""
    return known.unionByName(new).groupBy("uid", "reg_ts", "word").agg(F.bit_or("bits").alias("bits"))


def _users_per_day(bits: DataFrame, *keys: str) -> DataFrame:
    """``(*keys, day_number, unique_id)`` for the days that occur: a user's registrations meet first, then every bit of
    a word is one sum, so no row is made for a user's day."""
    per_user = bits.groupBy(*keys, "uid", "word").agg(F.bit_or("bits").alias("bits"))
    sums = [F.sum(F.getbit("bits", F.lit(i))).alias(f"b{i}") for i in range(WORD_DAYS)]
    words = per_user.groupBy(*keys, "word").agg(*sums)
    days = F.posexplode(F.array(*(f"b{i}" for i in range(WORD_DAYS)))).alias("at", "unique_id")
    number = (F.col("word") * WORD_DAYS + F.col("at")).cast("long")
    return words.select(*keys, "word", days).filter("unique_id > 0").select(*keys, number.alias("day_number"), F.col("unique_id").cast("long").alias("unique_id"))


def retention_curve(bits: DataFrame, rows: int = 30) -> DataFrame:
    """``retention.retention_overall`` from the state."""
    head = _users_per_day(bits).orderBy("day_number").limit(rows)
    # At most ``rows`` rows are left.
    base = F.max(F.when(F.col("day_number") == 0, F.col("unique_id"))).over(Window.partitionBy(F.lit(0)))
    return head.select("day_number", "unique_id", round2_even(ratio(F.col("unique_id"), base) * 100).alias("retention"))


def cohort_curves(bits: DataFrame, horizon: int = 14, first_cohort: date | None = None, cohort: Column | None = None) -> DataFrame:
    """``retention.retention_cohorts`` from the state."""
    if first_cohort is not None:
        bits = bits.filter(F.col("reg_ts") >= epoch_of(first_cohort.replace(day=1)))
    cohort = month_of(epoch_to_timestamp("reg_ts")) if cohort is None else cohort
    reached = bits.filter(F.col("word") <= horizon // WORD_DAYS).withColumn("cohort", cohort)
    per_cohort = _users_per_day(reached, "cohort").filter(F.col("day_number") <= horizon)
    base = F.max(F.when(F.col("day_number") == 0, F.col("unique_id"))).over(Window.partitionBy("cohort"))
    return per_cohort.select("cohort", "day_number", "unique_id", ratio(F.col("unique_id"), base).alias("share"))
