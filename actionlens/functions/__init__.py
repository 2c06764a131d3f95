"""Column helpers shared by every job."""

from .columns import (
    ACTION_LIKE,
    ACTION_MESSAGE,
    ACTION_VIEW,
    EPOCH,
    day_of,
    elapsed_seconds,
    epoch_to_timestamp,
    floor2,
    month_of,
    percent_text,
    ratio,
    round2_even,
    slot_seconds_of,
    slot_start,
    timestamp_to_epoch,
    whole_days,
    whole_days_from_seconds,
    year_month_text,
)
from .significance import normal_two_sided_p

__all__ = [
    "ACTION_LIKE",
    "ACTION_MESSAGE",
    "ACTION_VIEW",
    "EPOCH",
    "day_of",
    "elapsed_seconds",
    "epoch_to_timestamp",
    "floor2",
    "month_of",
    "normal_two_sided_p",
    "percent_text",
    "ratio",
    "round2_even",
    "slot_seconds_of",
    "slot_start",
    "timestamp_to_epoch",
    "whole_days",
    "whole_days_from_seconds",
    "year_month_text",
]
