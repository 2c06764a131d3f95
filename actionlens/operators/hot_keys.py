"""Join facts to one row per key when a few keys own a large part of the facts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# No more keys than this can each hold more than one part in this many of all rows.
MAX_HOT_KEYS = 10_000
MIN_HOT_ROWS = 1_000_000
# Places that facts without a key are spread over.
KEYLESS_PARTS = 10_007


def join_per_key(
    facts: DataFrame,
    per_key: DataFrame,
    key: str,
    rows: str,
    min_hot_rows: int = MIN_HOT_ROWS,
) -> DataFrame:
    """Left join of ``facts`` with ``per_key`` (unique on ``key``).

    ``per_key`` carries in ``rows`` the number of facts of the key. Keys with more than
    1/10,000 of all facts number less than 10,000, whatever the data, so their side is broadcast
    and their facts are not shuffled. All other keys join by shuffle; facts without a key, which
    match nothing, are spread by a hash of their other columns. Without a hot key this is one join.

    Runs jobs: ``per_key`` is stored, for its counts tell which keys are hot.
    """
    per_key = cut_lineage(per_key)
    total, largest = per_key.agg(F.sum(rows), F.max(rows)).first()
    hot_from = max(min_hot_rows, (total or 0) // MAX_HOT_KEYS)
    if (largest or 0) <= hot_from:
        return _spread_join(facts, per_key.drop(rows), key)
    hot = per_key.filter(F.col(rows) > hot_from).drop(rows)
    cold = per_key.filter(F.col(rows) <= hot_from).drop(rows)
    hot_facts = facts.join(F.broadcast(hot), key)
    cold_facts = _spread_join(facts.join(F.broadcast(hot.select(key)), key, "left_anti"), cold, key)
    return hot_facts.unionByName(cold_facts)


def _spread_join(facts: DataFrame, per_key: DataFrame, key: str) -> DataFrame:
    """Left join in which facts without a key do not meet in one task."""
    hashed = [c for c, kind in facts.dtypes if c != key and "map<" not in kind and "variant" not in kind]
    spread = F.pmod(F.xxhash64(*hashed), F.lit(KEYLESS_PARTS)) if hashed else F.lit(0).cast("long")
    placed = facts.withColumn("_part", F.when(F.col(key).isNull(), spread).otherwise(F.lit(0).cast("long")))
    return placed.join(per_key.withColumn("_part", F.lit(0).cast("long")), [key, "_part"], "left").drop("_part")
