"""An audit of a table from one pass over it.

The pass collapses rows to ``(digest, missing, n)``: a 128-bit digest of the whole row, a bit for each column
without a value, and how many rows are alike. Copies are alike in both, so nulls, known values, row
count, duplicates and, from digests of the key, uniqueness all follow from the collapsed rows. States
of several days add up.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import cut_lineage

# Columns in one number of the ``missing`` array.
_BITS = 62


def _missing(name: str, kind: str) -> Column:
    column = F.col(f"`{name}`")
    return column.isNull() | F.isnan(column) if kind in ("double", "float") else column.isNull()


def _digest(columns: list[tuple[str, str]]) -> Column:
    """Digest of the values. A value has its length before it, so that no two rows are written alike; a missing
    one is written apart, and so is a null from a NaN."""
    texts = []
    for name, kind in columns:
        column = F.col(f"`{name}`")
        # Text does for plain values; others are written as JSON, which tells their parts apart.
        nested = any(part in kind for part in ("struct", "array", "map"))
        text = F.to_json(F.struct(column)) if nested else column.cast("string")
        size = F.octet_length(text).cast("string")
        texts.append(F.when(column.isNull(), "-").otherwise(F.concat(size, F.lit(":"), text)))
    return F.unhex(F.md5(F.concat(*texts) if texts else F.lit("")))


def profile_state(df: DataFrame, keys: list[str] = ()) -> DataFrame:
    """``(digest, missing, n, key_<i>...)``, the collapsed rows of ``df``; ``key_<i>`` is a digest of the i-th of ``keys``,
    null where the key is. Copies meet on the map side."""
    kinds = df.dtypes
    words = []
    for low in range(0, len(kinds), _BITS):
        bits = [F.when(_missing(*column), F.lit(1 << i)).otherwise(0).cast("long") for i, column in enumerate(kinds[low : low + _BITS])]
        words.append(sum(bits[1:], bits[0]))
    of_key = {f"key_{i}": F.when(F.col(f"`{key}`").isNotNull(), _digest([(key, dict(kinds)[key])])) for i, key in enumerate(keys)}
    narrow = df.select(_digest(kinds).alias("digest"), F.array(*words).cast("array<long>").alias("missing"), *(c.alias(name) for name, c in of_key.items()))
    return narrow.groupBy(*narrow.columns).agg(F.count("*").alias("n"))


def merge_states(one: DataFrame, other: DataFrame) -> DataFrame:
    """The state of both tables together."""
    names = [c for c in one.columns if c != "n"]
    return one.unionByName(other).groupBy(*names).agg(F.sum("n").alias("n"))


def duplicates_of(state: DataFrame) -> DataFrame:
    """``(rows, distinct_rows, duplicates)`` of the table."""
    total = F.coalesce(F.sum("n"), F.lit(0)).cast("long")
    return state.agg(total.alias("rows"), F.count("*").alias("distinct_rows")).withColumn("duplicates", F.col("rows") - F.col("distinct_rows"))


def columns_of(state: DataFrame, dtypes: list[tuple[str, str]]) -> DataFrame:
    """``(column_name, data_type, nulls, non_null)`` of the table whose columns are ``dtypes``; NaN counts as missing."""
    missing = [F.coalesce(F.sum(F.col("n") * F.getbit(F.col("missing")[i // _BITS], F.lit(i % _BITS))), F.lit(0)) for i in range(len(dtypes))]
    sums = state.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.array(*missing).alias("nulls"))
    named = F.array(*(F.struct(F.lit(name).alias("column_name"), F.lit(kind).alias("data_type")) for name, kind in dtypes))
    each = sums.select("rows", F.explode(F.arrays_zip(named.alias("named"), "nulls")).alias("x"))
    nulls = F.col("x.nulls").cast("long")
    return each.select("x.named.column_name", "x.named.data_type", nulls.alias("nulls"), (F.col("rows") - nulls).cast("long").alias("non_null"))


def uniqueness_of(state: DataFrame, key: int = 0) -> DataFrame:
    """``(n_rows, n_keys, is_unique)`` of the ``key``-th key; null keys make it not unique."""
    per_key = state.groupBy(f"key_{key}").agg(F.sum("n").alias("n"))
    counted = per_key.agg(F.coalesce(F.sum("n"), F.lit(0)).cast("long").alias("n_rows"), F.count(f"key_{key}").alias("n_keys"))
    return counted.withColumn("is_unique", F.col("n_rows") == F.col("n_keys"))


def profile(df: DataFrame, keys: list[str] = ()) -> tuple[DataFrame, DataFrame, dict[str, DataFrame]]:
    """Columns, duplicates, and by key its uniqueness. The table is read once, by a job that stores the state."""
    state = cut_lineage(profile_state(df, keys))
    return columns_of(state, df.dtypes), duplicates_of(state), {key: uniqueness_of(state, i) for i, key in enumerate(keys)}
