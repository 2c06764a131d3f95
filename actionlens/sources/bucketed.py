"""Tables that are laid out by a key, so that joins on the key leave them where they are."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


def open_bucketed(spark: SparkSession, path: str, name: str, schema: T.StructType, key: str, buckets: int) -> DataFrame:
    """The folder ``path`` as the table ``name``, told to be in ``buckets`` buckets by ``key``, as
    ``write_bucketed`` has left it. A catalog that already has the table keeps its definition."""
    columns = ", ".join(f"`{field.name}` {field.dataType.simpleString()}" for field in schema)
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet "
        f"CLUSTERED BY (`{key}`) SORTED BY (`{key}`) INTO {buckets} BUCKETS LOCATION '{path}'"
    )
    return spark.table(name)


def write_bucketed(df: DataFrame, path: str, name: str, key: str, buckets: int) -> DataFrame:
    """Write ``df`` as a new table ``name`` in ``path`` and return it. Rows are brought together by bucket
    first, one file each; rows that come from a join with a table of the same buckets already are."""
    placed = df.repartition(buckets, key)
    placed.write.format("parquet").bucketBy(buckets, key).sortBy(key).option("path", path).mode("error").saveAsTable(name)
    return df.sparkSession.table(name)
