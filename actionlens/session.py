"""Session settings and lineage cutting."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = 8, app: str = "actionlens") -> SparkSession:
    """A session for tests and the benchmark. On a cluster the caller brings its own."""
    return (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cores))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", "8g")
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )


def shared_folder(spark: SparkSession) -> str:
    """The checkpoint folder of the session: the cluster's ``spark.checkpoint.dir``; only a local
    session without one gets its own."""
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        configured = spark.conf.get("spark.checkpoint.dir", None)
        if configured:
            context.setCheckpointDir(configured)
        elif context.master.startswith("local"):
            context.setCheckpointDir(tempfile.mkdtemp(prefix="checkpoint-"))
        else:
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return context.getCheckpointDir()


def scratch_folder(spark: SparkSession) -> str:
    """A new folder name under the shared folder."""
    return f"{shared_folder(spark)}/{uuid.uuid4().hex}"


def cut_lineage(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the checkpoint folder and continue from there.

    Used where one intermediate result feeds several later steps: every step then sees the same
    rows, and a lost executor re-reads files instead of recomputing them.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)
