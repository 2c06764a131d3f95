import sys
from datetime import datetime
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from actionlens.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session(4, "tests")
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


@pytest.fixture
def actions(spark):
    """Build ``(user_id, time, action)`` from ``(user, 'YYYY-MM-DD HH:MM:SS', action)`` rows."""

    def build(*rows):
        return spark.createDataFrame(
            [(u, at(t), a) for u, t, a in rows], "user_id long, time timestamp_ntz, action string"
        )

    return build


def rows_of(df, *order):
    """Rows as tuples, sorted by the given columns (or all)."""
    return [tuple(r) for r in df.orderBy(*(order or df.columns)).collect()]


def plan_of(df) -> str:
    """Physical plan text."""
    return df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
