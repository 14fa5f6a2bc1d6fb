from __future__ import annotations

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from talkmart.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"},
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate one Column over a list of texts."""

    def run(function, texts, type_="string"):
        df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], f"i int, x {type_}")
        from pyspark.sql import functions as F

        rows = df.select("i", function(F.col("x")).alias("y")).orderBy("i").collect()
        return [r["y"] for r in rows]

    return run


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()
