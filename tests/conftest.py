from __future__ import annotations

import os
import re
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.abspath(__file__)), ".."))

from curaspan.session import build_session  # noqa: E402

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("scratch")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    if not os.path.isdir(SF_DIR):
        pytest.skip("no test tables")
    return SF_DIR


@pytest.fixture
def texts(spark):
    """A table of (record_id, text) in the given order."""

    def make(*values):
        rows = [(f"r{i:04d}", value) for i, value in enumerate(values)]
        return spark.createDataFrame(rows, "record_id string, text string")

    return make


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def shuffled_columns(df) -> list[str]:
    """Names of the columns that go through the shuffles of a plan, one text per shuffle."""
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    return re.findall(r"\(\d+\) Exchange\nInput \[\d+\]: \[(.*)\]", text)
