from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.join(ROOT, "tests")]

from riskflow import build_session  # noqa: E402
from riskflow.plans.shared import drop_intermediates  # noqa: E402

SF_SMALL = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "riskflow-tests",
        "local[4]",
        spark__sql__shuffle__partitions=4,
        spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false",
        spark__driver__memory="4g",
        spark__sql__warehouse__dir=str(tmp_path_factory.mktemp("warehouse")),
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    drop_intermediates(session)
    session.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_SMALL


@pytest.fixture
def plan(spark):
    """Physical plan of a DataFrame as text."""

    def text(df):
        return df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
        )

    return text
