import os
import sys
import uuid
from datetime import datetime

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from faremill.lake import Lake  # noqa: E402
from faremill.schema import BRONZE_DDL, MONTH, RAW, TRIP_COLUMNS  # noqa: E402
from faremill.session import build_spark  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = build_spark("tests", "local[4]", conf={
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g",
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lake(spark, tmp_path):
    return Lake(spark, str(tmp_path / "lake"), f"t{uuid.uuid4().hex[:8]}_").create()


def at(text):
    return datetime.fromisoformat(text)


@pytest.fixture
def trips(spark):
    """Builds bronze rows; columns not given are null, the month follows the start time."""
    def build(*rows):
        full = []
        for row in rows:
            values = {name: row.get(name) for name in TRIP_COLUMNS}
            start = values["trip_start_timestamp"]
            if isinstance(start, str):
                values["trip_start_timestamp"] = start = at(start)
            full.append((*values.values(), start.strftime("%Y-%m") if start else None))
        return spark.createDataFrame(full, BRONZE_DDL)

    return build


@pytest.fixture
def raw_text(spark):
    def build(*rows):
        return spark.createDataFrame(
            [tuple(row.get(name) for name in TRIP_COLUMNS) for row in rows], RAW)

    return build


def rows(df, *columns):
    return sorted(tuple(r) for r in (df.select(*columns) if columns else df).collect())


def counts(df):
    return dict(rows(df.groupBy(MONTH).count()))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    return plan(df)
