from __future__ import annotations

import sys
import uuid
from datetime import datetime
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from tillpanel.schemas import BRONZE_SCHEMA  # noqa: E402
from tillpanel.storage.warehouse import Warehouse  # noqa: E402

SHEET_1, SHEET_2 = "Year 2009-2010", "Year 2010-2011"
FILE = "online_retail_II.xlsx"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .appName("tillpanel-tests")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "shared"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "warehouse"), prefix=f"t{uuid.uuid4().hex[:10]}_")


@pytest.fixture
def bronze_frame(spark):
    """Bronze rows from (invoice, code, description, quantity, date, price, customer, country, sheet)."""

    def build(rows):
        return spark.createDataFrame(
            [(*row[:8], FILE, row[8], datetime(2026, 6, 12)) for row in rows], BRONZE_SCHEMA
        )

    return build
