import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from trendmill.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = tmp_path_factory.mktemp("spark")
    session = build_session("tests", "local[4]", {
        "spark.sql.shuffle.partitions": "4",
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.driver.memory": "4g",
        "spark.sql.warehouse.dir": str(base / "warehouse"),
        "spark.checkpoint.dir": str(base / "checkpoints"),
    })
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def layout(spark, tmp_path):
    from trendmill.sources.tables import Layout

    database = f"t_{abs(hash(str(tmp_path))):x}"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{tmp_path}/db'")
    yield Layout(str(tmp_path / "tables"), database)
    spark.sql(f"DROP DATABASE {database} CASCADE")
