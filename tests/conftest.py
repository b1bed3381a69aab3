import logging
import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from corpuscle.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session("tests", "local[4]", {
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))})
    session.sparkContext.setLogLevel("OFF")
    logging.getLogger("DataFrameQueryContextLogger").disabled = True
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Make a small DataFrame: rows([(1, 'a')], 'id INT, t STRING')."""
    def make(data, ddl):
        return spark.createDataFrame(data, ddl)
    return make


def values(df, *columns):
    """Rows as tuples in a stable order."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)
