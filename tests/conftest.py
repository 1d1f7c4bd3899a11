import sys
from datetime import date, datetime
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent
sys.path.insert(0, str(ROOT))

from patronlens import create_session  # noqa: E402

RUN_DATE = date(2026, 7, 1)
LOADED_AT = datetime(2026, 7, 1, 2)


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = create_session(
        "patronlens-tests",
        "local[4]",
        {
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def store(spark, tmp_path):
    from patronlens.sources.tables import TableStore

    return TableStore(spark, str(tmp_path / "store"))
