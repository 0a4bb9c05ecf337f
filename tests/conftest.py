import sys
from pathlib import Path

import pytest

sys.path[:0] = [str(Path(__file__).parent), str(Path(__file__).parent.parent)]


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from daybook import build_session

    session = build_session(
        "daybook-tests", "local[4]",
        **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false",
           "spark.ui.showConsoleProgress": "false", "spark.driver.memory": "4g"},
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", ""):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
    yield session
    session.stop()


@pytest.fixture()
def frame(spark):
    """frame(schema, rows) -> DataFrame; None cells are NULL, ISO texts in date columns are dates."""
    import datetime as dt

    def make(schema: str, rows):
        dates = {i for i, part in enumerate(schema.split(",")) if part.split()[1] == "date"}
        rows = [
            tuple(dt.date.fromisoformat(v) if i in dates and isinstance(v, str) else v for i, v in enumerate(r))
            for r in rows
        ]
        return spark.createDataFrame(rows, schema)

    return make
