import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from cohortloom.schemas import SOURCE_TABLES  # noqa: E402
from cohortloom.session import build_session, local_frame  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "4g",
            "spark.sql.maxMetadataStringLength": "2000",
            "spark.ui.showConsoleProgress": "false",
            "spark.python.sql.dataFrameDebugging.enabled": "false",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def make_tables(spark):
    """Source tables from rows given as dicts; tables not named are empty."""

    def make(**rows):
        return {
            name: local_frame(
                spark, [tuple(row.get(c) for c in schema.names) for row in rows.get(name, [])], schema
            )
            for name, schema in SOURCE_TABLES.items()
        }

    return make
