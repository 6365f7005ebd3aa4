import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from assaylake.session import get_spark  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = get_spark("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "6g",
                                                "spark.ui.showConsoleProgress": "false"})
    session.sparkContext.setLogLevel("ERROR")
    return session


def rows(df, *cols):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*cols).collect()), key=repr)
