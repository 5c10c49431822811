import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from martloom.session import get_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    return get_session(
        "tests",
        "local[8]",
        **{
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.log.level": "ERROR",
            "spark.sql.shuffle.partitions": "4",
            "spark.driver.memory": "8g",
        },
    )


@pytest.fixture(scope="session")
def small():
    return "/root/testdata/sf0.001"
