import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
sys.path.insert(0, os.path.join(ROOT, "tests"))

from explain import SMALL  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tallyhouse import build_session

    session = build_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "8",
            "spark.driver.memory": "4g",
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("stages")),
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def small(spark):
    """The model over the smallest sample tables, every table written once."""
    from tallyhouse.plans.model import ALL_TABLES, RetailModel

    return RetailModel.from_folder(spark, SMALL, staged=ALL_TABLES)

