import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from scriptorium.session import session

    spark = session(
        "tests",
        f"local[{os.environ.get('CPUS', '4')}]",
        **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.showConsoleProgress": "false"},
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark


@pytest.fixture
def one(spark):
    """The value of a Column of literals."""
    return lambda column: spark.range(1).select(column.alias("v")).first().v
