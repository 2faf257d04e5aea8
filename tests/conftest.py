import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from mention_pulse.session import get_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark import SparkConf

    # the folder an environment names is used; tests bring their own only where there is none
    own = {} if SparkConf().contains("spark.checkpoint.dir") else {
        "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))
    }
    session = get_session(
        "tests",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "4g",
            **own,
            "spark.sql.warehouse.dir": str(tmp_path_factory.mktemp("warehouse")),
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df, *columns):
    """Rows as sorted tuples."""
    picked = df.select(*columns) if columns else df
    return sorted((tuple(r) for r in picked.collect()), key=repr)


def plan(df):
    """The physical plan as text, before anything ran."""
    return df._jdf.queryExecution().executedPlan().toString()
