import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from fleetpulse.session import build_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "2", "spark.ui.enabled": "false", "spark.driver.memory": "4g",
            # Tests ask for the stages of their jobs; by default the oldest are forgotten above 1,000.
            "spark.ui.retainedStages": "100000", "spark.ui.retainedJobs": "100000",
        },
    )
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def rows_of():
    """Rows as sorted tuples, with NaN made comparable."""

    def convert(df, *columns):
        df = df.select(*columns) if columns else df
        rows = [
            tuple("nan" if isinstance(v, float) and v != v else v for v in row)
            for row in df.collect()
        ]
        return sorted(rows, key=repr)

    return convert
