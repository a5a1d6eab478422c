import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from fleetpulse.operators.running import running_sum
from fleetpulse.operators.split_runs import Runs, over_runs, plan_cuts

RUNS = Runs(keys=("k",), order=("a", "b"), levels=(("a", 16), ("a", 1), ("b", 64), ("b", 1)))


def data(spark, seed=3, count=1200):
    """A third of the rows under one key, and most of those under one value of ``a``."""
    rng = random.Random(seed)
    rows = set()
    while len(rows) < count:
        if rng.random() < 0.35:
            k, a = 1, rng.choice([7, 7, 7, rng.randint(-40, 400), None])
        else:
            k, a = rng.choice([None, 2, 3, 4, 5]), rng.randint(-300, 300)
        rows.add((k, a, rng.choice([rng.randint(0, 3000), rng.randint(-(10**12), 10**12)])))
    return spark.createDataFrame(
        [(*r, n, n % 11) for n, r in enumerate(sorted(rows, key=repr))],
        "k int, a int, b long, id int, v int",
    ).repartition(7)


@pytest.mark.parametrize("limit", [5, 50, 300])
def test_look_back_equals_the_plain_window(spark, rows_of, limit):
    df = data(spark)

    def compute(frame, window):
        return frame.withColumns(
            {
                "before": F.lag("id", 1).over(window),
                "far": F.lag("id", 6).over(window),
                "total": F.sum("v").over(window.rowsBetween(-6, 0)),
            }
        )

    cuts = plan_cuts(df, RUNS, limit)
    assert cuts is not None
    expected = rows_of(compute(df, RUNS.window()))
    assert rows_of(over_runs(df, RUNS, 6, compute, cuts)) == expected
    thin = over_runs(df, RUNS, 6, compute, cuts, carry=("id", "v"))
    assert rows_of(thin.select(*df.columns, "before", "far", "total")) == expected


def test_blocks_stay_small_and_tables_bounded(spark):
    df = data(spark)
    limit = 30
    cuts = plan_cuts(df, RUNS, limit)
    split = cuts.tag(df).filter("_split")
    sizes = [r["count"] for r in split.groupBy("k", *cuts.blocks).count().collect()]
    assert max(sizes) <= limit
    assert all(n <= 1200 / limit for n in cuts.counts)


def test_short_runs_keep_the_plain_window(spark):
    assert plan_cuts(data(spark), RUNS, 5000) is None


@pytest.mark.parametrize("limit", [5, 60, 5000])
def test_running_sum_over_long_runs(spark, rows_of, limit):
    df = data(spark)
    plain = df.withColumn("total", F.sum("v").over(RUNS.window().rowsBetween(Window.unboundedPreceding, 0)))
    assert rows_of(running_sum(df, RUNS, "v", "total", limit)) == rows_of(plain)
