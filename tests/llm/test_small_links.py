"""Components of few links take few tasks, however many shuffle partitions the session has."""

import random

import pytest

from fleetpulse.llm import components
from tests.llm.by_hand import roots

SET = {"spark.sql.shuffle.partitions": "64", "spark.sql.adaptive.coalescePartitions.enabled": "false"}


@pytest.fixture
def many_partitions(spark):
    old = {k: spark.conf.get(k) for k in SET}
    for k, v in SET.items():
        spark.conf.set(k, v)
    yield spark
    for k, v in old.items():
        spark.conf.set(k, v)


def links_of_all_kinds():
    rng = random.Random(6)
    chain = [(n, n + 1) for n in range(100)]
    hub = [(1000 + n, 1000) for n in range(150)]
    loose = [(rng.randrange(3000, 3300), rng.randrange(3000, 3300)) for _ in range(140)]
    return chain + hub + loose + [(7, 7), (None, 3), (5, None), (1000, 1001)]


def found_and_tasks(spark, links):
    context = spark.sparkContext
    group = f"components-{random.random()}"
    context.setJobGroup(group, "components")
    found = components.components(spark.createDataFrame(links, "a long, b long")).collect()
    context.setJobGroup("others", "others")
    tracker = context.statusTracker()
    stages = {s for j in tracker.getJobIdsForGroup(group) for s in tracker.getJobInfo(j).stageIds}
    return dict(map(tuple, found)), sum(tracker.getStageInfo(s).numCompletedTasks for s in stages)


def test_few_links_take_few_tasks(many_partitions):
    links = links_of_all_kinds()
    found, tasks = found_and_tasks(many_partitions, links)
    real = [(a, b) for a, b in links if a is not None and b is not None]
    expected = {n: r for n, r in roots(real, {n for link in real for n in link}).items() if n != r}
    assert found == expected
    assert tasks < 5 * 64  # the links made distinct and counted; each round made some 500


def test_one_task_and_many_agree(many_partitions, monkeypatch):
    links = links_of_all_kinds()
    few, _ = found_and_tasks(many_partitions, links)
    monkeypatch.setattr(components, "ONE_TASK", 0)
    assert found_and_tasks(many_partitions, links)[0] == few
