"""Rounds and checkpoints leave no more files than their rows ask for, whatever the number of shuffle partitions."""

import pytest

from ledgerleaf.llm import common, simhash


@pytest.fixture
def many(spark):
    had = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", "61")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield spark
    for k, v in had.items():
        spark.conf.set(k, v)


def test_a_small_checkpoint_is_read_by_few_tasks(many):
    most = 2 * many.sparkContext.defaultParallelism
    made = common.cut(many.range(1000).repartition(61, "id"))
    assert made.rdd.getNumPartitions() <= most and sorted(r.id for r in made.collect()) == list(range(1000))


def test_rounds_of_components_are_written_by_few_tasks(many):
    status, ring = many.sparkContext._jsc.sc().statusTracker(), [(i, i + 1) for i in range(20)] + [(40, 41)]
    many.sparkContext.setJobGroup("components", "")
    got = {r.node: r.component for r in simhash.components(many.createDataFrame(ring, "u long, v long").repartition(61)).collect()}
    jobs = list(status.getJobIdsForGroup("components"))
    many.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    stages = {s for j in jobs for s in status.getJobInfo(j).get().stageIds()}
    tasks = sum(i.get().numCompletedTasks() for i in map(status.getStageInfo, stages) if i.isDefined())
    assert got == {i: 0 for i in range(21)} | {40: 40, 41: 40}
    assert tasks < 3000
