import datetime as dt
import time
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from barloom import files, session
from barloom.sinks import stores


class OnCluster:
    """The test session as a cluster's one would look; `hidden`: what the driver writes is not seen by tasks."""

    def __init__(self, spark, folder, warehouse, hidden=False):
        self._jvm, self._jsc = spark._jvm, spark._jsc
        values = {"spark.checkpoint.dir": folder, "spark.sql.warehouse.dir": warehouse}
        self.conf = SimpleNamespace(get=lambda key, default=None: values.get(key, default))
        context = spark.sparkContext
        made = SimpleNamespace(map=lambda f: SimpleNamespace(collect=lambda: [True, False]))
        self.sparkContext = SimpleNamespace(master="spark://host:7077", defaultParallelism=2, applicationId="app-1", getCheckpointDir=lambda: None,
                                            parallelize=(lambda *a: made) if hidden else context.parallelize)


@pytest.mark.parametrize("kind", ["file", "bare", "unset"])
def test_a_cluster_takes_any_shared_folder(spark, tmp_path, kind):
    folder = {"file": f"file://{tmp_path}/shared", "bare": f"{tmp_path}/shared", "unset": None}[kind]
    cluster = OnCluster(spark, folder, f"file://{tmp_path}/tables")
    expected = folder or f"file://{tmp_path}/tables/barloom-scratch"
    assert session.shared_folder(cluster) == expected
    assert session.scratch_path(cluster, "stage").startswith(f"{expected}/barloom-app-1/stage-")
    assert files.names(spark, expected) == []  # no mark is left


def test_a_folder_that_tasks_do_not_see_stops_the_job(spark, tmp_path):
    with pytest.raises(RuntimeError, match="all executors share"):
        session.shared_folder(OnCluster(spark, f"file://{tmp_path}", f"file://{tmp_path}/tables", hidden=True))


def test_stores_and_stages_work_on_a_cluster_with_a_bare_folder(spark, tmp_path, monkeypatch):
    """spark.checkpoint.dir of the test session is a bare path; with a cluster's master, staging stopped there."""
    monkeypatch.setattr(type(spark.sparkContext), "master", property(lambda self: "spark://host:7077"), raising=False)
    monkeypatch.delattr(spark.sparkContext, "_barloom_seen", raising=False)
    rows = spark.createDataFrame([("A", 1.5), ("B", None)], "security_id string, close double")
    assert sorted(session.stage(rows).collect()) == sorted(rows.collect())
    bars = spark.createDataFrame([("A", dt.date(2026, 1, 1), 1.0, 1.0, 1.0, 1.0, 5.0)],
                                 "security_id string, date date, open double, high double, low double, close double, volume double")
    assert stores.append_daily(bars, f"{tmp_path}/daily").isEmpty()
    assert spark.read.parquet(f"{tmp_path}/daily").count() == 1


def test_a_folder_of_one_machine_gives_way_to_the_shared_warehouse(spark, tmp_path):
    """spark.checkpoint.dir that executors do not see stopped the job though they share the warehouse."""
    cluster, answers = OnCluster(spark, f"{tmp_path}/alone", f"file://{tmp_path}/tables"), [[True, False], [True, True]]
    cluster.sparkContext.parallelize = lambda *a: SimpleNamespace(map=lambda f: SimpleNamespace(collect=lambda: answers.pop(0)))
    for _ in range(2):  # tasks are asked once
        assert session.shared_folder(cluster) == f"file://{tmp_path}/tables/barloom-scratch"
    assert not answers
    assert files.names(spark, f"{tmp_path}/alone") == files.names(spark, f"{tmp_path}/tables/barloom-scratch") == []


def test_a_large_step_leaves_no_shuffle_files(spark):
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    disk = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager()

    def shuffles():
        return {name for b in spark._jvm.scala.jdk.javaapi.CollectionConverters.asJava(disk.getAllBlocks()) if (name := b.name()).startswith("shuffle_")}
    before, setting = shuffles(), spark.conf.get(key, None)
    rows = spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count()
    kept = session.stage(rows)
    assert shuffles() - before  # else this test shows nothing
    again, settled = shuffles(), session.stage(rows, drop_shuffles=True)
    until = time.time() + 20
    while shuffles() - again and time.time() < until:
        time.sleep(.1)
    assert not shuffles() - again and spark.conf.get(key, None) == setting
    assert sorted(settled.collect()) == sorted(kept.collect())
