"""Session set-up and the shared scratch folder used to cut lineage."""
from __future__ import annotations

import contextlib
import os
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

from barloom import files


def build_session(app: str = "barloom", master: str | None = None, **conf) -> SparkSession:
    """A session with the settings the jobs assume; the cluster's own values win."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        **{k.replace("__", "."): v for k, v in conf.items()},
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The cluster's shared folder: of spark.checkpoint.dir, the context's checkpoint folder and a folder of the warehouse
    the first that all executors share.

    Any address will do, `file:` and bare paths too, as a shared disk may be mounted everywhere. Of such a path tasks
    confirm once that they see what the driver writes. A folder is made up only where everything runs in one process.
    """
    context = spark.sparkContext
    named = [x for x in (spark.conf.get("spark.checkpoint.dir", None), context.getCheckpointDir()) if x]
    if context.master == "local" or context.master.startswith("local["):
        if not named:
            context._barloom_folder = getattr(context, "_barloom_folder", None) or tempfile.mkdtemp(prefix="barloom-")
            named = [context._barloom_folder]
        return named[0]
    named.append(os.path.join(spark.conf.get("spark.sql.warehouse.dir"), "barloom-scratch"))
    known, folder = getattr(context, "_barloom_seen", None) or (None, None)
    if known != named:
        folder = next((x for x in named if _seen_by_tasks(spark, x)), None)
        if folder is None:
            raise RuntimeError(f"spark.checkpoint.dir must name a folder that all executors share; some see none of {', '.join(named)}")
        context._barloom_seen = (named, folder)
    return folder


def _seen_by_tasks(spark: SparkSession, folder: str) -> bool:
    """False where a folder on a file system of the machine is not the same one for the executors."""
    mark = os.path.join(folder, "barloom-seen-" + uuid.uuid4().hex)
    place = spark._jvm.org.apache.hadoop.fs.Path(mark)
    system = place.getFileSystem(spark._jsc.hadoopConfiguration())
    if system.getUri().getScheme() != "file":
        return True
    path = system.makeQualified(place).toUri().getPath()
    files.create_text(spark, mark, "")
    try:
        tasks = spark.sparkContext.defaultParallelism
        return all(spark.sparkContext.parallelize(range(tasks), tasks).map(lambda _: os.path.exists(path)).collect())
    finally:
        files.delete(spark, mark)


def stage(df: DataFrame, drop_shuffles: bool = False) -> DataFrame:
    """Write an intermediate result reliably so later reads never recompute it.

    Used where a result is read more than once, or where row placement must not
    change between reads. Survives executor loss because the files are shared.
    `drop_shuffles` is for large steps: their shuffle files go once the result is written.
    """
    spark = df.sparkSession
    path = scratch_path(spark, "stage")
    with _shuffles_dropped(spark) if drop_shuffles else contextlib.nullcontext():
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def _shuffles_dropped(spark: SparkSession):
    """Queries begun inside delete their shuffle files when they end; else the files stay until the driver collects garbage,
    which may be after the job. Where Spark does not know the setting they stay as ever."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(key, None)
    spark.conf.set(key, "true")
    try:
        yield
    finally:
        spark.conf.unset(key) if before is None else spark.conf.set(key, before)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the application's own folder, so one delete tidies up after a job."""
    return os.path.join(shared_folder(spark), "barloom-" + spark.sparkContext.applicationId, name + "-" + uuid.uuid4().hex)
