"""A store of day folders that follows its files: only days whose files changed are read and replaced."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from barloom.operators.quality import source_diff
from barloom.session import stage
from barloom.sinks.ledger import Ledger, Write
from barloom.sources.documents import DAY_FOLDER, SUFFIXES, read_day_folders


def open_mirror(spark: SparkSession, root: str) -> Ledger:
    """The store: bars and the index of the files they came from, both by the folder's date, committed together."""
    return Ledger(spark, root, {"bars": "folder_date", "files": "folder_date"})


def file_index(spark: SparkSession, root: str) -> DataFrame:
    """Files of the day folders below `root`: path, md5, size, folder, folder_date. Contents are hashed where they lie."""
    found = (spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", SUFFIXES).load(root)
             .select("path", F.md5("content").alias("md5"), F.col("length").alias("size")))
    date = F.to_date(F.nullif(F.regexp_extract("path", DAY_FOLDER, 1), F.lit("")))
    return (found.withColumn("folder", F.regexp_replace("path", r"/[^/]+$", "")).withColumn("folder_date", date)
            .filter("folder_date IS NOT NULL"))


def refresh(mirror: Ledger, root: str, batch: str) -> DataFrame:
    """Bring the store up to what `root` holds now; returns the state of every file: NEW, CHANGED, DELETED or UNCHANGED.

    A file counts as changed where its digest or size differs, so one corrected without a change of size counts. Days
    with a file that is not unchanged are read anew, all their files, and replaced; all other days keep their place in
    the store. Rows and index are committed together: a refresh that stops has changed nothing.
    """
    spark = mirror.spark
    live = stage(file_index(spark, root))
    saved = mirror.read("files")
    saved = live.limit(0) if saved is None else saved
    states = stage(source_diff(saved.select("path", "md5", "size"), live.select("path", "md5", "size")))
    moved = states.filter("state <> 'UNCHANGED'").select("path")
    known = live.select("path", "folder", "folder_date").unionByName(saved.select("path", "folder", "folder_date")).distinct()
    touched = [r.folder_date for r in known.join(moved, "path").select("folder_date").distinct().collect()]  # days
    if touched:
        again = live.filter(F.col("folder_date").isin(touched))
        folders = [r.folder for r in again.select("folder").distinct().collect()]
        rows = read_day_folders(spark, folders) if folders else mirror.read("bars").limit(0)
        mirror.commit(batch, {"bars": Write(rows, emptied=tuple(touched)), "files": Write(again, emptied=tuple(touched))})
    return states
