"""Bars, corrections, corporate actions and snapshots as files."""
from __future__ import annotations

import sys
import zlib

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from barloom import contracts as K
from barloom.operators.compose import effective_bars
from barloom.schemas import CORPORATE_ACTION, PATCH, PATCH_DOCUMENT, STORED_BAR

# Ship these helpers inside the serialized function: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

DAY_FOLDER = r"/(?:[a-z_]+=)?(\d{4}-\d{2}-\d{2})/(?:[^/]+/)?[^/]+$"


#: Both spellings of a compressed part. Spark's readers unpack `.gz` by themselves; `.gzip`, the older one, is unpacked here.
SUFFIXES = "*.{gz,gzip}"
#: Compressed bytes taken at a time, and bytes of text given at a time.
CHUNK_BYTES, PIECE_BYTES = 256 << 10, 4 << 20


def unpacked_lines(files: DataFrame) -> DataFrame:
    """files(path, content), gzip, of any number of members -> (path, value), a row for each line.

    A task holds one file's compressed bytes and a piece of some megabytes of its text. A file that is damaged or cut
    short stops the job with its name.
    """
    def run(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                path, content = batch["path"][i].as_py(), batch["content"][i].as_buffer()
                for lines in _lines_of(path, memoryview(content)):
                    yield pa.RecordBatch.from_arrays([pa.array([path] * len(lines), pa.string()), pa.array(lines, pa.string())], names=["path", "value"])
    return files.select("path", "content").mapInArrow(run, "path string, value string")


def _text_of(path: str, data: memoryview):
    """Pieces of a gzip file's text, member after member; zeros between members are padding."""
    unpack, idle = zlib.decompressobj(wbits=31), True
    try:
        for at in range(0, len(data), CHUNK_BYTES):
            piece = bytes(data[at:at + CHUNK_BYTES])
            while piece := piece.lstrip(b"\0") if idle else piece:
                idle = False
                while text := unpack.decompress(piece, PIECE_BYTES):
                    yield text
                    piece = unpack.unconsumed_tail
                piece = b""
                if unpack.eof:
                    piece, idle = unpack.unused_data, True
                    unpack = zlib.decompressobj(wbits=31)
    except zlib.error as error:
        raise ValueError(f"{path} cannot be unpacked: {error}") from None
    if not idle:
        raise ValueError(f"{path} is cut short")


def _lines_of(path: str, data: memoryview):
    """Lists of lines; the last line may lack its end."""
    rest = b""
    for text in _text_of(path, data):
        *lines, rest = (rest + text).split(b"\n")
        if lines:
            yield [x.decode("utf-8") for x in lines]
    if rest:
        yield [rest.decode("utf-8")]


def older_parts(reader, path: str | list[str]) -> DataFrame:
    """STORED_BAR rows and `file_path` of the `.gzip` parts below a path, for a batch or a stream reader."""
    files = (reader.format("binaryFile").schema("path string, modificationTime timestamp, length bigint, content binary")
             .option("recursiveFileLookup", True).option("pathGlobFilter", "*.gzip").load(path))
    parsed = unpacked_lines(files).filter(F.trim("value") != "")
    return parsed.select(F.from_json("value", STORED_BAR).alias("bar"), F.col("path").alias("file_path")).select("bar.*", "file_path")


def bar_parts(reader, path: str | list[str]) -> DataFrame:
    """STORED_BAR rows of all parts below a path, under either suffix, with `file_path`; for a batch or a stream reader."""
    plain = (reader.format("json").schema(STORED_BAR).option("recursiveFileLookup", True).option("pathGlobFilter", "*.gz").load(path))
    return plain.select(*STORED_BAR.fieldNames(), F.col("_metadata.file_path").alias("file_path"))


def read_bars(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """Compressed newline-delimited JSON bars, with an explicit schema."""
    return effective_bars(bar_parts(spark.read, path).unionByName(older_parts(spark.read, path)).drop("file_path"))


def read_csv_bars(spark: SparkSession, path: str) -> DataFrame:
    """Compressed CSV snapshot with header; a byte-order mark is skipped by the line reader."""
    schema = "security_id string, date date, open double, high double, low double, close double, volume double"
    return spark.read.schema(schema).option("header", True).csv(path)


def read_day_folders(spark: SparkSession, root: str | list[str]) -> DataFrame:
    """Bars below `root/<date>/`, directly or one shard level down, with the folder's date.

    The folder may be bare or `name=<date>`; folders that are not dates are left out. `root` may also be a list of folders.
    """
    stored = bar_parts(spark.read, root).unionByName(older_parts(spark.read, root))
    rows = stored.withColumn("folder", F.regexp_extract("file_path", DAY_FOLDER, 1)).filter("folder <> ''")
    return rows.withColumn("folder_date", F.to_date("folder")).drop("folder", "file_path")


def explode_patches(documents: DataFrame) -> DataFrame:
    """One row per corrected bar; order is file path, then item, then position.

    A document is one correction, or many under `items`.
    """
    own = [c for c in PATCH.fieldNames()]
    single = F.array(F.struct(*own))
    items = documents.select("path", F.posexplode(F.coalesce("items", single)).alias("item", "patch"))
    patches = items.filter(F.col("patch.security_id").isNotNull())
    rows = patches.select("path", "item", "patch.accepted", "patch.result", F.col("patch.category").alias("category"),
                          F.posexplode("patch.rows").alias("position", "bar"))
    return rows.select(
        "bar.security_id", F.coalesce("bar.trade_date", "bar.date").alias("date"), "bar.open", "bar.high", "bar.low",
        "bar.close", "bar.volume", "bar.adjustment_as_of", F.coalesce("accepted", F.lit(False)).alias("accepted"),
        "result", "path", "item", "position")


def read_patches(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Correction documents: one JSON document a file, or one a line."""
    documents = (spark.read.schema(PATCH_DOCUMENT).option("multiLine", one_per_file).option("recursiveFileLookup", True)
                 .option("pathGlobFilter", "*.json").json(path))
    return explode_patches(documents.select("*", F.col("_metadata.file_path").alias("path")))


def read_corporate_actions(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Split events from lists of events: one list a file, or one list a line."""
    if one_per_file:
        events = (spark.read.schema(CORPORATE_ACTION).option("multiLine", True).option("recursiveFileLookup", True)
                  .option("pathGlobFilter", "*.json").json(path))
    else:
        lists = F.from_json("value", T.ArrayType(CORPORATE_ACTION))
        events = spark.read.text(path).select(F.inline(lists))
    return events.dropDuplicates(["security_id", "effective_date", "factor"])


def snapshot_violations(benchmark: DataFrame, tickers=K.BENCHMARK_TICKERS, sessions: int = K.WINDOW_SESSIONS,
                        as_of=None) -> DataFrame:
    """Tickers that are missing, unexpected, or do not hold exactly the window."""
    wanted = benchmark.sparkSession.range(1).select(F.explode(F.array(*[F.lit(t) for t in tickers])).alias("ticker"))
    have = benchmark.groupBy("ticker").agg(F.count(F.lit(1)).alias("bar_count"), F.max("date").alias("last_date"))
    joined = wanted.withColumn("wanted", F.lit(True)).join(have, "ticker", "full")
    late = F.col("last_date") != F.lit(as_of).cast("date") if as_of is not None else F.lit(False)
    error = (F.when(F.col("wanted").isNull(), "UNEXPECTED_TICKER").when(F.col("bar_count").isNull(), "MISSING_TICKER")
             .when(F.col("bar_count") != sessions, "BAR_COUNT").when(late, "AS_OF_DRIFT"))
    return joined.select("ticker", F.coalesce("bar_count", F.lit(0)).alias("bar_count"), error.alias("error")).filter("error IS NOT NULL")
