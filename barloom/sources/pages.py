"""Rows and cells out of HTML pages, and the listing files of the exchanges."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from barloom import contracts as K
from barloom.functions.text import cell_text, hk_ticker, strip_markup


def page_cells(pages: DataFrame, row: str = "tr", cell: str = "td|th", text=cell_text) -> DataFrame:
    """(page columns, row_no, cell_no, text) for every cell of every row element, from its start tag to the next end tag."""
    kept = [c for c in pages.columns if c != "html"]
    rows = pages.select(*kept, F.posexplode(F.regexp_extract_all(
        "html", F.lit(rf"(?is)<{row}\b[^>]*>(.*?)</{row}>"), F.lit(1))).alias("row_no", "markup"))
    cells = rows.select(*kept, "row_no", F.posexplode(F.regexp_extract_all(
        "markup", F.lit(rf"(?is)<(?:{cell})\b[^>]*>(.*?)</(?:{cell})>"), F.lit(1))).alias("cell_no", "cell"))
    return cells.select(*kept, "row_no", "cell_no", text(F.col("cell")).alias("text"))


def table_cells(pages: DataFrame, table_id: str | None = None, text=cell_text) -> DataFrame:
    """(page columns, row_no, cell_no, text) of the tables of pages; `table_id`: of the table with that id and those in it.

    Pages are cut at their table, row and cell tags. How deep a piece lies, and which row and cell are open in it, follow
    from running sums over the tags before it, so nested tables are told apart: a row that begins inside a cell ends that
    cell's row, whose later cells are not read. Rows and cells count where they are closed. The pieces of a page stand in one
    window; ids are taken to be unique within a page.
    """
    kept = [c for c in pages.columns if c != "html"]
    known = pages.select(F.monotonically_increasing_id().alias("_page"), F.struct(*kept).alias("_kept"), "html")
    cut = known.select("_page", "_kept", F.posexplode(F.split("html", r"(?i)(?=</?(?:table|tr|td|th)\b)")).alias("_at", "piece"))
    tag = F.lower(F.regexp_extract("piece", r"(?i)^<(/?(?:table|tr|td|th))\b", 1))
    kind = F.regexp_replace(F.regexp_replace(tag, "t[dh]$", "cell"), "^(?=[a-z])", "+")
    if table_id is None:
        wanted = F.lit(False)
    else:
        wanted = (tag == "table") & (F.regexp_extract("piece", r"(?is)^<table\b[^>]*?\sid\s*=\s*([\"']?)([^\"'\s>]*)\1", 2) == table_id)
    page = Window.partitionBy("_page").orderBy("_at")
    pieces = cut.select("_page", "_kept", "_at", "piece", kind.alias("kind"), wanted.alias("wanted"))
    depth = F.sum(F.when(F.col("kind") == "+table", 1).when(F.col("kind") == "/table", -1).otherwise(0)).over(page)
    pieces = pieces.select("*", depth.alias("depth"), F.sum(F.col("wanted").cast("int")).over(page).alias("region"))
    if table_id is not None:
        inside = Window.partitionBy("_page", "region").orderBy("_at").rowsBetween(Window.unboundedPreceding, 0)
        pieces = pieces.withColumn("in", (F.col("region") > 0) & (F.min("depth").over(inside) >= F.first("depth").over(inside))).filter("in")
    last = {t: F.last(F.when(F.col("kind").isin(f"+{t}", f"/{t}"), F.col("kind")), ignorenulls=True).over(page) == f"+{t}" for t in ("tr", "cell")}
    # The row that was open when a tag came: an end tag of a row still belongs to it.
    lined = pieces.select("*", F.sum((F.col("kind") == "+tr").cast("int")).over(page).alias("row"), F.sum((F.col("kind") == "+cell").cast("int")).over(page).alias("cell"),
                          F.coalesce(last["tr"], F.lit(False)).alias("in_row"), F.coalesce(last["cell"], F.lit(False)).alias("in_cell"))
    words = F.when(F.col("in_cell"), F.struct("_at", F.col("piece")))
    cells = lined.filter("row > 0").groupBy("_page", "row", "cell").agg(
        F.first("_kept").alias("_kept"), F.array_sort(F.collect_list(words)).alias("words"),
        F.bool_or((F.col("kind") == "+cell") & F.col("in_row")).alias("opened"), F.bool_or((F.col("kind") == "/cell") & F.col("in_row")).alias("closed"),
        F.bool_or(F.col("kind") == "/tr").alias("ended"))
    by_row = Window.partitionBy("_page", "row")
    upto = Window.partitionBy("_page").orderBy("row").rangeBetween(Window.unboundedPreceding, 0)
    rows = cells.withColumn("whole", F.bool_or("ended").over(by_row)).withColumn("lead", F.row_number().over(by_row.orderBy("cell")) == 1)
    rows = rows.withColumn("row_no", (F.sum((F.col("lead") & F.col("whole")).cast("int")).over(upto) - 1).cast("int")).filter("whole AND opened AND closed")
    numbered = rows.withColumn("cell_no", (F.row_number().over(by_row.orderBy("cell")) - 1).cast("int"))
    markup = F.array_join(F.transform("words", lambda w: w["piece"]), "")
    return numbered.select("_kept.*", "row_no", "cell_no", text(markup).alias("text"))


def designated_securities(pages: DataFrame, as_of, minimum: int = K.MIN_DESIGNATED_ROWS,
                          lookback: int = K.DESIGNATED_LOOKBACK_DAYS) -> DataFrame:
    """Short-selling list of the newest usable page in the days up to `as_of`.

    `pages`: list_id (which list the page is an issue of), page_date, page_no (order of the
    pages of one issue), html. An issue needs the heading and at least `minimum` codes; a
    repeated code keeps its last row.
    """
    day, issue = F.lit(as_of).cast("date"), ["list_id", "page_date"]
    recent = pages.filter(F.col("page_date").between(F.date_sub(day, lookback - 1), day)
                          & F.contains("html", F.lit("Designated Securities")))
    cells = page_cells(recent.select(*issue, "page_no", "html"), cell="td", text=strip_markup)
    wide = cells.groupBy(*issue, "page_no", "row_no").agg(
        F.max(F.when(F.col("cell_no") == 1, F.col("text"))).alias("code"), F.max(F.when(F.col("cell_no") == 2, F.col("text"))).alias("name"))
    coded = wide.filter(F.col("code").rlike(r"^\d{1,5}$")).withColumn("stock_code", F.col("code").cast("int"))
    last = (coded.groupBy(*issue, "stock_code").agg(F.max_by(
        F.coalesce("name", F.lit("")), F.struct("page_no", "row_no")).alias("name")))
    usable = last.groupBy(*issue).agg(F.count(F.lit(1)).alias("codes")).filter(F.col("codes") >= minimum)
    newest = usable.groupBy("list_id").agg(F.max("page_date").alias("page_date"))
    return (last.join(newest, issue, "left_semi")
            .select("list_id", F.col("page_date").alias("effective_date"), "stock_code", hk_ticker(F.col("stock_code")).alias("ticker"), "name"))


def designated_missing(pages: DataFrame, as_of, minimum: int = K.MIN_DESIGNATED_ROWS, lookback: int = K.DESIGNATED_LOOKBACK_DAYS) -> DataFrame:
    """An error row for every list that has no usable issue in the days looked at."""
    usable = designated_securities(pages, as_of, minimum, lookback).select("list_id").distinct()
    return pages.select("list_id").distinct().join(usable, "list_id", "left_anti").withColumn("error", F.lit("DESIGNATED_LIST_UNAVAILABLE"))


FOOTER = "File Creation Time:"


def listing_rows(lines: DataFrame) -> DataFrame:
    """Rows of pipe-delimited symbol files, named by their header.

    `lines`: file, place (order within the file), value. Only the header and the footer, one
    line per file each, are brought together; the lines themselves stay spread. A file
    without the creation-time footer in its last three lines marks its rows with an error.
    """
    lines = lines.withColumn("value", F.regexp_replace("value", "^\ufeff", "")).filter("value <> ''")
    header = lines.groupBy("file").agg(F.min("place").alias("first"),
                                       F.split(F.min_by("value", "place"), r"\|").alias("header"),
                                       F.max(F.when(F.col("value").startswith(FOOTER), F.col("place"))).alias("footer"))
    placed = lines.join(header, "file")
    tail = placed.groupBy("file").agg(F.count(F.when(F.col("place") > F.col("footer"), 1)).alias("after"),
                                      F.max("footer").isNotNull().alias("stamped"))
    sound = tail.select("file", (F.col("stamped") & (F.col("after") <= 2)).alias("sound"))
    body = placed.filter((F.col("place") > F.col("first")) & F.contains("value", F.lit("|")) & ~F.col("value").startswith(FOOTER))
    cells = body.withColumn("cells", F.split("value", r"\|")).join(sound, "file")

    def named(*names):
        found = [F.try_element_at("cells", F.nullif(F.array_position("header", n), F.lit(0).cast("bigint")).cast("int")) for n in names]
        return F.coalesce(*found)

    return cells.select("file", F.col("place").alias("sequence"), named("Symbol", "ACT Symbol").alias("symbol"),
                        named("Security Name").alias("name"), named("ETF").alias("etf"), named("Test Issue").alias("test_issue"),
                        named("Exchange").alias("exchange"), F.when(~F.col("sound"), "OFFICIAL_US_TIMESTAMP_MISSING").alias("error"))


def read_listing_files(spark: SparkSession, paths) -> DataFrame:
    """Symbol files as lines; their place follows the block they were read from."""
    texts = spark.read.text(paths).select(
        F.element_at(F.split(F.col("_metadata.file_path"), "/"), -1).alias("file"),
        F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("line")).alias("place"), "value")
    return listing_rows(texts)


def listing_size_violation(listed: DataFrame, minimum: int = K.MIN_LISTING_ROWS) -> DataFrame:
    return (listed.agg(F.count(F.lit(1)).alias("rows"))
            .select("rows", F.when(F.col("rows") < minimum, "OFFICIAL_US_LIST_INCOMPLETE").alias("error")))
