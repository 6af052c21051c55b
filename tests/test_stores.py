import datetime as dt
import gzip
import json
import os

import pytest
from pyspark.sql import functions as F

from barloom.sinks import stores as ST
from barloom.sinks.ledger import Write
from barloom.sources import charts as CH
from barloom.sources import documents as DOC
from barloom.sources import pages as PG
from barloom.streaming.ingest import ingest_bars
from tests.conftest import bar, bars_frame, days


def line(day, close, sid="US-000001", **extra):
    return {"security_id": sid, "date": str(day), "open": close, "high": close + 1, "low": close - 1, "close": close,
            "volume": 100, "adjustment_as_of": str(day), **extra}


def put(path, rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with gzip.open(path, "wt") as out:
        out.write("\n".join(json.dumps(r) for r in rows) + "\n")


def stored(spark, path):
    return sorted((r.security_id, r.date, r.close) for r in spark.read.parquet(path).collect())


def test_day_folders_and_effective_dates(spark, tmp_path):
    root, d = str(tmp_path / "DAILY"), days(3)
    put(f"{root}/{d[0]}/part-0001.ndjson.gz", [line(d[0], 10)])
    put(f"{root}/{d[1]}/aa/part-0001.ndjson.gz", [line(d[0], 11, trade_date=str(d[1]))])
    put(f"{root}/notes/part-0001.ndjson.gz", [line(d[2], 12)])
    rows = {r.folder_date: r for r in DOC.read_day_folders(spark, root).collect()}
    assert set(rows) == {d[0], d[1]} and rows[d[1]].close == 11
    assert {r.date for r in DOC.read_bars(spark, f"{root}/*/*.gz").collect()} == {d[0], d[2]}
    assert [r.date for r in DOC.read_bars(spark, f"{root}/{d[1]}/aa").collect()] == [d[1]]


def test_csv_snapshot_with_byte_order_mark(spark, tmp_path):
    path = str(tmp_path / "bars.csv.gz")
    with gzip.open(path, "wt", encoding="utf-8-sig") as out:
        out.write("security_id,date,open,high,low,close,volume\nUS-000001,2025-01-01,1,2,0.5,1.5,10\n")
    row = DOC.read_csv_bars(spark, path).first()
    assert row.security_id == "US-000001" and row.close == 1.5 and row.date == dt.date(2025, 1, 1)


def test_single_and_bulk_corrections(spark, tmp_path):
    d = days(2)
    single = {"security_id": "US-1", "accepted": True, "result": "RESOLVED", "rows": [line(d[0], 5, "US-1")]}
    bulk = {"items": [{"security_id": "US-2", "accepted": False, "result": "X", "rows": [line(d[0], 6, "US-2"), line(d[1], 7, "US-2")]},
                      {"security_id": "US-3", "result": "RESOLVED", "rows": [line(d[0], 8, "US-3")]}]}
    os.makedirs(tmp_path / "p" / "aa")
    (tmp_path / "p" / "aa" / "one.json").write_text(json.dumps(single, indent=1))
    (tmp_path / "p" / "many.json").write_text(json.dumps(bulk))
    rows = {(r.security_id, r.position): (r.item, r.accepted, r.close) for r in DOC.read_patches(spark, str(tmp_path / "p")).collect()}
    assert rows == {("US-1", 0): (0, True, 5), ("US-2", 0): (0, False, 6), ("US-2", 1): (0, False, 7), ("US-3", 0): (1, False, 8)}


def test_second_append_writes_nothing(spark, tmp_path):
    path, d = str(tmp_path / "store"), days(3)
    rows = bars_frame(spark, [bar(x, 100 + i) for i, x in enumerate(d)])
    ST.append_daily(rows, path)
    files = len([f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")])
    ST.append_daily(rows, path)
    assert len(stored(spark, path)) == 3
    assert len([f for _, _, names in os.walk(path) for f in names if f.endswith(".parquet")]) == files
    wrong = ST.append_daily(bars_frame(spark, [bar(d[0], 999), bar(d[0], 50, "US-000002")]), path)
    assert [(r.security_id, r.trade_date, r.error) for r in wrong.collect()] == [("US-000001", d[0], "CONFLICT_WITH_STORED")]
    assert stored(spark, path)[0] == ("US-000001", d[0], 100.0) and len(stored(spark, path)) == 4


def test_copies_that_differ_are_violations(spark, tmp_path):
    path, d = str(tmp_path / "store"), days(2)
    rows = bars_frame(spark, [bar(d[0], 1), bar(d[0], 9), bar(d[1], 2), bar(d[1], 2)])
    assert [(r.trade_date, r.error) for r in ST.append_daily(rows, path).collect()] == [(d[0], "CONFLICT_IN_DELIVERY")]
    assert stored(spark, path) == [("US-000001", d[1], 2.0)]


def test_parts_under_the_older_suffix(spark, tmp_path):
    folder, d = str(tmp_path / "in"), days(3)
    put(f"{folder}/{d[0]}/part-1.ndjson.gz", [line(d[0], 10)])
    put(f"{folder}/{d[0]}/part-2.ndjson.gzip", [line(d[0], 11, "US-000002")])
    put(f"{folder}/{d[1]}/aa/part-1.ndjson.gzip", [line(d[1], 12)])
    rows = sorted((r.security_id, r.folder_date, r.close) for r in DOC.read_day_folders(spark, folder).collect())
    assert rows == [("US-000001", d[0], 10), ("US-000001", d[1], 12), ("US-000002", d[0], 11)]
    assert DOC.read_bars(spark, folder).count() == 3
    store, progress = str(tmp_path / "o"), str(tmp_path / "p")
    ingest_bars(spark, folder, store, progress)
    put(f"{folder}/{d[2]}/part-1.ndjson.gzip", [line(d[2], 13)])
    ingest_bars(spark, folder, store, progress)
    assert len(stored(spark, store)) == 4


def test_unpacking_of_many_members_long_lines_and_damage():
    text = b"".join(b"%d %s\n" % (i, b"x" * (i % 50)) for i in range(50_000)) + b"y" * 9_000_000 + b"\nlast"
    packed = b"".join(gzip.compress(text[at:at + 700_001]) + b"\0" * 300 for at in range(0, len(text), 700_001))
    lines = [x for piece in DOC._lines_of("f", memoryview(packed)) for x in piece]
    assert lines == text.decode().split("\n")
    assert list(DOC._lines_of("f", memoryview(b""))) == []
    for broken, message in ((packed[:-400], "cut short"), (packed[:5000] + b"junk" * 200 + packed[5800:], "cannot be unpacked")):
        with pytest.raises(ValueError, match=message):
            list(DOC._lines_of("f", memoryview(broken)))


def test_stream_equals_batch_and_late_dates_arrive(spark, tmp_path):
    arrivals, store, progress, d = str(tmp_path / "in"), str(tmp_path / "out"), str(tmp_path / "progress"), days(4)
    put(f"{arrivals}/{d[1]}/part-1.ndjson.gz", [line(d[1], 11), line(d[2], 12)])
    ingest_bars(spark, arrivals, store, progress)
    put(f"{arrivals}/{d[0]}/part-1.ndjson.gz", [line(d[0], 10), line(d[1], 99)])
    ingest_bars(spark, arrivals, store, progress)
    ingest_bars(spark, arrivals, store, progress)
    batch = str(tmp_path / "batch")
    ST.append_daily(bars_frame(spark, [bar(d[0], 10), bar(d[1], 11), bar(d[2], 12)]), batch)
    assert stored(spark, store) == stored(spark, batch)
    assert [c for _, _, c in stored(spark, store)] == [10.0, 11.0, 12.0]


def test_rank_is_written_in_parts_and_only_when_it_changed(spark, tmp_path):
    rows = [(i, f"US-{i:06d}", None if i > 600 else 1000.0 - i, i <= 600) for i in range(1, 621)]
    first = spark.createDataFrame(rows, "rank int, security_id string, rank_score double, filter_pass boolean").repartition(7)
    assert ST.write_rank(first, str(tmp_path), "2026-10-12") is True
    assert ST.write_rank(first.repartition(3), str(tmp_path), "2026-10-12") is False
    store = ST.open_rank(spark, str(tmp_path), "2026-10-12")
    parts = store.read("detail").groupBy("part").agg(F.min("rank"), F.max("rank"), F.count_distinct("_metadata.file_path")).collect()
    assert sorted(map(tuple, parts)) == [(1, 1, 250, 1), (2, 251, 500, 1), (3, 501, 620, 1)]
    assert [tuple(r) for r in store.read("list").select("rank", "security_id").orderBy("rank").collect()] == [r[:2] for r in rows]
    shorter = first.filter("rank <= 300").withColumn("rank_score", F.lit(1.0))
    assert ST.write_rank(shorter, str(tmp_path), "2026-10-12") is True
    assert store.values("detail") == ["1", "2"] and store.read("detail").count() == store.read("list").count() == 300
    assert store.read("receipt").select("rows", "detail_parts").collect() == [(300, 2)]
    assert ST.write_rank(first, str(tmp_path), "2026-10-12") is True and store.read("detail").count() == 620


def test_digests_see_every_change_and_merge(spark):
    from barloom.functions import digests as DG
    ddl = "k int, a double, b string, c date"
    rows = [(i % 3, i / 7, None if i % 5 == 0 else "x|" * (i % 4), dt.date(2026, 1, 1 + i % 9)) for i in range(60)]

    def of(rows, **kw):
        return DG.content_digest(spark.createDataFrame(rows, ddl).repartition(4), ["k", "a", "b", "c"], **kw).collect()
    [whole] = of(rows)
    assert whole == of(rows[::-1])[0]
    changed = [(rows[7][0], rows[7][1] + 1e-15, *rows[7][2:])] + rows[:7] + rows[8:]
    swapped = [(0, 1.0, "ab", None), (0, 1.0, "c", None)], [(0, 1.0, "a", None), (0, 1.0, "bc", None)]
    assert len({r["digest"] for r in (whole, of(changed)[0], of(rows[1:])[0], of(rows + rows[:1])[0])}) == 4 and of(swapped[0]) != of(swapped[1])
    parts = DG.content_digest(spark.createDataFrame(rows, ddl), ["k", "a", "b", "c"], ["k"])
    assert parts.agg(DG.merged(F.col("digest"))).first()[0] == whole["digest"]
    assert DG.content_digest(spark.createDataFrame([], ddl), ["k"]).first()["digest"] == "0:0:0"


def test_conflicting_correction_is_not_written(spark, tmp_path):
    ddl = "market string, security_id string, category string, batch int, trade_date date, result string, accepted boolean"
    path = str(tmp_path / "patches")
    one = spark.createDataFrame([("US", "a", "DATA_SUSPECT", 1, None, "RESOLVED", True)], ddl)
    assert ST.append_patches(one, path) is None and ST.append_patches(one, path) is None
    other = spark.createDataFrame([("US", "a", "DATA_SUSPECT", 1, None, "IDENTITY_FIXED", True), ("US", "b", "X", 1, None, "RESOLVED", True)], ddl)
    assert ST.append_patches(other, path).count() == 1
    assert spark.read.parquet(path).count() == 1


def test_snapshot_manifest_and_no_overwrite(spark, tmp_path):
    path = str(tmp_path / "snap")
    rows = bars_frame(spark, [bar(d, 100) for d in days(50)])
    ST.write_snapshot(rows, path, rows_per_file=20)
    manifest = ST.snapshot_manifest(spark, path).collect()
    assert sum(r["rows"] for r in manifest) == 50 and all(len(r.sha256) == 64 and r.bytes > 0 for r in manifest)
    with pytest.raises(Exception, match="PATH_ALREADY_EXISTS"):
        ST.write_snapshot(rows, path)


def test_listing_files(spark, tmp_path):
    good = "﻿Symbol|Security Name|Test Issue|ETF\nA.B|Alpha Common Stock|N|N\nW|Alpha Warrants|N|N\nE|Fundless|N|Y\nT|Test|Y|N\nFile Creation Time: 1|||\n"
    other = "ACT Symbol|Security Name|Exchange|ETF|Test Issue\nC|Gamma|N|N|N\nD|Delta|P|N|N\nM|Mu|A|N|N\n"
    (tmp_path / "nasdaqlisted.txt").write_text(good, encoding="utf-8")
    (tmp_path / "otherlisted.txt").write_text(other, encoding="utf-8")
    rows = PG.read_listing_files(spark, [str(tmp_path / n) for n in ("nasdaqlisted.txt", "otherlisted.txt")])
    assert {r.file: r.error for r in rows.collect()} == {"nasdaqlisted.txt": None, "otherlisted.txt": "OFFICIAL_US_TIMESTAMP_MISSING"}
    from barloom.operators.listing import us_listing
    got = {r.source_symbol: (r.ticker, r.exchange) for r in us_listing(rows).collect()}
    assert got == {"A.B": ("A-B", "NASDAQ"), "C": ("C", "NYSE"), "M": ("M", "NYSE_AMERICAN")}
    assert len(us_listing(rows, exclude=False).collect()) == 7
    assert PG.listing_size_violation(us_listing(rows)).first().error == "OFFICIAL_US_LIST_INCOMPLETE"


def test_table_cells_and_table_id(spark):
    html = ("<table id='x'><tr><th>BM Date</th></tr><tr><td>01/02/2026</td><td> A&amp;B\n c </td></tr></table>"
            "<table id=y><tr><td>other</td></tr></table>")
    page = spark.createDataFrame([(1, html)], "page_id int, html string")
    assert [(r.row_no, r.cell_no, r.text) for r in PG.page_cells(page).orderBy("row_no", "cell_no").collect()] == [
        (0, 0, "BM Date"), (1, 0, "01/02/2026"), (1, 1, "A&B c"), (2, 0, "other")]
    assert [(r.page_id, r.row_no, r.cell_no, r.text) for r in PG.table_cells(page, "y").collect()] == [(1, 0, 0, "other")]
    assert sorted((r.row_no, r.cell_no, r.text) for r in PG.table_cells(page).collect()) == [(0, 0, "BM Date"), (1, 0, "01/02/2026"), (1, 1, "A&B c"), (2, 0, "other")]


def cells_of(spark, html, table_id=None):
    got = {}
    for r in PG.table_cells(spark.createDataFrame([(1, html)], "page_id int, html string"), table_id).orderBy("row_no", "cell_no").collect():
        got.setdefault(r.row_no, []).append(r.text)
    return got


def test_nested_tables(spark):
    inner = "<table><tr><td>in</td><td>ner</td></tr></table>"
    html = (f"<TABLE><tr><td>before</td></tr></TABLE><table class=w id='x'><tr><td>1</td></tr><tr><td>a{inner}b</td><td>lost</td></tr>"
            f"<tr></tr><tr><th>2</th><td></td></tr></table><table id=z><tr><td>after</td></tr></table>")
    assert cells_of(spark, html, "x") == {0: ["1"], 1: ["in", "ner"], 3: ["2", ""]}
    assert cells_of(spark, html, "z") == {0: ["after"]} and cells_of(spark, html, "none") == {}
    assert cells_of(spark, html) == {0: ["before"], 1: ["1"], 2: ["in", "ner"], 4: ["2", ""], 5: ["after"]}
    assert cells_of(spark, "<table id=x><tr><td>open<tr><td>next</td><td>cut</tr></table></table><tr><td>out</td></tr>", "x") == {0: ["next"]}
    assert cells_of(spark, f"<table id=x>{'<tr><td>' * 3}deep{'</td></tr>' * 3}" + "<tr><td>" + "w" * 100_000 + "</td></tr></table>", "x") == {0: ["deep"], 1: ["w" * 100_000]}
    assert cells_of(spark, "", "x") == {} and cells_of(spark, None) == {}


def test_designated_list_takes_the_newest_usable_page(spark):
    def page(day, codes):
        body = "".join(f"<tr><td>1</td><td>{c}</td><td>N{c}</td></tr>" for c in codes)
        return ("hk", day, 0, f"Designated Securities<table>{body}<tr><td>x</td><td>no</td></tr></table>")
    as_of = dt.date(2026, 10, 1)
    pages = [page(as_of, range(50)), page(as_of - dt.timedelta(days=2), list(range(1, 101)) + [7]), page(as_of - dt.timedelta(days=1), range(99)),
             page(as_of - dt.timedelta(days=30), range(500))]
    got = PG.designated_securities(spark.createDataFrame(pages, "list_id string, page_date date, page_no int, html string"), as_of).collect()
    assert len(got) == 100 and {r.effective_date for r in got} == {as_of - dt.timedelta(days=2)}
    assert {r.ticker for r in got if r.stock_code == 7} == {"0007.HK"}


def test_chart_payload(spark):
    from pyspark.sql import types as T
    from barloom.schemas import CHART
    stamp = int(dt.datetime(2026, 1, 5, 22, tzinfo=dt.timezone.utc).timestamp())
    chart = (None, [stamp, stamp + 86400, stamp + 2 * 86400], [1.0, 2.0, None], [1.0, 2.5, 3.0], [0.9, 1.5, 2.0], [1.5, 2.0, 2.5],
             [10.0, float("nan"), 5.0], {"a": (stamp, 4.0, 0.0), "b": (stamp, 0.0, 1.0)})
    schema = T.StructType([T.StructField(n, T.StringType()) for n in ("security_id", "market", "ticker")] + [T.StructField("chart", CHART)])
    payload = spark.createDataFrame([("US-1", "US", "A", chart), ("HK-1", "HK", "0001.HK", chart)], schema)
    calendar = spark.createDataFrame([(d,) for d in days(10, dt.date(2026, 1, 1))], "date date")
    got = {r.security_id: r for r in CH.chart_bars(payload, calendar, "2026-01-31").collect()}
    assert got["US-1"].date == dt.date(2026, 1, 5) and got["US-1"].high == 1.0
    assert got["HK-1"].date == dt.date(2026, 1, 6) and got["HK-1"].high == 1.5  # the envelope takes in the close
    splits = CH.chart_splits(payload).filter("security_id = 'US-1'").collect()
    assert [(s.effective_date, s.factor) for s in splits] == [(dt.date(2026, 1, 5), 4.0)]
    rows = bars_frame(spark, [bar(dt.date(2026, 1, 4), 10, "US-1"), bar(dt.date(2026, 1, 5), 10, "US-1")])
    undone = {r.date.day: (r.close, r.volume) for r in CH.undo_later_splits(rows, CH.chart_splits(payload), "2026-01-04").collect()}
    assert undone == {4: (40.0, 25.0), 5: (10.0, 100.0)}


def test_same_prices_with_another_anchor_are_a_violation(spark, tmp_path):
    path, d = str(tmp_path / "store"), days(1)
    rows = bars_frame(spark, [bar(d[0], 1, anchor=dt.date(2025, 1, 2)), bar(d[0], 1, anchor=dt.date(2026, 1, 2)), bar(d[0], 1, "US-000002")])
    assert [(r.security_id, r.error) for r in ST.append_daily(rows, path).collect()] == [("US-000001", "CONFLICT_IN_DELIVERY")]
    later = bars_frame(spark, [bar(d[0], 1, "US-000002", anchor=dt.date(2027, 1, 1))])
    assert [(r.security_id, r.error) for r in ST.append_daily(later, path).collect()] == [("US-000002", "CONFLICT_WITH_STORED")]
    assert stored(spark, path) == [("US-000002", d[0], 1.0)]


def test_days_are_committed_whole_and_once(spark, tmp_path):
    from barloom.plans import daily_append as DA
    d = days(7)
    ids = [f"US-{i:06d}" for i in range(1, 11)]
    universe = spark.createDataFrame([(s, "US", "ACTIVE", "NEW_LISTING" if s == ids[1] else None, None, False) for s in ids],
                                     "security_id string, market string, listing_status string, security_id_origin string, listing_date date, listing_date_verified boolean")
    sessions = spark.createDataFrame([(x, i) for i, x in enumerate(d)], "date date, idx long")
    source = bars_frame(spark, [bar(x, 10 + i, s, low=-1.0 if (s, i) == (ids[2], 6) else 9.0) for s in ids[1:] for i, x in enumerate(d) if (s, i) != (ids[3], 5)])
    store = DA.open_daily(spark, str(tmp_path))
    past = spark.createDataFrame([("US", ids[0], "FETCH_FAILED", x, "OPEN") for x in d[2:5]], DA.QUEUE)
    store.commit("before", {"queue": Write(past), "bars": Write(source.filter(F.col("date").between(d[1], d[4])).withColumn("trade_date", F.col("date")))})

    def stop(table):
        if table == "reviews":
            raise InterruptedError
    assert DA.append_day(store, universe, source, sessions, d[0], d[5])
    with pytest.raises(InterruptedError):
        DA.append_day(store, universe, source, sessions, d[0], d[6], after_write=stop)
    assert str(d[6]) not in store.batches() and store.read("bars").count() == 9 * 4 + 8
    assert DA.append_day(store, universe, source, sessions, d[0], d[6]) and not DA.append_day(store, universe, source, sessions, d[0], d[6])
    assert store.read("bars").count() == 9 * 6 - 1 and store.read("bars").filter("date <> trade_date").count() == 0
    queue = {(r.security_id, r.category): r.n for r in store.read("queue").groupBy("security_id", "category").agg(F.count("*").alias("n")).collect()}
    assert queue == {(ids[0], "FETCH_FAILED"): 5, (ids[0], "SUSPECT_DELISTED"): 1, (ids[2], "DATA_SUSPECT"): 1, (ids[3], "FETCH_FAILED"): 1}
    assert [(r.security_id, r.trade_date) for r in store.read("reviews").collect()] == [(ids[0], d[6])]
    assert [(r.security_id, r.bar_count, r.history_status) for r in store.read("history").collect()] == [(ids[1], 6, "SHORT_HISTORY")]
    assert {(r.trade_date, r.active, r.available) for r in store.read("receipts").collect()} == {(d[5], 10, 8), (d[6], 10, 9)}


def test_an_outage_leaves_its_receipt_and_the_day_open(spark, tmp_path):
    from barloom.plans import daily_append as DA
    d = days(2)
    ids = [f"US-{i:06d}" for i in range(1, 6)]
    universe = spark.createDataFrame([(s, "US", "ACTIVE", None, None, False) for s in ids],
                                     "security_id string, market string, listing_status string, security_id_origin string, listing_date date, listing_date_verified boolean")
    sessions = spark.createDataFrame([(x, i) for i, x in enumerate(d)], "date date, idx long")
    store = DA.open_daily(spark, str(tmp_path))
    assert DA.append_day(store, universe, bars_frame(spark, [bar(d[1], 5, ids[0])]), sessions, d[0], d[1])
    assert [r.status for r in store.read("receipts").collect()] == ["MARKET_WIDE_DATA_UNAVAILABLE"] and store.read("bars") is None
    assert DA.append_day(store, universe, bars_frame(spark, [bar(d[1], 5, s) for s in ids]), sessions, d[0], d[1])
    assert [(r.status, r.written) for r in store.read("receipts").collect()] == [("COMPLETE", 5)]
