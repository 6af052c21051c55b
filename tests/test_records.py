import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.functions import dates as DT
from barloom.functions import text as X
from barloom.operators import listing as L
from barloom.operators import monitor as M
from barloom.operators import quality as Q
from barloom.operators import repair as P
from barloom.operators.indicators import session_index
from barloom.schemas import OPTION_CHAIN
from tests.conftest import bar, bars_frame, days


def one(spark, value, expression):
    return spark.createDataFrame([(value,)], "x string").select(expression(F.col("x")).alias("y")).first().y


@pytest.mark.parametrize("name,listing,closing", [
    ("Acme Warrants", "EXCLUDED_NON_COMMON", "EXCLUDED_NON_COMMON"), ("acme spac", "EXCLUDED_SPAC", "EXCLUDED_SPAC"),
    ("Acme Acquisition Corp Class A", "EXCLUDED_SPAC", "EXCLUDED_SPAC"), ("Acme Acquisition Corp", None, None),
    ("Acme SPAC Units", "EXCLUDED_NON_COMMON", "EXCLUDED_SPAC"), ("United Parts", None, None), ("Brightside Inc", None, None)])
def test_name_exclusions_and_their_precedence(spark, name, listing, closing):
    assert one(spark, name, X.listing_exclusion) == listing
    assert one(spark, name, X.closing_exclusion) == closing


@pytest.mark.parametrize("text,value", [("$1,234.50", 1234.5), ("(3.2)", -3.2), ("12%", 12.0), ("N/A", None), ("", None),
                                        ("--", None), ("-", None), ("abc", None), (None, None)])
def test_number_text(spark, text, value):
    assert one(spark, text, X.parse_number) == value


@pytest.mark.parametrize("text,key", [("700", "00700"), ("0700.HK", "00700"), ("code 12345", "12345"), ("1234567", None), ("abc", None)])
def test_hong_kong_codes(spark, text, key):
    assert one(spark, text, X.hk_ticker_key) == key


def test_markup_is_decoded_before_tags_go(spark):
    assert one(spark, "&lt;b&gt;A&amp;B&lt;/b&gt;&nbsp; x &#33;", X.strip_markup) == "A&B x !"


def test_calendar_invents_nothing(spark):
    seen = spark.createDataFrame([(dt.date(2026, 9, 25),)], "date date")
    ddl = "date date, session_status string, official_source string, evidence_ref string, open_time string, close_time string"
    rows = M.market_calendar(seen, spark.createDataFrame([], ddl), spark.createDataFrame([], "date date"), "2026-09-28").orderBy("trade_date").collect()
    assert [r.session_status for r in rows] == ["OPEN", "CLOSED", "CLOSED", "UNVERIFIED"]
    proof = spark.createDataFrame([(dt.date(2026, 9, 28), "CLOSED", "bulletin", "b1", None, None), (dt.date(2026, 9, 25), "HALF_DAY", "bulletin", "b2", None, "13:00")], ddl)
    outage = spark.createDataFrame([(dt.date(2026, 9, 28),)], "date date")
    rows = M.market_calendar(seen, proof, outage, "2026-09-28").orderBy("trade_date").collect()
    assert rows[3].session_status == "MARKET_WIDE_DATA_UNAVAILABLE" and rows[0].half_day and rows[0].close_time == "13:00"
    bad = spark.createDataFrame([(dt.date(2026, 9, 28), "CLOSED", None, None, None, None), (dt.date(2026, 9, 29), "ODD", "s", "r", None, None)], ddl)
    assert sorted(r.error for r in M.override_violations(bad).collect()) == ["CALENDAR_BAD_OFFICIAL_STATUS", "CALENDAR_OVERRIDE_MISSING_OFFICIAL_EVIDENCE"]


def test_session_close_in_summer_and_winter(spark):
    rows = [("US", "2026-07-01 21:29:00", False), ("US", "2026-07-01 21:30:00", True), ("US", "2026-12-01 22:29:00", False),
            ("US", "2026-12-01 22:30:00", True), ("HK", "2026-07-01 09:30:00", True), ("HK", "2026-07-01 09:29:00", False)]
    df = spark.createDataFrame(rows, "market string, utc string, want boolean")
    local = DT.local_time(F.col("utc").cast("timestamp_ntz"), F.col("market"))
    got = df.select("want", DT.session_closed(F.to_date(F.substring("utc", 1, 10)), local).alias("closed")).collect()
    assert all(r.want == r.closed for r in got)


def test_us_open_days(spark):
    starts = spark.createDataFrame([(dt.date(2026, 3, 30),)], "start date")
    got = {r.date for r in DT.us_open_days(starts).collect()}
    assert dt.date(2026, 4, 3) not in got and dt.date(2026, 4, 6) in got  # Good Friday 2026
    assert dt.date(2026, 5, 25) not in got and dt.date(2026, 6, 19) not in got and dt.date(2026, 7, 3) not in got


def test_options_need_two_quoted_strikes_on_one_expiry(spark):
    def chain(second_ask, expiry=1790294400, listed=(1790294400,)):
        legs = [(100.0, 2.0, 2.2), (105.0, 1.0, second_ask)]
        return (list(listed), [(expiry, legs, None)])
    from pyspark.sql import types as T
    schema = T.StructType([T.StructField("security_id", T.StringType()), T.StructField("chain", OPTION_CHAIN)])
    rows = [("full", chain(1.2)), ("half", chain(None)), ("unlisted", chain(1.2, expiry=1)), ("none", ([], [])), ("silent", None)]
    got = {r.security_id: r for r in Q.option_label(spark.createDataFrame(rows, schema)).collect()}
    assert got["full"].vertical_usable == "TRUE" and got["full"].nearest_expiry == dt.date(2026, 9, 25)
    assert got["half"].has_options == "TRUE" and got["half"].vertical_usable == "UNKNOWN" and got["half"].strike_data_available == "TRUE"
    assert got["unlisted"].vertical_usable == "UNKNOWN"
    assert (got["none"].has_options, got["none"].status) == ("FALSE", "NO_EXPIRIES")
    assert (got["silent"].has_options, got["silent"].status) == ("UNKNOWN", "SOURCE_UNAVAILABLE")


def test_option_status_goes_stale(spark):
    row = spark.range(1).select(Q.stale_option_status(F.lit("TRUE"), F.lit("2026-08-31").cast("date"), F.lit("2026-09-01").cast("date")).alias("a"),
                                Q.stale_option_status(F.lit("TRUE"), F.lit("2026-09-30").cast("date"), F.lit("2026-09-01").cast("date")).alias("b")).first()
    assert (row.a, row.b) == ("STALE", "TRUE")


def test_flags_and_their_order(spark):
    dates = days(6)
    sessions = session_index(spark.createDataFrame([(d,) for d in dates], "date date"))
    rows = [bar(d, 100, "ok") for d in dates] + [bar(d, 100, "gap") for i, d in enumerate(dates) if i != 3]
    rows += [bar(d, 100 if i < 3 else 200, "jump", low=(-1.0 if i == 5 else 50.0), high=300.0) for i, d in enumerate(dates)]
    rows += [bar(d, 100, "late") for d in dates[2:]] + [bar(d, 100, "twice") for d in dates + dates[:1]]
    ids = spark.createDataFrame([(s, s == "jump") for s in ("ok", "gap", "jump", "late", "twice", "none")], "security_id string, identity_review boolean")
    got = {r.security_id: r.flags for r in Q.quality_flags(bars_frame(spark, rows), sessions, ids).collect()}
    assert got["ok"] == ["PASS_501"] and got["none"] == ["FETCH_FAILED"]
    assert got["gap"] == ["DATA_SUSPECT", "INSUFFICIENT_HISTORY_NEW_LISTING"] and got["late"] == ["INSUFFICIENT_HISTORY_NEW_LISTING"]
    assert got["jump"] == ["LARGE_MOVE", "IDENTITY_REVIEW", "DATA_SUSPECT", "PASS_501"]
    assert got["twice"] == ["DATA_SUSPECT", "INSUFFICIENT_HISTORY_NEW_LISTING"]


def test_missing_sessions_by_kind(spark):
    dates = days(30)
    sessions = session_index(spark.createDataFrame([(d,) for d in dates], "date date"))
    rows = bars_frame(spark, [bar(d, 100, "a") for i, d in enumerate(dates) if 3 <= i <= 27 and i != 12])
    wanted = spark.createDataFrame([("a",), ("b",)], "security_id string")
    full = {(r.security_id, r.date) for r in Q.missing_sessions(rows, sessions, wanted).collect()}
    assert {d for s, d in full if s == "a"} == {dates[12], dates[28], dates[29]} and len([1 for s, _ in full if s == "b"]) == 30
    recent = {(r.security_id, r.date) for r in Q.missing_sessions(rows, sessions, wanted, recent=20).collect()}
    assert {d for s, d in recent if s == "a"} == {dates[12], dates[28], dates[29]} and len([1 for s, _ in recent if s == "b"]) == 20


def test_health_names_the_first_failure(spark):
    d = [dt.date(2026, 9, 20 + i) for i in range(6)]
    cp = spark.createDataFrame([("A", d[2]), ("B", d[2]), ("C", d[3]), ("D", d[3]), ("E", d[0]), ("F", d[3])], "market string, last_completed_date date")
    ses = spark.createDataFrame([("A", d[2]), ("B", d[3]), ("C", d[3]), ("D", d[3]), ("F", d[3])], "market string, date date")
    base = spark.createDataFrame([(m, d[2]) for m in "ABCDEFG"], "market string, base_as_of date")
    runs = spark.createDataFrame([("D", d[3], "FAILED"), ("F", d[3], "COMPLETE")], "market string, trade_date date, status string")
    ranks = spark.createDataFrame([("A", d[2])], "market string, as_of date")
    got = {r.market: r.status for r in M.daily_health(cp, ses, base, runs, ranks).collect()}
    assert got == {"A": "HEALTHY", "B": "DAILY_STALE", "C": "DAILY_RUN_RECEIPT_MISSING", "D": "DAILY_RUN_NOT_COMPLETE",
                   "E": "DAILY_CHECKPOINT_BEFORE_BASE", "F": "DERIVED_RANK_MISSING", "G": "DAILY_CHECKPOINT_MISSING"}


SECURITY_DDL = ("security_id string, market string, ticker string, exchange string, isin string, identity_review boolean, listing_date date, "
                "listing_date_verified boolean, delisting_proven boolean, official struct<ticker:string,exchange:string,isin:string,source_hash:string>, "
                "proof struct<kind:string,isin:string,new_ticker:string,source_hash:string>")


def test_identity_fix_needs_the_matching_isin(spark):
    item = spark.createDataFrame([(1, "HK", "HK-000001", "IDENTITY_REVIEW", "OFFICIAL_ISIN_SAME_NEW_TICKER", None, None)],
                                 "item_id int, market string, security_id string, category string, problem string, trade_date date, batch int")
    none = bars_frame(spark, [])
    sessions = session_index(spark.createDataFrame([(dt.date(2026, 1, 1),)], "date date"))
    outages = spark.createDataFrame([], "market string, trade_date date")

    def decide(isin):
        sec = spark.createDataFrame([("HK-000001", "HK", "0002.HK", "HKEX", "HK123", None, None, None, None, None,
                                      ("HK_ISIN_MATCH", isin, "0002.HK", "abc"))], SECURITY_DDL)
        return P.repair_decisions(item, sec, sessions, outages, none, none).first()
    assert decide("HK123").result == "IDENTITY_FIXED" and decide("HK123").accepted
    assert decide("OTHER").result == "UNRESOLVED" and not decide("OTHER").accepted


def test_decisions_count_refreshed_bars_by_day_and_security(spark):
    d = [dt.date(2026, 1, 1 + i) for i in range(10)]
    sessions = session_index(spark.createDataFrame([(x,) for x in d[:5]], "date date"))
    stored = bars_frame(spark, [bar(d[0], 10, "A"), bar(d[1], 10, "A", low=-1.0), bar(d[3], 10, "A"), bar(d[0], 10, "B", low=-1.0),
                                bar(None, 10, "D", low=-1.0), bar(d[0], 10, None, low=-1.0)])  # A: d1 is bad, d2 is missing
    refreshed = bars_frame(spark, [bar(d[1], 10, "A"), bar(d[2], 10, "A"), bar(d[2], 10, "A", low=-1.0), bar(d[4], 10, "A"), bar(d[9], 10, "A"),
                                   bar(d[0], 10, "C"), bar(d[0], 10, None), bar(None, 10, "D")])
    suspect, failed = "DATA_SUSPECT", "FETCH_FAILED"
    asked = [("A", suspect, d[1], 1), ("A", suspect, d[2], 1), ("A", suspect, d[3], 1), ("A", suspect, None, 1), ("A", failed, None, 1), ("A", suspect, d[9], 1),
             ("B", suspect, None, 1), ("C", failed, None, 1), ("C", suspect, None, 1), ("D", suspect, None, 1), (None, suspect, d[0], 1)]
    items = spark.createDataFrame([(i, "US", s, c, "x", day, n) for i, (s, c, day, n) in enumerate(asked)],
                                  "item_id int, market string, security_id string, category string, problem string, trade_date date, batch int")
    securities = spark.createDataFrame([(s, "US", s, "NYSE", "I", False, None, None, None, (s, "NYSE", "I", "h"), None) for s in "ABCD"], SECURITY_DDL)
    out = P.repair_decisions(items, securities, sessions, spark.createDataFrame([], "market string, trade_date date"), stored, refreshed)
    bad, none = ("UNRESOLVED", "BAR_STILL_SUSPECT"), ("NO_DATA", "NO_PRIMARY_BAR_ACTIVE_LISTING")
    assert [(r.result, r.reason) for r in out.orderBy("item_id").collect()] == [
        ("RESOLVED", None), bad, none, bad, bad, ("UNRESOLVED", "SESSION_NOT_CONFIRMED"), none, ("RESOLVED", None),
        ("VALIDATED_NO_DATA_DEFECT", "NO_TRADE_BAR_VALID_OR_NOT_REPRODUCED"), none, ("UNRESOLVED", "SECURITY_ID_MISSING_OR_EXECUTION_EVENT")]
    assert "Window [" not in out._jdf.queryExecution().optimizedPlan().toString()  # calendar and gaps are not made again at each use


def test_unresolved_items_stay_open_and_are_tried_again(spark):
    queue = spark.createDataFrame([(i, "US", "OPEN", None) for i in range(52)], "item_id int, market string, status string, reason string")
    verdict = queue.select("item_id", F.lit("UNRESOLVED").alias("result"), F.lit("NO_EVIDENCE").alias("reason"))
    after = P.apply_decisions(queue, verdict)
    assert P.queue_summary(after).first().asDict() == {"market": "US", "processed": 52, "accepted": 0, "open": 52}
    better = queue.select("item_id", F.lit("VALIDATED_NO_DATA_DEFECT").alias("result"), F.lit("X").alias("reason"))
    final = P.apply_decisions(after.drop("processed"), better)
    assert P.queue_summary(final).first().open == 0
    assert P.queue_summary(P.apply_decisions(final.drop("processed"), better)).first().processed == 0


def test_presence_in_a_list_lifts_no_gate(spark):
    known = spark.createDataFrame([("US-000001", "A", "Alpha", None, "A", "QUARANTINED_IDENTITY", 1)],
                                  "security_id string, symbol string, name string, isin string, ticker string, listing_status string, sequence int")
    seen = spark.createDataFrame([("A", "ALPHA ", None, "A", "NYSE", 1), ("B", "Beta", None, "B", "NYSE", 2)],
                                 "symbol string, name string, isin string, ticker string, exchange string, sequence int")
    got = {r.symbol: r for r in L.universe_refresh(known, seen, "US").collect()}
    assert got["A"].decision == "UPDATED" and got["A"].listing_status == "QUARANTINED_IDENTITY"
    assert (got["B"].decision, got["B"].security_id) == ("NEW", "US-000002")


def test_monthly_contract(spark):
    expected = M.expected_values(spark)
    assert all(r["pass"] for r in M.label_contract(M.expected_labels(spark), M.expected_labels(spark)).collect())
    assert all(r["pass"] for r in M.regression_contract(expected, expected).collect())
    off = expected.withColumn("value", F.when((F.col("name") == "long_is_core") & (F.col("field") == "wr"), F.col("value") + 1e-11).otherwise(F.col("value")))
    assert [r.name for r in M.regression_contract(off, expected).collect() if not r["pass"]] == ["long_is_core"]


def test_closeout_stops_at_the_first_gap(spark):
    d = days(6)
    sessions = spark.createDataFrame([("US", x) for x in d], "market string, date date")
    cp = spark.createDataFrame([("US", d[0])], "market string, last_completed_date date")
    runs = spark.createDataFrame([("US", d[1], "COMPLETE", 5, 5), ("US", d[2], "COMPLETE", 5, 4), ("US", d[3], "COMPLETE", 5, 6), ("US", d[4], "COMPLETE", 5, 5)],
                                 "market string, trade_date date, status string, active int, available int")
    assert sorted(r.date for r in M.contiguous_closeout(sessions, cp, runs).collect()) == d[1:3]


def test_one_security_is_bound_once_and_blanks_are_no_change(spark):
    known = spark.createDataFrame([("HK-000001", "A", "Alpha", "I1", "0001.HK", "ACTIVE", 1), ("HK-000002", "B", " ", "", "0002.HK", "ACTIVE", 2)],
                                  "security_id string, symbol string, name string, isin string, ticker string, listing_status string, sequence long")
    observed = spark.createDataFrame([("N2", "Alpha", "I1", "0009.HK", "HKEX", 9), ("N1", "Alpha", "I1", "0008.HK", "HKEX", 8), ("B", "Beta", "I2", "0002.HK", "HKEX", 2)],
                                     "symbol string, name string, isin string, ticker string, exchange string, sequence long")
    got = {(r.security_id, r.symbol, r.decision) for r in L.universe_refresh(known, observed, "HK").collect()}
    assert got == {("HK-000001", "N1", "REBOUND"), ("HK-000003", "N2", "NEW"), ("HK-000002", "B", "UPDATED")}
    us = {(r.symbol, r.decision) for r in L.universe_refresh(known, observed.filter("symbol = 'B'"), "US").collect()}
    assert ("B", "UPDATED") in us


def test_a_bar_off_the_calendar_hides_no_gap(spark):
    d = days(5)
    bars = bars_frame(spark, [bar(d[0], 10), bar(d[4], 10), bar(d[3], 10)])
    sessions = spark.createDataFrame([(d[i], k) for k, i in enumerate((0, 1, 2, 3))], "date date, idx int")
    own = spark.createDataFrame([("US-000001", False)], "security_id string, identity_review boolean")
    assert "DATA_SUSPECT" in Q.quality_flags(bars, sessions, own).first().flags


def test_escaped_signs_stay_in_cells(spark):
    assert one(spark, "<b>a</b> &lt;b&gt; &amp; c", X.cell_text) == "a <b> & c"


KNOWN = "security_id string, symbol string, name string, isin string, ticker string, listing_status string, sequence int, exchange string"
SEEN = "symbol string, name string, isin string, ticker string, exchange string, sequence int"


def test_refreshed_universe_holds_whole_rows_and_review_items(spark):
    known = spark.createDataFrame([("US-000007", "A", "Alpha", "I1", "A", "QUARANTINED_DATA_GAP", 1, "NYSE"), ("US-000003", "B", "Beta", "I2", "B", "ACTIVE", 2, "NYSE"),
                                   ("US-000004", "C", "Gamma", "I3", "C", "ACTIVE", 3, "NYSE")], KNOWN)
    seen = spark.createDataFrame([("A", "ALPHA", "J1", "A-1", "NASDAQ", 1), ("B", "Other", "I2", "B", "NASDAQ", 2), ("N", "New", "J9", "N", "NYSE", 3)], SEEN)
    rows, reviews = L.refreshed_universe(known, seen, "US")
    got = {r.security_id: (r.symbol, r.name, r.isin, r.ticker, r.exchange, r.currency, r.listing_status, r.security_id_origin, r.history_status, r.review_status) for r in rows.collect()}
    assert got == {"US-000007": ("A", "ALPHA", "J1", "A-1", "NASDAQ", "USD", "QUARANTINED_DATA_GAP", None, None, None),
                   "US-000003": ("B", "Beta", "I2", "B", "NYSE", "USD", "ACTIVE", None, None, None),
                   "US-000004": ("C", "Gamma", "I3", "C", "NYSE", "USD", "ACTIVE", None, None, "LISTING_STATUS_REVIEW"),
                   "US-000008": ("N", "New", "J9", "N", "NYSE", "USD", "ACTIVE", "NEW_LISTING", "SHORT_HISTORY", None)}
    assert {(r.security_id, r.problem) for r in reviews.collect()} == {("US-000003", "NAME_CHANGED"), ("US-000004", "ABSENT_OFFICIAL_SNAPSHOT")}


def test_refresh_of_an_empty_universe_and_of_a_cut_list(spark):
    seen = spark.createDataFrame([("A", "Alpha", "J1", "A", "NYSE", 1), ("B", "Beta", "J2", "B", "NYSE", 2)], SEEN)
    rows, _ = L.refreshed_universe(spark.createDataFrame([], KNOWN), seen, "US")
    assert sorted((r.security_id, r.symbol) for r in rows.collect()) == [("US-000001", "A"), ("US-000002", "B")]
    many = spark.createDataFrame([(f"US-{i:06d}", f"S{i}", "n", "i", "t", "ACTIVE", i, "NYSE") for i in range(40)], KNOWN)
    with pytest.raises(Exception, match="OFFICIAL_LIST_SHRINK_GUARD"):
        L.refreshed_universe(many, seen, "US")[0].collect()
