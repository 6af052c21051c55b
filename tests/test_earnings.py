import datetime as dt

import pytest
from pyspark.sql import functions as F

from barloom.operators import earnings as E
from barloom.operators.indicators import session_index
from barloom.plans import earnings_daily as plan
from tests.conftest import bar, bars_frame, days

EVENT_DDL = ("event_id string, security_id string, report_date date, session string, event_status string, "
             "reaction_status string")


def event(day, session="BMO", status=None, reaction=None, sid="US-000001"):
    return (f"{sid}:{day}", sid, day, session, status, reaction)


def sessions(spark, dates):
    return session_index(spark.createDataFrame([(d,) for d in dates], "date date"))


def react(spark, events, rows, dates, market="US"):
    out = E.reactions(spark.createDataFrame(events, EVENT_DDL), bars_frame(spark, rows), sessions(spark, dates), market)
    return {r.event_id: r for r in out.collect()}


def test_repaired_bars_complete_a_missing_price(spark):
    dates = days(28, dt.date(2026, 8, 1))
    rows = [bar(d, 100 if i < 20 else 110) for i, d in enumerate(dates)]
    e = event(dates[20], reaction="PRICE_MISSING")
    got = react(spark, [e], rows, dates)[e[0]]
    assert got.reaction_status == "COMPLETE" and got.day1_volume_ratio == 1.0
    assert got.day5_pct == pytest.approx(.1) and got.prev_close == 100


def test_session_decides_the_reaction_day(spark):
    dates = days(40)
    rows = [bar(d, 100 + i) for i, d in enumerate(dates)]
    before, after = event(dates[25], "BMO"), event(dates[26], "AMC")
    got = react(spark, [before, after], rows, dates)
    assert got[before[0]].reaction_date == dates[25] and got[after[0]].reaction_date == dates[27]
    assert react(spark, [before], rows, dates, "HK")[before[0]].reaction_date == dates[26]


def test_pending_missing_partial_and_settled(spark):
    dates = days(40)
    rows = [bar(d, 100) for i, d in enumerate(dates) if i not in (30, 5)]
    last, gap, early, late = event(dates[39], "AMC"), event(dates[30]), event(dates[10]), event(dates[38])
    done, revised = event(dates[12], reaction="COMPLETE"), event(dates[13], status="REVISED", reaction="PARTIAL")
    ancient = event(dt.date(2020, 1, 1))
    got = react(spark, [last, gap, early, late, done, revised, ancient], rows, dates)
    assert got[last[0]].reaction_status == "PENDING_PRICE"
    assert got[gap[0]].reaction_status == "PRICE_MISSING" and got[gap[0]].prev_close == 100
    assert got[early[0]].reaction_status == "PARTIAL"
    assert got[early[0]].day1_volume_ratio_reason == "INSUFFICIENT_20_SESSION_VOLUME"
    assert got[late[0]].day5_reason == "PENDING_FIVE_SESSIONS" and got[late[0]].reaction_status == "PARTIAL"
    assert got[done[0]].reaction_status == "COMPLETE" and got[done[0]].reaction_date is None
    assert got[revised[0]].reaction_status == "PARTIAL"
    assert got[ancient[0]].reaction_date == dates[0] and got[ancient[0]].reaction_status == "PRICE_MISSING"


def violations(spark, previous, events, active):
    ids = spark.createDataFrame([(i,) for i in previous], "event_id string")
    history = spark.createDataFrame(events, "event_id string, security_id string, report_date date")
    known = spark.createDataFrame([(s,) for s in active], "security_id string")
    return sorted(r.error for r in E.history_violations(ids, history, known, "US").collect())


def test_history_transition_rules(spark):
    d = dt.date(2026, 8, 25)
    e = (f"US-000780:{d}", "US-000780", d)
    assert violations(spark, [], [e], []) == ["NEW_INACTIVE_EVENT"]
    assert violations(spark, [e[0]], [e], []) == []
    assert violations(spark, [], [e], ["US-000780"]) == []
    assert violations(spark, [e[0]], [], []) == ["EVENT_REMOVED"]
    assert violations(spark, [e[0]], [e, e], []) == ["DUPLICATE_EVENT"]
    assert violations(spark, [e[0]], [(e[0], "HK-000780", d)], []) == ["IDENTITY_MISMATCH"]
    assert violations(spark, [e[0]], [(e[0], "US-000780", dt.date(2026, 8, 26))], []) == ["IDENTITY_MISMATCH"]


def test_former_ticker_counts_before_its_date(spark):
    active = spark.createDataFrame([("US", "FISV", "US-001945"), ("US", "B.A", "US-000001"), ("US", "B-A", "US-000002")],
                                   "market string, ticker string, security_id string")
    alias = spark.createDataFrame([("FI", dt.date(2025, 11, 11), "US-001945")], "key string, before date, alias_id string")
    rows = [("US", "FI", dt.date(2025, 11, 10)), ("US", "FI", dt.date(2025, 11, 11)), ("US", " fisv", dt.date(2025, 1, 1)), ("US", "ba", dt.date(2025, 1, 1))]
    mentions = spark.createDataFrame(rows, "market string, ticker string, day date")
    got = {(r.ticker, r.day.day): (r.security_id, r.match) for r in E.resolve_tickers(mentions, active, alias).collect()}
    assert got["FI", 10] == ("US-001945", "RESOLVED") and got["FI", 11] == (None, "UNKNOWN")
    assert got[" fisv", 1] == ("US-001945", "RESOLVED") and got["ba", 1] == (None, "AMBIGUOUS")


def test_report_time_follows_daylight_saving(spark):
    rows = [(dt.date(2026, 7, 1), "BMO"), (dt.date(2026, 12, 1), "AMC"), (dt.date(2026, 7, 1), "UNKNOWN")]
    got = E.report_time(spark.createDataFrame(rows, "report_date date, session string")).collect()
    assert [r.boundary_myt for r in got] == ["2026-07-01T21:30+08:00", "2026-12-02T05:00+08:00", None]
    assert got[2].report_date_myt == dt.date(2026, 7, 1)


def test_moved_dates_become_revisions_once(spark):
    old = spark.createDataFrame([("US-1", dt.date(2026, 9, 1), "BMO"), ("US-2", dt.date(2026, 9, 1), "AMC"), ("US-3", dt.date(2026, 1, 1), "BMO")],
                                "security_id string, report_date date, session string")
    new = spark.createDataFrame([("US-1", dt.date(2026, 9, 9)), ("US-2", dt.date(2026, 9, 1))], "security_id string, report_date date")
    ddl = ("event_id string, security_id string, report_date date, session string, event_status string, "
           "revisions array<struct<old_date:date,new_date:date>>")
    first = E.calendar_to_history(old, new, spark.createDataFrame([], ddl), dt.date(2026, 8, 1))
    rows = {r.security_id: r for r in first.collect()}
    assert set(rows) == {"US-1", "US-3"} and rows["US-1"].event_status == "REVISED" and rows["US-3"].eps_refresh_pending
    again = E.calendar_to_history(old, new, first.select("event_id", "security_id", "report_date", "session", "event_status", "revisions"), dt.date(2026, 8, 1))
    assert {r.security_id: len(r.revisions) for r in again.collect()} == {"US-1": 1, "US-3": 0}


def test_revisions_are_in_the_result_but_in_no_staged_table(spark, monkeypatch):
    dates, sid = days(40, dt.date(2026, 8, 1)), "US-000001"
    pairs = "revisions array<struct<old_date:date,new_date:date>>"
    old = spark.createDataFrame([(sid, d, "BMO") for d in dates[:20]], "security_id string, report_date date, session string")
    new = spark.createDataFrame([(sid, d) for d in dates[20:]], "security_id string, report_date date")
    known = [(f"{sid}:{dates[0]}", sid, dates[0], "BMO", None, [(dates[0], dates[20])], None, None, None, True, None),
             (f"{sid}:{dates[20]}", sid, dates[20], "AMC", None, None, None, None, None, True, None)]
    history = spark.createDataFrame(known, f"event_id string, security_id string, report_date date, session string, event_status string, {pairs}, "
                                           "eps_actual double, eps_surprise_pct double, eps_status string, eps_refresh_pending boolean, reaction_status string")
    provider = spark.createDataFrame([(dates[1], "AA", "1.5", "2%", 1)], "report_date date, symbol string, eps string, surprise string, sequence int")
    active = spark.createDataFrame([(sid, "A.A")], "security_id string, ticker string")
    staged, stage = [], plan.stage

    def keep(df, **options):
        staged.append(stage(df, **options))
        return staged[-1]
    monkeypatch.setattr(plan, "stage", keep)
    bars = bars_frame(spark, [bar(d, 100) for d in dates])
    done, violations = plan.earnings_daily(old, new, history, provider, bars, sessions(spark, dates), active, dates[30])
    rows = {r.report_date: r for r in done.collect()}
    assert len(rows) == 21 and violations.count() == 0
    assert all([x.new_date for x in rows[d].revisions] == dates[20:] and rows[d].event_status == "REVISED" for d in dates[:20])
    assert {x.old_date for x in rows[dates[5]].revisions} == {dates[5]} and rows[dates[20]].revisions == []
    assert rows[dates[1]].eps_actual == 1.5 and rows[dates[20]].reaction_status == "COMPLETE" and rows[dates[20]].day5_pct == 0
    held = sum(df.agg(F.sum(F.size("revisions"))).first()[0] for df in staged if "revisions" in df.columns)
    assert held == 1  # the one that history had; 400 were found


def test_sector_reasons_and_change_log(spark):
    active = spark.createDataFrame([("US-1", "AAA"), ("US-2", "BBB"), ("US-3", "CCC"), ("US-4", "DDD")], "security_id string, ticker string")
    screener = spark.createDataFrame([("AAA", "Tech", "Chips"), ("BBB", "", "")], "symbol string, sector string, industry string")
    filings = spark.createDataFrame([("BBB", "1311", "Crude"), ("CCC", None, None)], "symbol string, sic string, sic_description string")
    record = "struct<sector:string,industry:string,sic_code:string>"
    prior = spark.createDataFrame([("US-1", "Old", "Chips", None, [])], f"security_id string, sector string, industry string, sic_code string, changes array<struct<old:{record},new:{record}>>")
    got = {r.security_id: r for r in E.classify_sectors(active, screener, filings, prior).collect()}
    assert [got[f"US-{i}"].source for i in (1, 2, 3, 4)] == ["NASDAQ", "SEC_SIC", None, None]
    assert got["US-2"].industry == "Crude" and got["US-3"].reason == "SEC_SIC_NOT_PUBLISHED" and got["US-4"].reason == "NO_SOURCE_MATCH"
    assert got["US-1"].changes[0].old.sector == "Old" and got["US-1"].changes[0].new.sector == "Tech" and got["US-2"].changes == []
    down = {r.security_id: r.reason for r in E.classify_sectors(active, screener, filings, source_failed=True).collect()}
    assert down["US-4"] == "SOURCE_UNAVAILABLE"


def test_completeness_needs_every_date(spark):
    today = dt.date(2026, 10, 18)
    wanted = spark.createDataFrame([(today + dt.timedelta(days=i),) for i in (1, 20, 30)], "date date")
    cached = spark.createDataFrame([(today + dt.timedelta(days=1), today - dt.timedelta(days=1)), (today + dt.timedelta(days=20), today - dt.timedelta(days=7))], "date date, fetched_on date")
    fetched = spark.createDataFrame([(today + dt.timedelta(days=30),)], "date date")
    states = E.completeness(wanted, cached, fetched, today)
    assert sorted(r.state for r in states.collect()) == ["FETCHED", "MISSING", "REUSED"]
    assert E.completeness_summary(states).first().complete is False
    assert E.completeness_summary(states.filter("state <> 'MISSING'")).first().complete is True
    assert E.completeness_summary(states.filter("state <> 'MISSING'"), source_errors=1).first().complete is False


def test_freshness_labels(spark):
    rows = [("2026-10-07", "2026-10-07"), ("2026-10-07", "2026-10-06"), ("2026-10-07", "2026-10-08"), ("2026-10-07", None)]
    got = spark.createDataFrame(rows, "a string, b string").select(E.freshness(F.col("a"), F.col("b")).alias("f")).collect()
    assert [r.f for r in got] == ["CURRENT", "BEHIND", "RECEIPT_CONFLICT", "NOT_RECORDED"]
