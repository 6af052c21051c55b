"""Calendars, windows of sessions, and the segments cut from them.

A calendar holds one row per open date, so it is bounded (about 252 rows a year);
ordering it in one task and broadcasting it are both safe.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from barloom import contracts as K


def open_dates(base_calendar: DataFrame, daily_dates: DataFrame | None = None) -> DataFrame:
    """Base calendar together with the dates that have daily rows."""
    dates = base_calendar.select("date")
    if daily_dates is not None:
        dates = dates.union(daily_dates.select("date"))
    return dates.distinct()


def last_window(calendar: DataFrame, sessions: int = K.WINDOW_SESSIONS) -> DataFrame:
    """The last `sessions` open dates with their position; an error when there are fewer."""
    newest = Window.orderBy(F.desc("date"))
    ranked = calendar.select("date").distinct().select(
        "date", F.row_number().over(newest).alias("back"),
        F.count(F.lit(1)).over(Window.partitionBy(F.lit(1))).alias("known"))
    enough = F.when(F.col("known") < sessions,
                    F.raise_error(F.lit(f"CALENDAR_LT_{sessions}"))).otherwise(F.lit(True))
    return (ranked.filter(enough.cast("boolean") & (F.col("back") <= sessions))
            .select("date", (F.lit(sessions) - F.col("back")).cast("bigint").alias("pos")))


def _cut(window: DataFrame, bounds: dict[str, int]) -> DataFrame:
    return window.agg(*[F.max(F.when(F.col("pos") == pos, F.col("date"))).alias(name)
                        for name, pos in bounds.items()])


def split_us(calendar: DataFrame) -> DataFrame:
    """One row: in-sample, out-of-sample and tail bounds of the last 501 sessions."""
    first_oos = K.IN_SAMPLE_SESSIONS
    tail = first_oos + K.OUT_OF_SAMPLE_SESSIONS
    return _cut(last_window(calendar), {
        "is_start": 0, "is_end": first_oos - 1, "oos_start": first_oos, "oos_end": tail - 1,
        "tail_start": tail, "tail_end": K.WINDOW_SESSIONS - 1})


def split_hk(calendar: DataFrame) -> DataFrame:
    """One row: research, validation, out-of-sample and tail bounds."""
    pre, research, validation, oos, _ = K.HK_SPLIT_SHAPE
    marks = [pre, pre + research, pre + research + validation, pre + research + validation + oos]
    return _cut(last_window(calendar), {
        "research_start": marks[0], "research_end": marks[1] - 1,
        "validation_start": marks[1], "validation_end": marks[2] - 1,
        "oos_start": marks[2], "oos_end": marks[3] - 1,
        "tail_start": marks[3], "tail_end": K.WINDOW_SESSIONS - 1})


US_SEGMENTS = (("IS", "is_start", "is_end"), ("FINAL_OOS", "oos_start", "oos_end"))
HK_SEGMENTS = (("RESEARCH", "research_start", "research_end"),
               ("VALIDATION", "validation_start", "validation_end"),
               ("FINAL_OOS", "oos_start", "oos_end"))


def day_segments(split: DataFrame, segments=US_SEGMENTS) -> DataFrame:
    """(date, segment) for every calendar day inside a segment.

    Turning the ranges into days lets bars meet their segment by equality on the date,
    broadcast, instead of by comparing every bar with the split row.
    """
    ranges = F.array(*[F.struct(F.lit(n).alias("segment"), F.col(a).alias("start"), F.col(b).alias("end"))
                       for n, a, b in segments])
    return (split.select(F.inline(ranges))
            .select(F.explode(F.sequence("start", "end")).alias("date"), "segment"))


def with_segment(bars: DataFrame, segments: DataFrame, outside: str | None = None) -> DataFrame:
    """Label rows with their segment; `outside` names days in none of them."""
    joined = bars.join(F.broadcast(segments), "date", "left")
    return joined.fillna({"segment": outside}) if outside else joined
