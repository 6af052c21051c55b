"""Daily earnings enrichment: calendar to history, figures, reactions, transition check."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from barloom.operators import earnings as E
from barloom.session import stage


def earnings_daily(old_calendar: DataFrame, new_calendar: DataFrame, history: DataFrame, provider: DataFrame,
                   bars: DataFrame, sessions: DataFrame, active: DataFrame, today, market: str = "US"):
    """Next history and the violations of the transition (publish only when there are none).

    `history` carries event_id, security_id, report_date, session, event_status, revisions,
    ticker, eps fields and reaction_status. The revisions found now join last, where events already lie by
    security: no exchange of events and no staged table holds them.
    """
    moved = E.calendar_moves(old_calendar, new_calendar, history, today)
    carried = history.select("event_id", "eps_actual", "eps_surprise_pct", "eps_status",
                             F.col("eps_refresh_pending").alias("was_pending"), "reaction_status")
    tickers = active.select("security_id", "ticker")
    merged = moved.join(tickers, "security_id", "left").join(carried, "event_id", "left").withColumn(
        "eps_refresh_pending", F.coalesce("was_pending", "eps_refresh_pending")).withColumn(
        "eps_status", F.coalesce("eps_status", F.lit("EPS_ACTUAL_UNAVAILABLE"))).drop("was_pending")
    # An identity that says no more than security and date is left out on the way and made again behind it.
    plain = F.concat_ws(":", "security_id", F.col("report_date").cast("string"))
    merged = merged.withColumn("event_id", F.nullif("event_id", plain))
    filled = stage(E.eps_refresh(merged, provider, today), drop_shuffles=True).withColumn(  # read for open, pending and settled events
        "event_id", F.coalesce("event_id", plain))
    priced = E.reactions(filled, bars, sessions, market)
    # The check needs no prices; staged, its exchanges are gone before bars and events are exchanged.
    violations = stage(E.history_violations(history.select("event_id"), priced, active, market), drop_shuffles=True)
    return E.with_revisions(priced, new_calendar), violations
