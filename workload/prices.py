"""Queries: composition, adjustment, indicators and ranking."""
from __future__ import annotations

from pyspark.sql import functions as F

from barloom.functions import checks
from barloom.functions.recursion import ema_first_seed, ema_mean_seed
from barloom.operators import compose as C
from barloom.operators import indicators as I
from barloom.operators import ranking as R
from workload import inputs as W
from workload.inputs import AS_OF
from workload.registry import cte, day, query, r, with_ctes


def composed(spark, d, wanted=None):
    return C.compose_bars(W.base_bars(spark, d), W.patch_rows(spark, d), W.appended_bars(spark, d),
                          wanted=wanted)


def adjusted(spark, d):
    return C.split_adjust(composed(spark, d), W.splits(spark, d))


BAR_COLUMNS = f"{r('open', 'open')}, {r('high', 'high')}, {r('low', 'low')}, {r('close', 'close')}, {r('volume', 'volume')}"


@query("bar_valid_flags", with_ctes("adjusted") + f"""
, tail AS (SELECT security_id, bool_and(isfinite(open) AND open > 0 AND isfinite(high) AND high > 0
    AND isfinite(low) AND low > 0 AND isfinite(close) AND close > 0) AS price_data_valid
  FROM (SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY date DESC) AS back FROM adjusted) t
  WHERE back <= 252 GROUP BY 1)
SELECT security_id, {day('date', 'date')},
  least(open, high, low, close) > 0 AND volume >= 0 AND high >= greatest(open, close, low) AND low <= least(open, close) AS structural,
  isfinite(open) AND isfinite(high) AND isfinite(low) AND isfinite(close) AND isfinite(volume)
    AND least(open, high, low, close) > 0 AND volume >= 0 AND high >= greatest(open, close, low) AND low <= least(open, close) AS row_valid,
  price_data_valid
FROM adjusted JOIN tail USING (security_id)""")
def bar_valid_flags(spark, d):
    from pyspark.sql import Window
    newest = Window.partitionBy("security_id").orderBy(F.desc("date"))
    everything = Window.partitionBy("security_id")
    rows = adjusted(spark, d).withColumn("back", F.row_number().over(newest))
    recent = F.when(F.col("back") <= 252, checks.is_priced())
    return rows.select("security_id", "date", checks.is_structural().alias("structural"),
                       checks.is_row_valid().alias("row_valid"),
                       F.bool_and(recent).over(everything).alias("price_data_valid"))


@query("compose_bars", with_ctes("composed") + f"""
SELECT security_id, {day('date', 'date')}, {BAR_COLUMNS}, {day('adjustment_as_of', 'adjustment_as_of')},
  CAST(source AS BIGINT) AS source FROM composed""")
def compose_bars(spark, d):
    return composed(spark, d)


@query("base_daily_overlap", with_ctes("daily_bars", "bars") + f"""
SELECT DISTINCT security_id, {day('date', 'date')}, 'BASE_DAILY_OVERLAP' AS error
FROM bars SEMI JOIN daily_bars USING (security_id, date)""")
def base_daily_overlap(spark, d):
    return C.base_daily_overlap(W.supplier_bars(spark, d), W.daily_bars(spark, d))


@query("split_adjust", with_ctes("adjusted") + f"""
SELECT security_id, {day('date', 'date')}, {BAR_COLUMNS}, {day('adjustment_as_of', 'adjustment_as_of')} FROM adjusted""")
def split_adjust(spark, d):
    return adjusted(spark, d).drop("source")


@query("corporate_action_events", with_ctes("splits") + f"""
SELECT DISTINCT security_id, {day('effective_date', 'effective_date')}, {r('factor', 'factor')} FROM splits""")
def corporate_action_events(spark, d):
    return C.unique_splits(W.splits(spark, d)).drop("ticker")


@query("wanted_prices", with_ctes("composed", "securities") + f"""
SELECT security_id, {day('date', 'date')}, {BAR_COLUMNS} FROM composed
SEMI JOIN (SELECT security_id FROM securities WHERE listing_status LIKE 'QUARANTINED%') USING (security_id)""")
def wanted_prices(spark, d):
    wanted = W.securities(spark, d).filter(F.col("listing_status").startswith("QUARANTINED"))
    return composed(spark, d, wanted).drop("source", "adjustment_as_of")


# --- indicators at the last bar ----------------------------------------------
def snapshot(spark, d, until=None):
    return I.latest_indicators(W.known_bars(spark, d, until))


cte("known_bars", "SELECT * FROM bars", "bars")
cte("back", """SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY date DESC) AS back,
  row_number() OVER (PARTITION BY security_id ORDER BY date) AS i,
  count(*) OVER (PARTITION BY security_id) AS n FROM known_bars""", "known_bars")


def _ma(n, shift=0):
    return (f"CASE WHEN max(n) >= {n + shift} THEN avg(close) FILTER (back > {shift} AND back <= {n + shift}) END")


LAST = "max(close) FILTER (back = 1)"


@query("moving_averages", with_ctes("back") + "SELECT security_id, " + ", ".join(
    f"{r(_ma(n), f'ma_{n}', 8)}, {r(f'{LAST} / nullif({_ma(n)}, 0) - 1', f'price_vs_ma_{n}', 8)}"
    for n in (20, 50, 200)) + " FROM back GROUP BY 1", digits=8)
def moving_averages(spark, d):
    return snapshot(spark, d).select("security_id", *[f"{k}_{n}" for n in (20, 50, 200)
                                                      for k in ("ma", "price_vs_ma")])


@query("ma_slope_5d", with_ctes("back") + "SELECT security_id, " + ", ".join(
    r(f"{_ma(n)} / nullif({_ma(n, 5)}, 0) - 1", f"slope_{n}") for n in (20, 50, 200)) + " FROM back GROUP BY 1")
def ma_slope_5d(spark, d):
    return snapshot(spark, d).select("security_id", "slope_20", "slope_50", "slope_200")


@query("low_distance", with_ctes("back") + "SELECT security_id, " + ", ".join(
    r(f"CASE WHEN max(n) >= {n} THEN {LAST} / min(low) FILTER (back <= {n}) - 1 END", f"low_distance_{n}")
    for n in (20, 60, 120, 252)) + " FROM back GROUP BY 1")
def low_distance(spark, d):
    return snapshot(spark, d).select("security_id", *[f"low_distance_{n}" for n in (20, 60, 120, 252)])


@query("range_52w", with_ctes("back") + f"""SELECT security_id,
  {r('(' + LAST + ' - min(low)) / nullif(max(high) - min(low), 0)', 'percentile_52w')},
  {r(LAST + ' / max(high) - 1', 'drawdown_52w')} FROM back WHERE back <= 252 GROUP BY 1""")
def range_52w(spark, d):
    return snapshot(spark, d).select("security_id", "percentile_52w", "drawdown_52w")


@query("returns_n", with_ctes("back") + "SELECT security_id, " + ", ".join(
    r(f"{LAST} / nullif(max(close) FILTER (back = {n + 1}), 0) - 1", f"return_{n}d")
    for n in (20, 60, 252)) + " FROM back GROUP BY 1")
def returns_n(spark, d):
    return snapshot(spark, d).select("security_id", "return_20d", "return_60d", "return_252d")


_CONFIRMED = f"""(max(n) >= 3 AND max(close) FILTER (back = 2) >= min(close) FILTER (back >= 3)
  AND {LAST} >= min(close) FILTER (back >= 2) AND coalesce({LAST} > {_ma(20)}, false))"""
_ZONE = f"coalesce(max(n) >= 60 AND {LAST} / min(low) FILTER (back <= 60) - 1 <= 0.1::DOUBLE, false)"


@query("bottom_structure", with_ctes("back") + f"""SELECT security_id,
  CASE WHEN {_ZONE} THEN 'STAGE_LOW' ELSE 'NONE' END AS bottom_structure,
  coalesce({_CONFIRMED}, false) AS bottom_confirmation,
  CASE WHEN {_ZONE} AND coalesce({_CONFIRMED}, false) THEN '阶段低位，收盘确认' WHEN {_ZONE} THEN '阶段低位，未确认'
    ELSE '非阶段低位' END AS bottom_label FROM back GROUP BY 1""")
def bottom_structure(spark, d):
    return snapshot(spark, d).select("security_id", "bottom_structure", "bottom_confirmation", "bottom_label")


@query("liquidity_20d", with_ctes("back") + f"""SELECT security_id,
  {r('CASE WHEN max(n) >= 20 THEN avg(volume) FILTER (back <= 20) END', 'volume_20d')},
  {r('CASE WHEN max(n) >= 20 THEN avg(close * volume) FILTER (back <= 20) END', 'dollar_volume_20d')}
  FROM back GROUP BY 1""")
def liquidity_20d(spark, d):
    return snapshot(spark, d).select("security_id", "volume_20d", "dollar_volume_20d")


WALK_SQL = """walk AS (
  SELECT security_id, CAST(1 AS BIGINT) AS i, n, close, 0.0::DOUBLE AS gain, 0.0::DOUBLE AS loss,
    close AS f, close AS s, NULL::DOUBLE AS line, 0.0::DOUBLE AS g FROM back WHERE i = 1
  UNION ALL
  SELECT security_id, i, n, close,
    CASE WHEN i <= 14 THEN gain + up WHEN i = 15 THEN (gain + up) / 14 ELSE (gain * 13 + up) / 14 END,
    CASE WHEN i <= 14 THEN loss + down WHEN i = 15 THEN (loss + down) / 14 ELSE (loss * 13 + down) / 14 END,
    f, s, line,
    CASE WHEN i < 26 THEN 0.0::DOUBLE WHEN i < 34 THEN g + line WHEN i = 34 THEN (g + line) / 9
      ELSE 0.2::DOUBLE * line + 0.8::DOUBLE * g END
  FROM (
    SELECT *, CASE WHEN i >= 26 THEN f - s END AS line FROM (
      SELECT b.security_id, b.i, b.n, b.close, w.gain, w.loss, w.g,
        greatest(b.close - w.close, 0.0::DOUBLE) AS up, greatest(w.close - b.close, 0.0::DOUBLE) AS down,
        CASE WHEN b.i < 12 THEN w.f + b.close WHEN b.i = 12 THEN (w.f + b.close) / 12
          ELSE (2.0::DOUBLE / 13) * b.close + (1 - 2.0::DOUBLE / 13) * w.f END AS f,
        CASE WHEN b.i < 26 THEN w.s + b.close WHEN b.i = 26 THEN (w.s + b.close) / 26
          ELSE (2.0::DOUBLE / 27) * b.close + (1 - 2.0::DOUBLE / 27) * w.s END AS s
      FROM walk w JOIN back b ON b.security_id = w.security_id AND b.i = w.i + 1) a) c)"""
MOMENTUM_SQL = with_ctes("back", recursive=True, extra=WALK_SQL)


@query("rsi14", MOMENTUM_SQL + f"""SELECT security_id,
  {r('CASE WHEN n <= 14 THEN NULL WHEN loss = 0 THEN CASE WHEN gain <> 0 THEN 100 ELSE 50 END ELSE 100 - 100 / (1 + gain / loss) END', 'rsi14')}
FROM walk WHERE i = n""")
def rsi14(spark, d):
    return snapshot(spark, d).select("security_id", "rsi14")


@query("macd_12_26_9", MOMENTUM_SQL + f"""SELECT security_id, {r('line', 'macd')},
  {r('CASE WHEN n >= 34 THEN g END', 'macd_signal')}, {r('CASE WHEN n >= 34 THEN line - g END', 'macd_histogram')}
FROM walk WHERE i = n""")
def macd_12_26_9(spark, d):
    return snapshot(spark, d).select("security_id", "macd", "macd_signal", "macd_histogram")


def _ema_sql(seed, step, out):
    return with_ctes("back", recursive=True, extra=f"""
walk AS (SELECT security_id, i, date, {seed} AS y FROM back WHERE i = 1
  UNION ALL SELECT b.security_id, b.i, b.date, {step}
  FROM walk w JOIN back b ON b.security_id = w.security_id AND b.i = w.i + 1)
SELECT security_id, {day('date', 'date')}, {r(out, 'ema')} FROM walk""")


def _series(spark, d, fold, *args):
    bars = W.known_bars(spark, d)
    arrays = I.bar_arrays(bars).withColumn("ema", fold(F.col("bars.close"), *args))
    zipped = arrays.select("security_id", F.inline(F.arrays_zip(F.col("bars.date").alias("date"), "ema")))
    return zipped.toDF("security_id", "date", "ema")


@query("ema_sma_seed", _ema_sql("close", """CASE WHEN b.i < 12 THEN w.y + b.close WHEN b.i = 12 THEN (w.y + b.close) / 12
    ELSE (2.0::DOUBLE / 13) * b.close + (1 - 2.0::DOUBLE / 13) * w.y END""", "CASE WHEN i >= 12 THEN y END"))
def ema_sma_seed(spark, d):
    return _series(spark, d, ema_mean_seed, 12)


@query("ema_first_seed", _ema_sql("close", "(2.0::DOUBLE / 18) * b.close + (1 - 2.0::DOUBLE / 18) * w.y", "y"))
def ema_first_seed_series(spark, d):
    return _series(spark, d, ema_first_seed, 17)


cte("index_series", "SELECT date, close FROM type_bars WHERE ticker = 'ECONOMY'", "type_bars")


@query("benchmark_relative", with_ctes("known_bars", "index_series") + f"""
, aligned AS (SELECT b.security_id, b.close, x.close AS bench,
    row_number() OVER (PARTITION BY b.security_id ORDER BY b.date DESC) AS back
  FROM known_bars b JOIN index_series x ON x.date = b.date)
SELECT security_id, {r('''max(close) FILTER (back = 1) / nullif(max(close) FILTER (back = 21), 0) - 1
  - (max(bench) FILTER (back = 1) / nullif(max(bench) FILTER (back = 21), 0) - 1)''', 'relative_20d')}
FROM aligned GROUP BY 1""")
def benchmark_relative(spark, d):
    bars = W.known_bars(spark, d)
    index = W.type_bars(spark, d).filter(F.col("ticker") == "ECONOMY")
    return I.benchmark_relative(bars, index)


# --- cross-section ---------------------------------------------------------------
cte("strength", """SELECT security_id, ret, CASE WHEN count(*) OVER () > 1 THEN cume_dist() OVER (ORDER BY ret) END AS rs
FROM (SELECT security_id, max(close) FILTER (back = 1) / nullif(max(close) FILTER (back = 21), 0) - 1 AS ret
      FROM back GROUP BY 1) t WHERE ret IS NOT NULL""", "back")


@query("relative_strength", with_ctes("strength") + f"""
SELECT security_id, {r('ret', 'return_20d')}, {r('rs', 'relative_strength_20d')}
FROM (SELECT DISTINCT security_id FROM back) b LEFT JOIN strength USING (security_id)""")
def relative_strength(spark, d):
    return R.relative_strength(snapshot(spark, d)).select("security_id", "return_20d", "relative_strength_20d")


def _score_sql(source, gate):
    back = f"""SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY date DESC) AS back,
  count(*) OVER (PARTITION BY security_id) AS n FROM {source} WHERE date <= DATE '{AS_OF}'"""
    valid = "bool_and(least(open, high, low, close) > 0 AND isfinite(open + high + low + close)) FILTER (back <= 252)"
    return f"""
, back2 AS ({back}),
snap AS (SELECT security_id, max(date) AS trade_date, {valid} AS valid, {_ma(20)} AS m20, {_ma(50)} AS m50, {_ma(200)} AS m200,
    coalesce({_CONFIRMED}, false) AS confirmed,
    CASE WHEN max(n) >= 20 THEN avg(close * volume) FILTER (back <= 20) END AS dollars,
    {LAST} / nullif(max(close) FILTER (back = 21), 0) - 1 AS ret FROM back2 GROUP BY 1),
rs AS (SELECT security_id, CASE WHEN count(*) OVER () > 1 THEN cume_dist() OVER (ORDER BY ret) END AS rs FROM snap WHERE ret IS NOT NULL),
judged AS (SELECT *, {'valid AND ' if gate else ''}m20 IS NOT NULL AND dollars IS NOT NULL AND trade_date = DATE '{AS_OF}' AS pass
  FROM snap LEFT JOIN rs USING (security_id)),
scored AS (SELECT *, CASE WHEN pass THEN CASE WHEN m20 > m50 AND m50 > m200 THEN 2 ELSE 0 END
    + CASE WHEN {'valid AND ' } confirmed THEN 1 ELSE 0 END + least(dollars / 1000000, 1.0::DOUBLE) + coalesce(rs, 0) END AS score FROM judged)
SELECT security_id, pass AS filter_pass, CASE WHEN pass THEN NULL {"WHEN NOT valid THEN 'INVALID_NONPOSITIVE_OHLC'" if gate else ''}
    ELSE 'SHORT_OR_STALE_HISTORY' END AS filter_reason, {r('score', 'rank_score')},
  row_number() OVER (ORDER BY score DESC NULLS LAST, security_id) AS rank,
  (row_number() OVER (ORDER BY score DESC NULLS LAST, security_id) - 1) // 250 + 1 AS part
FROM scored"""


RANK_COLUMNS = ("security_id", "filter_pass", "filter_reason", "rank_score", "rank", "part")


@query("rank_score", with_ctes("bars") + _score_sql("bars", True))
def rank_score(spark, d):
    return R.rank(R.score(R.relative_strength(snapshot(spark, d, AS_OF)), AS_OF)).select(*RANK_COLUMNS)


@query("rank_score_autoclose", with_ctes("bars") + _score_sql("bars", False))
def rank_score_autoclose(spark, d):
    scored = R.score(R.relative_strength(snapshot(spark, d, AS_OF)), AS_OF, price_gate=False)
    return R.rank(scored).select(*RANK_COLUMNS)


@query("daily_rank", with_ctes("adjusted", "securities") + """
, active_bars AS (SELECT * FROM adjusted SEMI JOIN (
    SELECT security_id FROM securities WHERE coalesce(listing_status, 'ACTIVE') = 'ACTIVE') USING (security_id))""" + _score_sql("active_bars", True))
def daily_rank(spark, d):
    from barloom.plans.daily_rank import daily_rank as plan
    return plan(W.base_bars(spark, d), W.patch_rows(spark, d, AS_OF), W.appended_bars(spark, d, AS_OF),
                W.splits(spark, d), W.securities(spark, d), AS_OF).select(*RANK_COLUMNS)
