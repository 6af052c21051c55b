"""Queries: calendars and splits, direction signals, baselines, bootstrap, trade grid."""
from __future__ import annotations

from pyspark.sql import functions as F

from barloom import contracts as K
from barloom.operators import baseline as B
from barloom.operators import bootstrap as BS
from barloom.operators import direction as D
from barloom.operators import sessions as S
from barloom.operators import trades as T
from barloom.session import stage
from workload import generator as G
from workload import inputs as W
from workload.registry import cte, day, query, r, with_ctes

INDEX_LIST = ", ".join(f"'{t}'" for t in W.INDEX_TYPES)
LEAD_TICKER = W.INDEX_TYPES[0]


# --- calendars and splits ---------------------------------------------------------
cte("us_dates", f"""SELECT date, 501 - row_number() OVER (ORDER BY date DESC) AS pos
FROM (SELECT DISTINCT date FROM type_bars WHERE ticker = '{LEAD_TICKER}') t QUALIFY pos >= 0""", "type_bars")
cte("us_split", """SELECT max(date) FILTER (pos = 0) AS is_start, max(date) FILTER (pos = 248) AS is_end,
  max(date) FILTER (pos = 249) AS oos_start, max(date) FILTER (pos = 493) AS oos_end,
  max(date) FILTER (pos = 494) AS tail_start, max(date) FILTER (pos = 500) AS tail_end FROM us_dates""", "us_dates")
cte("hk_dates", """SELECT date, 501 - row_number() OVER (ORDER BY date DESC) AS pos
FROM calendar QUALIFY pos >= 0""", "calendar")
cte("hk_split", """SELECT max(date) FILTER (pos = 6) AS research_start, max(date) FILTER (pos = 133) AS research_end,
  max(date) FILTER (pos = 134) AS validation_start, max(date) FILTER (pos = 258) AS validation_end,
  max(date) FILTER (pos = 259) AS oos_start, max(date) FILTER (pos = 497) AS oos_end,
  max(date) FILTER (pos = 498) AS tail_start, max(date) FILTER (pos = 500) AS tail_end FROM hk_dates""", "hk_dates")


def us_calendar(spark, d):
    return W.type_bars(spark, d).filter(F.col("ticker") == LEAD_TICKER).select("date").distinct()


def us_segments(spark, d):
    return S.day_segments(S.split_us(us_calendar(spark, d)))


def hk_segments(spark, d):
    return S.day_segments(S.split_hk(W.calendar(spark, d)), S.HK_SEGMENTS)


@query("session_index", with_ctes("sessions") + f"SELECT {day('date', 'date')}, idx FROM sessions")
def session_index(spark, d):
    from barloom.operators.indicators import session_index as index
    return index(W.calendar(spark, d))


@query("last_n_window", with_ctes("hk_dates") + f"SELECT {day('date', 'date')}, pos FROM hk_dates")
def last_n_window(spark, d):
    return S.last_window(W.calendar(spark, d))


@query("open_dates_union", with_ctes("daily_bars", "calendar") + f"""
SELECT {day('date', 'date')} FROM (SELECT date FROM calendar UNION SELECT date FROM daily_bars) t""")
def open_dates_union(spark, d):
    return S.open_dates(W.calendar(spark, d), W.daily_bars(spark, d))


_US = ("is_start", "is_end", "oos_start", "oos_end", "tail_start", "tail_end")
_HK = ("research_start", "research_end", "validation_start", "validation_end", "oos_start", "oos_end",
       "tail_start", "tail_end")


@query("split_us", with_ctes("us_split") + "SELECT " + ", ".join(day(c, c) for c in _US) + " FROM us_split")
def split_us(spark, d):
    return S.split_us(us_calendar(spark, d))


@query("split_hk", with_ctes("hk_split") + "SELECT " + ", ".join(day(c, c) for c in _HK) + " FROM hk_split")
def split_hk(spark, d):
    return S.split_hk(W.calendar(spark, d))


@query("segment_us", with_ctes("daily_bars", "us_split") + f"""
SELECT security_id, {day('date', 'date')}, CASE WHEN date BETWEEN is_start AND is_end THEN 'IS'
  WHEN date BETWEEN oos_start AND oos_end THEN 'FINAL_OOS' END AS segment FROM daily_bars, us_split""")
def segment_us(spark, d):
    return S.with_segment(W.daily_bars(spark, d), us_segments(spark, d)).select("security_id", "date", "segment")


@query("segment_hk", with_ctes("daily_bars", "hk_split") + f"""
SELECT security_id, {day('date', 'date')}, CASE WHEN date BETWEEN research_start AND research_end THEN 'RESEARCH'
  WHEN date BETWEEN validation_start AND validation_end THEN 'VALIDATION'
  WHEN date BETWEEN oos_start AND oos_end THEN 'FINAL_OOS' ELSE 'OUTSIDE' END AS segment FROM daily_bars, hk_split""")
def segment_hk(spark, d):
    return S.with_segment(W.daily_bars(spark, d), hk_segments(spark, d), "OUTSIDE").select(
        "security_id", "date", "segment")


# --- direction signals ---------------------------------------------------------
cte("index_bars", f"""SELECT ticker, date, open, close, row_number() OVER (PARTITION BY ticker ORDER BY date) - 1 AS i
FROM type_bars SEMI JOIN us_dates USING (date) WHERE ticker IN ({INDEX_LIST})""", "type_bars", "us_dates")


def trend_walk(source: str, key: str) -> str:
    """Recursive text: the 8, 17, 50 averages and the 9-step signal of every series."""
    a8, a17, a50, a9 = "(2.0::DOUBLE / 9)", "(2.0::DOUBLE / 18)", "(2.0::DOUBLE / 51)", "(2.0::DOUBLE / 10)"
    return f"""SELECT {key}, i, close AS e8, close AS e17, close AS e50, 0.0::DOUBLE AS sig FROM {source} WHERE i = 0
  UNION ALL
  SELECT {key}, i, e8, e17, e50, {a9} * (e8 - e17) + (1 - {a9}) * sig FROM (
    SELECT b.{key}, b.i, {a8} * b.close + (1 - {a8}) * w.e8 AS e8, {a17} * b.close + (1 - {a17}) * w.e17 AS e17,
      {a50} * b.close + (1 - {a50}) * w.e50 AS e50, w.sig
    FROM WALKNAME w JOIN {source} b ON b.{key} = w.{key} AND b.i = w.i + 1) t"""


cte("index_walk", trend_walk("index_bars", "ticker").replace("WALKNAME", "index_walk"), "index_bars")
cte("crosses", """SELECT ticker, i, CASE WHEN i >= 50 AND before <= 0 AND hist > 0 THEN 1
    WHEN i >= 50 AND before >= 0 AND hist < 0 THEN -1 END AS cross_
  FROM (SELECT ticker, i, e8 - e17 - sig AS hist, lag(e8 - e17 - sig) OVER (PARTITION BY ticker ORDER BY i) AS before
        FROM index_walk) t""", "index_walk")
cte("states", """SELECT *, CASE WHEN S1 <> 0 AND S1 = S2 THEN S1 ELSE 0 END AS S4 FROM (
  SELECT ticker, date, i, open, close, coalesce(s1, 0) AS S1, coalesce(CAST(sign(close - m50) AS INTEGER), 0) AS S2,
    coalesce(CAST(sign(m50 - m200) AS INTEGER), 0) AS S3 FROM (
    SELECT b.ticker, b.date, b.i, b.open, b.close,
      last_value(cross_ IGNORE NULLS) OVER (PARTITION BY b.ticker ORDER BY b.i ROWS UNBOUNDED PRECEDING) AS s1,
      CASE WHEN b.i >= 49 THEN avg(close) OVER (PARTITION BY b.ticker ORDER BY b.i ROWS 49 PRECEDING) END AS m50,
      CASE WHEN b.i >= 199 THEN avg(close) OVER (PARTITION BY b.ticker ORDER BY b.i ROWS 199 PRECEDING) END AS m200
    FROM index_bars b JOIN crosses c ON c.ticker = b.ticker AND c.i = b.i) x) y""", "index_bars", "crosses")


def index_states(spark, d):
    window = S.last_window(us_calendar(spark, d)).select("date")
    series = (W.type_bars(spark, d).filter(F.col("ticker").isin(*W.INDEX_TYPES))
              .join(F.broadcast(window), "date", "left_semi"))
    return D.direction_states(series)


@query("direction_states", with_ctes("states", recursive=True) + f"""
SELECT ticker, {day('date', 'date')}, i, S1 AS s1, S2 AS s2, S3 AS s3, S4 AS s4 FROM states""")
def direction_states(spark, d):
    return index_states(spark, d).select("ticker", "date", "i", *[F.col(s).alias(s.lower()) for s in D.SIGNALS])


cte("outcomes", """
SELECT ticker, signal, h, side, segment, date, CAST(CASE WHEN side = 'LONG' THEN final > entry ELSE final < entry END AS INTEGER) AS won,
  state = CASE WHEN side = 'LONG' THEN 1 ELSE -1 END AS fired
FROM (
  SELECT s.ticker, s.date, x.signal, h.h, sd.side, n.open AS entry, e.close AS final,
    CASE x.signal WHEN 'S1' THEN s.S1 WHEN 'S2' THEN s.S2 WHEN 'S3' THEN s.S3 ELSE s.S4 END AS state,
    CASE WHEN s.date BETWEEN is_start AND is_end THEN 'IS' WHEN s.date BETWEEN oos_start AND oos_end THEN 'FINAL_OOS' END AS segment
  FROM states s, us_split, (VALUES ('S1', 50), ('S2', 49), ('S3', 199), ('S4', 50)) x(signal, first),
    (VALUES (5), (10), (20)) h(h), (VALUES ('LONG'), ('SHORT')) sd(side), states n, states e
  WHERE s.i >= x.first AND n.ticker = s.ticker AND n.i = s.i + 1 AND e.ticker = s.ticker AND e.i = s.i + 1 + h.h AND n.open > 0) t
WHERE segment IS NOT NULL""", "states", "us_split")
cte("rates", """SELECT ticker, signal, h, side, segment, count(*) FILTER (fired) AS n, count(*) AS benchmark_n,
  avg(won) FILTER (fired) AS wr, avg(won) AS benchmark_wr FROM outcomes GROUP BY ALL""", "outcomes")


def index_outcomes(spark, d):
    states = stage(index_states(spark, d))
    segments = us_segments(spark, d)
    return states, segments, stage(D.outcomes(states, segments))


@query("signal_winrate", with_ctes("rates", recursive=True) + f"""
SELECT ticker, signal, h, side, segment, n, benchmark_n, {r('wr', 'wr')}, {r('benchmark_wr', 'benchmark_wr')},
  {r('wr - benchmark_wr', 'delta')} FROM rates""")
def signal_winrate(spark, d):
    results = D.outcomes(index_states(spark, d), us_segments(spark, d))
    return D.win_rates(results, D.CANDIDATE + ["segment"])


cte("directed", """SELECT 'D1-G178|' || ticker || '|' || signal || '|' || h || '|' || side || '|' || segment AS seed_key, date,
  count(*) FILTER (fired AND won = 1) AS s, count(*) FILTER (fired) AS sn, sum(won) AS b, count(*) AS bn FROM outcomes GROUP BY 1, 2""", "outcomes")
CANDIDATES = G.delta_interval("directed", "bands", "d_").lstrip() + """,
options AS (SELECT * FROM (SELECT DISTINCT ticker FROM states), (VALUES ('S1'), ('S2'), ('S3'), ('S4')) a(signal), (VALUES (5), (10), (20)) b(h),
  (VALUES ('LONG'), ('SHORT')) c(side), (VALUES ('IS'), ('FINAL_OOS')) d(segment)),
candidates AS (SELECT ticker, signal, h, side, segment, coalesce(n, 0) AS n, coalesce(benchmark_n, 0) AS benchmark_n, wr, benchmark_wr, wr - benchmark_wr AS delta, low AS ci_low, high AS ci_high
  FROM options LEFT JOIN rates USING (ticker, signal, h, side, segment)
  LEFT JOIN bands ON seed_key = 'D1-G178|' || ticker || '|' || signal || '|' || h || '|' || side || '|' || segment),
chosen AS (SELECT * FROM candidates WHERE segment = 'IS' AND wr >= 0.55 AND ci_low > 0 QUALIFY row_number() OVER (PARTITION BY side ORDER BY wr DESC, delta DESC, ticker, signal, h) = 1)"""
CANDIDATES_SQL = with_ctes("directed", "rates", recursive=True, extra=CANDIDATES)
RATE_COLUMNS = ", ".join(r(c, c) for c in ("wr", "benchmark_wr", "delta", "ci_low", "ci_high"))


@query("block_bootstrap_delta", CANDIDATES_SQL + f"SELECT ticker, signal, h, side, segment, n, benchmark_n, {r('ci_low', 'ci_low')}, {r('ci_high', 'ci_high')} FROM candidates")
def block_bootstrap_delta(spark, d):
    states, _, results = index_outcomes(spark, d)
    return D.candidates(states, results).select(*D.CANDIDATE, "segment", "n", "benchmark_n", "ci_low", "ci_high")


@query("direction_candidates", CANDIDATES_SQL + f"SELECT ticker, signal, h, side, segment, n, benchmark_n, {RATE_COLUMNS} FROM candidates")
def direction_candidates(spark, d):
    states, _, results = index_outcomes(spark, d)
    return D.candidates(states, results)


@query("select_is_candidates", CANDIDATES_SQL + f"""SELECT c.ticker, c.signal, c.h, c.side, c.n, c.benchmark_n, {", ".join(r("c." + c, c) for c in ("wr", "benchmark_wr", "delta", "ci_low", "ci_high"))},
  o.n AS oos_n, o.benchmark_n AS oos_benchmark_n, {", ".join(r("o." + c, "oos_" + c) for c in ("wr", "benchmark_wr", "delta", "ci_low", "ci_high"))}, coalesce(o.wr >= 0.55 AND o.ci_low > 0, false) AS pass
FROM chosen c JOIN candidates o ON o.ticker = c.ticker AND o.signal = c.signal AND o.h = c.h AND o.side = c.side AND o.segment = 'FINAL_OOS'""")
def select_is_candidates(spark, d):
    states, _, results = index_outcomes(spark, d)
    return D.select_in_sample(D.candidates(states, results))


# The replay set used by the comparable queries: best out-of-sample win rate per side.
cte("replay_set", """SELECT side, ticker, signal, h FROM rates WHERE segment = 'FINAL_OOS' AND n > 0
QUALIFY row_number() OVER (PARTITION BY side ORDER BY wr DESC, n DESC, ticker, signal, h) = 1""", "rates")


def replay_set(results):
    from pyspark.sql import Window
    best = Window.partitionBy("side").orderBy(F.desc("wr"), F.desc("n"), "ticker", "signal", "h")
    return (D.win_rates(results.filter(F.col("segment") == "FINAL_OOS"), D.CANDIDATE).filter("n > 0")
            .withColumn("pick", F.row_number().over(best)).filter("pick = 1").select(*D.CANDIDATE))


cte("oos_dates", f"""SELECT s.date FROM states s, us_split WHERE s.ticker = '{LEAD_TICKER}'
  AND s.date BETWEEN oos_start AND oos_end""", "states", "us_split")
cte("emitted", """SELECT date, max(side) AS side FROM (
  SELECT s.date, a.side FROM states s JOIN replay_set a ON a.ticker = s.ticker
  WHERE CASE a.signal WHEN 'S1' THEN S1 WHEN 'S2' THEN S2 WHEN 'S3' THEN S3 ELSE S4 END = CASE WHEN a.side = 'LONG' THEN 1 ELSE -1 END
    AND s.date IN (SELECT date FROM oos_dates)) t GROUP BY date HAVING count(*) = 1""", "replay_set", "oos_dates")


@query("direction_replay", with_ctes("emitted", "outcomes", recursive=True) + f"""
SELECT a.ticker, a.signal, a.h, a.side, count(*) FILTER (e.side IS NOT NULL) AS n, count(*) AS benchmark_n,
  {r('avg(won) FILTER (e.side IS NOT NULL)', 'wr')}, {r('avg(won)', 'benchmark_wr')},
  {r('avg(won) FILTER (e.side IS NOT NULL) - avg(won)', 'delta')}
FROM replay_set a JOIN outcomes o ON o.ticker = a.ticker AND o.signal = a.signal AND o.h = a.h AND o.side = a.side AND o.segment = 'FINAL_OOS'
LEFT JOIN emitted e ON e.date = o.date AND e.side = o.side GROUP BY ALL""")
def direction_replay(spark, d):
    states, segments, results = index_outcomes(spark, d)
    metrics, _ = D.replay(stage(replay_set(results)), states, results, segments, LEAD_TICKER)
    return metrics.drop("ci_low", "ci_high")


@query("direction_replay_counts", with_ctes("emitted", recursive=True) + f"""
SELECT count(*) FILTER (side = 'LONG') AS long_dates, count(*) FILTER (side = 'SHORT') AS short_dates,
  count(*) FILTER (side IS NULL) AS none_dates, count(*) AS total, {r('count(side) / count(*)', 'coverage')}
FROM oos_dates LEFT JOIN emitted USING (date)""")
def direction_replay_counts(spark, d):
    states, segments, results = index_outcomes(spark, d)
    emitted = D.emitted_dates(stage(replay_set(results)), states, segments, LEAD_TICKER)
    return D.replay_counts(emitted, states, segments, LEAD_TICKER)


def replay_round(number: int, active: str) -> str:
    """CTEs up to `metrics<number>`: the sides of `active` replayed on the dates on which only one of them is on."""
    p = f"r{number}_"
    return f"""
{p}emitted AS (SELECT date, max(side) AS side FROM (SELECT s.date, a.side FROM states s JOIN {active} a ON a.ticker = s.ticker
  WHERE CASE a.signal WHEN 'S1' THEN S1 WHEN 'S2' THEN S2 WHEN 'S3' THEN S3 ELSE S4 END = CASE WHEN a.side = 'LONG' THEN 1 ELSE -1 END AND s.date IN (SELECT date FROM oos_dates)) t GROUP BY date HAVING count(*) = 1),
{p}rows AS (SELECT o.*, e.side IS NOT NULL AS allowed, 'REPLAY|' || o.side || '|' || o.ticker || '|' || o.signal || '|' || o.h AS seed_key FROM outcomes o
  SEMI JOIN {active} a ON a.ticker = o.ticker AND a.signal = o.signal AND a.h = o.h AND a.side = o.side LEFT JOIN {p}emitted e ON e.date = o.date AND e.side = o.side WHERE segment = 'FINAL_OOS'),
{p}dated AS (SELECT seed_key, date, count(*) FILTER (allowed AND won = 1) AS s, count(*) FILTER (allowed) AS sn, sum(won) AS b, count(*) AS bn FROM {p}rows GROUP BY 1, 2),{G.delta_interval(p + "dated", p + "bands", p)},
{p}rates AS (SELECT seed_key, count(*) FILTER (allowed) AS n, count(*) AS benchmark_n, avg(won) FILTER (allowed) AS wr, avg(won) AS benchmark_wr FROM {p}rows GROUP BY 1),
metrics{number} AS (SELECT a.side, a.ticker, a.signal, a.h, coalesce(n, 0) AS n, coalesce(benchmark_n, 0) AS benchmark_n, wr, benchmark_wr, wr - benchmark_wr AS delta, low AS ci_low, high AS ci_high, coalesce(low <= 0, true) AS deleted
  FROM {active} a LEFT JOIN {p}rates t ON t.seed_key = 'REPLAY|' || a.side || '|' || a.ticker || '|' || a.signal || '|' || a.h LEFT JOIN {p}bands c ON c.seed_key = t.seed_key),
left{number} AS (SELECT side, ticker, signal, h FROM metrics{number} WHERE NOT deleted)"""


@query("replay_prune", with_ctes("replay_set", "oos_dates", "outcomes", recursive=True, extra=(replay_round(1, "replay_set") + "," + replay_round(2, "left1")).lstrip()) + f"""
SELECT round, side, ticker, signal, h, n, benchmark_n, {RATE_COLUMNS}, deleted FROM (SELECT 1 AS round, * FROM metrics1 UNION ALL SELECT 2, * FROM metrics2) t""")
def replay_prune(spark, d):
    states, segments, results = index_outcomes(spark, d)
    _, rounds = D.prune_by_replay(stage(replay_set(results)), states, results, segments, LEAD_TICKER)
    return rounds


@query("percentile_linear", with_ctes("bars") + f"""
SELECT security_id, {r('quantile_cont(close, 0.025)', 'p025', 9)}, {r('quantile_cont(close, 0.5)', 'p500', 9)},
  {r('quantile_cont(close, 0.975)', 'p975', 9)} FROM bars GROUP BY 1""", digits=9)
def percentile_linear(spark, d):
    return W.supplier_bars(spark, d).groupBy("security_id").agg(
        *[F.percentile("close", q).alias(n) for n, q in (("p025", 0.025), ("p500", 0.5), ("p975", 0.975))])


# --- stock signals against the cross-section ------------------------------------------
cte("long_bars", """SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY date) - 1 AS i
FROM daily_bars QUALIFY count(*) OVER (PARTITION BY security_id) >= 501""", "daily_bars")
cte("stock_walk", trend_walk("long_bars", "security_id").replace("WALKNAME", "stock_walk"), "long_bars")
_VALID = ("least({0}.open, {0}.high, {0}.low, {0}.close) > 0 AND {0}.volume >= 0 AND "
          "{0}.high >= greatest({0}.open, {0}.close, {0}.low) AND {0}.low <= least({0}.open, {0}.close)")
cte("stock_rows", f"""
SELECT b.security_id, b.date, b.close AS s0, t.close AS st, CASE WHEN b.date BETWEEN is_start AND is_end THEN 'IS' ELSE 'FINAL_OOS' END AS segment,
  greatest(0.0::DOUBLE, least(1.0::DOUBLE, (t.close - b.close) / (b.close * 0.05::DOUBLE))) AS p_long,
  greatest(0.0::DOUBLE, least(1.0::DOUBLE, (b.close - t.close) / (b.close * 0.05::DOUBLE))) AS p_short,
  b.i >= 50 AND macd > 0 AND before <= 0 AND e17 > e50 AND hist > 0 AS up,
  b.i >= 50 AND macd < 0 AND before >= 0 AND e17 < e50 AND hist < 0 AS down
FROM long_bars b JOIN long_bars t ON t.security_id = b.security_id AND t.i = b.i + 20
JOIN (SELECT security_id, i, e17, e50, e8 - e17 AS macd, e8 - e17 - sig AS hist,
        lag(e8 - e17) OVER (PARTITION BY security_id ORDER BY i) AS before FROM stock_walk) w
  ON w.security_id = b.security_id AND w.i = b.i, us_split
WHERE (b.date BETWEEN is_start AND is_end OR b.date BETWEEN oos_start AND oos_end)
  AND {_VALID.format('b')} AND {_VALID.format('t')}""", "long_bars", "stock_walk", "us_split")
cte("samples", """SELECT security_id, date, segment, CASE WHEN up THEN 'LONG' ELSE 'SHORT' END AS side,
  CASE WHEN up THEN p_long ELSE p_short END AS p,
  CAST(CASE WHEN up THEN st > s0 ELSE st < s0 END AS INTEGER) AS dwr FROM stock_rows WHERE up OR down""", "stock_rows")
cte("paired", """SELECT security_id, date, segment, side, p AS own,
  (CASE WHEN side = 'LONG' THEN tl ELSE ts END - p) / (c - 1) AS bench
FROM samples JOIN (SELECT date, segment, count(*) AS c, sum(p_long) AS tl, sum(p_short) AS ts FROM stock_rows GROUP BY 1, 2) t
USING (date, segment) WHERE c > 1""", "samples")


def stock_rows(spark, d):
    return B.stock_rows(W.daily_bars(spark, d), us_segments(spark, d))


@query("macd_cross_signals", with_ctes("samples", recursive=True) + f"""
SELECT security_id, {day('date', 'date')}, segment, side, {r('p', 'p')}, dwr FROM samples""")
def macd_cross_signals(spark, d):
    return B.signal_samples(stock_rows(spark, d))


@query("leave_one_out_benchmark", with_ctes("paired", recursive=True) + f"""
SELECT security_id, {day('date', 'date')}, segment, side, {r('own', 'own')}, {r('bench', 'bench')} FROM paired""")
def leave_one_out_benchmark(spark, d):
    return B.leave_one_out(stock_rows(spark, d))


@query("vertical_baseline", with_ctes("paired", recursive=True) + f"""
SELECT side, segment, count(*) AS n, {r('avg(own)', 'own')}, {r('avg(bench)', 'bench')},
  {r('avg(own) - avg(bench)', 'delta')}, count(DISTINCT date) AS unique_dates FROM paired GROUP BY 1, 2""")
def vertical_baseline(spark, d):
    return B.vertical_baseline(stock_rows(spark, d)).select(
        "side", "segment", "n", "own", "bench", "delta", "unique_dates")


cte("drifted", """SELECT 'VERTICAL_BASELINE|' || side || '|' || segment AS seed_key, date, sum(own) AS own, sum(bench) AS bench, count(*) AS n FROM paired GROUP BY 1, 2""", "paired")
BASELINE_SQL = G.paired_interval("drifted", "drift", "v_").lstrip() + """,
edges AS (SELECT side, segment, count(own) AS n, avg(own) AS own, avg(bench) AS bench, avg(own) - avg(bench) AS delta, count(DISTINCT date) AS unique_dates
  FROM (SELECT * FROM (VALUES ('LONG'), ('SHORT')) a(side), (VALUES ('IS'), ('FINAL_OOS')) b(segment)) g LEFT JOIN paired USING (side, segment) GROUP BY 1, 2),
baseline AS (SELECT edges.*, drift.* EXCLUDE (seed_key), CASE WHEN max(delta_low) FILTER (segment = 'FINAL_OOS') OVER s > 0 THEN CASE WHEN max(delta) FILTER (segment = 'IS') OVER s > 0 THEN 'SIGNAL_EDGE_CONFIRMED' ELSE 'OOS_ONLY' END
  ELSE 'MARKET_DRIFT_ONLY' END AS verdict FROM edges LEFT JOIN drift ON seed_key = 'VERTICAL_BASELINE|' || side || '|' || segment WINDOW s AS (PARTITION BY side))"""


@query("paired_bootstrap", with_ctes("drifted", recursive=True, extra=BASELINE_SQL) + f"""
SELECT side, segment, n, unique_dates, verdict, {", ".join(r(c, c) for c in ("own", "bench", "delta", "own_low", "own_high", "bench_low", "bench_high", "delta_low", "delta_high"))} FROM baseline""")
def paired_bootstrap(spark, d):
    return B.vertical_baseline(stock_rows(spark, d))


@query("bootstrap_picks", with_ctes("drifted", recursive=True, extra="series AS (SELECT seed_key, 16 AS digits, (count(*) + 19) // 20 AS blocks FROM drifted GROUP BY 1),"
                                    + G.picks("series", "v_")) + "SELECT seed_key, draw, pos, block FROM v_picks")
def bootstrap_picks(spark, d):
    """The blocks that each draw of the stock baseline takes, as rows."""
    paired = B.leave_one_out(stock_rows(spark, d))
    series = paired.groupBy("side", "segment").agg(F.count_distinct("date").alias("dates"))
    return BS.block_picks(series.select(F.format_string(K.BASELINE_SEED, "side", "segment").alias("seed_key"),
                                        F.ceil(F.col("dates") / K.BOOTSTRAP_BLOCK).alias("blocks")), 16)


@query("same_direction_test", with_ctes("emitted", "samples", recursive=True) + f"""
SELECT g.side, g.market_class, count(x.r) AS n, {r('avg(CASE WHEN r > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FILTER (r IS NOT NULL)', 'vertical_wr')},
  {r('avg(r)', 'avg_r')}, {r('avg(dwr)', 'dwr')}
FROM (SELECT * FROM (VALUES ('LONG'), ('SHORT')) a(side), (VALUES ('SAME'), ('OPPOSITE'), ('NONE')) b(market_class)) g
LEFT JOIN (SELECT s.side, CASE WHEN e.side = s.side THEN 'SAME' WHEN e.side IS NOT NULL THEN 'OPPOSITE' ELSE 'NONE' END AS market_class,
    p / CASE WHEN s.side = 'LONG' THEN 0.34::DOUBLE ELSE 0.40::DOUBLE END - 1 AS r, dwr
  FROM samples s LEFT JOIN emitted e ON e.date = s.date WHERE segment = 'FINAL_OOS') x
ON x.side = g.side AND x.market_class = g.market_class GROUP BY 1, 2""")
def same_direction_test(spark, d):
    states, segments, results = index_outcomes(spark, d)
    emitted = D.emitted_dates(stage(replay_set(results)), states, segments, LEAD_TICKER)
    return B.same_direction(B.signal_samples(stock_rows(spark, d)), emitted)


# --- trade grid -------------------------------------------------------------------
#: Suppliers that make one series together: enough to fill the window, and more series as there are more suppliers.
GROUPED = 10


def grid_bars(spark, d):
    """Groups of suppliers by session: series dense enough to fill the window, as many as the data has."""
    group = F.floor(F.col("supplier") / GROUPED)
    from barloom.sources.trades import bars_from_trades
    bars = bars_from_trades(W.trades(spark, d).withColumn("group", group), ["group", "date"])
    return bars.select(W.security_id(F.col("group"), "HK").alias("security_id"), *[c for c in bars.columns if c != "group"])


cte("grid_bars", f"""SELECT printf('HK-%06d', (CAST(substr(security_id, 4) AS BIGINT) - 1) // {GROUPED} + 1) AS security_id, date, {W.BAR_SQL}
FROM trades GROUP BY 1, 2""", "trades")
cte("full_bars", """SELECT *, row_number() OVER (PARTITION BY security_id ORDER BY date) - 1 AS i
FROM grid_bars SEMI JOIN hk_dates USING (date) QUALIFY count(*) OVER (PARTITION BY security_id) = 501""", "grid_bars", "hk_dates")
cte("grid_walk", trend_walk("full_bars", "security_id").replace("WALKNAME", "grid_walk"), "full_bars")
cte("ranges", """SELECT security_id, i, CASE WHEN prev IS NULL THEN high - low ELSE greatest(high - low, abs(high - prev), abs(low - prev)) END AS tr
FROM (SELECT *, lag(close) OVER (PARTITION BY security_id ORDER BY i) AS prev FROM full_bars) t""", "full_bars")
cte("atr_walk", """SELECT security_id, 13 AS i, sum(tr) / 14 AS atr FROM ranges WHERE i <= 13 GROUP BY 1
UNION ALL SELECT r.security_id, r.i, (w.atr * 13 + r.tr) / 14 FROM atr_walk w JOIN ranges r ON r.security_id = w.security_id AND r.i = w.i + 1""", "ranges")
cte("path", """SELECT b.security_id, b.i, b.date, b.open, b.high, b.low, b.close, atr,
  b.i >= 50 AND macd > 0 AND before <= 0 AND e17 > e50 AND hist > 0 AS up,
  b.i >= 50 AND macd < 0 AND before >= 0 AND e17 < e50 AND hist < 0 AS down
FROM full_bars b JOIN (SELECT security_id, i, e17, e50, e8 - e17 AS macd, e8 - e17 - sig AS hist,
    lag(e8 - e17) OVER (PARTITION BY security_id ORDER BY i) AS before FROM grid_walk) w ON w.security_id = b.security_id AND w.i = b.i
LEFT JOIN atr_walk a ON a.security_id = b.security_id AND a.i = b.i""", "full_bars", "grid_walk", "atr_walk")


def full_arrays(spark, d):
    return T.full_window(grid_bars(spark, d), S.last_window(W.calendar(spark, d)))


@query("full_window_coverage", with_ctes("full_bars") + """
SELECT security_id, count(*) AS bar_count FROM full_bars GROUP BY 1""")
def full_window_coverage(spark, d):
    return full_arrays(spark, d).select("security_id", F.size("bars").alias("bar_count"))


@query("atr14", with_ctes("full_bars", "atr_walk", recursive=True) + f"""
SELECT b.security_id, {day('b.date', 'date')}, {r('atr', 'atr')} FROM full_bars b LEFT JOIN atr_walk a ON a.security_id = b.security_id AND a.i = b.i""")
def atr14(spark, d):
    from barloom.functions.recursion import trend_features
    arrays = full_arrays(spark, d).withColumn("trend", trend_features("bars.high", "bars.low", "bars.close"))
    return arrays.select("security_id", F.inline(F.arrays_zip("bars.date", "trend.atr"))).toDF("security_id", "date", "atr")


@query("macd_cross_hk", with_ctes("path", recursive=True) + f"""
SELECT security_id, {day('date', 'date')}, i, CASE WHEN up THEN 'LONG' ELSE 'SHORT' END AS side, {r('atr', 'atr')}
FROM path WHERE (up OR down) AND i < 500""")
def macd_cross_hk(spark, d):
    return T.signal_paths(full_arrays(spark, d)).select("security_id", "date", "i", "side", "atr")


cte("points", """SELECT stop_atr, target_r, max_hold FROM (VALUES (1.0::DOUBLE), (1.5::DOUBLE), (2.0::DOUBLE)) a(stop_atr),
  (VALUES (1.5::DOUBLE), (2.0::DOUBLE), (3.0::DOUBLE)) b(target_r), (VALUES (5), (10), (20)) c(max_hold)""")
cte("entries", """SELECT *, CASE WHEN side = 'LONG' THEN entry - risk ELSE entry + risk END AS stop,
  CASE WHEN side = 'LONG' THEN entry + target_r * risk ELSE entry - target_r * risk END AS target FROM (
  SELECT p.security_id, p.i, p.date AS signal_date, n.date AS entry_date, CASE WHEN p.up THEN 'LONG' ELSE 'SHORT' END AS side,
    n.open * CASE WHEN p.up THEN 1.0005::DOUBLE ELSE 0.9995::DOUBLE END AS entry, stop_atr * p.atr AS risk, stop_atr, target_r, max_hold,
    CASE WHEN p.date BETWEEN research_start AND research_end THEN 'RESEARCH' WHEN p.date BETWEEN validation_start AND validation_end THEN 'VALIDATION'
      WHEN p.date BETWEEN oos_start AND oos_end THEN 'FINAL_OOS' END AS segment
  FROM path p JOIN path n ON n.security_id = p.security_id AND n.i = p.i + 1, points, hk_split
  WHERE (p.up OR p.down) AND p.atr IS NOT NULL) t
WHERE segment IS NOT NULL AND entry > 0 AND risk > 0""", "path", "points", "hk_split")
cte("exits", """SELECT e.*, x.code FROM (SELECT * FROM entries WHERE target > 0) e LEFT JOIN (
  SELECT e.security_id, e.i, e.stop_atr, e.target_r, e.max_hold, min(least(
      CASE WHEN (side = 'LONG' AND (b.open <= stop OR b.low <= stop)) OR (side = 'SHORT' AND (b.open >= stop OR b.high >= stop)) THEN b.i * 4 END,
      CASE WHEN (side = 'LONG' AND b.high >= target) OR (side = 'SHORT' AND b.low <= target) THEN b.i * 4 + 1 END,
      CASE WHEN b.i < 500 AND CASE WHEN side = 'LONG' THEN b.down ELSE b.up END THEN b.i * 4 + 2 END)) AS code
  FROM entries e JOIN path b ON b.security_id = e.security_id AND b.i > e.i AND b.i <= e.i + max_hold GROUP BY ALL) x
USING (security_id, i, stop_atr, target_r, max_hold)""", "entries")
cte("filled", """SELECT e.*, exit_bar.i AS exit_i, exit_bar.date AS exit_date,
  CASE WHEN code % 4 = 0 THEN CASE WHEN (side = 'LONG' AND exit_bar.open <= stop) OR (side = 'SHORT' AND exit_bar.open >= stop) THEN exit_bar.open ELSE stop END
    WHEN code % 4 = 1 THEN target WHEN code % 4 = 2 THEN exit_bar.open ELSE exit_bar.close END
    * CASE WHEN side = 'LONG' THEN 0.9995::DOUBLE ELSE 1.0005::DOUBLE END AS fill
FROM exits e JOIN path exit_bar ON exit_bar.security_id = e.security_id
  AND exit_bar.i = coalesce(code // 4 + CASE WHEN code % 4 = 2 THEN 1 ELSE 0 END, least(e.i + max_hold, 500))""", "exits")
cte("outcome_trades", """SELECT security_id, side, stop_atr, target_r, max_hold, i, exit_i, segment, signal_date, entry_date, exit_date,
  CASE WHEN side = 'LONG' THEN fill - entry ELSE entry - fill END / risk AS r_gross,
  CASE WHEN side = 'LONG' THEN fill - entry ELSE entry - fill END / risk - (entry * 0.0011::DOUBLE + fill * 0.0011::DOUBLE) / risk AS r_net FROM filled""", "filled")
cte("linked", """SELECT t.*, (SELECT min(n.i) FROM outcome_trades n WHERE n.security_id = t.security_id AND n.side = t.side AND n.stop_atr = t.stop_atr
    AND n.target_r = t.target_r AND n.max_hold = t.max_hold AND n.i > t.exit_i) AS next_i FROM outcome_trades t""", "outcome_trades")
cte("taken", """SELECT * FROM linked QUALIFY row_number() OVER (PARTITION BY security_id, side, stop_atr, target_r, max_hold ORDER BY i) = 1
UNION ALL SELECT n.* FROM taken t JOIN linked n ON n.security_id = t.security_id AND n.side = t.side AND n.stop_atr = t.stop_atr
  AND n.target_r = t.target_r AND n.max_hold = t.max_hold AND n.i = t.next_i""", "linked")


def simulated(spark, d):
    signals = T.signal_paths(full_arrays(spark, d))
    return T.without_overlap(T.trade_outcomes(signals, hk_segments(spark, d)))


@query("simulate_trades", with_ctes("taken", recursive=True) + f"""
SELECT security_id, side, stop_atr, target_r, max_hold, i, exit_i, segment, {day('signal_date', 'signal_date')},
  {day('entry_date', 'entry_date')}, {day('exit_date', 'exit_date')}, {r('r_gross', 'r_gross')}, {r('r_net', 'r_net')} FROM taken""")
def simulate_trades(spark, d):
    return simulated(spark, d)


def _m(value, where, prefix):
    pf = (f"CASE WHEN count(*) FILTER ({where} AND {value} < 0) > 0 THEN coalesce(sum({value}) FILTER ({where} AND {value} > 0), 0) "
          f"/ abs(sum({value}) FILTER ({where} AND {value} < 0)) WHEN count(*) FILTER ({where} AND {value} > 0) > 0 THEN 1e308 END")
    return (f"count(*) FILTER ({where}) AS {prefix}n, avg(CASE WHEN {value} > 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END) FILTER ({where}) AS {prefix}wr, "
            f"{pf} AS {prefix}pf, avg({value}) FILTER ({where}) AS {prefix}exp")


METRICS = ("n", "wr", "pf", "exp")


@query("trade_metrics", with_ctes("taken", recursive=True) + f"""
, m AS (SELECT side, segment, {_m('r_net', 'true', '')} FROM taken GROUP BY 1, 2)
SELECT side, segment, n, {r('wr', 'wr')}, {r('pf', 'pf')}, {r('exp', 'exp')} FROM m""")
def trade_metrics(spark, d):
    return simulated(spark, d).groupBy("side", "segment").agg(*T.metrics(F.col("r_net"), F.lit(True), ""))


cte("grid", f"""SELECT s.side, p.stop_atr, p.target_r, p.max_hold, coalesce(validation_n, 0) AS validation_n, validation_wr, validation_pf, validation_exp,
  coalesce(oos_n, 0) AS oos_n, oos_wr, oos_pf, oos_exp, coalesce(gross_oos_n, 0) AS gross_oos_n, gross_oos_wr, gross_oos_pf, gross_oos_exp
FROM (VALUES ('LONG'), ('SHORT')) s(side) CROSS JOIN points p LEFT JOIN (
  SELECT side, stop_atr, target_r, max_hold, {_m('r_net', "segment = 'VALIDATION'", 'validation_')}, {_m('r_net', "segment = 'FINAL_OOS'", 'oos_')},
    {_m('r_gross', "segment = 'FINAL_OOS'", 'gross_oos_')} FROM taken GROUP BY 1, 2, 3, 4) m USING (side, stop_atr, target_r, max_hold)""", "taken", "points")
cte("gated", """SELECT *, n_gate AND pf_gate AND exp_gate AS pre FROM (
  SELECT *, oos_n >= 50 AS n_gate, coalesce(oos_pf >= 1.2::DOUBLE, false) AS pf_gate, coalesce(oos_exp >= req, false) AS exp_gate FROM (
    SELECT *, CASE WHEN oos_wr < 0.45::DOUBLE THEN 0.15::DOUBLE ELSE 0.10::DOUBLE END AS req FROM grid) a) b""", "grid")
cte("stable", """SELECT g.*, CASE WHEN NOT pre THEN 'NOT_EVALUATED_GATE_ALREADY_FAIL' WHEN EXISTS (
    SELECT 1 FROM gated n WHERE n.pre AND n.side = g.side AND n.max_hold = g.max_hold AND (
      (abs(n.stop_atr - g.stop_atr) = 1.0::DOUBLE AND n.target_r = g.target_r) OR (n.stop_atr = g.stop_atr AND abs(n.target_r - g.target_r) = 0.5::DOUBLE)))
  THEN 'PASS' ELSE 'OVERFIT_RISK' END AS stability FROM gated g""", "gated")


@query("edge_grid", with_ctes("stable", recursive=True) + "SELECT side, stop_atr, target_r, max_hold, " + ", ".join(
    f"{p}n, " + ", ".join(r(p + m, p + m) for m in METRICS[1:]) for p in ("validation_", "oos_", "gross_oos_")) + """,
  req AS required_exp, n_gate, pf_gate, exp_gate, pre AS pre_stability_pass, coalesce(oos_wr >= 0.55::DOUBLE, false) AS high_win_55_label,
  concat_ws('|', CASE WHEN NOT n_gate THEN 'N_LT_50' END, CASE WHEN NOT pf_gate THEN 'PF_LT_1.20' END,
    CASE WHEN NOT exp_gate THEN CASE WHEN req = 0.15::DOUBLE THEN 'EXP_LT_0.15' ELSE 'EXP_LT_0.10' END END) AS fail_reason,
  stability, CASE WHEN stability = 'PASS' THEN 'PASS' ELSE 'FAIL' END AS edge_status FROM stable""")
def edge_grid(spark, d):
    return T.edge_grid(simulated(spark, d))


# The neighbour rule on the trade counts alone, so that points of both kinds occur.
@query("stability_neighbors", with_ctes("grid", recursive=True) + """
, gated2 AS (SELECT *, coalesce(oos_exp >= (SELECT avg(oos_exp) FROM grid), false) AS pre FROM grid)
SELECT side, stop_atr, target_r, max_hold, CASE WHEN NOT pre THEN 'NOT_EVALUATED_GATE_ALREADY_FAIL' WHEN EXISTS (
    SELECT 1 FROM gated2 n WHERE n.pre AND n.side = g.side AND n.max_hold = g.max_hold AND (
      (abs(n.stop_atr - g.stop_atr) = 1.0::DOUBLE AND n.target_r = g.target_r) OR (n.stop_atr = g.stop_atr AND abs(n.target_r - g.target_r) = 0.5::DOUBLE)))
  THEN 'PASS' ELSE 'OVERFIT_RISK' END AS stability FROM gated2 g""")
def stability_neighbors(spark, d):
    from pyspark.sql import Window
    grid = T.edge_grid(simulated(spark, d)).drop("stability", "edge_status")
    mean = F.avg("oos_exp").over(Window.partitionBy(F.lit(1)))
    lenient = grid.withColumn("pre_stability_pass", F.coalesce(F.col("oos_exp") >= mean, F.lit(False)))
    return T.with_stability(lenient).select("side", *T.POINT, "stability")


@query("edge_summary", with_ctes("stable", recursive=True) + f"""
SELECT side, count(*) FILTER (stability = 'PASS') AS pass_count, count(*) AS parameter_points,
  CASE WHEN count(*) FILTER (stability = 'PASS') > 0 THEN 'CERTIFIED' ELSE 'EDGE_NOT_CERTIFIED' END AS status,
  any_value(b.stop_atr) AS stop_atr, any_value(b.target_r) AS target_r, any_value(b.max_hold) AS max_hold, any_value(b.oos_n) AS n,
  {r('any_value(b.oos_wr)', 'wr')}, {r('any_value(b.oos_pf)', 'pf')}, {r('any_value(b.oos_exp)', 'expectancy_r')},
  any_value(b.stability) AS stability, any_value(CASE WHEN b.stability = 'PASS' THEN 'PASS' ELSE 'FAIL' END) AS edge_status
FROM (SELECT side, stability FROM stable) s JOIN (SELECT * FROM stable QUALIFY row_number() OVER (PARTITION BY side
    ORDER BY coalesce(oos_exp, -1e300) DESC, stop_atr, target_r, max_hold) = 1) b USING (side) GROUP BY side""".replace("count(*) FILTER (stability = 'PASS')", "count(*) FILTER (s.stability = 'PASS')"))
def edge_summary(spark, d):
    return T.edge_summary(T.edge_grid(simulated(spark, d)))
