"""These must stay exactly as they are for results to be right.

Everything here is a number, word list, key format or code that the domain
defines. No logic lives in this module.
"""

# --- fixed values: rolling-window shapes -----------------------------------
WINDOW_SESSIONS = 501
TAIL_SESSIONS = 7
IN_SAMPLE_SESSIONS = 249
OUT_OF_SAMPLE_SESSIONS = 245
HK_SPLIT_SHAPE = (6, 128, 125, 239, 3)

# --- fixed values: indicators ----------------------------------------------
MOVING_AVERAGES = (20, 50, 200)
LOW_WINDOWS = (20, 60, 120, 252)
RETURN_WINDOWS = (20, 60, 252)
YEAR_BARS = 252
SLOPE_LAG = 5
RSI_PERIOD = 14
ATR_PERIOD = 14
EXCURSION_HORIZONS = (5, 10, 20, 60)

# --- fixed values: direction signals and bootstrap -------------------------
SIGNAL_HORIZONS = (5, 10, 20)
SIGNAL_FIRST_INDEX = {"S1": 50, "S2": 49, "S3": 199, "S4": 50}
BOOTSTRAP_BLOCK = 20
BOOTSTRAP_DRAWS = 1000
DIRECTION_SEED = "D1-G178|%s|%s|%s|%s|%s"
REPLAY_SEED = "REPLAY|%s|%s|%s|%s"
BASELINE_SEED = "VERTICAL_BASELINE|%s|%s"
SELECT_MIN_WIN_RATE = 0.55
VERTICAL_WIDTH = 0.05
DIRECTION_WEIGHT = {"LONG": 0.34, "SHORT": 0.40}
NO_SIGNAL = "无合格信号"

# --- fixed values: trade grid ----------------------------------------------
GRID_STOPS = (1.0, 1.5, 2.0)
GRID_TARGETS = (1.5, 2.0, 3.0)
GRID_HOLDS = (5, 10, 20)
TRADE_WARMUP = 50
SLIPPAGE = 0.0005
FEE_RATE = 0.0011
GRID_MIN_TRADES = 50
GRID_MIN_PROFIT_FACTOR = 1.20
ALL_WINS_PROFIT_FACTOR = 1e308

# --- fixed values: ranking and reporting -----------------------------------
RANK_PART_ROWS = 250
OUTAGE_SHARE = 0.80
SHRINK_FLOOR = 25
SHRINK_SHARE = 0.05

# --- fixed values: benchmark tickers ---------------------------------------
BENCHMARK_TICKERS = ("SPY", "QQQ", "DIA", "IWM", "SSO", "QLD",
                     "DDM", "UWM", "SDS", "QID", "DXD", "TWM")

# --- fixed values: security-name patterns ----------------------------------
NON_COMMON_WORDS = (
    "WARRANTS?", "PREFERRED", "PREFERENCE", "PREF", "PFD", "RIGHTS?", "UNITS?",
    "REIT", "FUND", "SENIOR NOTES", "SUBORDINATED NOTES", "NOTES DUE",
    "DEBENTURES?", "MORTGAGE BONDS?", "TRUST PREFERRED",
)
SPAC_WORD = "SPAC"
ACQUISITION_WORD = "ACQUISITION"
SPAC_SHARE_WORDS = ("CLASS A", "ORDINARY SHARES?", "COMMON STOCK")
RESULT_PHRASES = ("FIN RES", "INT RES", "ANNUAL RES", "QUARTER RES",
                  "QUARTERLY RES", "RESULTS")

# --- fixed values: listing codes -------------------------------------------
LISTED_EXCHANGES = {"N": "NYSE", "A": "NYSE_AMERICAN", "P": "NYSE_ARCA"}
QUARANTINE_STATES = ("QUARANTINED_UNCONFIRMED_SOURCE", "QUARANTINED_IDENTITY",
                     "QUARANTINED_DATA_GAP")
PENDING_STATES = ("OPEN", "UNRESOLVED")
QUEUE_FLAGS = ("FETCH_FAILED", "DATA_SUSPECT", "IDENTITY_REVIEW")
RENAMED_TICKER = {"ticker": "FI", "before": "2025-11-11", "security_id": "US-001945"}
MIN_LISTING_ROWS = 1000
MIN_DESIGNATED_ROWS = 100
DESIGNATED_LOOKBACK_DAYS = 21

# --- fixed values: monthly regression targets (tolerance 1e-12) ------------
REGRESSION_TOLERANCE = 1e-12
REGRESSION_VALUES = (
    ("long_is_core", "n", 64.0), ("long_is_core", "benchmark_n", 199.0),
    ("long_is_core", "wr", 0.8125), ("long_is_core", "benchmark_wr", 0.7085427135678392),
    ("long_is_core", "delta", 0.10395728643216084),
    ("short_is_core", "n", 11.0), ("short_is_core", "benchmark_n", 50.0),
    ("short_is_core", "wr", 0.6363636363636364), ("short_is_core", "benchmark_wr", 0.3),
    ("short_is_core", "delta", 0.33636363636363636),
    ("long_final_oos", "n", 93.0), ("long_final_oos", "benchmark_n", 241.0),
    ("long_final_oos", "wr", 0.46236559139784944),
    ("long_final_oos", "benchmark_wr", 0.5560165975103735),
    ("long_final_oos", "delta", -0.09365100611252403),
    ("short_final_oos", "n", 0.0), ("short_final_oos", "benchmark_n", 245.0),
    ("short_final_oos", "wr", None), ("short_final_oos", "benchmark_wr", 0.4897959183673469),
    ("short_final_oos", "delta", None),
    ("long_baseline_is", "n", 5854.0), ("long_baseline_is", "own", 0.3973315753041392),
    ("long_baseline_is", "bench", 0.40606151903052695),
    ("long_baseline_is", "delta", -0.008729943726387746),
    ("long_baseline_oos", "n", 7410.0), ("long_baseline_oos", "own", 0.391389410574781),
    ("long_baseline_oos", "bench", 0.38934503480645566),
    ("long_baseline_oos", "delta", 0.002044375768325335),
    ("short_baseline_is", "n", 7428.0), ("short_baseline_is", "own", 0.39592643775206443),
    ("short_baseline_is", "bench", 0.4052858110215986),
    ("short_baseline_is", "delta", -0.009359373269534177),
    ("short_baseline_oos", "n", 7611.0), ("short_baseline_oos", "own", 0.44561326955688624),
    ("short_baseline_oos", "bench", 0.4177880513769859),
    ("short_baseline_oos", "delta", 0.027825218179900357),
    ("coverage_zero", "coverage", 0.0),
)
REGRESSION_LABELS = (
    ("long_is_identity", "selected", "SPY|S4|10"),
    ("short_is_identity", "selected", "IWM|S3|5"),
    ("long_final_oos", "pass", "false"), ("short_final_oos", "pass", "false"),
    ("final_online_empty", "sides", ""),
    ("long_direction_none", "direction", NO_SIGNAL),
    ("short_direction_none", "direction", NO_SIGNAL),
    ("long_baseline_verdict", "verdict", "MARKET_DRIFT_ONLY"),
    ("short_baseline_verdict", "verdict", "OOS_ONLY"),
)
