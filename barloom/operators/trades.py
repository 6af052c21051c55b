"""Stop, target and holding-time trades on crossing signals, over a grid of settings."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from barloom import contracts as K
from barloom.functions.checks import is_finite
from barloom.functions.recursion import trend_features
from barloom.operators.baseline import crossings
from barloom.operators.indicators import bar_arrays

POINT = ["stop_atr", "target_r", "max_hold"]
AHEAD = max(K.GRID_HOLDS) + 1


def full_window(bars: DataFrame, window: DataFrame) -> DataFrame:
    """Bar arrays of securities that have a bar on every date of the window."""
    dates = F.broadcast(window.select("date"))
    inside = bars.join(dates, "date", "left_semi")
    return bar_arrays(inside).filter(F.size("bars") == K.WINDOW_SESSIONS)


def signal_paths(arrays: DataFrame) -> DataFrame:
    """One row per crossing signal that has a next bar, with the bars that follow it.

    The path array is passed through a generator before it is indexed, so that the
    optimizer cannot inline its computation into the per-signal expressions.
    """
    arrays = arrays.withColumn("trend", trend_features("bars.high", "bars.low", "bars.close"))
    names = ("macd", "prev_macd", "hist", "e17", "e50", "atr")
    zipped = F.arrays_zip("bars", *[F.col(f"trend.{n}").alias(n) for n in names])

    def element(z: Column, i: Column) -> Column:
        up, down = crossings(i, z["macd"], z["prev_macd"], z["e17"], z["e50"], z["hist"])
        bar = z["bars"]
        return F.struct(bar["date"].alias("date"), bar["open"].alias("open"), bar["high"].alias("high"),
                        bar["low"].alias("low"), bar["close"].alias("close"), z["atr"].alias("atr"),
                        up.alias("up"), down.alias("down"))

    paths = arrays.select("security_id", F.explode(F.array(F.transform(zipped, element))).alias("path"))
    path = F.col("path")
    places = F.filter(F.sequence(F.lit(0), F.size(path) - 2), lambda i: path[i]["up"] | path[i]["down"])
    signals = F.transform(places, lambda i: F.struct(
        i.alias("i"), path[i]["date"].alias("date"), path[i]["atr"].alias("atr"), path[i]["up"].alias("up"),
        F.slice(path, i + 2, AHEAD).alias("ahead")))
    return (paths.filter(F.size("path") >= 2).select("security_id", F.inline(signals))
            .withColumn("side", F.when(F.col("up"), "LONG").otherwise("SHORT")).drop("up"))


def _slip(price: Column, buying: Column) -> Column:
    return price * F.when(buying, 1.0 + K.SLIPPAGE).otherwise(1.0 - K.SLIPPAGE)


def _first(bars: Column, test) -> Column:
    """1-based place of the first bar that passes, null when none does."""
    place = F.array_position(F.transform(bars, lambda b: F.coalesce(test(b), F.lit(False))), F.lit(True))
    return F.nullif(place, F.lit(0).cast("bigint"))


def grid_points() -> Column:
    return F.array(*[F.struct(F.lit(s).alias("stop_atr"), F.lit(t).alias("target_r"), F.lit(h).alias("max_hold"))
                     for s in K.GRID_STOPS for t in K.GRID_TARGETS for h in K.GRID_HOLDS])


def trade_outcomes(signals: DataFrame, segments: DataFrame) -> DataFrame:
    """The trade each signal would make at each grid point, whatever came before it.

    Exits in order of bar; within a bar the stop comes before the target, and both before
    an opposite signal, which fills at the next open (if there is a next bar).
    """
    long = F.col("side") == "LONG"
    rows = signals.join(F.broadcast(segments), "date").filter(F.col("atr").isNotNull())
    opposite = _first(F.col("ahead"), lambda b: F.when(long, b["down"]).otherwise(b["up"]))
    entry = _slip(F.col("ahead")[0]["open"], long)
    rows = rows.select("security_id", "i", F.col("date").alias("signal_date"), "segment", "side", "atr", "ahead",
                       opposite.alias("opposite"), entry.alias("entry"))
    rows = rows.select("*", F.inline(grid_points()))
    risk = F.col("stop_atr") * F.col("atr")
    rows = rows.withColumn("risk", risk).filter(
        (F.col("entry") > 0) & (F.col("risk") > 0) & is_finite(F.col("entry")) & is_finite(F.col("risk")))
    reach = F.col("target_r") * F.col("risk")
    rows = rows.select("*", F.when(long, F.col("entry") - F.col("risk")).otherwise(F.col("entry") + F.col("risk")).alias("stop"),
                       F.when(long, F.col("entry") + reach).otherwise(F.col("entry") - reach).alias("target"),
                       F.least("max_hold", F.size("ahead")).alias("last")).filter("target > 0")

    def stopped(b):
        return F.when(long, (b["open"] <= F.col("stop")) | (b["low"] <= F.col("stop"))).otherwise(
            (b["open"] >= F.col("stop")) | (b["high"] >= F.col("stop")))

    def reached(b):
        return F.when(long, b["high"] >= F.col("target")).otherwise(b["low"] <= F.col("target"))

    def coded(place: Column, rule: int) -> Column:
        return F.when(place <= F.col("last"), place * 4 + rule)

    can_turn = F.when(F.col("opposite") < F.size("ahead"), F.col("opposite"))
    rows = rows.withColumn("code", F.least(coded(_first(F.col("ahead"), stopped), 0),
                                           coded(_first(F.col("ahead"), reached), 1), coded(can_turn, 2)))
    rule = F.col("code") % 4
    place = F.coalesce(F.expr("code div 4"), F.col("last")).cast("int")
    rows = rows.select("*", rule.alias("rule"), place.alias("place"))
    bar = F.element_at("ahead", F.col("place"))
    gapped = F.when(long, bar["open"] <= F.col("stop")).otherwise(bar["open"] >= F.col("stop"))
    raw = (F.when(F.col("rule") == 0, F.when(gapped, bar["open"]).otherwise(F.col("stop")))
           .when(F.col("rule") == 1, F.col("target"))
           .when(F.col("rule") == 2, F.try_element_at("ahead", F.col("place") + 1)["open"])
           .otherwise(bar["close"]))
    exit_place = F.when(F.col("rule") == 2, F.col("place") + 1).otherwise(F.col("place"))
    rows = rows.select("*", _slip(raw, ~long).alias("fill"), exit_place.alias("exit_place"))
    gross = F.when(long, F.col("fill") - F.col("entry")).otherwise(F.col("entry") - F.col("fill")) / F.col("risk")
    fees = (F.col("entry") * K.FEE_RATE + F.col("fill") * K.FEE_RATE) / F.col("risk")
    return rows.select(
        "security_id", "side", *POINT, "i", (F.col("i") + F.col("exit_place")).alias("exit_i"), "segment",
        "signal_date", F.col("ahead")[0]["date"].alias("entry_date"),
        F.element_at("ahead", F.col("exit_place"))["date"].alias("exit_date"),
        gross.alias("r_gross"), (gross - fees).alias("r_net"))


def without_overlap(outcomes: DataFrame) -> DataFrame:
    """Trades taken one at a time: a signal counts only after the previous exit.

    A greedy choice along one security's signals (bounded by the 501-bar window), per
    grid point; only signals are shuffled here, not bars.
    """
    keys = ["security_id", "side"] + POINT
    fields = [c for c in outcomes.columns if c not in keys]
    fields.remove("i")
    trade = F.struct("i", *fields)
    grouped = outcomes.groupBy(*keys).agg(F.array_sort(F.collect_list(trade)).alias("trades"))
    kept = F.aggregate(
        "trades", F.struct(F.lit(-1).alias("last"), F.slice("trades", 1, 0).alias("taken")),
        lambda acc, t: F.when(t["i"] > acc["last"], F.struct(
            t["exit_i"].alias("last"), F.array_append(acc["taken"], t).alias("taken"))).otherwise(acc),
        lambda acc: acc["taken"])
    return grouped.select(*keys, F.inline(kept))


def metrics(value: Column, when: Column, prefix: str) -> list[Column]:
    """Count, win rate, profit factor and mean of `value` on the rows where `when` holds."""
    x = F.when(when & is_finite(value), value)
    wins = F.sum(F.when(x > 0, x))
    losses = F.sum(F.when(x < 0, x))
    pf = F.when(losses.isNotNull(), F.coalesce(wins, F.lit(0.0)) / F.abs(losses)).when(
        wins.isNotNull(), F.lit(K.ALL_WINS_PROFIT_FACTOR))
    return [F.count(x).alias(prefix + "n"), F.avg(F.when(x.isNotNull(), (x > 0).cast("double"))).alias(prefix + "wr"),
            pf.alias(prefix + "pf"), F.avg(x).alias(prefix + "exp")]


def edge_grid(trades: DataFrame, sides=("LONG", "SHORT")) -> DataFrame:
    """All grid points of each side with their metrics, gates and reasons for failing."""
    keys = ["side"] + POINT
    oos = F.col("segment") == "FINAL_OOS"
    measured = trades.groupBy(*keys).agg(
        *metrics(F.col("r_net"), F.col("segment") == "VALIDATION", "validation_"),
        *metrics(F.col("r_net"), oos, "oos_"), *metrics(F.col("r_gross"), oos, "gross_oos_"))
    points = trades.sparkSession.range(1).select(F.explode(F.array(*[F.lit(s) for s in sides])).alias("side"))
    points = points.select("side", F.inline(grid_points()))
    grid = points.join(measured, keys, "left").fillna(0, ["validation_n", "oos_n", "gross_oos_n"])
    return with_stability(with_gates(grid))


def with_gates(grid: DataFrame) -> DataFrame:
    required = F.when(F.col("oos_wr") < 0.45, 0.15).otherwise(0.10)
    grid = grid.withColumn("required_exp", required)
    gates = grid.select(
        "*", (F.col("oos_n") >= K.GRID_MIN_TRADES).alias("n_gate"),
        F.coalesce(F.col("oos_pf") >= K.GRID_MIN_PROFIT_FACTOR, F.lit(False)).alias("pf_gate"),
        F.coalesce(F.col("oos_exp") >= F.col("required_exp"), F.lit(False)).alias("exp_gate"))
    floor = F.when(F.col("required_exp") == 0.15, "EXP_LT_0.15").otherwise("EXP_LT_0.10")
    return gates.select(
        "*", (F.col("n_gate") & F.col("pf_gate") & F.col("exp_gate")).alias("pre_stability_pass"),
        F.coalesce(F.col("oos_wr") >= 0.55, F.lit(False)).alias("high_win_55_label"),
        F.concat_ws("|", F.when(~F.col("n_gate"), "N_LT_50"), F.when(~F.col("pf_gate"), "PF_LT_1.20"),
                    F.when(~F.col("exp_gate"), floor)).alias("fail_reason"))


def with_stability(grid: DataFrame) -> DataFrame:
    """A point passes only with a passing neighbour: stop one step of 1.0 or target 0.5 away."""
    steps = F.array(*[F.struct(F.lit(a).alias("ds"), F.lit(b).alias("dt"))
                      for a, b in ((1.0, 0.0), (-1.0, 0.0), (0.0, 0.5), (0.0, -0.5))])
    passing = grid.filter("pre_stability_pass").select("side", *POINT)
    reached = (passing.select("side", *POINT, F.inline(steps))
               .select("side", (F.col("stop_atr") + F.col("ds")).alias("stop_atr"),
                       (F.col("target_r") + F.col("dt")).alias("target_r"), "max_hold").distinct()
               .withColumn("supported", F.lit(True)))
    joined = grid.join(reached, ["side"] + POINT, "left")
    stability = (F.when(~F.col("pre_stability_pass"), "NOT_EVALUATED_GATE_ALREADY_FAIL")
                 .when(F.col("supported"), "PASS").otherwise("OVERFIT_RISK"))
    return (joined.withColumn("stability", stability).drop("supported")
            .withColumn("edge_status", F.when(F.col("stability") == "PASS", "PASS").otherwise("FAIL")))


def edge_summary(grid: DataFrame) -> DataFrame:
    """Per side: passing points, status, and the best point by out-of-sample mean."""
    point = F.struct(*POINT, F.col("oos_n").alias("n"), F.col("oos_wr").alias("wr"), F.col("oos_pf").alias("pf"),
                     F.col("oos_exp").alias("expectancy_r"), "stability", "edge_status")
    # Equal means: the earlier point of the grid (stop, target, hold) is kept.
    order = F.struct(F.coalesce("oos_exp", F.lit(float("-inf"))), -F.col("stop_atr"), -F.col("target_r"), -F.col("max_hold"))
    return grid.groupBy("side").agg(
        F.count(F.when(F.col("edge_status") == "PASS", 1)).alias("pass_count"),
        F.count(F.lit(1)).alias("parameter_points"), F.max_by(point, order).alias("best")).select(
        "side", "pass_count", "parameter_points",
        F.when(F.col("pass_count") > 0, "CERTIFIED").otherwise("EDGE_NOT_CERTIFIED").alias("status"), "best.*")
