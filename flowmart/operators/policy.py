"""Scoring, selection and performance tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.functions.exprs import all_of, flag, safe_div, spread_frac


def fit_classifier(train: DataFrame, features: Sequence[str], label: str, weight: str | None = None, valid: str | None = None, trees: int = 20, depth: int = 4, seed: int = 7):
    """A boosted-tree pipeline; with `valid` (a boolean column) it stops early on those rows."""
    extra = ({"weightCol": weight} if weight else {}) | ({"validationIndicatorCol": valid} if valid else {})
    gbt = GBTClassifier(featuresCol="_features", labelCol="_label", maxIter=trees, maxDepth=depth, seed=seed, **extra)
    data = train.withColumn("_label", F.col(label).cast("double"))
    return Pipeline(stages=[VectorAssembler(inputCols=list(features), outputCol="_features", handleInvalid="keep"), gbt]).fit(data)


def score(df: DataFrame, model, day: str = "date", tie: str = "ticker") -> DataFrame:
    """pred_proba, and the row's rank of the day by it."""
    out = model.transform(df).withColumn("pred_proba", vector_to_array("probability")[1]).drop("_features", "rawPrediction", "probability", "prediction")
    return out.withColumn("rank_daily", F.row_number().over(Window.partitionBy(day).orderBy(F.desc("pred_proba"), tie)))


def cross_validate(df: DataFrame, folds: Sequence[tuple[Sequence, Sequence]], features: Sequence[str], label: str, day: str = "date", tie: str = "ticker") -> DataFrame:
    """Predictions of every fold's validation days by a model of its training days. Folds are a handful; each fit and
    each scoring is distributed."""
    out = None
    for i, (train, valid) in enumerate(folds):
        model = fit_classifier(df.filter(F.col(day).isin(*train)), features, label)
        told = score(df.filter(F.col(day).isin(*valid)), model, day, tie).withColumn("fold", F.lit(i))
        out = told if out is None else out.unionByName(told)
    return out


def policy_score(mode: str, proba: Column, risk: Column, threshold: Column | None = None) -> Column:
    if mode == "threshold":
        return F.greatest(proba - threshold, F.lit(0.0)) * (1 - risk)
    if mode == "rank":
        return proba * (1 - risk)
    if mode == "pure":
        return proba
    raise ValueError(f"unknown mode: {mode}")


def capped_weights(scores: Column, cap: Column, rounds: int = 10) -> Column:
    """Weights in proportion to an array of scores, none above the cap: in each round the excess of those above it is
    given to those below in proportion to their weights, until none is above or none is below."""
    total = F.aggregate(scores, F.lit(0.0), lambda a, x: a + x)
    start = F.when(total > 0, F.transform(scores, lambda x: x / total)).otherwise(F.transform(scores, lambda x: F.lit(0.0)))
    cap = F.least(F.greatest(cap, F.lit(0.0)), F.lit(1.0))

    def round_(w: Column, _: Column) -> Column:
        excess = F.aggregate(w, F.lit(0.0), lambda a, x: a + F.greatest(x - cap, F.lit(0.0)))
        below = F.aggregate(w, F.lit(0.0), lambda a, x: a + F.when(x <= cap, x).otherwise(0.0))
        grown = F.transform(w, lambda x: F.when(x > cap, cap).otherwise(x * (1 + F.when(below > 0, excess / below).otherwise(0.0))))
        return F.when(excess > 0, grown).otherwise(w)

    return F.transform(F.aggregate(F.sequence(F.lit(1), F.lit(rounds)), start, round_), lambda x: F.least(x, cap))


def rank_weights(rank: Column, n: Column, weights: Sequence[float]) -> Column:
    """Fixed weights by rank, renormalised over the n that are used."""
    listed = F.array(*[F.lit(float(w)) for w in weights])
    used = F.aggregate(F.slice(listed, 1, F.least(n, F.lit(len(weights)))), F.lit(0.0), lambda a, x: a + x)
    return F.when(rank <= len(weights), F.element_at(listed, rank.cast("int")) / used)


def apply_policy(pred: DataFrame, grid: DataFrame, days: DataFrame, filters: Sequence[Column] = (), day: str = "date", tie: str = "ticker") -> tuple[DataFrame, DataFrame]:
    """(trades, daily) of every policy of a grid: a table of (policy, mode, floor, quantile, k, cap, fee), a row each.

    Candidates pass the filters; the day's threshold is the larger of the floor and the quantile of the day's scores;
    the best k by the mode's score, if above 0, get capped weights. A trade's net return is its return less fee and both
    spreads. The grid is data: policies are worked out side by side, grouped by (policy, day). Days without trades
    come with zeros. Weights don't depend on capital here; see equity_curve for compounding.
    """
    rows = pred.filter(all_of(filters)) if filters else pred
    rows = rows.join(F.broadcast(grid), how="cross")
    ranked = rows.withColumns({"_n": F.count("*").over(Window.partitionBy("policy", day)), "_up": F.row_number().over(Window.partitionBy("policy", day).orderBy("pred_proba", tie))})
    spot = (F.col("_n") - 1) * F.col("quantile") + 1
    low, high = F.floor(spot), F.ceil(spot)
    at = lambda i: F.max(F.when(F.col("_up") == i, F.col("pred_proba"))).over(Window.partitionBy("policy", day))
    ranked = ranked.withColumn("_q", at(low) + (at(high) - at(low)) * (spot - low)).withColumn("threshold", F.greatest("floor", "_q"))
    p, risk = F.col("pred_proba"), F.coalesce("risk_norm", F.lit(0.0))
    scored = F.when(F.col("mode") == "threshold", policy_score("threshold", p, risk, F.col("threshold"))).when(F.col("mode") == "rank", policy_score("rank", p, risk)).otherwise(p)
    keep = (p >= F.col("threshold")) | (F.col("mode") == "pure")
    best = ranked.filter(keep).withColumn("score", scored).filter("score > 0")
    best = best.withColumn("rank", F.row_number().over(Window.partitionBy("policy", day).orderBy(F.desc("score"), tie))).filter("rank <= k")
    row = F.struct("rank", "score", tie, "ret", "entry_price", "exit_price", "fee", "threshold")
    lists = best.groupBy("policy", day).agg(F.sort_array(F.collect_list(row)).alias("_rows"), F.first("cap").alias("_cap"))
    lists = lists.withColumn("_w", capped_weights(F.col("_rows.score"), F.col("_cap")))
    trades = lists.select("policy", day, F.explode(F.arrays_zip("_rows", F.col("_w").alias("w"))).alias("x")).select("policy", day, "x._rows.*", F.col("x.w").alias("weight"))
    net = F.col("ret") - F.col("fee") - spread_frac("entry_price") - spread_frac("exit_price")
    trades = trades.withColumn("net_ret", net).withColumns({"weighted_gross": F.col("weight") * F.col("ret"), "weighted_net": F.col("weight") * F.col("net_ret")})
    return trades, daily_table(trades, days, grid, day)


def daily_table(trades: DataFrame, days: DataFrame, policies: DataFrame, day: str = "date") -> DataFrame:
    """positions, gross and net of every policy and day; idle days have zeros."""
    sums = trades.groupBy("policy", day).agg(F.count("*").alias("positions"), F.sum("weighted_gross").alias("gross_return"), F.sum("weighted_net").alias("net_return"))
    every = days.select(day).distinct().join(F.broadcast(policies.select("policy").distinct()), how="cross")
    return every.join(sums, ["policy", day], "left").fillna({"positions": 0, "gross_return": 0.0, "net_return": 0.0})


def equity_curve(daily: DataFrame, keys: Sequence[str], ret: str = "net_return", day: str = "date", start: float = 1.0) -> DataFrame:
    """Capital before and after each day, its running maximum and the drawdown from it. One ordered series of days for each key."""
    w = Window.partitionBy(*keys).orderBy(day).rowsBetween(Window.unboundedPreceding, 0)
    out = daily.withColumn("capital_end", start * F.exp(F.sum(F.log1p(ret)).over(w)))
    out = out.withColumn("capital_start", F.col("capital_end") / (1 + F.col(ret)))
    return out.withColumn("drawdown", F.col("capital_end") / F.max("capital_end").over(w) - 1)


def performance_summary(daily: DataFrame, keys: Sequence[str], ret: str = "net_return", day: str = "date", active: str = "positions") -> DataFrame:
    """Days, active days, mean, win rate, cumulative return, worst drawdown, volatility, Sharpe ratio of a year of 252 days."""
    curve = equity_curve(daily, keys, ret, day)
    g = curve.groupBy(*keys).agg(
        F.count("*").alias("days"), F.sum(flag(F.col(active) > 0)).alias("active_days"), F.avg(ret).alias("mean"), F.avg(flag(F.col(ret) > 0)).alias("win_rate"),
        (F.exp(F.sum(F.log1p(ret))) - 1).alias("cumulative"), F.min("drawdown").alias("max_drawdown"), F.stddev_pop(ret).alias("volatility"),
    )
    return g.withColumn("sharpe", safe_div("mean", "volatility") * F.sqrt(F.lit(252.0)))


def rolling_performance(daily: DataFrame, keys: Sequence[str], window: int, step: int, ret: str = "net_return", day: str = "date", active: str = "positions") -> DataFrame:
    """performance_summary of every window of days; each day is put in the windows that hold it, and those are grouped."""
    w = Window.partitionBy(*keys).orderBy(day)
    rows = daily.withColumns({"_i": F.row_number().over(w) - 1, "_n": F.count("*").over(Window.partitionBy(*keys))})
    first = F.greatest(F.lit(0), F.ceil((F.col("_i") - window + 1) / step)).cast("long")
    last = F.least(F.floor(F.col("_i") / step), F.floor((F.col("_n") - window) / step)).cast("long")
    rows = rows.filter(first <= last).withColumn("window", F.explode(F.sequence(first, last)))
    return performance_summary(rows, [*keys, "window"], ret, day, active)


def window_report(windows: DataFrame, keys: Sequence[str]) -> DataFrame:
    return windows.groupBy(*keys).agg(F.count("*").alias("windows"), F.avg(flag(F.col("cumulative") > 0)).alias("positive_share"), F.percentile("cumulative", 0.5).alias("median"), F.min("cumulative").alias("worst"), F.min("max_drawdown").alias("worst_drawdown"))


def policy_ranking(summary: DataFrame, drawdown_weight: float = 0.5, idle_weight: float = 0.1) -> DataFrame:
    """Policies by return less penalties for drawdown and idle days."""
    robust = F.col("cumulative") + drawdown_weight * F.col("max_drawdown") - idle_weight * (1 - F.col("active_days") / F.col("days"))
    return summary.withColumn("robust", robust)


def veto(trades: DataFrame, allowed: Column, days: DataFrame, policies: DataFrame, day: str = "date") -> DataFrame:
    """The daily table of the trades that are allowed; their weights stay, what is vetoed stays in cash."""
    return daily_table(trades.filter(F.coalesce(allowed, F.lit(False))), days, policies, day)


def trade_anatomy(trades: DataFrame, prices: DataFrame, keys: Sequence[str], entry: str) -> DataFrame:
    """Best and closing return after entry, and the fall from the high."""
    rows = trades.join(prices.select(*keys, "high", "close"), list(keys))
    return rows.withColumns({"spike": safe_div("high", entry) - 1, "close_ret": safe_div("close", entry) - 1, "fall_from_high": safe_div("close", "high") - 1}).drop("high", "close")


def block_bootstrap(daily: DataFrame, paths: int, block: int, horizon: int, seed: int = 0, ret: str = "net_return", day: str = "date") -> DataFrame:
    """final and max_drawdown of resampled paths. Path i draws contiguous blocks of days; a block's start is the hash of
    (seed, path, block number), so reruns agree. block=1 draws single days. No block wraps around the end, and the
    drawdown is from the path's own maximum."""
    days = daily.select(day, ret).withColumn("_i", F.row_number().over(Window.orderBy(day)) - 1)
    n = days.count()
    block = min(block, max(n, 1))
    draws = daily.sparkSession.range(paths).select(F.col("id").alias("path"), F.explode(F.sequence(F.lit(0), F.lit(horizon - 1))).alias("t"))
    start = F.pmod(F.xxhash64(F.lit(seed), "path", F.floor(F.col("t") / block)), F.lit(max(n - block + 1, 1)))
    draws = draws.withColumn("_i", start + F.col("t") % block)
    rows = draws.join(days, "_i")
    w = Window.partitionBy("path").orderBy("t").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn("_e", F.exp(F.sum(F.log1p(ret)).over(w)))
    rows = rows.withColumn("_d", F.col("_e") / F.max("_e").over(w) - 1)
    return rows.groupBy("path").agg(F.max_by("_e", "t").alias("final"), F.min("_d").alias("max_drawdown"))


def path_report(paths: DataFrame, ruin: float = -0.3) -> DataFrame:
    q = F.percentile("final", F.array(*map(F.lit, (0.05, 0.5, 0.95))))
    return paths.agg(F.count("*").alias("paths"), q[0].alias("p05"), q[1].alias("median"), q[2].alias("p95"), F.avg(flag(F.col("final") < 1)).alias("p_loss"), F.avg(flag(F.col("max_drawdown") <= ruin)).alias("p_ruin"))


def kelly_scan(daily: DataFrame, fractions: Sequence[float], ret: str = "net_return") -> DataFrame:
    """Mean log growth at each fraction of capital, and which is best."""
    grid = F.explode(F.array(*[F.lit(float(f)) for f in fractions])).alias("fraction")
    g = daily.select(ret, grid).withColumn("_x", F.col("fraction") * F.col(ret)).groupBy("fraction").agg(F.avg(F.log1p("_x")).alias("growth"))
    return g.withColumn("best", F.col("fraction") == F.max_by("fraction", "growth").over(Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)))


def market_filters(policy: Mapping[str, float]) -> list[Column]:
    """Conditions of a policy: least_price, most_cost, least_turnover, most_ret (not limit-like), index_floor."""
    known = {
        "least_price": lambda x: F.col("entry_price") >= x, "most_cost": lambda x: spread_frac("entry_price") <= x, "least_turnover": lambda x: F.col("turnover") >= x,
        "most_ret": lambda x: F.col("day_ret") < x, "index_floor": lambda x: F.col("index_ret") >= x,
    }
    return [known[k](v) for k, v in policy.items()]
