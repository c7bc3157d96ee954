"""Rolling and lagged features. All expressions of a call share one window specification: one shuffle and one sort."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, WindowSpec
from pyspark.sql import functions as F

from flowmart.functions.exprs import clip, col, flag, limit_pct, safe_div, sample_kurtosis, sample_skew

STATS = {"mean": F.avg, "std": F.stddev_samp, "sum": F.sum, "max": F.max, "min": F.min, "median": lambda x: F.percentile(x, 0.5)}


def by(keys: Sequence[str], order: str | Sequence[str] = "date") -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*([order] if isinstance(order, str) else order))


def prior(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-n, -1)


def latest(w: WindowSpec, n: int) -> WindowSpec:
    return w.rowsBetween(-(n - 1), 0)


def guarded(stat: str, x: Column, frame: WindowSpec, least: int) -> Column:
    """The statistic where the frame has at least so many values that aren't null."""
    return F.when(F.count(x).over(frame) >= least, STATS[stat](x).over(frame))


def lag_cols(df: DataFrame, cols: Sequence[str], keys: Sequence[str], n: int = 1, order: str = "date", prefix: str | None = None) -> DataFrame:
    """Lags columns, or with prefix all those whose names begin with it."""
    w, names = by(keys, order), [*cols, *[c for c in df.columns if prefix and c.startswith(prefix)]]
    return df.withColumns({f"{c}_lag{n}": F.lag(c, n).over(w) for c in names})


def rolling(df: DataFrame, cols: Sequence[str], windows: Sequence[int], stats: Sequence[str], keys: Sequence[str], order: str = "date", shift: bool = True, least: int | None = None) -> DataFrame:
    """{col}_{stat}_{window} over the rows before (shift) or up to the current one; null below `least` values (all)."""
    w = by(keys, order)
    frame = prior if shift else latest
    return df.withColumns({f"{c}_{s}_{n}": guarded(s, F.col(c), frame(w, n), n if least is None else least) for c in cols for n in windows for s in stats})


def temporal_flow(df: DataFrame, windows: Sequence[int], value: str = "total_net_buy", others: Sequence[str] = ("net_flow_ratio", "churn_ratio"), keys: Sequence[str] = ("broker", "ticker"), order: str = "date", sign_rows: int = 5) -> DataFrame:
    """Lags and means before each row, and of value also deviation, z (clipped at 10) and velocity of the current row
    against them; and the share of buying rows among the sign_rows before, where a row before the first counts 0."""
    w, made = by(keys, order), {}
    for c in [c for c in (value, *others) if c in df.columns]:
        made[f"{c}_lag1"] = F.lag(c).over(w)
        for n in windows:
            mean = guarded("mean", F.col(c), prior(w, n), n)
            made[f"{c}_ma_{n}"] = mean
            if c == value:
                std = guarded("std", F.col(c), prior(w, n), n)
                made |= {f"{c}_std_{n}": std, f"{c}_z_{n}": clip(safe_div(F.col(c) - mean, std), -10.0, 10.0), f"{c}_velocity_{n}": safe_div(F.col(c), mean)}
    up = flag(F.col(value) > 0)
    seen = F.row_number().over(w)
    made["net_buy_sign_consistency_5"] = F.when(seen >= sign_rows, F.coalesce(F.sum(up).over(prior(w, sign_rows)), F.lit(0)) / F.lit(sign_rows))
    return df.withColumns(made)


def with_days_since(df: DataFrame, cond: Column, name: str, keys: Sequence[str], order: str = "date") -> DataFrame:
    w = by(keys, order)
    df = df.withColumns({"_n": F.row_number().over(w), "_c": flag(cond)})
    last = F.max(F.when(F.col("_c") == 1, F.col("_n"))).over(w.rowsBetween(Window.unboundedPreceding, -1))
    return df.withColumn(name, F.col("_n") - 1 - last).drop("_n", "_c")


def with_streak(df: DataFrame, cond: Column, name: str, keys: Sequence[str], order: str = "date", current: bool = True) -> DataFrame:
    """Length of the run of rows that hold the condition, up to this row (current) or the one before (0 at the first)."""
    w = by(keys, order)
    df = df.withColumns({"_n": F.row_number().over(w), "_c": flag(cond)})
    last_miss = F.coalesce(F.max(F.when(F.col("_c") == 0, F.col("_n"))).over(w.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0))
    df = df.withColumn("_s", F.col("_n") - last_miss)
    return df.withColumn(name, F.col("_s") if current else F.coalesce(F.lag("_s").over(w), F.lit(0))).drop("_n", "_c", "_s")


def last_value_when(cond: Column, value, w: WindowSpec, current: bool = False) -> Column:
    """The value at the last row before (or up to) this one that holds the condition."""
    frame = w.rowsBetween(Window.unboundedPreceding, 0 if current else -1)
    return F.last(F.when(F.coalesce(cond, F.lit(False)), col(value)), ignorenulls=True).over(frame)


def activity(df: DataFrame, value: str = "total_net_buy", keys: Sequence[str] = ("broker", "ticker"), order: str = "date", rows: int = 5) -> DataFrame:
    """Active rows among the `rows` before (null with fewer rows before), and rows since the last active one."""
    w, active = by(keys, order), flag(F.abs(value) > 0)
    seen = F.row_number().over(w)
    df = df.withColumn("active_days_in_5", F.when(seen > rows, F.sum(active).over(prior(w, rows))).cast("int"))
    return with_days_since(df, F.abs(F.col(value)) > 0, "days_since_last_active", keys, order)


def baseline(df: DataFrame, value: str, windows: Sequence[int], keys: Sequence[str], order: str = "date", least_share: float = 1.0) -> DataFrame:
    """Means of the rows before, over several windows, from a share of the window on."""
    w = by(keys, order)
    return df.withColumns({f"{value}_base_{n}": guarded("mean", F.col(value), prior(w, n), max(1, int(n * least_share))) for n in windows})


def half_window_baseline(df: DataFrame, value: str, windows: Sequence[int], keys: Sequence[str], order: str = "date", velocity: tuple[int, int] = (5, 20)) -> DataFrame:
    """Mean, sample deviation and z of the value over the rows before, from half a window's values on, and the velocity:
    the shorter mean over the longer one. A deviation or longer mean of 0 gives null."""
    w, x = by(keys, order), F.col(value)
    df = df.withColumns({f"{value}_{name}_{n}": guarded(stat, x, prior(w, n), max(1, n // 2)) for n in windows for name, stat in (("ma", "mean"), ("std", "std"))})
    zero = F.lit(0.0)
    made = {f"{value}_z_{n}": (x - F.col(f"{value}_ma_{n}")) / F.nullif(f"{value}_std_{n}", zero) for n in windows}
    short, long = velocity
    if {short, long} <= set(windows):
        made[f"{value}_velocity_{long}"] = F.col(f"{value}_ma_{short}") / F.nullif(f"{value}_ma_{long}", zero)
    return df.withColumns(made)


def daily_price_features(df: DataFrame, windows: Sequence[int], keys: Sequence[str] = ("ticker",), order: str = "date") -> DataFrame:
    """From daily bars: previous close, returns, gap, range, turnover, and means and z of what lies before."""
    w = by(keys, order)
    prev = F.lag("close").over(w)
    made = {
        "prev_close": prev,
        "ret_oc": safe_div(F.col("close") - F.col("open"), "open"),
        "ret_cc": safe_div(F.col("close") - prev, prev),
        "gap": safe_div(F.col("open") - prev, prev),
        "range_pct": safe_div(F.col("high") - F.col("low"), "open"),
        "turnover": F.col("close") * F.col("volume"),
    }
    df, more = df.withColumns(made), {}
    for n in windows:
        before = prior(w, n)
        close, volume, spread = (guarded("mean", F.col(c), before, n) for c in ("close", "volume", "range_pct"))
        more |= {
            f"close_ma_{n}": close,
            f"close_z_{n}": clip(safe_div(F.col("close") - close, guarded("std", F.col("close"), before, n)), -10.0, 10.0),
            f"volume_ma_{n}": volume,
            f"volume_velocity_{n}": safe_div(F.col("volume"), volume),
            f"range_ma_{n}": spread,
            f"range_z_{n}": clip(safe_div(F.col("range_pct") - spread, guarded("std", F.col("range_pct"), before, n)), -10.0, 10.0),
        }
    return df.withColumns(more)


def rolling_ratio(df: DataFrame, top: str, bottom: str, windows: Sequence[int], name: str, keys: Sequence[str], order: str = "date", lag_rows: int = 0) -> DataFrame:
    """Rolling sum of top, and that over the rolling sum of bottom, up to the row lag_rows before this one; from one value on."""
    w, made = by(keys, order), {}
    for n in windows:
        frame = w.rowsBetween(-(n - 1) - lag_rows, -lag_rows)
        made |= {f"{name}_{n}": F.sum(top).over(frame), f"{name}_ratio_{n}": safe_div(F.sum(top).over(frame), F.sum(bottom).over(frame))}
    return df.withColumns(made)


def rolling_moments(df: DataFrame, value: str, windows: Sequence[int], keys: Sequence[str], order: str = "date") -> DataFrame:
    """Bias-corrected skewness and kurtosis of the rows before, from half a window on."""
    w, made = by(keys, order), {}
    for n in windows:
        frame = prior(w, n)
        enough = F.count(value).over(frame) >= max(1, n // 2)
        made |= {f"{value}_skew_{n}": F.when(enough, sample_skew(F.col(value), frame)), f"{value}_kurt_{n}": F.when(enough, sample_kurtosis(F.col(value), frame))}
    return df.withColumns(made)


def hit_rate(df: DataFrame, label: str, windows: Sequence[int], keys: Sequence[str], order: str = "date") -> DataFrame:
    """Prior mean of a label from max(5, n / 4) rows on, and the short minus the long window."""
    w = by(keys, order)
    df = df.withColumns({f"{label}_rate_{n}": guarded("mean", F.col(label), prior(w, n), max(5, n // 4)) for n in windows})
    return df.withColumn(f"{label}_trend", F.col(f"{label}_rate_{min(windows)}") - F.col(f"{label}_rate_{max(windows)}"))


def overnight_profile(df: DataFrame, windows: Sequence[int], keys: Sequence[str] = ("ticker",), order: str = "date") -> DataFrame:
    """Of the overnight returns (open over the previous close) of the rows before: mean, rates, worst and the value at
    the floor of a tenth; from max(3, n / 4) rows on."""
    w = by(keys, order)
    df = df.withColumn("overnight", safe_div(F.col("open"), F.lag("close").over(w)) - 1)
    x, made = F.col("overnight"), {}
    rate = lambda cond, frame: F.avg(F.when(x.isNotNull(), cond.cast("double"))).over(frame)
    for n in windows:
        frame = prior(w, n)
        enough = F.count(x).over(frame) >= max(3, n // 4)
        kept = F.sort_array(F.collect_list(x).over(frame))
        parts = {
            "mean": F.avg(x).over(frame), "pos": rate(x > 0, frame), "down2": rate(x <= -0.02, frame), "down5": rate(x <= -0.05, frame), "up2": rate(x >= 0.02, frame),
            "worst": F.min(x).over(frame), "p10": F.element_at(kept, (F.floor(F.size(kept) * 0.1) + 1).cast("int")),
        }
        made |= {f"on_{k}_{n}": F.when(enough, v) for k, v in parts.items()}
        made[f"on_edge_{n}"] = F.when(enough, parts["up2"] - parts["down2"])
    return df.withColumns(made)


def index_features(df: DataFrame, value: str = "close", keys: Sequence[str] = ("symbol",), order: str = "date", windows: Sequence[int] = (5, 20, 100, 200)) -> DataFrame:
    """Of each series the previous value and return, the 5-row return, the means of the rows before (from half a window
    of values on) and the previous value's ratios to them."""
    w = by(keys, order)
    prev = F.lag(value).over(w)
    made = {"prev": prev, "prev_ret": safe_div(prev, F.lag(value, 2).over(w)) - 1, "ret5": safe_div(prev, F.lag(value, 6).over(w)) - 1}
    means = {n: guarded("mean", F.col(value), prior(w, n), (n + 1) // 2) for n in windows}
    return df.withColumns(made | {f"ma_{n}": m for n, m in means.items()} | {f"to_ma_{n}": safe_div(prev, m) for n, m in means.items()})


def ewm_sum(value, w: WindowSpec, alpha: float) -> Column:
    """The sum of (1 - alpha)^i x over the rows up to this one, 0 < alpha < 1. The frame ends where the weights fall
    below 2^-56, less than a double holds beside values of like size."""
    rows = math.ceil(-56 / math.log2(1 - alpha))
    kept = F.collect_list(F.coalesce(col(value), F.lit(0.0))).over(latest(w, rows))
    return F.aggregate(kept, F.lit(0.0), lambda acc, x: acc * (1 - alpha) + x)


def limit_history(df: DataFrame, limit: Column | None = None, keys: Sequence[str] = ("ticker",), order: str = "date", windows: Sequence[int] = (3, 5, 10, 20, 60), buffer: float = 0.005) -> DataFrame:
    """History of limit-up rows before each row: state and counts (null at the first row), streaks with and without,
    rows since, last return, best returns. limit: the row's limit as a fraction of the previous close (by the price
    steps, if None); the row is limit-up if its return comes within `buffer` of it."""
    w = by(keys, order)
    df = df.withColumn("_prev", F.lag("close").over(w)).withColumn("_ret", safe_div(F.col("close") - F.col("_prev"), "_prev"))
    df = df.withColumn("is_limit", flag(F.col("_ret") >= (limit_pct("_prev") if limit is None else limit) - F.lit(buffer)))
    hit = F.col("is_limit") == 1
    made = {"limit_t1": F.lag("is_limit").over(w), "limit_last_ret": last_value_when(hit, "_ret", w)}
    made |= {f"limit_count_{n}": F.sum("is_limit").over(prior(w, n)) for n in windows}
    made |= {f"max_ret_{n}": F.max("_ret").over(prior(w, n)) for n in (5, 20)}
    df = with_days_since(df.withColumns(made), hit, "limit_days_since", keys, order)
    df = with_streak(df, ~hit, "no_limit_streak", keys, order, current=False)
    return with_streak(df, hit, "limit_streak", keys, order, current=False).drop("_prev", "_ret")


def rezscore(df: DataFrame, value: str, window: int, keys: Sequence[str], order: str = "date") -> DataFrame:
    """z and velocity of the row before against its own prior baseline, so that nothing of the current row is known."""
    w = by(keys, order)
    mean, std = guarded("mean", F.col(value), prior(w, window), window), guarded("std", F.col(value), prior(w, window), window)
    df = df.withColumns({"_m": mean, "_s": std})
    last, m, s = (F.lag(c).over(w) for c in (value, "_m", "_s"))
    return df.withColumns({f"{value}_rez_{window}": clip(safe_div(last - m, s), -10.0, 10.0), f"{value}_revelocity_{window}": safe_div(last, m)}).drop("_m", "_s")


def opening_history(df: DataFrame, hour: str, first_hour: int, ts: str, keys: Sequence[str] = ("ticker",), order: str = "date", window: int = 20, rise: float = 0.02, least: int = 10) -> DataFrame:
    """Of each day's opening bar the return and range, their mean, deviation and rate of rises over the last days (from
    `least` days on), and the previous return. Bars without all four prices, or that open at 0 or less, don't count."""
    rn = F.row_number().over(Window.partitionBy(*keys, order).orderBy(ts))
    whole = " and ".join(f"{c} is not null" for c in ("high", "low", "close"))
    day = df.filter(F.col(hour) == first_hour).filter(f"open > 0 and {whole}").withColumn("_rn", rn).filter("_rn = 1")
    day = day.select(*keys, order, (safe_div("close", "open") - 1).alias("open_ret"), safe_div(F.col("high") - F.col("low"), "open").alias("open_range"))
    w = by(keys, order)
    frame = latest(w, window)
    of = lambda s, x: guarded(s, x, frame, least)
    made = {"open_ret_ma": of("mean", F.col("open_ret")), "open_ret_std": of("std", F.col("open_ret")), "open_rise_rate": of("mean", flag(F.col("open_ret") >= rise))}
    return day.withColumns(made | {"open_range_ma": of("mean", F.col("open_range")), "open_ret_prev": F.lag("open_ret").over(w)})


def volume_family(df: DataFrame, hour: str, last_hour: int, keys: Sequence[str] = ("ticker",), order: str = "date", window: int = 20, least: int = 10) -> DataFrame:
    """A day's volume against its mean of the days before, and its last hour against the mean of the hours before it."""
    late = F.col(hour) == last_hour
    day = df.groupBy(*keys, order).agg(F.sum("volume").alias("day_volume"), F.sum(F.when(late, F.col("volume"))).alias("_l"), F.avg(F.when(F.col(hour) < last_hour, F.col("volume"))).alias("_e"))
    mean = guarded("mean", F.col("day_volume"), prior(by(keys, order), window), least)
    return day.withColumns({"volume_ma": mean, "relative_volume": safe_div("day_volume", mean), "last_hour_surge": safe_div("_l", "_e")}).drop("_l", "_e")


def frequency_surge(df: DataFrame, keys: Sequence[str] = ("ticker",), order: str = "date", buy: str = "buy_freq", sell: str = "sell_freq") -> DataFrame:
    """Of the trades of one member, nulls as 0: means of bought and sold ones over the 5 rows before (from 2 on) and of
    bought ones over 20 (from 5 on), and the total of the row before over the total's mean of the 20 rows before."""
    w = by(keys, order)
    df = df.withColumns({"_b": F.coalesce(buy, F.lit(0)), "_s": F.coalesce(sell, F.lit(0))}).withColumn("_t", F.col("_b") + F.col("_s"))
    mean = lambda c, n, least: guarded("mean", F.col(c), prior(w, n), least)
    made = {"buy_freq_ma_5": mean("_b", 5, 2), "sell_freq_ma_5": mean("_s", 5, 2), "buy_freq_ma_20": mean("_b", 20, 5), "freq_surge": safe_div(F.lag("_t").over(w), mean("_t", 20, 5))}
    return df.withColumns(made).drop("_b", "_s", "_t")


def group_rolling(df: DataFrame, group: str, all_members: str = "members", keys: Sequence[str] = ("ticker",), order: str = "date") -> DataFrame:
    """Of a member group's totals ({group}_sum, _abs, _members, _buyers, _buy_freq): participation among all members,
    share of buyers, consensus; the run of rows bought (rows without the group neither add nor end it); and against
    the rows before the z over 20 (from 5 values), sums over 3 and 7 (from 1 and 3), and of bought trades the mean, z
    and ratio over 30 (from 10). What isn't known is 0."""
    w, g = by(keys, order), group
    net, freq = F.col(f"{g}_sum"), F.col(f"{g}_buy_freq")
    of = lambda s, x, n, least: guarded(s, x, prior(w, n), least)
    up = F.sum(flag(net > 0)).over(w.rowsBetween(Window.unboundedPreceding, 0))
    df = df.withColumn("_up", up)
    ended = F.max(F.when(net <= 0, F.col("_up"))).over(w.rowsBetween(Window.unboundedPreceding, 0))
    made = {
        f"{g}_participation": safe_div(f"{g}_members", all_members), f"{g}_buyer_ratio": safe_div(f"{g}_buyers", f"{g}_members"), f"{g}_consensus": safe_div(F.abs(net), f"{g}_abs"),
        f"{g}_streak": F.col("_up") - F.coalesce(ended, F.lit(0)), f"{g}_z_20": safe_div(net - of("mean", net, 20, 5), of("std", net, 20, 5)), f"{g}_sum_3": of("sum", net, 3, 1), f"{g}_sum_7": of("sum", net, 7, 3),
        f"{g}_buy_freq_ma_30": of("mean", freq, 30, 10), f"{g}_buy_freq_z_30": safe_div(freq - of("mean", freq, 30, 10), of("std", freq, 30, 10)), f"{g}_buy_freq_ratio_30": safe_div(freq, of("mean", freq, 30, 10)),
    }
    df = df.withColumns(made).drop("_up")
    return df.fillna(0, [f"{g}_{c}" for c in ("sum", "abs", "members", "buyers", "buy_freq")] + list(made))


def foreign_flow(df: DataFrame, names: Sequence[str], keys: Sequence[str] = ("date", "ticker"), member: str = "broker", buy: str = "gross_buy", sell: str = "gross_sell", turnover: str = "gross_turnover") -> DataFrame:
    """foreign_net_buy and foreign_participation (bought and sold over the turnover of all rows) by key, the mean of
    the 5 net flows before (from 3), and z: the flow less that mean over the deviation of the 20 before (from 10).

    The flows are those of the members `names` (in any case of letters), for keys that have such rows. If there are
    none, the columns foreign_buy and foreign_sell, or foreign_net_buy alone, are taken of all rows; else none comes back.
    """
    mine = F.upper(member).isin([x.upper() for x in names]) if member in df.columns else F.lit(False)
    b, s = F.col(buy), F.col(sell)
    if df.filter(mine).isEmpty():
        mine = F.lit(bool({"foreign_net_buy", "foreign_buy"} & set(df.columns)))
        pair = {"foreign_buy", "foreign_sell"} <= set(df.columns)
        net = F.col("foreign_net_buy") if "foreign_net_buy" in df.columns else F.lit(None).cast("double")
        b, s = (F.col("foreign_buy"), F.col("foreign_sell")) if pair else (F.greatest(net, F.lit(0.0)), F.greatest(-net, F.lit(0.0)))
    both = F.sum(F.when(mine, F.coalesce(b, F.lit(0.0)) + F.coalesce(s, F.lit(0.0))))
    day = df.groupBy(*keys).agg(F.count(F.when(mine, 1)).alias("_n"), F.coalesce(F.sum(F.when(mine, b - s)), F.lit(0.0)).alias("foreign_net_buy"), safe_div(both, F.sum(turnover)).alias("foreign_participation")).filter("_n > 0").drop("_n")
    w, net = by(keys[1:], keys[0]), F.col("foreign_net_buy")
    mean = guarded("mean", net, prior(w, 5), 3)
    return day.withColumns({"foreign_ma_5": mean, "foreign_z_20": safe_div(net - mean, guarded("std", net, prior(w, 20), 10))})
