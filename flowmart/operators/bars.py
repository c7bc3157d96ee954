"""Bars and time buckets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.functions.exprs import clip, flag, limit_pct, safe_div, tick_size


def first_of(value, *order) -> Column:
    """The value of the first row by order that has one."""
    return F.min_by(value, F.when(F.col(value).isNotNull() if isinstance(value, str) else value.isNotNull(), F.struct(*order)))


def last_of(value, *order) -> Column:
    return F.max_by(value, F.when(F.col(value).isNotNull() if isinstance(value, str) else value.isNotNull(), F.struct(*order)))


def resample_ohlcv(df: DataFrame, keys: Sequence[str], bucket: Column, order: Sequence[str], price: str, volume: Column | str, name: str = "bucket") -> DataFrame:
    """Open, high, low, close, volume and ticks of each bucket."""
    rows = df.withColumn(name, bucket)
    volume = F.col(volume) if isinstance(volume, str) else volume
    return rows.groupBy(*keys, name).agg(
        first_of(price, *order).alias("open"), F.max(price).alias("high"), F.min(price).alias("low"), last_of(price, *order).alias("close"), F.coalesce(F.sum(volume), F.lit(0)).alias("volume"), F.count("*").alias("ticks")
    )


def derive_volume(df: DataFrame, keys: Sequence[str], order: Sequence[str], volume: str, mode: str = "auto") -> DataFrame:
    """Volume of each group: the sum, or last less first where the column runs up. auto: it runs up where there are
    at least three differences and 95 % of them aren't negative."""
    w = Window.partitionBy(*keys).orderBy(*order)
    g = df.withColumn("_d", F.col(volume) - F.lag(volume).over(w)).groupBy(*keys)
    g = g.agg(F.coalesce(F.sum(volume), F.lit(0.0)).alias("_sum"), (last_of(volume, *order) - first_of(volume, *order)).alias("_span"), F.count("_d").alias("_n"), F.avg(flag(F.col("_d") >= 0)).alias("_up0"), F.sum(flag(F.col("_d") >= 0)).alias("_up"))
    rising = (F.col("_n") >= 3) & (F.col("_up") >= 0.95 * F.col("_n")) if mode == "auto" else F.lit(mode == "cumulative")
    return g.select(*keys, rising.alias("cumulative"), F.when(rising, F.greatest("_span", F.lit(0.0))).otherwise(F.col("_sum")).alias("volume"))


def daily_from_intraday(df: DataFrame, keys: Sequence[str], ts: str) -> DataFrame:
    """A day's bar, its number of bars, and the returns of the whole day, the first bar and the first two."""
    rows = df.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(ts)))
    g = rows.groupBy(*keys).agg(
        first_of("open", ts).alias("open"), F.max("high").alias("high"), F.min("low").alias("low"), last_of("close", ts).alias("close"), F.coalesce(F.sum("volume"), F.lit(0)).alias("volume"),
        F.count("*").alias("bar_count"), F.max(F.when(F.col("_rn") == 1, F.col("close"))).alias("_c1"), F.max(F.when(F.col("_rn") == 2, F.col("close"))).alias("_c2"),
    )
    made = {name: safe_div(F.col(c) - F.col("open"), "open") for name, c in (("ret_oc", "close"), ("first_bar_ret", "_c1"), ("two_bar_ret", "_c2"))}
    return g.withColumns(made | {"range_pct": safe_div(F.col("high") - F.col("low"), "open"), "turnover": F.col("close") * F.col("volume")}).drop("_c1", "_c2")


def vwap_features(df: DataFrame, keys: Sequence[str], ts: str, hour: str, morning: Sequence[int] = (9, 10, 11), afternoon: int = 13) -> DataFrame:
    """Volume-weighted prices of day, morning and up to each bar, and how close, drive and volume stand to them; one
    running window and one grouping."""
    w = Window.partitionBy(*keys).orderBy(ts)
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    rows = df.withColumn("_tv", (F.col("high") + F.col("low") + F.col("close")) / 3 * F.col("volume"))
    rows = rows.withColumns({"_run": safe_div(F.sum("_tv").over(run), F.sum("volume").over(run)), "_back": F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(ts)))})
    am, pm, second = F.col(hour).isin(*morning), F.col(hour) >= afternoon, F.col("_back") == 2
    g = rows.groupBy(*keys).agg(
        safe_div(F.sum("_tv"), F.sum("volume")).alias("vf"), safe_div(F.sum(F.when(am, F.col("_tv"))), F.sum(F.when(am, F.col("volume")))).alias("vm"), F.sum("volume").alias("_v"), last_of("close", ts).alias("_c"),
        F.min_by(F.when(pm, F.col("close")), F.when(pm, F.col(ts))).alias("_pm"), F.max(F.when(second, flag(F.col("close") > F.col("_run")))).alias("_above"),
        F.sum(F.when(F.col("close") > F.col("_run"), F.col("volume")).otherwise(0)).alias("_va"),
    )
    return g.select(
        *keys,
        safe_div(F.col("_c") - F.col("vf"), "vf").alias("close_to_vwap"), safe_div(F.col("_pm") - F.col("vm"), "vm").alias("open_pm_to_vwap_am"), safe_div(F.col("vf") - F.col("vm"), "vm").alias("vwap_trend"),
        F.coalesce("_above", F.lit(0)).alias("last_hour_above_vwap"), safe_div(F.col("_c") - F.col("_pm"), "vf").alias("close_drive"), safe_div("_va", "_v").alias("vol_above_vwap_pct"),
    )


def preclose_features(df: DataFrame, keys: Sequence[str], ts: str, hour: str, cutoff: int = 14, noon: int = 12, windows: Sequence[int] = (5, 10, 20)) -> DataFrame:
    """What is known of a day at the cutoff hour, for the days that have a bar of that hour: opening range (first two
    bars), ranges, volumes and turnovers of both halves and their rates by bar, place of the price in the day so far,
    and, over the days before, means of close and volume that the present ones are held against."""
    rows = df.filter(F.col(hour) <= cutoff).withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(ts)))
    am, pm, opening = F.col(hour) < noon, F.col(hour) >= noon, F.col("_rn") <= 2
    typical = (F.col("high") + F.col("low") + F.col("close")) / 3
    made = []
    for name, cond in (("am", am), ("pm", pm), ("open2", opening)):
        made += [F.max(F.when(cond, F.col("high"))).alias(f"{name}_high"), F.min(F.when(cond, F.col("low"))).alias(f"{name}_low"), F.coalesce(F.sum(F.when(cond, F.col("volume"))), F.lit(0)).alias(f"{name}_volume"),
                 F.coalesce(F.sum(F.when(cond, F.col("volume") * typical)), F.lit(0.0)).alias(f"{name}_turnover"), F.sum(flag(cond)).alias(f"{name}_bars")]
    g = rows.groupBy(*keys).agg(
        first_of("open", ts).alias("day_open"), F.max("high").alias("day_high"), F.min("low").alias("day_low"), last_of("close", ts).alias("price"), F.sum("volume").alias("day_volume"),
        safe_div(F.sum(F.col("volume") * typical), F.sum("volume")).alias("vwap"), F.max(flag(F.col(hour) == cutoff)).alias("_has"), *made,
    )
    g = g.filter("_has = 1").drop("_has")
    out = {f"{n}_range_pct": safe_div(F.col(f"{n}_high") - F.col(f"{n}_low"), "day_open") for n in ("am", "pm", "open2")}
    out |= {f"{n}_volume_rate": safe_div(f"{n}_volume", f"{n}_bars") for n in ("am", "pm")}
    out |= {
        "ret_from_open": safe_div("price", "day_open") - 1, "place_in_day": clip(safe_div(F.col("price") - F.col("day_low"), F.col("day_high") - F.col("day_low")), 0.0, 1.0), "to_vwap": safe_div("price", "vwap") - 1,
        "pm_to_am_volume": safe_div("pm_volume", "am_volume"), "over_opening_high": safe_div("price", "open2_high") - 1,
    }
    entity = [k for k in keys if k != "date"]
    w = Window.partitionBy(*entity).orderBy("date")
    for n in windows:
        frame = w.rowsBetween(-n, -1)
        for c in ("price", "day_volume"):
            out[f"{c}_to_ma_{n}"] = safe_div(F.col(c), F.when(F.count(c).over(frame) >= max(3, n // 2), F.avg(c).over(frame)))
    return g.withColumns(out)


def limit_state(df: DataFrame, keys: Sequence[str], ts: str, hour: str, prev_close: str) -> DataFrame:
    """Of each day how its bars met the upper limit: touched, released, closed at it, locked; and the state of the last bar."""
    limit, tick = F.col(prev_close) * (1 + limit_pct(prev_close)), tick_size(prev_close)
    rows = df.withColumn("_limit", limit).withColumn("_at", F.when(F.col("_limit") > 0, F.col("_limit") - tick))
    rows = rows.withColumns({"_t": flag(F.col("high") >= F.col("_at")), "_c": flag(F.col("close") >= F.col("_at"))})
    rows = rows.withColumns({"_r": flag((F.col("_t") == 1) & (F.col("low") < F.col("_at"))), "_f": flag((F.col("_t") == 1) & (F.col("open") >= F.col("_at")) & (F.col("low") >= F.col("_at")) & (F.col("_c") == 1))})
    rows = rows.withColumn("_d", F.when(F.col("_r") == 1, (F.col("_limit") - F.col("low")) / F.col("_limit")).otherwise(0.0))
    last = F.max_by(F.struct("_t", "_r", "_c", "_f", "_d"), ts)
    g = rows.groupBy(*keys).agg(
        first_of("_limit", ts).alias("limit_price"), F.max("_t").alias("touched"), F.sum("_t").alias("touched_bars"), F.sum("_r").alias("released"), F.sum("_c").alias("closed_at"), F.sum("_f").alias("locked_bars"),
        F.max("_d").alias("depth_max"), F.avg("_d").alias("depth_mean"), F.min(F.when(F.col("_t") == 1, F.col(hour))).alias("touch_hour"), last.alias("_last"),
    )
    return g.withColumns({"last_touched": F.col("_last._t"), "last_closed_at": F.col("_last._c"), "release_ratio": safe_div("released", "touched_bars"), "locked_proxy": flag((F.col("touched") > 0) & (F.col("released") <= 0) & (F.col("_last._c") > 0))}).drop("_last")


def session_intensity(df: DataFrame, keys: Sequence[str], hour: str, noon: int = 12) -> DataFrame:
    """Volume weighted by where the close lies in the bar, by half of the day, and their ratios."""
    x = F.col("volume") * (F.col("close") - F.col("low")) / (F.col("high") - F.col("low") + 1e-6)
    g = df.groupBy(*keys).agg(*[F.coalesce(F.sum(F.when(c, x)), F.lit(0.0)).alias(n) for n, c in (("am_intensity", F.col(hour) < noon), ("pm_intensity", F.col(hour) >= noon))], F.sum("volume").alias("_v"))
    return g.withColumns({"pm_to_am": safe_div("pm_intensity", "am_intensity"), "intensity_share": safe_div(F.col("am_intensity") + F.col("pm_intensity"), "_v")}).drop("_v")


def closing_momentum(df: DataFrame, keys: Sequence[str], ts: str, hour: str, last: int = 15, before: int = 14, first: int = 9) -> DataFrame:
    """The close of the last hour against the hour before and the first open, and the day's range."""
    at = lambda h, c, f: f(F.when(F.col(hour) == h, F.col(c)), ts)
    g = df.groupBy(*keys).agg(
        at(last, "close", last_of).alias("entry_price"), at(before, "close", last_of).alias("_b"), at(first, "open", first_of).alias("_o"), F.max("high").alias("_h"), F.min("low").alias("_l")
    )
    return g.filter(F.col("entry_price").isNotNull()).select(*keys, "entry_price", (safe_div("entry_price", "_b") - 1).alias("mom_last_hour"), (safe_div("entry_price", "_o") - 1).alias("mom_day"), safe_div(F.col("_h") - F.col("_l"), "_o").alias("range_to_open"))


def sector_share(df: DataFrame, sectors: DataFrame, date: str, entity: str, value: str) -> DataFrame:
    """The entity's share of its sector's total on the day, and the sector's number of entities."""
    rows = df.join(sectors, entity, "left")
    total = rows.groupBy(date, "sector").agg(F.sum(value).alias("sector_day"), F.count_distinct(entity).alias("sector_entities"))
    return rows.join(total, [date, "sector"]).withColumn("sector_share", safe_div(value, "sector_day"))


def basket_proxy(prices: DataFrame, base: DataFrame, index_level: float, members: int, least: int) -> DataFrame:
    """An index estimate: its last level times the mean price of the `members` largest by turnover, now against then;
    null if fewer than `least` of them have both. prices: (ticker, price); base: (ticker, price_then, turnover)."""
    top = base.orderBy(F.desc("turnover"), "ticker").limit(members)
    both = top.join(prices, "ticker").agg(F.count("*").alias("n"), F.avg("price").alias("now"), F.avg("price_then").alias("then"))
    return both.select("n", F.when(F.col("n") >= least, index_level * safe_div("now", "then")).alias("estimate"))


def quantile_regime(df: DataFrame, value: str, keys: Sequence[str], order: str, edges: Sequence[float]) -> DataFrame:
    """State of the log return by its place among edges (such as its quantiles)."""
    w = Window.partitionBy(*keys).orderBy(order)
    df = df.withColumn("log_ret", F.log(safe_div(value, F.lag(value).over(w))))
    state = sum((flag(F.col("log_ret") > e) for e in edges), F.lit(0))
    return df.withColumn("regime", F.when(F.col("log_ret").isNotNull(), state))


def forensic_daily(flow: DataFrame, daily: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Absorption: net flow against the size of the day's return."""
    rows = flow.join(daily.select(*keys, "open", "close"), list(keys), "left")
    ret = safe_div(F.col("close") - F.col("open"), "open")
    return rows.withColumn("absorption", F.col(value) / (F.abs(ret) + 0.001)).drop("open", "close")
