"""Labels, datasets and splits."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.functions.exprs import flag, safe_div, spread_frac
from flowmart.operators.bars import first_of, last_of
from flowmart.operators.joins import next_session


def label_intraday(bars: DataFrame, keys: Sequence[str], hour: str, ts: str, cutoff: int, take: float = 0.02, stop: float = -0.035) -> DataFrame:
    """From the last bar of the cutoff hour: returns of high, low and close from the open; hit and stop; the day's
    features are those of the entity's session before."""
    entity = [k for k in keys if k != "date"]
    w = Window.partitionBy(*keys).orderBy(F.desc(ts))
    day = bars.filter(F.col(hour) == cutoff).withColumn("_rn", F.row_number().over(w)).filter("_rn = 1")
    made = {f"{n}_ret": safe_div(F.col(n) - F.col("open"), "open") for n in ("high", "low", "close")}
    out = day.withColumns(made).withColumns({"label_hit": flag((F.col("low_ret") > stop) & (F.col("high_ret") >= take)), "label_stop": flag(F.col("low_ret") <= stop)})
    return out.withColumn("feature_date", F.lag("date").over(Window.partitionBy(*entity).orderBy("date"))).select(*keys, "feature_date", *made, "label_hit", "label_stop")


def label_next_open(daily: DataFrame, keys: Sequence[str], take: float, stop: float, order: str = "date") -> DataFrame:
    """Return from a day's close to the next open, hit and stop, null on the last day; the day's range over its close,
    and where in the range it closed (null if there was none)."""
    w = Window.partitionBy(*keys).orderBy(order)
    out = daily.withColumn("next_open", F.lead("open").over(w)).withColumn("next_ret", safe_div(F.col("next_open") - F.col("close"), "close"))
    known = F.col("next_ret").isNotNull()
    return out.withColumns({
        "label_hit": F.when(known, flag(F.col("next_ret") >= take)), "label_stop": F.when(known, flag(F.col("next_ret") <= stop)),
        "range_share": safe_div(F.col("high") - F.col("low"), "close"), "close_place": safe_div(F.col("close") - F.col("low"), F.col("high") - F.col("low")),
    })


def label_overnight(bars: DataFrame, ts: str, hour: str, entry_hour: int, exit_hour: int, take: float = 0.004, stop: float = -0.02, jump: float = 0.15, gap_days: int = 3, absurd: float = 0.5) -> DataFrame:
    """From the last close of the entry hour to the first open of the exit hour of the ticker's next session. Returns
    beyond `jump` over gaps of more than gap_days, or beyond `absurd`, are taken for errors and dropped."""
    day = bars.groupBy("date", "ticker").agg(last_of(F.when(F.col(hour) == entry_hour, F.col("close")), ts).alias("entry_price"), first_of(F.when(F.col(hour) == exit_hour, F.col("open")), ts).alias("_open"))
    w = Window.partitionBy("ticker").orderBy("date")
    exits = F.when(F.col("_open").isNotNull(), F.struct(F.col("date").alias("d"), F.col("_open").alias("p")))
    day = day.withColumn("_exit", F.first(exits, ignorenulls=True).over(w.rowsBetween(1, Window.unboundedFollowing))).filter("entry_price is not null and _exit is not null")
    out = day.select("date", "ticker", "entry_price", F.col("_exit.p").alias("exit_price"), F.col("_exit.d").alias("exit_date")).withColumn("overnight_return", safe_div(F.col("exit_price") - F.col("entry_price"), "entry_price"))
    r, gap = F.abs("overnight_return"), F.date_diff("exit_date", "date")
    out = out.filter(~((r > jump) & (gap > gap_days)) & ~(r > absurd))
    return out.withColumns({"label_tp": flag(F.col("overnight_return") > take), "label_sl": flag(F.col("overnight_return") < stop)})


def relabel(base: DataFrame, exits: DataFrame, keys: Sequence[str], take: float, stop: float, fee: float | None = None) -> DataFrame:
    """Another exit price for the same rows; with a fee the return is net of it and of both spreads."""
    out = base.drop("exit_price", "overnight_return", "label_tp", "label_sl").join(exits.select(*keys, "exit_price"), list(keys), "left")
    gross = safe_div(F.col("exit_price") - F.col("entry_price"), "entry_price")
    net = gross if fee is None else gross - fee - spread_frac("entry_price") - spread_frac("exit_price")
    out = out.withColumn("overnight_return", net)
    known = F.col("overnight_return").isNotNull()
    return out.withColumns({"label_tp": F.when(known, flag(F.col("overnight_return") > take)), "label_sl": F.when(known, flag(F.col("overnight_return") < stop))})


def feature_label_join(features: DataFrame, labels: DataFrame, keys: Sequence[str] = ("ticker",), name: str = "default") -> DataFrame:
    """Features of a date with the labels whose feature_date it is."""
    f = features.withColumnRenamed("date", "feature_date")
    return labels.join(f, ["feature_date", *keys]).withColumn("label_name", F.lit(name))


def select_features(df: DataFrame, keys: Sequence[str], blocked: Sequence[str] = (), prefixes: Sequence[str] = ()) -> list[str]:
    """Numeric columns that aren't blocked, all null, constant, or the same as an earlier one (by an order-free
    fingerprint of key and value), from one pass over the table."""
    numeric = [f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float", "integer", "long", "short", "byte") and f.name not in (*keys, *blocked) and not f.name.startswith(tuple(prefixes) or ("\0",))]
    made = [e for c in numeric for e in (F.count(c).alias(f"{c}|n"), F.min(c).alias(f"{c}|lo"), F.max(c).alias(f"{c}|hi"), F.bit_xor(F.xxhash64(*keys, F.col(c).cast("double"))).alias(f"{c}|x"))]
    seen, kept, row = set(), [], df.agg(*made).first() if numeric else None
    for c in numeric:
        if row[f"{c}|n"] and row[f"{c}|lo"] != row[f"{c}|hi"] and row[f"{c}|x"] not in seen:
            seen.add(row[f"{c}|x"])
            kept.append(c)
    return kept


def cast_features(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Doubles to floats, as the last step before a write."""
    return df.withColumns({c: F.col(c).cast("float") for c in cols})


def universe_filter(daily: DataFrame, keys: Sequence[str] = ("ticker",), least_price: float = 50, least_turnover: float = 5e8, most_return: float = 0.2, rows: int = 20) -> DataFrame:
    """Without cheap rows, rows whose median turnover of the last `rows` is low, and rows that rose too far."""
    w = Window.partitionBy(*keys).orderBy("date")
    frame = w.rowsBetween(-(rows - 1), 0)
    out = daily.withColumns({"median_turnover": F.percentile(F.col("close") * F.col("volume"), 0.5).over(frame), "day_ret": safe_div("close", F.lag("close").over(w)) - 1})
    return out.filter((F.col("close") >= least_price) & (F.col("median_turnover") >= least_turnover) & ~F.coalesce(F.col("day_ret") >= most_return, F.lit(False)))


def time_split(days: Sequence[date], oot: int) -> tuple[list[date], list[date]]:
    """The days before, and the last `oot` of them."""
    days = sorted(days)
    if len(days) <= oot:
        raise ValueError(f"{len(days)} days are too few to hold out {oot}")
    return days[:-oot], days[-oot:]


def walk_forward(days: Sequence[date], folds: int, valid: int, least_train: int) -> list[tuple[list[date], list[date]]]:
    """Folds whose training days grow and whose `valid` validation days follow them."""
    days = sorted(days)
    if len(days) < least_train + folds * valid:
        raise ValueError(f"{len(days)} days are too few for {folds} folds")
    start = len(days) - folds * valid
    return [(days[: start + i * valid], days[start + i * valid : start + (i + 1) * valid]) for i in range(folds)]


def rolling_windows(days: Sequence[date], n: int, step: int, oot: int) -> list[dict]:
    """n hold-outs of `oot` days, each `step` days earlier than the one before, with the last day to train on."""
    days = sorted(days)
    if len(days) < oot + (n - 1) * step + 1:
        raise ValueError(f"{len(days)} days are too few for {n} windows")
    ends = [len(days) - 1 - i * step for i in range(n)]
    return [{"train_end": days[e - oot], "oot_start": days[e - oot + 1], "oot_end": days[e]} for e in ends]


def with_fold(df: DataFrame, folds: Sequence[tuple[Sequence[date], Sequence[date]]], day: str = "date") -> DataFrame:
    """A row for each fold that uses it, with fold and role; the days of all folds are few and are broadcast."""
    roles = [(i, d, role) for i, parts in enumerate(folds) for role, days in zip(("train", "valid"), parts, strict=True) for d in days]
    return df.join(F.broadcast(df.sparkSession.createDataFrame(roles, f"fold int, {day} date, role string")), day)


def oversample(df: DataFrame, y: str, ratio: float, keys: Sequence[str], seed: int = 0) -> DataFrame:
    """Repeats positives so that their share comes near `ratio`: the whole times for each, the rest by a hash of the key."""
    n = df.agg(F.sum(flag(F.col(y) == 1)).alias("p"), F.count("*").alias("n")).first()
    if not n.p or n.p / n.n >= ratio:
        return df
    times = ratio * (n.n - n.p) / (1 - ratio) / n.p
    draw = F.pmod(F.xxhash64(F.lit(seed), *keys), F.lit(1_000_000)) / 1e6
    copies = F.when(F.col(y) == 1, F.lit(int(times)) + flag(draw < times - int(times))).otherwise(1)
    return df.withColumn("_c", F.explode(F.sequence(F.lit(1), copies))).drop("_c")


def class_weight(df: DataFrame, y: str, mult: float = 1.0, name: str = "weight") -> DataFrame:
    n = df.agg(F.sum(flag(F.col(y) == 1)).alias("p"), F.count("*").alias("n")).first()
    return df.withColumn(name, F.when(F.col(y) == 1, (n.n - n.p) / max(n.p, 1) * mult).otherwise(1.0))


def coverage_clean(df: DataFrame, keys: Sequence[str], least_per_date: int, unsafe: Sequence[str] = (), date_col: str = "date") -> DataFrame:
    """Without repeated keys, dates with few rows, and columns of unsafe families; those come back lagged by one row."""
    entity = [k for k in keys if k != date_col]
    rows = df.dropDuplicates(list(keys))
    rows = rows.join(rows.groupBy(date_col).count().filter(F.col("count") < least_per_date), date_col, "left_anti")
    bad = [c for c in df.columns if c.startswith(tuple(unsafe) or ("\0",))]
    w = Window.partitionBy(*entity).orderBy(date_col)
    return rows.withColumns({f"{c}_lag1": F.lag(c).over(w) for c in bad}).drop(*bad)


def exits_on_next_session(picks: DataFrame, prices: DataFrame, cost: float, date_col: str = "date") -> DataFrame:
    """Picks (date, ticker, entry_price) settled on the next date that prices (date, ticker, exit_price) know.

    status: closed; pending if there is no later date yet; missing if a price isn't there. Returns gross and net.
    """
    days = next_session(prices.select(date_col).unionByName(picks.select(date_col)), date_col, "exit_date")
    p = prices.select(F.col(date_col).alias("exit_date"), "ticker", "exit_price")
    out = picks.join(days, date_col, "left").join(p, ["exit_date", "ticker"], "left")
    gross = safe_div(F.col("exit_price") - F.col("entry_price"), "entry_price")
    status = F.when(F.col("exit_date").isNull(), "pending").when(gross.isNull(), "missing").otherwise("closed")
    return out.select(date_col, "ticker", "exit_date", status.alias("status"), gross.alias("gross"), (gross - cost).alias("net"))


def settled_by_day(settled: DataFrame, days: DataFrame, date_col: str = "date") -> DataFrame:
    """What exits_on_next_session() settled, a row for each of `days` and each day with picks: status, picks, closed and
    the mean gross and net of those. A day is closed if any pick is, else pending if any is; without picks missing."""
    g = settled.groupBy(date_col).agg(
        F.count("*").alias("picks"), F.sum(flag(F.col("status") == "closed")).cast("long").alias("closed"), F.sum(flag(F.col("status") == "pending")).alias("_open"), F.avg(F.when(F.col("status") == "closed", F.col("gross"))).alias("gross"), F.avg(F.when(F.col("status") == "closed", F.col("net"))).alias("net")
    )
    every = days.select(date_col).unionByName(settled.select(date_col)).dropna().distinct()
    status = F.when(F.col("closed") > 0, "closed").when(F.col("_open") > 0, "pending").otherwise("missing")
    return every.join(g, date_col, "left").select(date_col, status.alias("status"), F.coalesce("picks", F.lit(0)).alias("picks"), F.coalesce("closed", F.lit(0)).alias("closed"), "gross", "net")
