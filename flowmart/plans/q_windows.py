"""Queries of rolling and lagged features, and of ranks."""

import datetime

from pyspark.sql import functions as F

from flowmart.functions import exprs as X
from flowmart.operators import aggs, checks, ranks
from flowmart.operators import windows as W
from flowmart.plans import views as V
from flowmart.plans.catalog import day, query, r, rd, shown
from flowmart.plans.q_rows import FLOW_SQL, with_flow_ratios

PAIR = "PARTITION BY broker, ticker ORDER BY date"
TICKER = "PARTITION BY ticker ORDER BY date"


def prior(n, over=TICKER):
    return f"OVER ({over} ROWS BETWEEN {n} PRECEDING AND 1 PRECEDING)"


def upto(n, over=TICKER):
    return f"OVER ({over} ROWS BETWEEN {n - 1} PRECEDING AND CURRENT ROW)"


def stat(f, x, n, least=None, over=TICKER):
    return f"CASE WHEN count({x}) {prior(n, over)} >= {n if least is None else least} THEN {f}({x}) {prior(n, over)} END"


def z_sql(x, n, over=PAIR):
    z = f"({x} - {stat('avg', x, n, over=over)}) / nullif({stat('stddev_samp', x, n, over=over)}, 0)"
    return f"CASE WHEN ({z}) IS NOT NULL THEN least(greatest({z}, -10), 10) END"


@query("v_panel", f"""SELECT date::VARCHAR AS date, broker, ticker, {r('net_rank')}, z5, rank FROM (
  SELECT *, row_number() OVER (PARTITION BY date ORDER BY abs(z5) DESC, broker, ticker) AS rank FROM (
    SELECT *, (rank() OVER (PARTITION BY date, ticker ORDER BY total_net_buy) + (count(*) OVER (PARTITION BY date, ticker, total_net_buy) - 1) / 2.0) / count(*) OVER (PARTITION BY date, ticker) AS net_rank,
      {r(z_sql('total_net_buy', 5) + ' AS z5')} FROM v_panel) WHERE z5 IS NOT NULL) WHERE rank <= 3""")
def abnormal_flow(spark, sf):
    """The three largest abnormal net flows of each day."""
    p = W.temporal_flow(with_flow_ratios(V.panel(spark, sf)), [5, 20])
    p = ranks.pct_rank(p, ["date", "ticker"], "total_net_buy", "net_rank").withColumn("z5", rd("total_net_buy_z_5"))
    top = ranks.top_k(p.filter("z5 is not null"), ["date"], [F.desc(F.abs("z5")), "broker", "ticker"], 3)
    return top.select(day().alias("date"), "broker", "ticker", rd("net_rank").alias("net_rank"), "z5", "rank")


@query("v_daily", f"SELECT date::VARCHAR AS date, ticker, lag(close) OVER ({TICKER}) AS close_lag1, lag(volume) OVER ({TICKER}) AS volume_lag1 FROM v_daily")
def e1_lag_cols(spark, sf):
    d = W.lag_cols(V.daily(spark, sf), ["close", "volume"], ["ticker"])
    return d.select(day().alias("date"), "ticker", "close_lag1", "volume_lag1")


@query("v_daily", f"""SELECT date::VARCHAR AS date, ticker, {r(*[f"{stat(f, 'close', n)} AS close_{s}_{n}" for n in (3, 8) for f, s in (("avg", "mean"), ("stddev_samp", "std"), ("max", "max"), ("min", "min"), ("sum", "sum"))], n=3)} FROM v_daily""")
def e2_rolling(spark, sf):
    d = W.rolling(V.daily(spark, sf), ["close"], [3, 8], ["mean", "std", "max", "min", "sum"], ["ticker"])
    return shown(d, "date", "ticker", *[f"close_{s}_{n}" for n in (3, 8) for s in ("mean", "std", "max", "min", "sum")], digits=3)


@query("v_panel", f"""SELECT date::VARCHAR AS date, broker, ticker, {r(f"lag(total_net_buy) OVER ({PAIR}) AS total_net_buy_lag1", f"{stat('avg', 'total_net_buy', 5, over=PAIR)} AS total_net_buy_ma_5", f"{z_sql('total_net_buy', 5)} AS total_net_buy_z_5", f"{stat('avg', 'net_flow_ratio', 20, over=PAIR)} AS net_flow_ratio_ma_20", n=4)},
  {r(f"CASE WHEN row_number() OVER ({PAIR}) >= 5 THEN coalesce(sum((total_net_buy > 0)::INT) {prior(5, PAIR)}, 0) / 5.0 END AS net_buy_sign_consistency_5", n=4)} FROM ({FLOW_SQL})""")
def e3_temporal_flow(spark, sf):
    p = W.temporal_flow(with_flow_ratios(V.panel(spark, sf)), [5, 20])
    return shown(p, "date", "broker", "ticker", "total_net_buy_lag1", "total_net_buy_ma_5", "total_net_buy_z_5", "net_flow_ratio_ma_20", "net_buy_sign_consistency_5", digits=4)


@query("v_panel", f"""WITH b AS (SELECT date, broker, round(sum(abs(total_net_buy)), 4) AS broker_day FROM v_panel GROUP BY ALL), w AS (SELECT *, {stat('avg', 'broker_day', 20, over='PARTITION BY broker ORDER BY date')} AS broker_day_base_20 FROM b)
  SELECT date::VARCHAR AS date, broker, ticker, {r(f"{stat('avg', 'total_net_buy', 20, over=PAIR)} AS total_net_buy_base_20", 'broker_day_base_20', f"{stat('avg', 'total_net_buy', 20, 10, PAIR)} AS half_base_20", n=3)} FROM v_panel JOIN w USING (date, broker)""")
def e4_e5_baselines(spark, sf):
    p = V.panel(spark, sf)
    b = p.groupBy("date", "broker").agg(F.round(F.sum(F.abs("total_net_buy")), 4).alias("broker_day"))
    b = W.baseline(b, "broker_day", [20], ["broker"]).drop("broker_day")
    own = W.baseline(p, "total_net_buy", [20], ["broker", "ticker"])
    half = W.baseline(own.withColumnRenamed("total_net_buy_base_20", "full"), "total_net_buy", [20], ["broker", "ticker"], least_share=0.5).withColumnsRenamed({"total_net_buy_base_20": "half_base_20", "full": "total_net_buy_base_20"})
    return shown(half.join(b, ["date", "broker"]), "date", "broker", "ticker", "total_net_buy_base_20", "broker_day_base_20", "half_base_20", digits=3)


HALF = ", ".join(f"{stat('avg', 'total_net_buy', n, n // 2, PAIR)} AS ma{n}, {stat('stddev_samp', 'total_net_buy', n, n // 2, PAIR)} AS std{n}" for n in (5, 20, 60))


@query("v_panel", f"""WITH h AS (SELECT *, {HALF} FROM v_panel) SELECT date::VARCHAR AS date, broker, ticker, {r(*[f'{c}{n} AS total_net_buy_{c}_{n}' for n in (5, 20, 60) for c in ('ma', 'std')], n=2)}, {r(*[f'(total_net_buy - ma{n}) / nullif(std{n}, 0) AS total_net_buy_z_{n}' for n in (5, 20, 60)], n=4)},
  (ma5 / nullif(ma20, 0) > 1)::INT::DOUBLE AS faster FROM h""")
def e5_half_window_baseline(spark, sf):
    """The velocity is shown as whether it is above 1, as its divisor may be near 0."""
    out = W.half_window_baseline(V.panel(spark, sf), "total_net_buy", [5, 20, 60], ["broker", "ticker"])
    names = [f"total_net_buy_{c}_{n}" for n in (5, 20, 60) for c in ("ma", "std", "z")]
    rounded = {c: rd(c, 4 if "_z_" in c else 2) for c in names}
    return out.withColumns(rounded).select(day().alias("date"), "broker", "ticker", *names, (F.col("total_net_buy_velocity_20") > 1).cast("int").cast("double").alias("faster"))


@query("v_daily", f"""WITH a AS (SELECT *, lag(close) OVER ({TICKER}) AS pc, (high - low) / nullif(open, 0) AS range_pct FROM v_daily)
  SELECT date::VARCHAR AS date, ticker, {r("(close - open) / nullif(open, 0) AS ret_oc", "(close - pc) / nullif(pc, 0) AS ret_cc", "(open - pc) / nullif(pc, 0) AS gap", "range_pct", f"{z_sql('close', 5, TICKER)} AS close_z_5", f"volume / nullif({stat('avg', 'volume', 5)}, 0) AS volume_velocity_5", f"{z_sql('range_pct', 5, TICKER)} AS range_z_5", n=5)} FROM a""")
def e6_daily_price_features(spark, sf):
    d = W.daily_price_features(V.daily(spark, sf), [5])
    return shown(d, "date", "ticker", "ret_oc", "ret_cc", "gap", "range_pct", "close_z_5", "volume_velocity_5", "range_z_5", digits=5)


@query("v_panel", f"""SELECT date::VARCHAR AS date, ticker, {r(f"sum(nv) {upto(5)} AS cvd_5", f"sum(nv) {upto(5)} / nullif(sum(tv) {upto(5)}, 0) AS cvd_ratio_5", f"sum(nv) {upto(20)} AS cvd_20", f"sum(nv) {upto(20)} / nullif(sum(tv) {upto(20)}, 0) AS cvd_ratio_20")}
  FROM (SELECT date, ticker, sum(buy_volume - sell_volume) AS nv, sum(buy_volume + sell_volume) AS tv FROM v_panel GROUP BY ALL)""")
def e9_cvd(spark, sf):
    d = V.panel(spark, sf).groupBy("date", "ticker").agg(F.sum(F.col("buy_volume") - F.col("sell_volume")).alias("nv"), F.sum(F.col("buy_volume") + F.col("sell_volume")).alias("tv"))
    d = W.rolling_ratio(d, "nv", "tv", [5, 20], "cvd", ["ticker"])
    return shown(d, "date", "ticker", "cvd_5", "cvd_ratio_5", "cvd_20", "cvd_ratio_20")


@query("v_panel", f"""WITH f AS (SELECT date, ticker, coalesce(buy_freq, 0) AS b, coalesce(sell_freq, 0) AS s, coalesce(buy_freq, 0) + coalesce(sell_freq, 0) AS t FROM v_panel WHERE broker = 'B7')
  SELECT date::VARCHAR AS date, ticker, {r(f"{stat('avg', 'b', 5, 2)} AS buy_freq_ma_5", f"{stat('avg', 's', 5, 2)} AS sell_freq_ma_5", f"{stat('avg', 'b', 20, 5)} AS buy_freq_ma_20", f"lag(t) OVER ({TICKER}) / nullif({stat('avg', 't', 20, 5)}, 0) AS freq_surge")} FROM f""")
def e10_frequency_surge(spark, sf):
    f = W.frequency_surge(V.panel(spark, sf).filter("broker = 'B7'"))
    return shown(f, "date", "ticker", "buy_freq_ma_5", "sell_freq_ma_5", "buy_freq_ma_20", "freq_surge")


@query("v_panel", f"""WITH n AS (SELECT *, row_number() OVER ({PAIR}) AS rn, (abs(total_net_buy) > 0)::INT AS act, (total_net_buy > 0)::INT AS up FROM v_panel),
  m AS (SELECT *, coalesce(max(CASE WHEN up = 0 THEN rn END) OVER ({PAIR} ROWS UNBOUNDED PRECEDING), 0) AS last_miss FROM n)
  SELECT date::VARCHAR AS date, broker, ticker, CASE WHEN rn > 5 THEN (sum(act) {prior(5, PAIR)})::DOUBLE END AS active_days_in_5,
    (rn - 1 - max(CASE WHEN act = 1 THEN rn END) OVER ({PAIR} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::DOUBLE AS days_since_last_active, (rn - 1 - max(CASE WHEN up = 1 THEN rn END) OVER ({PAIR} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::DOUBLE AS since_buy,
    (rn - last_miss)::INT AS buy_streak, coalesce(lag(rn - last_miss) OVER ({PAIR}), 0)::INT AS streak_before, last_value(CASE WHEN up = 1 THEN total_net_buy END IGNORE NULLS) OVER ({PAIR} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS last_buy FROM m""")
def e11_e14_activity(spark, sf):
    keys, up = ["broker", "ticker"], F.col("total_net_buy") > 0
    p = W.activity(V.panel(spark, sf))
    p = W.with_days_since(p, up, "since_buy", keys)
    p = W.with_streak(p, up, "buy_streak", keys)
    p = W.with_streak(p, up, "streak_before", keys, current=False)
    p = p.withColumn("last_buy", W.last_value_when(up, "total_net_buy", W.by(keys)))
    return p.select(day().alias("date"), *keys, *[F.col(c).cast("double").alias(c) for c in ("active_days_in_5", "days_since_last_active", "since_buy")], "buy_streak", "streak_before", "last_buy")


@query("v_daily", f"""WITH a AS (SELECT *, (close - lag(close) OVER ({TICKER})) / lag(close) OVER ({TICKER}) AS ret FROM v_daily), b AS (SELECT *, coalesce((ret >= CASE WHEN close / (1 + ret) <= 200 THEN 0.35 WHEN close / (1 + ret) <= 5000 THEN 0.25 ELSE 0.2 END - 0.005)::INT, 0) AS is_limit, row_number() OVER ({TICKER}) AS rn FROM a),
  c AS (SELECT *, coalesce(max(CASE WHEN is_limit = 0 THEN rn END) OVER ({TICKER} ROWS UNBOUNDED PRECEDING), 0) AS miss, coalesce(max(CASE WHEN is_limit = 1 THEN rn END) OVER ({TICKER} ROWS UNBOUNDED PRECEDING), 0) AS hit FROM b)
  SELECT date::VARCHAR AS date, ticker, is_limit, (lag(is_limit) OVER ({TICKER}))::DOUBLE AS limit_t1, (sum(is_limit) {prior(5)})::DOUBLE AS limit_count_5, (sum(is_limit) {prior(20)})::DOUBLE AS limit_count_20, coalesce(lag(rn - hit) OVER ({TICKER}), 0)::INT AS no_limit_streak,
    (rn - 1 - max(CASE WHEN is_limit = 1 THEN rn END) OVER ({TICKER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING))::DOUBLE AS limit_days_since, coalesce(lag(rn - miss) OVER ({TICKER}), 0)::INT AS limit_streak,
    {r(f"last_value(CASE WHEN is_limit = 1 THEN ret END IGNORE NULLS) OVER ({TICKER} ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS limit_last_ret", f"max(ret) {prior(5)} AS max_ret_5", f"max(ret) {prior(20)} AS max_ret_20")} FROM c""")
def e15_limit_history(spark, sf):
    d = W.limit_history(V.daily(spark, sf))
    d = d.withColumns({c: F.col(c).cast("double") for c in ("limit_t1", "limit_count_5", "limit_count_20", "limit_days_since")})
    return shown(d, "date", "ticker", "is_limit", "limit_t1", "limit_count_5", "limit_count_20", "limit_days_since", "limit_streak", "no_limit_streak", "limit_last_ret", "max_ret_5", "max_ret_20")


@query("v_daily", f"SELECT date::VARCHAR AS date, ticker, {r(f'quantile_cont(close * volume, 0.5) {upto(20)} AS median_turnover', n=3)} FROM v_daily")
def e16_rolling_median(spark, sf):
    d = V.daily(spark, sf).withColumn("median_turnover", F.percentile(F.col("close") * F.col("volume"), 0.5).over(W.latest(W.by(["ticker"]), 20)))
    return shown(d, "date", "ticker", "median_turnover", digits=3)


@query("v_daily", f"""SELECT date::VARCHAR AS date, ticker, {r(f"CASE WHEN count(close) {prior(20)} >= 10 THEN skewness(close) {prior(20)} END AS close_skew_20", f"CASE WHEN count(close) {prior(20)} >= 10 THEN kurtosis(close) {prior(20)} END AS close_kurt_20", n=4)} FROM v_daily""")
def e17_rolling_moments(spark, sf):
    return shown(W.rolling_moments(V.daily(spark, sf), "close", [20], ["ticker"]), "date", "ticker", "close_skew_20", "close_kurt_20", digits=4)


@query("v_pred", f"""SELECT date::VARCHAR AS date, ticker, {r(f"{stat('avg', 'label_hit', 20, 5)} AS label_hit_rate_20", f"{stat('avg', 'label_hit', 20, 5)} - {stat('avg', 'label_hit', 60, 15)} AS label_hit_trend")} FROM v_pred""")
def e18_hit_rate(spark, sf):
    return shown(W.hit_rate(V.predictions(spark, sf), "label_hit", [20, 60], ["ticker"]), "date", "ticker", "label_hit_rate_20", "label_hit_trend")


@query("v_daily", f"""WITH o AS (SELECT *, open / nullif(lag(close) OVER ({TICKER}), 0) - 1 AS x FROM v_daily)
  SELECT date::VARCHAR AS date, ticker, {r(*[f"CASE WHEN count(x) {prior(20)} >= 5 THEN {e} END AS {n}" for e, n in ((f'avg(x) {prior(20)}', 'on_mean_20'), (f'avg((x > 0)::INT) {prior(20)}', 'on_pos_20'), (f'avg((x <= -0.02)::INT) {prior(20)}', 'on_down2_20'), (f'min(x) {prior(20)}', 'on_worst_20'), (f'avg((x >= 0.02)::INT) {prior(20)} - avg((x <= -0.02)::INT) {prior(20)}', 'on_edge_20'), (f'list_sort(list_filter(list(x) {prior(20)}, lambda v: v IS NOT NULL))[(floor(count(x) {prior(20)} * 0.1) + 1)::INT]', 'on_p10_20'))])} FROM o""")
def e20_overnight_profile(spark, sf):
    d = W.overnight_profile(V.daily(spark, sf), [20])
    return shown(d, "date", "ticker", "on_mean_20", "on_pos_20", "on_down2_20", "on_worst_20", "on_edge_20", "on_p10_20")


IDX = "PARTITION BY symbol ORDER BY date"


@query("v_index", f"""SELECT date::VARCHAR AS date, symbol, {r(f"{stat('avg', 'close', 5, 3, IDX)} AS ma_5", f"lag(close) OVER ({IDX}) / nullif(lag(close, 2) OVER ({IDX}), 0) - 1 AS prev_ret", f"lag(close) OVER ({IDX}) / nullif(lag(close, 6) OVER ({IDX}), 0) - 1 AS ret5", f"lag(close) OVER ({IDX}) / nullif({stat('avg', 'close', 20, 10, IDX)}, 0) AS to_ma_20", f"lag(close) OVER ({IDX}) / nullif({stat('avg', 'close', 200, 100, IDX)}, 0) AS to_ma_200")} FROM v_index""")
def e21_index_features(spark, sf):
    return shown(W.index_features(V.index(spark, sf)), "date", "symbol", "ma_5", "prev_ret", "ret5", "to_ma_20", "to_ma_200")


@query("v_panel", f"""WITH f AS (SELECT date, ticker, round(sum(total_net_buy), 4) AS net FROM v_panel GROUP BY ALL)
  SELECT date::VARCHAR AS date, ticker, {r(f"list_reduce(list_prepend(0.0, list(net) OVER ({TICKER} ROWS UNBOUNDED PRECEDING)), lambda a, x: a * 0.7 + x) AS decay", f"sum(net) {upto(10)} AS inventory_10", n=3)} FROM f""")
def e22_ewm_sum(spark, sf):
    f = V.panel(spark, sf).groupBy("date", "ticker").agg(F.round(F.sum("total_net_buy"), 4).alias("net"))
    w = W.by(["ticker"])
    f = f.withColumns({"decay": W.ewm_sum("net", w, 0.3), "inventory_10": F.sum("net").over(W.latest(w, 10))})
    return shown(f, "date", "ticker", "decay", "inventory_10", digits=3)


ADX = f"""WITH RECURSIVE b AS (SELECT *, row_number() OVER t AS i, high - lag(high) OVER t AS up, lag(low) OVER t - low AS down, lag(close) OVER t AS was FROM v_daily WINDOW t AS (PARTITION BY ticker ORDER BY date)),
  m AS (SELECT ticker, date, i, greatest(high - low, abs(high - was), abs(low - was)) AS tr, CASE WHEN up > down AND up > 0 THEN up ELSE 0 END AS plus, CASE WHEN down > up AND down > 0 THEN down ELSE 0 END AS minus FROM b),
  s AS (SELECT ticker, i, tr, plus, minus FROM m WHERE i = 1 UNION ALL SELECT m.ticker, m.i, (13 * s.tr + m.tr) / 14, (13 * s.plus + m.plus) / 14, (13 * s.minus + m.minus) / 14 FROM s JOIN m ON m.ticker = s.ticker AND m.i = s.i + 1),
  d AS (SELECT ticker, i, CASE WHEN i >= 14 THEN 100 * plus / nullif(tr, 0) END AS di_plus, CASE WHEN i >= 14 THEN 100 * minus / nullif(tr, 0) END AS di_minus FROM s),
  x AS (SELECT *, 100 * abs(di_plus - di_minus) / nullif(di_plus + di_minus, 0) AS dx FROM d),
  a AS (SELECT ticker, i, dx AS y, (dx IS NOT NULL)::INT AS known, 1 AS gap FROM x WHERE i = 1
    UNION ALL SELECT x.ticker, x.i, CASE WHEN x.dx IS NULL THEN a.y WHEN a.y IS NULL THEN x.dx ELSE (pow(13 / 14, a.gap) * a.y + x.dx / 14) / (pow(13 / 14, a.gap) + 1 / 14) END,
      a.known + (x.dx IS NOT NULL)::INT, CASE WHEN x.dx IS NULL THEN a.gap + 1 ELSE 1 END FROM a JOIN x ON x.ticker = a.ticker AND x.i = a.i + 1)
  SELECT date::VARCHAR AS date, ticker, {r('CASE WHEN known >= 14 THEN y END AS adx', 'di_plus', 'di_minus', 'di_plus - di_minus AS di_diff', n=4)} FROM m JOIN x USING (ticker, i) JOIN a USING (ticker, i)"""


@query("v_daily", ADX)
def e23_wilder_adx(spark, sf):
    """Two rounds of Wilder means, in blocks of time."""
    from flowmart.operators.adx import wilder_adx

    return shown(wilder_adx(V.daily(spark, sf), 14), "date", "ticker", "adx", "di_plus", "di_minus", "di_diff", digits=4)


@query("v_hourly", f"""SELECT ticker, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, sum(volume) OVER d AS cum_volume, max(high) OVER d AS high_so_far, nth_value(close, 2) OVER (PARTITION BY ticker, date ORDER BY ts ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS second_close
  FROM v_hourly WINDOW d AS (PARTITION BY ticker, date ORDER BY ts ROWS UNBOUNDED PRECEDING)""")
def e24_e25_cumulative(spark, sf):
    w = W.by(["ticker", "date"], "ts")
    run, whole = w.rowsBetween(W.Window.unboundedPreceding, 0), w.rowsBetween(W.Window.unboundedPreceding, W.Window.unboundedFollowing)
    h = V.hourly(spark, sf)
    return h.select("ticker", F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"), F.sum("volume").over(run).alias("cum_volume"), F.max("high").over(run).alias("high_so_far"), F.nth_value("close", 2).over(whole).alias("second_close"))


GROUP_PARTS = ("members / nullif(n, 0) AS g_participation", "buyers / nullif(members, 0) AS g_buyer_ratio", "abs(net) / nullif(total, 0) AS g_consensus", f"(net - {stat('avg', 'net', 20, 5)}) / nullif({stat('stddev_samp', 'net', 20, 5)}, 0) AS g_z_20", f"{stat('sum', 'net', 3, 1)} AS g_sum_3", f"{stat('sum', 'net', 7, 3)} AS g_sum_7",
    f"{stat('avg', 'freq', 30, 10)} AS g_buy_freq_ma_30", f"(freq - {stat('avg', 'freq', 30, 10)}) / nullif({stat('stddev_samp', 'freq', 30, 10)}, 0) AS g_buy_freq_z_30", f"freq / nullif({stat('avg', 'freq', 30, 10)}, 0) AS g_buy_freq_ratio_30")
OWN = "FILTER (broker IN ('B1', 'B2'))"


@query("v_panel", f"""WITH f AS (SELECT date, ticker, count(*) AS n, nullif(count(*) {OWN}, 0) AS members, CASE WHEN count(*) {OWN} > 0 THEN count(*) FILTER (broker IN ('B1', 'B2') AND total_net_buy > 0) END AS buyers, round(sum(total_net_buy) {OWN}, 4) AS net, sum(abs(total_net_buy)) {OWN} AS total, sum(buy_freq) {OWN} AS freq FROM v_panel GROUP BY ALL),
  s AS (SELECT *, coalesce(sum((net <= 0)::INT) OVER ({TICKER} ROWS UNBOUNDED PRECEDING), 0) AS run FROM f)
  SELECT date::VARCHAR AS date, ticker, coalesce(sum(coalesce((net > 0)::INT, 0)) OVER (PARTITION BY ticker, run ORDER BY date ROWS UNBOUNDED PRECEDING), 0)::BIGINT AS g_streak, {r(*[f"coalesce({x.rpartition(' AS ')[0]}, 0) AS {x.rpartition(' AS ')[2]}" for x in GROUP_PARTS], n=3)}
  FROM (SELECT *, {', '.join(GROUP_PARTS)} FROM s)""")
def e8_group_rolling(spark, sf):
    own, net = F.col("broker").isin("B1", "B2"), F.col("total_net_buy")
    of = lambda f, x: f(F.when(own, x))
    f = V.panel(spark, sf).groupBy("date", "ticker").agg(
        F.count("*").alias("members"), of(F.sum, F.lit(1)).alias("g_members"), of(F.sum, X.flag(net > 0)).alias("g_buyers"), F.round(of(F.sum, net), 4).alias("g_sum"), of(F.sum, F.abs(net)).alias("g_abs"), of(F.sum, F.col("buy_freq")).alias("g_buy_freq"),
    )
    return shown(W.group_rolling(f, "g"), "date", "ticker", "g_streak", *[x.rpartition(" AS ")[2] for x in GROUP_PARTS], digits=3)


@query("v_panel", f"""SELECT date::VARCHAR AS date, broker, ticker, {r("(rank() OVER (PARTITION BY date, ticker ORDER BY total_net_buy) + (count(*) OVER (PARTITION BY date, ticker, total_net_buy) - 1) / 2.0) / count(*) OVER (PARTITION BY date, ticker) AS p")} FROM v_panel""")
def f1_pct_rank(spark, sf):
    return shown(ranks.pct_rank(V.panel(spark, sf), ["date", "ticker"], "total_net_buy", "p"), "date", "broker", "ticker", "p")


@query("v_panel", """SELECT date::VARCHAR AS date, broker, ticker, total_net_buy, rank FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY total_net_buy DESC, broker, ticker) AS rank FROM v_panel) WHERE rank <= 5""")
def f2_top_k(spark, sf):
    return ranks.top_k(V.panel(spark, sf), ["date"], [F.desc("total_net_buy"), "broker", "ticker"], 5).select(day().alias("date"), "broker", "ticker", "total_net_buy", "rank")


@query("v_panel", f"""WITH q AS (SELECT date, quantile_cont(total_net_buy, 0.9) AS q FROM v_panel GROUP BY date)
  SELECT date::VARCHAR AS date, broker, ticker, (total_net_buy >= q)::INT AS top, {r('greatest(1000.0, q) AS threshold', n=3)} FROM v_panel JOIN q USING (date)""")
def f3_f4_quantiles(spark, sf):
    p = ranks.top_quantile_flag(V.panel(spark, sf), ["date"], "total_net_buy", 0.9, "top")
    t = ranks.adaptive_threshold(p, ["date"], "total_net_buy", 1000.0, 0.9)
    return shown(p.join(t, "date"), "date", "broker", "ticker", "top", "threshold", digits=3)


@query("v_hourly", """SELECT ticker, date::VARCHAR AS date, hour::BIGINT AS hour, close FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY CASE hour WHEN 10 THEN 0 WHEN 9 THEN 1 WHEN 11 THEN 2 ELSE 9 END, abs(hour - 10), ts) AS rn FROM v_hourly) WHERE rn = 1""")
def f5_prefer_row(spark, sf):
    place = F.when(F.col("hour") == 10, 0).when(F.col("hour") == 9, 1).when(F.col("hour") == 11, 2).otherwise(9)
    return ranks.top_k(V.hourly(spark, sf), ["ticker", "date"], [place, F.abs(F.col("hour") - 10), "ts"], 1).select("ticker", day().alias("date"), F.col("hour").cast("long").alias("hour"), "close")


@query("v_pred", f"""WITH t AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY pred_proba DESC, ticker) AS rn FROM v_pred) SELECT date::VARCHAR AS date, {r('max(pred_proba) - min(pred_proba) AS gap')}, count(*) AS n FROM t WHERE rn <= 3 GROUP BY date""")
def f6_score_gap(spark, sf):
    return shown(ranks.score_gap(V.predictions(spark, sf), ["date"], "pred_proba", "ticker", 3), "date", "gap", "n")


@query("v_daily", """(SELECT date::VARCHAR AS date, ticker, close, 'low' AS side FROM v_daily ORDER BY close, v_daily.date, ticker LIMIT 10) UNION ALL (SELECT date::VARCHAR AS date, ticker, close, 'high' AS side FROM v_daily ORDER BY close DESC, v_daily.date, ticker LIMIT 10)""")
def f7_extremes(spark, sf):
    return ranks.extremes(V.daily(spark, sf), "close", ["date", "ticker"], 10).select(day().alias("date"), "ticker", "close", "side")


WINSOR = "SELECT quantile_cont(close, 0.01) a, quantile_cont(close, 0.99) b, quantile_cont(volume, 0.01) c, quantile_cont(volume, 0.99) d FROM h"
RANK = "CASE WHEN {0} IS NOT NULL THEN (rank() OVER (ORDER BY {0} NULLS LAST) + (count({0}) OVER (PARTITION BY {0}) - 1) / 2.0) / count({0}) OVER () END AS r{0}"


@query("v_daily", f"""WITH h AS (SELECT date, ticker, CASE WHEN ticker NOT IN ('T3', 'T4') THEN close END AS close, CASE WHEN ticker NOT IN ('T4', 'T5') THEN volume END AS volume FROM v_daily), q AS ({WINSOR}),
  w AS (SELECT date, ticker, CASE WHEN close IS NOT NULL THEN least(greatest(close, a), b) END AS x, CASE WHEN volume IS NOT NULL THEN least(greatest(volume, c), d) END AS y FROM h, q),
  k AS (SELECT date, ticker, {RANK.format('x')}, {RANK.format('y')} FROM w), m AS (SELECT date, ticker, coalesce((rx + ry) / 2, rx, ry) AS risk FROM k)
  SELECT date::VARCHAR AS date, ticker, {r("coalesce(risk, (SELECT quantile_cont(risk, 0.5) FROM m)) AS risk_norm")} FROM m""")
def f8_risk_score(spark, sf):
    """Some values are left out, to show what nulls do."""
    kept = lambda c, *without: F.when(~F.col("ticker").isin(*without), F.col(c))
    d = V.daily(spark, sf).withColumns({"close": kept("close", "T3", "T4"), "volume": kept("volume", "T4", "T5")})
    return shown(ranks.risk_score(d, ["close", "volume"]), "date", "ticker", "risk_norm")


@query()
def n5_lookahead_audit(spark, sf):
    """Rolling features of a cut source against those of the whole one: no value may differ."""
    cut = datetime.date(1999, 1, 4)
    build = lambda d: W.limit_history(W.daily_price_features(d, [5, 20]), F.lit(0.25))
    return checks.lookahead_audit(build, V.daily(spark, sf), ["date", "ticker"], F.lit(cut))


LAGS = """WITH b AS (SELECT ticker, date, (close - open) / open AS move, high - low AS spread, volume FROM v_daily), l AS (
    SELECT *, {}, lag(move, 1) OVER t AS d_move, spread AS d_spread, lag(volume, 2) OVER t AS d_volume FROM b WINDOW t AS (PARTITION BY ticker ORDER BY date)), e AS ({}), c AS (
    SELECT feature, count(*) FILTER (v + l0 + l1 + l2 + l3 IS NOT NULL) AS compared, {} FROM e GROUP BY feature), m AS (SELECT *, greatest(m0, m1, m2, m3) AS best FROM c), p AS (
    SELECT *, CASE WHEN compared > 0 AND best >= 0.99 * compared AND (m0 = best)::INT + (m1 = best)::INT + (m2 = best)::INT + (m3 = best)::INT = 1 THEN list_position([m0, m1, m2, m3], best) - 1 END AS built_lag FROM m)
  SELECT feature, compared, m0, m1, m2, m3, built_lag::BIGINT AS built_lag, built_lag = 0 AS same_day FROM p""".format(
    ", ".join(f"lag({f}, {k}) OVER t AS {f}{k}" for f in ("move", "spread", "volume") for k in range(4)),
    " UNION ALL ".join(f"SELECT '{f}' AS feature, d_{f} AS v, {f}0 AS l0, {f}1 AS l1, {f}2 AS l2, {f}3 AS l3 FROM l" for f in ("move", "spread", "volume")),
    ", ".join(f"count(*) FILTER (v + l0 + l1 + l2 + l3 IS NOT NULL AND abs(v - l{k}) <= 1e-9 + 1e-6 * abs(l{k})) AS m{k}" for k in range(4)),
)


@query("v_daily", LAGS)
def n5_lag_audit(spark, sf):
    """Three delivered features, lagged by 1, by nothing (a leak) and by 2, told by their values."""
    from flowmart.operators.checks import lag_audit

    d = V.daily(spark, sf)
    rebuilt = d.select("ticker", "date", ((F.col("close") - F.col("open")) / F.col("open")).alias("move"), (F.col("high") - F.col("low")).alias("spread"), "volume")
    w = W.by(["ticker"], "date")
    return lag_audit(rebuilt.withColumns({"move": F.lag("move").over(w), "volume": F.lag("volume", 2).over(w)}), rebuilt, "ticker", "date", ["move", "spread", "volume"])


@query("v_pred", f"SELECT count(*) AS entities, {r('avg((n >= 300)::INT) AS ready_share')} FROM (SELECT ticker, count(DISTINCT date) AS n FROM v_pred GROUP BY ticker)")
def n6_readiness(spark, sf):
    return shown(checks.readiness(V.predictions(spark, sf), "ticker", 300), "entities", "ready_share")


@query("v_panel", f"""WITH g AS (SELECT broker, count(*) AS n, avg((total_net_buy > 0)::INT) AS rate FROM v_panel GROUP BY broker HAVING count(*) >= 50), b AS (SELECT avg((total_net_buy > 0)::INT) AS base FROM v_panel)
  SELECT broker, n, {r('rate', 'rate - base AS lift', '(rate + 3.8416 / (2 * n) - 1.96 * sqrt(rate * (1 - rate) / n + 3.8416 / (4.0 * n * n))) / (1 + 3.8416 / n) AS wilson_low')} FROM g, b""")
def j18_conditional_lift(spark, sf):
    p = V.panel(spark, sf).withColumn("won", X.flag(F.col("total_net_buy") > 0))
    return shown(aggs.conditional_lift(p, "broker", "won", 50), "broker", "n", "rate", "lift", "wilson_low")



@query("v_daily", f"""WITH m AS (SELECT *, {stat('avg', 'close', 5)} AS m, {stat('stddev_samp', 'close', 5)} AS s FROM v_daily), l AS (SELECT *, lag(close) OVER ({TICKER}) AS lc, lag(m) OVER ({TICKER}) AS lm, lag(s) OVER ({TICKER}) AS ls FROM m)
  SELECT date::VARCHAR AS date, ticker, {r('CASE WHEN ls <> 0 AND lm IS NOT NULL THEN least(greatest((lc - lm) / ls, -10), 10) END AS close_rez_5', 'lc / nullif(lm, 0) AS close_revelocity_5', n=5)} FROM l""")
def e7_rezscore(spark, sf):
    return shown(W.rezscore(V.daily(spark, sf), "close", 5, ["ticker"]), "date", "ticker", "close_rez_5", "close_revelocity_5", digits=5)


@query("v_hourly", f"""WITH d AS (SELECT date, ticker, close / nullif(open, 0) - 1 AS open_ret, (high - low) / nullif(open, 0) AS open_range FROM (SELECT *, row_number() OVER (PARTITION BY ticker, date ORDER BY ts) AS rn FROM v_hourly WHERE hour = 9 AND open > 0) WHERE rn = 1)
  SELECT date::VARCHAR AS date, ticker, {r('open_ret', 'open_range', *[f'CASE WHEN count(*) {upto(20)} >= 10 THEN {e} {upto(20)} END AS {n}' for e, n in (('avg(open_ret)', 'open_ret_ma'), ('stddev_samp(open_ret)', 'open_ret_std'), ('avg((open_ret >= 0.02)::INT)', 'open_rise_rate'), ('avg(open_range)', 'open_range_ma'))], f'lag(open_ret) OVER ({TICKER}) AS open_ret_prev', n=5)} FROM d""")
def e19_opening_history(spark, sf):
    h = W.opening_history(V.hourly(spark, sf), "hour", 9, "ts")
    return shown(h, "date", "ticker", "open_ret", "open_range", "open_ret_ma", "open_ret_std", "open_rise_rate", "open_range_ma", "open_ret_prev", digits=5)


@query("v_hourly", f"""WITH d AS (SELECT date, ticker, sum(volume) AS day_volume, sum(volume) FILTER (hour = 14) AS l, avg(volume) FILTER (hour < 14) AS e FROM v_hourly GROUP BY ALL)
  SELECT date::VARCHAR AS date, ticker, {r('day_volume', f"{stat('avg', 'day_volume', 20, 10)} AS volume_ma", f"day_volume / nullif({stat('avg', 'day_volume', 20, 10)}, 0) AS relative_volume", 'l / nullif(e, 0) AS last_hour_surge', n=5)} FROM d""")
def e26_volume_family(spark, sf):
    v = W.volume_family(V.hourly(spark, sf), "hour", 14)
    return shown(v, "date", "ticker", "day_volume", "volume_ma", "relative_volume", "last_hour_surge", digits=5)
