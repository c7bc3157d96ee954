"""Queries of bars, labels and datasets."""

from pyspark.sql import functions as F

from flowmart.functions import exprs as X
from flowmart.operators import bars as B
from flowmart.operators import labels as L
from flowmart.operators import ranks
from flowmart.operators import windows as W
from flowmart.plans import views as V
from flowmart.plans.catalog import day, query, r, rd, shown
from flowmart.plans.q_windows import TICKER, stat, upto

KEYS = ["date", "ticker"]
HOURS = "hour::BIGINT AS hour"


@query("v_ticks", """SELECT ticker, strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bucket, arg_min(price, (ts, event_id)) AS open, max(price) AS high, min(price) AS low, arg_max(price, (ts, event_id)) AS close, sum(volume) AS volume, count(*) AS ticks FROM v_ticks GROUP BY ticker, date_trunc('hour', ts)""")
def g1_resample_ohlcv(spark, sf):
    b = B.resample_ohlcv(V.ticks(spark, sf), ["ticker"], F.date_trunc("hour", "ts"), ["ts", "event_id"], "price", "volume")
    return b.withColumn("bucket", F.date_format("bucket", "yyyy-MM-dd HH:mm:ss"))


@query("", f"""WITH e AS (SELECT user_id, ts, event_id, CASE WHEN user_id % 2 = 0 THEN event_id ELSE value END AS v FROM events), d AS (SELECT *, v - lag(v) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS d FROM e),
  g AS (SELECT user_id, sum(v) AS s, arg_max(v, (ts, event_id)) - arg_min(v, (ts, event_id)) AS span, count(d) AS n, count(*) FILTER (d >= 0) AS up FROM d GROUP BY user_id)
  SELECT user_id, n >= 3 AND up >= 0.95 * n AS cumulative, {r('CASE WHEN n >= 3 AND up >= 0.95 * n THEN greatest(span, 0) ELSE s END AS volume', n=3)} FROM g""")
def g2_derive_volume(spark, sf):
    e = V.table(spark, sf, "events").withColumn("v", F.when(F.col("user_id") % 2 == 0, F.col("event_id")).otherwise(F.col("value")).cast("double"))
    return shown(B.derive_volume(e, ["user_id"], ["ts", "event_id"], "v"), "user_id", "cumulative", "volume", digits=3)


@query("v_hourly", f"""WITH n AS (SELECT *, row_number() OVER (PARTITION BY date, ticker ORDER BY ts) AS rn FROM v_hourly), g AS (SELECT date, ticker, arg_min(open, ts) AS open, max(high) AS high, min(low) AS low, arg_max(close, ts) AS close, sum(volume) AS volume, count(*) AS bar_count, max(close) FILTER (rn = 1) AS c1, max(close) FILTER (rn = 2) AS c2 FROM n GROUP BY ALL)
  SELECT date::VARCHAR AS date, ticker, open, high, low, close, volume, bar_count, {r('(close - open) / nullif(open, 0) AS ret_oc', '(c1 - open) / nullif(open, 0) AS first_bar_ret', '(c2 - open) / nullif(open, 0) AS two_bar_ret', '(high - low) / nullif(open, 0) AS range_pct', 'close * volume AS turnover', n=4)} FROM g""")
def g3_daily_from_intraday(spark, sf):
    d = B.daily_from_intraday(V.hourly(spark, sf), KEYS, "ts")
    return shown(d, *KEYS, "open", "high", "low", "close", "volume", "bar_count", "ret_oc", "first_bar_ret", "two_bar_ret", "range_pct", "turnover", digits=4)


@query("v_hourly", f"""WITH a AS (SELECT *, (high + low + close) / 3 * volume AS tv, row_number() OVER (PARTITION BY date, ticker ORDER BY ts DESC) AS back FROM v_hourly),
  b AS (SELECT *, sum(tv) OVER w / nullif(sum(volume) OVER w, 0) AS run FROM a WINDOW w AS (PARTITION BY date, ticker ORDER BY ts ROWS UNBOUNDED PRECEDING)),
  g AS (SELECT date, ticker, sum(tv) / nullif(sum(volume), 0) AS vf, sum(tv) FILTER (hour IN (9, 10, 11)) / nullif(sum(volume) FILTER (hour IN (9, 10, 11)), 0) AS vm, arg_max(close, ts) AS c, arg_min(close, ts) FILTER (hour >= 13) AS pm,
    coalesce(max((close > run)::INT) FILTER (back = 2), 0) AS last_hour_above_vwap, coalesce(sum(volume) FILTER (close > run), 0) / nullif(sum(volume), 0) AS va FROM b GROUP BY ALL)
  SELECT date::VARCHAR AS date, ticker, {r('(c - vf) / vf AS close_to_vwap', '(pm - vm) / vm AS open_pm_to_vwap_am', '(vf - vm) / vm AS vwap_trend', '(c - pm) / vf AS close_drive', 'va AS vol_above_vwap_pct')}, last_hour_above_vwap FROM g""")
def g4_vwap_features(spark, sf):
    v = B.vwap_features(V.hourly(spark, sf), KEYS, "ts", "hour")
    return shown(v, *v.columns)


@query("v_hourly", f"""WITH a AS (SELECT *, row_number() OVER (PARTITION BY date, ticker ORDER BY ts) AS rn, (high + low + close) / 3 AS tp FROM v_hourly WHERE hour <= 14),
  g AS (SELECT date, ticker, arg_min(open, ts) AS o, max(high) AS h, min(low) AS l, arg_max(close, ts) AS price, sum(volume) AS day_volume, sum(volume * tp) / nullif(sum(volume), 0) AS vwap, max(high) FILTER (hour < 12) AS ah, min(low) FILTER (hour < 12) AS al,
    coalesce(sum(volume) FILTER (hour < 12), 0) AS av, coalesce(sum(volume) FILTER (hour >= 12), 0) AS pv, max(high) FILTER (rn <= 2) AS oh, count(*) FILTER (hour >= 12) AS pb FROM a GROUP BY ALL HAVING max((hour = 14)::INT) = 1)
  SELECT date::VARCHAR AS date, ticker, {r('(ah - al) / nullif(o, 0) AS am_range_pct', 'price / nullif(o, 0) - 1 AS ret_from_open', 'CASE WHEN h <> l THEN least(greatest((price - l) / (h - l), 0), 1) END AS place_in_day', 'price / nullif(vwap, 0) - 1 AS to_vwap', 'pv / nullif(av, 0) AS pm_to_am_volume', 'price / nullif(oh, 0) - 1 AS over_opening_high', 'pv / nullif(pb, 0) AS pm_volume_rate',
    f"price / nullif({stat('avg', 'price', 5, 3)}, 0) AS price_to_ma_5", f"day_volume / nullif({stat('avg', 'day_volume', 20, 10)}, 0) AS day_volume_to_ma_20")} FROM g""")
def g5_preclose_features(spark, sf):
    p = B.preclose_features(V.hourly(spark, sf), KEYS, "ts", "hour")
    return shown(p, *KEYS, "am_range_pct", "ret_from_open", "place_in_day", "to_vwap", "pm_to_am_volume", "over_opening_high", "pm_volume_rate", "price_to_ma_5", "day_volume_to_ma_20")


@query("v_hourly", f"""WITH d AS (SELECT date, ticker, lag(c) OVER (PARTITION BY ticker ORDER BY date) AS pc FROM (SELECT date, ticker, avg(close) / 4 AS c FROM v_hourly GROUP BY ALL)),
  a AS (SELECT h.*, pc * (1 + CASE WHEN pc <= 0 THEN NULL WHEN pc <= 200 THEN 0.35 WHEN pc <= 5000 THEN 0.25 WHEN pc > 5000 THEN 0.2 END) AS lim, CASE WHEN pc < 200 THEN 1 WHEN pc < 500 THEN 2 WHEN pc < 2000 THEN 5 WHEN pc < 5000 THEN 10 WHEN pc >= 5000 THEN 25 END AS tick FROM v_hourly h JOIN d USING (date, ticker)),
  b AS (SELECT *, coalesce(high >= lim - tick, false) AS t, coalesce(close >= lim - tick, false) AS c FROM a), f AS (SELECT *, t AND low < lim - tick AS rel, t AND c AND open >= lim - tick AND low >= lim - tick AS flat FROM b),
  g AS (SELECT date, ticker, max(lim) AS limit_price, max(t::INT) AS touched, sum(t::INT)::BIGINT AS touched_bars, sum(coalesce(rel, false)::INT)::BIGINT AS released, sum(c::INT)::BIGINT AS closed_at, sum(coalesce(flat, false)::INT)::BIGINT AS locked_bars, max(CASE WHEN rel THEN (lim - low) / lim ELSE 0 END) AS depth_max, (min(hour) FILTER (t))::DOUBLE AS touch_hour, arg_max(c::INT, ts) AS last_closed_at FROM f GROUP BY ALL)
  SELECT date::VARCHAR AS date, ticker, {r('limit_price', 'depth_max', 'released / nullif(touched_bars, 0) AS release_ratio', n=5)}, touched, touched_bars, released, closed_at, locked_bars, touch_hour, last_closed_at, (touched > 0 AND released <= 0 AND last_closed_at > 0)::INT AS locked_proxy FROM g""")
def g6_limit_state(spark, sf):
    h = V.hourly(spark, sf)
    prev = h.groupBy(*KEYS).agg((F.avg("close") / 4).alias("c")).withColumn("pc", F.lag("c").over(W.by(["ticker"]))).drop("c")
    s = B.limit_state(h.join(prev, KEYS), KEYS, "ts", "hour", "pc").withColumn("touch_hour", F.col("touch_hour").cast("double"))
    return shown(s, *KEYS, "limit_price", "depth_max", "release_ratio", "touched", "touched_bars", "released", "closed_at", "locked_bars", "touch_hour", "last_closed_at", "locked_proxy", digits=5)


@query("v_hourly", f"""WITH a AS (SELECT *, volume * (close - low) / (high - low + 1e-6) AS x FROM v_hourly), g AS (SELECT date, ticker, coalesce(sum(x) FILTER (hour < 12), 0) AS a, coalesce(sum(x) FILTER (hour >= 12), 0) AS p, sum(volume) AS v FROM a GROUP BY ALL)
  SELECT date::VARCHAR AS date, ticker, {r('a AS am_intensity', 'p AS pm_intensity', 'CASE WHEN a <> 0 THEN p / a END AS pm_to_am', '(a + p) / nullif(v, 0) AS intensity_share', n=5)} FROM g""")
def g7_session_intensity(spark, sf):
    s = B.session_intensity(V.hourly(spark, sf), KEYS, "hour")
    return shown(s, *s.columns, digits=5)


@query("v_hourly", f"""WITH g AS (SELECT date, ticker, arg_max(close, ts) FILTER (hour = 15) AS e, arg_max(close, ts) FILTER (hour = 14) AS b, arg_min(open, ts) FILTER (hour = 9) AS o, max(high) AS h, min(low) AS l FROM v_hourly GROUP BY ALL)
  SELECT date::VARCHAR AS date, ticker, {r('e AS entry_price', 'e / nullif(b, 0) - 1 AS mom_last_hour', 'e / nullif(o, 0) - 1 AS mom_day', '(h - l) / nullif(o, 0) AS range_to_open', n=5)} FROM g WHERE e IS NOT NULL""")
def g8_closing_momentum(spark, sf):
    m = B.closing_momentum(V.hourly(spark, sf), KEYS, "ts", "hour")
    return shown(m, *m.columns, digits=5)


@query("v_panel v_daily", f"""WITH f AS (SELECT date, ticker, round(sum(total_net_buy), 4) AS net FROM v_panel GROUP BY ALL) SELECT f.date::VARCHAR AS date, f.ticker, {r("net / (abs((close - open) / nullif(open, 0)) + 0.001) AS absorption", n=2)} FROM f LEFT JOIN v_daily d USING (date, ticker)""")
def g9_forensic_daily(spark, sf):
    f = V.panel(spark, sf).groupBy(*KEYS).agg(F.round(F.sum("total_net_buy"), 4).alias("net"))
    return shown(B.forensic_daily(f, V.daily(spark, sf), KEYS, "net"), *KEYS, "absorption", digits=2)


@query("v_daily", f"""WITH s AS (SELECT *, 'S' || (substr(ticker, 2)::INT % 4) AS sector, close * volume AS v FROM v_daily) SELECT date::VARCHAR AS date, ticker, sector, {r('v / nullif(sum(v) OVER (PARTITION BY date, sector), 0) AS sector_share')}, count(*) OVER (PARTITION BY date, sector) AS sector_entities FROM s""")
def g10_sector_share(spark, sf):
    d = V.daily(spark, sf).withColumn("v", F.col("close") * F.col("volume"))
    sectors = d.select("ticker").distinct().withColumn("sector", F.concat(F.lit("S"), F.substring("ticker", 2, 9).cast("int") % 4))
    return shown(B.sector_share(d, sectors, "date", "ticker", "v"), *KEYS, "sector", "sector_share", "sector_entities")


@query("v_daily", f"""WITH b AS (SELECT ticker, arg_min(close, date) AS p0, sum(close * volume) AS t, arg_max(close, date) AS p1 FROM v_daily GROUP BY ticker ORDER BY t DESC, ticker LIMIT 10) SELECT count(*) AS n, {r('1000 * avg(p1) / avg(p0) AS estimate', n=4)} FROM b""")
def g11_basket_proxy(spark, sf):
    d = V.daily(spark, sf).groupBy("ticker").agg(F.min_by("close", "date").alias("price_then"), F.sum(F.col("close") * F.col("volume")).alias("turnover"), F.max_by("close", "date").alias("price"))
    return shown(B.basket_proxy(d.select("ticker", "price"), d.select("ticker", "price_then", "turnover"), 1000.0, 10, 10), "n", "estimate", digits=4)


@query("v_index", f"""WITH l AS (SELECT *, ln(close / lag(close) OVER (PARTITION BY symbol ORDER BY date)) AS x FROM v_index), q AS (SELECT quantile_cont(x, 1 / 3) a, quantile_cont(x, 2 / 3) b FROM l)
  SELECT date::VARCHAR AS date, symbol, {r('x AS log_ret')}, CASE WHEN x IS NOT NULL THEN ((x > a)::INT + (x > b)::INT)::DOUBLE END AS regime FROM l, q""")
def g12_quantile_regime(spark, sf):
    first = B.quantile_regime(V.index(spark, sf), "close", ["symbol"], "date", [])
    edges = ranks.quantile_edges(first, "log_ret", 3)[1:-1]
    return shown(B.quantile_regime(V.index(spark, sf), "close", ["symbol"], "date", edges).withColumn("regime", F.col("regime").cast("double")), "date", "symbol", "log_ret", "regime")


@query("v_hourly", f"""WITH b AS (SELECT *, row_number() OVER (PARTITION BY date, ticker ORDER BY ts DESC) AS rn FROM v_hourly WHERE hour = 10), c AS (SELECT * FROM b WHERE rn = 1)
  SELECT date::VARCHAR AS date, ticker, (lag(date) OVER (PARTITION BY ticker ORDER BY date))::VARCHAR AS feature_date, {r('(high - open) / nullif(open, 0) AS high_ret', '(low - open) / nullif(open, 0) AS low_ret', '(close - open) / nullif(open, 0) AS close_ret')},
    ((low - open) / nullif(open, 0) > -0.035 AND (high - open) / nullif(open, 0) >= 0.02)::INT AS label_hit, ((low - open) / nullif(open, 0) <= -0.035)::INT AS label_stop FROM c""")
def i1_label_intraday(spark, sf):
    return shown(L.label_intraday(V.hourly(spark, sf), KEYS, "hour", "ts", 10), *KEYS, "feature_date", "high_ret", "low_ret", "close_ret", "label_hit", "label_stop", days=("date", "feature_date"))


@query("v_daily", f"""WITH n AS (SELECT *, (lead(open) OVER ({TICKER}) - close) / nullif(close, 0) AS x FROM v_daily) SELECT date::VARCHAR AS date, ticker, {r('x AS next_ret', '(high - low) / nullif(close, 0) AS range_share', '(close - low) / nullif(high - low, 0) AS close_place')}, CASE WHEN x IS NOT NULL THEN (x >= 0.02)::INT::DOUBLE END AS label_hit, CASE WHEN x IS NOT NULL THEN (x <= -0.02)::INT::DOUBLE END AS label_stop FROM n""")
def i2_label_next_open(spark, sf):
    out = L.label_next_open(V.daily(spark, sf), ["ticker"], 0.02, -0.02)
    return shown(out.withColumns({c: F.col(c).cast("double") for c in ("label_hit", "label_stop")}), *KEYS, "next_ret", "label_hit", "label_stop", "range_share", "close_place")


@query("v_hourly", f"""WITH d AS (SELECT date, ticker, arg_max(close, ts) FILTER (hour = 15) AS entry_price, arg_min(open, ts) FILTER (hour = 10) AS o FROM v_hourly GROUP BY ALL), x AS (SELECT ticker, date AS exit_date, o AS exit_price, lag(date) OVER (PARTITION BY ticker ORDER BY date) AS prev_exit FROM d WHERE o IS NOT NULL),
  j AS (SELECT d.date, d.ticker, entry_price, exit_price, exit_date, (exit_price - entry_price) / nullif(entry_price, 0) AS rr FROM d JOIN x ON x.ticker = d.ticker AND x.exit_date > d.date AND (x.prev_exit IS NULL OR x.prev_exit <= d.date) WHERE entry_price IS NOT NULL)
  SELECT date::VARCHAR AS date, ticker, exit_date::VARCHAR AS exit_date, {r('rr AS overnight_return')}, (rr > 0.004)::INT AS label_tp, (rr < -0.02)::INT AS label_sl FROM j WHERE NOT (abs(rr) > 0.15 AND date_diff('day', date, exit_date) > 3) AND NOT abs(rr) > 0.5""")
def i3_label_overnight(spark, sf):
    return shown(L.label_overnight(V.hourly(spark, sf), "ts", "hour", 15, 10), *KEYS, "exit_date", "overnight_return", "label_tp", "label_sl", days=("date", "exit_date"))


SPREAD = "CASE WHEN {0} > 0 THEN CASE WHEN {0} < 200 THEN 1 WHEN {0} < 500 THEN 2 WHEN {0} < 2000 THEN 5 WHEN {0} < 5000 THEN 10 ELSE 25 END * CASE WHEN {0} < 200 THEN 2.5 WHEN {0} < 500 THEN 2.0 WHEN {0} < 5000 THEN 1.5 ELSE 1.0 END / {0} ELSE 0 END"


@query("v_daily", f"""WITH x AS (SELECT date, ticker, close AS e, high AS x FROM v_daily), n AS (SELECT *, (x - e) / nullif(e, 0) - 0.003 - {SPREAD.format('e')} - {SPREAD.format('x')} AS net FROM x)
  SELECT date::VARCHAR AS date, ticker, {r('net AS overnight_return')}, (net > 0.01)::INT AS label_tp, (net < -0.01)::INT AS label_sl FROM n""")
def i4_relabel(spark, sf):
    d = V.daily(spark, sf)
    base = d.select(*KEYS, F.col("close").alias("entry_price"), F.col("low").alias("exit_price"), F.lit(0.0).alias("overnight_return"), F.lit(0).alias("label_tp"), F.lit(0).alias("label_sl"))
    return shown(L.relabel(base, d.select(*KEYS, F.col("high").alias("exit_price")), KEYS, 0.01, -0.01, 0.003), *KEYS, "overnight_return", "label_tp", "label_sl")


@query("v_daily", f"""WITH l AS (SELECT date, ticker, lag(date) OVER ({TICKER}) AS feature_date, close FROM v_daily) SELECT l.date::VARCHAR AS date, l.ticker, l.feature_date::VARCHAR AS feature_date, l.close, f.volume, 'default' AS label_name FROM l JOIN v_daily f ON f.date = l.feature_date AND f.ticker = l.ticker""")
def i5_d12_feature_label_join(spark, sf):
    d = V.daily(spark, sf)
    labels = d.select(*KEYS, F.lag("date").over(W.by(["ticker"])).alias("feature_date"), "close")
    return shown(L.feature_label_join(d.select(*KEYS, "volume"), labels), *KEYS, "feature_date", "close", "volume", "label_name", days=("date", "feature_date"))


@query("", "SELECT unnest(['close', 'volume']) AS feature, (SELECT count(*) FROM (SELECT DISTINCT date_trunc('week', o_orderdate), o_custkey % 20 FROM orders)) AS rows")
def i6_select_features(spark, sf):
    d = V.daily(spark, sf).select(*KEYS, "close", F.col("close").alias("same"), F.lit(3.0).alias("constant"), F.lit(None).cast("double").alias("empty"), "volume", "high")
    kept = L.select_features(d, KEYS, blocked=["high"])
    return d.groupBy().agg(F.count("*").alias("rows")).select(F.explode(F.array(*map(F.lit, kept))).alias("feature"), "rows")


@query("v_daily", f"""WITH m AS (SELECT *, quantile_cont(close * volume, 0.5) {upto(20)} AS mt, close / nullif(lag(close) OVER ({TICKER}), 0) - 1 AS dr FROM v_daily) SELECT date::VARCHAR AS date, ticker FROM m WHERE close >= 50 AND mt >= 100000 AND NOT coalesce(dr >= 0.2, false)""")
def i8_universe_filter(spark, sf):
    return L.universe_filter(V.daily(spark, sf), least_turnover=100000).select(day().alias("date"), "ticker")


@query("v_daily", """WITH d AS (SELECT date, row_number() OVER (ORDER BY date) AS n, count(*) OVER () AS m FROM (SELECT DISTINCT date FROM v_daily)) SELECT f.f AS fold, CASE WHEN n <= m - (3 - f.f) * 20 THEN 'train' ELSE 'valid' END AS role, count(*) AS rows, count(DISTINCT v.date) AS days
  FROM v_daily v JOIN d USING (date), (VALUES (0), (1), (2)) f(f) WHERE n <= m - (3 - f.f) * 20 + 20 GROUP BY ALL""")
def i9_walk_forward(spark, sf):
    d = V.daily(spark, sf)
    days = [x.date for x in d.select("date").distinct().collect()]
    return L.with_fold(d, L.walk_forward(days, 3, 20, 60)).groupBy("fold", "role").agg(F.count("*").alias("rows"), F.count_distinct("date").alias("days"))


@query("v_pred", f"""WITH c AS (SELECT count(*) FILTER (label_hit = 1) AS p, count(*) AS n FROM v_pred) SELECT date::VARCHAR AS date, ticker, {r("CASE WHEN label_hit = 1 THEN (n - p) / p * 2.0 ELSE 1 END AS weight")} FROM v_pred, c""")
def i11_class_weight(spark, sf):
    return shown(L.class_weight(V.predictions(spark, sf), "label_hit", 2.0), *KEYS, "weight")


@query()
def i10_oversample(spark, sf):
    """Positives repeated to a share of two thirds; by a hash, so tested by its properties."""
    out = L.oversample(V.predictions(spark, sf).filter("label_hit is not null"), "label_hit", 2 / 3, KEYS)
    return out.groupBy(day().alias("date"), "ticker", "label_hit").agg(F.count("*").alias("copies"))


@query("v_daily", f"""WITH k AS (SELECT * FROM v_daily WHERE date NOT IN (SELECT date FROM v_daily GROUP BY date HAVING count(*) < 15)) SELECT date::VARCHAR AS date, ticker, close, lag(volume) OVER ({TICKER}) AS volume_lag1 FROM k""")
def i12_coverage_clean(spark, sf):
    d = V.daily(spark, sf).select(*KEYS, "close", "volume")
    return L.coverage_clean(d, KEYS, 15, unsafe=["vol"]).withColumn("date", day())


_ = (X, rd, HOURS)
