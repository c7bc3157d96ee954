"""Queries of scoring, selection and performance."""

from pyspark.sql import functions as F

from flowmart.functions import exprs as X
from flowmart.operators import labels as L
from flowmart.operators import policy as P
from flowmart.plans import views as V
from flowmart.plans.catalog import day, query, r, rd, shown

SPREAD = "CASE WHEN {0} > 0 THEN CASE WHEN {0} < 200 THEN 1 WHEN {0} < 500 THEN 2 WHEN {0} < 2000 THEN 5 WHEN {0} < 5000 THEN 10 ELSE 25 END * CASE WHEN {0} < 200 THEN 2.5 WHEN {0} < 500 THEN 2.0 WHEN {0} < 5000 THEN 1.5 ELSE 1.0 END / {0} ELSE 0 END"
GRID = [("t", "threshold", 0.3, 0.5, 3, 0.5, 0.001), ("r", "rank", 0.2, 0.3, 5, 0.3, 0.001), ("p", "pure", 0.0, 0.0, 1, 1.0, 0.001)]
#: Each of three scores is at most 0.5, so one round of capping settles the weights of the first policy.
GRID_SQL = "(VALUES " + ", ".join(str(g) for g in GRID) + ") g(policy, mode, floor, quantile, k, cap, fee)"


def grid(spark):
    return spark.createDataFrame(GRID, "policy string, mode string, floor double, quantile double, k int, cap double, fee double")


def candidates(spark, sf):
    return V.predictions(spark, sf).filter("ret is not null")


def trades(spark, sf):
    pred = candidates(spark, sf)
    return P.apply_policy(pred, grid(spark), pred.select("date"), [F.col("entry_price") > 50])


def trades_sql(body):
    """The daily and trade tables in SQL; the rounds of capping are written out one after another."""
    caps = ", ".join(f"'{g[0]}'" for g in GRID)
    per = " UNION ALL ".join(f"SELECT '{g[0]}' AS policy, date, greatest({g[2]}, quantile_cont(pred_proba, {g[3]})) AS threshold FROM v_pred WHERE ret IS NOT NULL AND entry_price > 50 GROUP BY date" for g in GRID)
    rounds = "\n".join(
        f""", w{i} AS (SELECT policy, date, ticker, rank, cap, ret, net_ret, CASE WHEN ex > 0 THEN CASE WHEN w > cap THEN cap ELSE w * (1 + CASE WHEN below > 0 THEN ex / below ELSE 0 END) END ELSE w END AS w
        FROM (SELECT *, sum(greatest(w - cap, 0)) OVER (PARTITION BY policy, date) AS ex, sum(CASE WHEN w <= cap THEN w ELSE 0 END) OVER (PARTITION BY policy, date) AS below FROM w{i - 1}))"""
        for i in range(1, 11)
    )
    return f"""WITH g AS (SELECT * FROM {GRID_SQL}), t AS ({per}),
  c AS (SELECT v.*, g.*, threshold, CASE mode WHEN 'threshold' THEN greatest(pred_proba - threshold, 0) * (1 - risk_norm) WHEN 'rank' THEN pred_proba * (1 - risk_norm) ELSE pred_proba END AS score FROM v_pred v, g JOIN t USING (policy) WHERE t.date = v.date AND ret IS NOT NULL AND entry_price > 50 AND (pred_proba >= threshold OR mode = 'pure') AND policy IN ({caps})),
  b AS (SELECT *, row_number() OVER (PARTITION BY policy, date ORDER BY score DESC, ticker) AS rank FROM c WHERE score > 0),
  w0 AS (SELECT policy, date, ticker, rank, cap, ret, ret - fee - {SPREAD.format('entry_price')} - {SPREAD.format('exit_price')} AS net_ret, score / sum(score) OVER (PARTITION BY policy, date) AS w FROM b WHERE rank <= k)
  {rounds}, trades AS (SELECT policy, date, ticker, rank, ret, net_ret, least(w, cap) AS weight FROM w10),
  days AS (SELECT DISTINCT date FROM v_pred WHERE ret IS NOT NULL), s AS (SELECT policy, date, count(*) AS positions, sum(weight * ret) AS gross_return, sum(weight * net_ret) AS net_return FROM trades GROUP BY ALL),
  daily AS (SELECT g.policy, days.date, coalesce(positions, 0) AS positions, coalesce(gross_return, 0) AS gross_return, coalesce(net_return, 0) AS net_return FROM g CROSS JOIN days LEFT JOIN s ON s.policy = g.policy AND s.date = days.date),
  curve AS (SELECT *, exp(sum(ln(1 + net_return)) OVER (PARTITION BY policy ORDER BY date)) AS capital_end FROM daily), dd AS (SELECT *, capital_end / max(capital_end) OVER (PARTITION BY policy ORDER BY date) - 1 AS drawdown FROM curve)
  {body}"""


@query("v_pred", trades_sql(f"SELECT policy, date::VARCHAR AS date, ticker, rank::INT AS rank, {r('weight', 'net_ret')} FROM trades"))
def j7_policy_trades(spark, sf):
    return shown(trades(spark, sf)[0], "policy", "date", "ticker", "rank", "weight", "net_ret")


@query("v_pred", trades_sql(f"SELECT policy, date::VARCHAR AS date, positions, {r('gross_return', 'net_return', 'capital_end', 'drawdown')} FROM dd"))
def j9_equity_curve(spark, sf):
    curve = P.equity_curve(trades(spark, sf)[1], ["policy"])
    return shown(curve, "policy", "date", "positions", "gross_return", "net_return", "capital_end", "drawdown")


PERF = "count(*) AS days, sum((positions > 0)::INT)::BIGINT AS active_days, " + r("avg(net_return) AS mean", "avg((net_return > 0)::INT) AS win_rate", "exp(sum(ln(1 + net_return))) - 1 AS cumulative", "min(drawdown) AS max_drawdown", "stddev_pop(net_return) AS volatility", "avg(net_return) / nullif(stddev_pop(net_return), 0) * sqrt(252) AS sharpe", n=5)


@query("v_pred", trades_sql(f"SELECT policy, {PERF}, {r('exp(sum(ln(1 + net_return))) - 1 + 0.5 * min(drawdown) - 0.1 * (1 - sum((positions > 0)::INT) / count(*)) AS robust', n=5)} FROM dd GROUP BY policy"))
def j10_j12_policy_grid(spark, sf):
    s = P.policy_ranking(P.performance_summary(trades(spark, sf)[1], ["policy"]))
    return shown(s, *s.columns, days=(), digits=5)


@query("v_pred", trades_sql(f""", i AS (SELECT *, row_number() OVER (PARTITION BY policy ORDER BY date) - 1 AS i, count(*) OVER (PARTITION BY policy) AS n FROM daily), k AS (SELECT i.*, w.w AS win FROM i, range(0, 1000) w(w) WHERE w.w * 20 <= i AND i < w.w * 20 + 60 AND w.w * 20 + 60 <= n),
  e AS (SELECT *, exp(sum(ln(1 + net_return)) OVER (PARTITION BY policy, win ORDER BY date)) AS ce FROM k), f AS (SELECT *, ce / max(ce) OVER (PARTITION BY policy, win ORDER BY date) - 1 AS d2 FROM e), h AS (SELECT policy, win, exp(sum(ln(1 + net_return))) - 1 AS cumulative, min(d2) AS md FROM f GROUP BY ALL)
  SELECT policy, count(*) AS windows, {r('avg((cumulative > 0)::INT) AS positive_share', 'quantile_cont(cumulative, 0.5) AS median', 'min(cumulative) AS worst', 'min(md) AS worst_drawdown', n=5)} FROM h GROUP BY policy""").replace("\n  , i AS", ", i AS"))
def j11_rolling_performance(spark, sf):
    w = P.window_report(P.rolling_performance(trades(spark, sf)[1], ["policy"], 60, 20), ["policy"])
    return shown(w, *w.columns, digits=5)


@query("v_pred", trades_sql(f"SELECT g.policy, days.date::VARCHAR AS date, count(x.ticker) AS positions, {r('coalesce(sum(weight * ret), 0) AS gross_return', 'coalesce(sum(weight * net_ret), 0) AS net_return')} FROM g CROSS JOIN days LEFT JOIN (SELECT * FROM trades WHERE ret < 0.002) x ON x.policy = g.policy AND x.date = days.date GROUP BY g.policy, days.date"))
def j13_veto(spark, sf):
    pred = candidates(spark, sf)
    return shown(P.veto(trades(spark, sf)[0], F.col("ret") < 0.002, pred.select("date"), grid(spark)), "policy", "date", "positions", "gross_return", "net_return")


@query("v_pred", f"""WITH d AS (SELECT date, lead(date) OVER (ORDER BY date) AS nx FROM (SELECT DISTINCT date FROM v_pred)), p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY pred_proba DESC, ticker) AS rn FROM v_pred) WHERE rn <= 3)
  SELECT p.date::VARCHAR AS date, p.ticker, nx::VARCHAR AS exit_date, CASE WHEN nx IS NULL THEN 'pending' WHEN x.entry_price IS NULL THEN 'missing' ELSE 'closed' END AS status, {r('(x.entry_price - p.entry_price) / p.entry_price AS gross', '(x.entry_price - p.entry_price) / p.entry_price - 0.004 AS net')}
  FROM p JOIN d USING (date) LEFT JOIN v_pred x ON x.date = d.nx AND x.ticker = p.ticker""")
def j14_settle_picks(spark, sf):
    pred = V.predictions(spark, sf)
    from flowmart.operators.ranks import top_k

    picks = top_k(pred, ["date"], [F.desc("pred_proba"), "ticker"], 3).select("date", "ticker", "entry_price")
    out = L.exits_on_next_session(picks, pred.select("date", "ticker", F.col("entry_price").alias("exit_price")), 0.004)
    return shown(out, "date", "ticker", "exit_date", "status", "gross", "net", days=("date", "exit_date"))


@query("v_pred", f"""WITH d AS (SELECT date, lead(date) OVER (ORDER BY date) AS nx FROM (SELECT DISTINCT date FROM v_pred)), p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY pred_proba DESC, ticker) AS rn FROM v_pred) WHERE rn <= 3 AND month(date) <> 5),
  s AS (SELECT p.date, nx, x.entry_price IS NOT NULL AS closed, (x.entry_price - p.entry_price) / p.entry_price AS gross FROM p JOIN d USING (date) LEFT JOIN v_pred x ON x.date = d.nx AND x.ticker = p.ticker),
  g AS (SELECT date, count(*) AS picks, sum(closed::INT)::BIGINT AS closed, avg(gross) FILTER (closed) AS gross, bool_or(nx IS NULL) AS open FROM s GROUP BY date)
  SELECT date::VARCHAR AS date, CASE WHEN closed > 0 THEN 'closed' WHEN open THEN 'pending' ELSE 'missing' END AS status, coalesce(picks, 0) AS picks, coalesce(closed, 0) AS closed, {r('gross', 'gross - 0.004 AS net')} FROM d LEFT JOIN g USING (date)""")
def j14_settled_by_day(spark, sf):
    """No picks were logged in May."""
    from flowmart.operators.ranks import top_k

    pred = V.predictions(spark, sf)
    picks = top_k(pred.filter(F.month("date") != 5), ["date"], [F.desc("pred_proba"), "ticker"], 3).select("date", "ticker", "entry_price")
    out = L.exits_on_next_session(picks, pred.select("date", "ticker", F.col("entry_price").alias("exit_price")), 0.004)
    return shown(L.settled_by_day(out, pred.select("date")), "date", "status", "picks", "closed", "gross", "net")


@query("v_pred v_daily", f"""SELECT p.date::VARCHAR AS date, p.ticker, {r('d.high / nullif(p.entry_price, 0) - 1 AS spike', 'd.close / nullif(p.entry_price, 0) - 1 AS close_ret', 'd.close / nullif(d.high, 0) - 1 AS fall_from_high')}, {r("CASE WHEN d.low / d.open - 1 <= -0.2 THEN -0.2 WHEN d.high / d.open - 1 >= 0.3 THEN 0.3 ELSE d.close / d.open - 1 END AS fill")} FROM v_pred p JOIN v_daily d USING (date, ticker)""")
def j8_j15_trade_anatomy(spark, sf):
    d = V.daily(spark, sf)
    out = P.trade_anatomy(V.predictions(spark, sf), d, ["date", "ticker"], "entry_price")
    fills = d.select("date", "ticker", X.stop_take_fill(F.col("low") / F.col("open") - 1, F.col("high") / F.col("open") - 1, F.col("close") / F.col("open") - 1, 0.3, -0.2).alias("fill"))
    return shown(out.join(fills, ["date", "ticker"]), "date", "ticker", "spike", "close_ret", "fall_from_high", "fill")


@query("v_pred", f"""WITH p AS (SELECT *, row_number() OVER (PARTITION BY date ORDER BY pred_proba DESC, ticker) AS rank, count(*) OVER (PARTITION BY date) AS n FROM v_pred) SELECT date::VARCHAR AS date, ticker, rank::INT AS rank,
  {r("CASE rank WHEN 1 THEN 0.5 WHEN 2 THEN 0.3 WHEN 3 THEN 0.2 END / CASE WHEN n >= 3 THEN 1.0 WHEN n = 2 THEN 0.8 ELSE 0.5 END AS weight")} FROM p WHERE rank <= 3""")
def j6_rank_weights(spark, sf):
    from pyspark.sql import Window

    p = V.predictions(spark, sf).withColumns({"rank": F.row_number().over(Window.partitionBy("date").orderBy(F.desc("pred_proba"), "ticker")), "n": F.count("*").over(Window.partitionBy("date")).cast("int")})
    return shown(p.filter("rank <= 3").withColumn("weight", P.rank_weights(F.col("rank"), F.col("n"), [0.5, 0.3, 0.2])), "date", "ticker", "rank", "weight")


@query("v_pred", f"""WITH d AS (SELECT date, avg(ret) AS net_return FROM v_pred WHERE ret IS NOT NULL GROUP BY date), f AS (SELECT f, avg(ln(1 + f * net_return)) AS growth FROM d, (VALUES (0.5), (1.0), (2.0), (4.0)) g(f) GROUP BY f) SELECT f::DOUBLE AS fraction, {r('growth', n=7)}, f = (SELECT arg_max(f, growth) FROM f) AS best FROM f""")
def j17_kelly_scan(spark, sf):
    d = candidates(spark, sf).groupBy("date").agg(F.avg("ret").alias("net_return"))
    return shown(P.kelly_scan(d, [0.5, 1.0, 2.0, 4.0]), "fraction", "growth", "best", digits=7)


@query()
def j16_block_bootstrap(spark, sf):
    """Resampled paths of the daily returns: drawn by hash, so tested by their properties."""
    paths = P.block_bootstrap(trades(spark, sf)[1].filter("policy = 'r'"), 500, 5, 60)
    return shown(P.path_report(paths), "paths", "p05", "median", "p95", "p_loss", "p_ruin")


@query()
def j1_j3_walk_forward_model(spark, sf):
    """Boosted trees fitted and scored fold by fold; held against the labels in the tests."""
    d = V.predictions(spark, sf).filter("label_hit is not null")
    days = [x.date for x in d.select("date").distinct().collect()]
    told = P.cross_validate(d, L.walk_forward(days, 2, 40, 60), ["pred_proba", "risk_norm", "entry_price", "volume"], "label_hit")
    return shown(told, "fold", "date", "ticker", "rank_daily", "label_hit")


_ = (day, rd)


@query("v_pred", f"""WITH p AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY date ORDER BY pred_proba DESC, ticker) AS rank FROM v_pred) WHERE rank <= 3)
  SELECT date::VARCHAR AS date, 'base' AS variant, rank::INT AS rank, CASE WHEN rank = 1 THEN ticker || '!' ELSE ticker END AS ticker, CASE WHEN rank = 1 THEN '2024-02-01' ELSE '2024-01-01' END AS logged FROM p""")
def h6_log_picks(spark, sf):
    """A log of picks by (date, variant, rank), written twice: the second time only the first ranks, renamed."""
    from flowmart.operators.ranks import top_k
    from flowmart.sources.sinks import upsert

    at = lambda s: F.lit(s).cast("timestamp")
    picks = top_k(V.predictions(spark, sf), ["date"], [F.desc("pred_proba"), "ticker"], 3).select("date", F.lit("base").alias("variant"), "rank", "ticker")
    first = picks.withColumns({"_inserted_at": at("2024-01-01"), "_updated_at": at("2024-01-01")})
    again = picks.filter("rank = 1").withColumn("ticker", F.concat("ticker", F.lit("!")))
    out = upsert(first, again, ["date", "variant", "rank"], at("2024-02-01"))
    return out.select(day().alias("date"), "variant", "rank", "ticker", day("_updated_at").alias("logged"))


@query("v_daily", f"""WITH d AS (SELECT date, ticker, close AS entry_price, close * volume AS turnover, close / open - 1 AS day_ret FROM v_daily), x AS (SELECT date, avg(day_ret) AS index_ret FROM d GROUP BY date)
  SELECT date::VARCHAR AS date, ticker, entry_price FROM d JOIN x USING (date) WHERE entry_price >= 50 AND {SPREAD.format("entry_price")} <= 0.004 AND turnover >= 100000 AND day_ret < 0.5 AND index_ret >= -0.1""")
def b14_market_filters(spark, sf):
    d = V.daily(spark, sf).select("date", "ticker", F.col("close").alias("entry_price"), (F.col("close") * F.col("volume")).alias("turnover"), (F.col("close") / F.col("open") - 1).alias("day_ret"))
    d = d.join(d.groupBy("date").agg(F.avg("day_ret").alias("index_ret")), "date")
    kept = P.market_filters({"least_price": 50, "most_cost": 0.004, "least_turnover": 1e5, "most_ret": 0.5, "index_floor": -0.1})
    return d.filter(X.all_of(kept)).select(day().alias("date"), "ticker", "entry_price")


@query("v_daily", "SELECT date::VARCHAR AS date, ticker, close::FLOAT::DOUBLE AS close, volume::FLOAT::DOUBLE AS volume FROM v_daily")
def i7_cast_features(spark, sf):
    d = L.cast_features(V.daily(spark, sf), ["close", "volume"])
    return d.select(day().alias("date"), "ticker", *[F.col(c).cast("double").alias(c) for c in ("close", "volume")])
