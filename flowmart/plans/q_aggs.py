"""Queries of aggregations, profiles and metrics."""

from pyspark.sql import functions as F

from flowmart.functions import exprs as X
from flowmart.operators import aggs
from flowmart.operators import windows as W
from flowmart.operators import quantiles
from flowmart.plans import views as V
from flowmart.plans.catalog import day, query, r, shared_folder, shown
from flowmart.plans.q_windows import stat

KEYS = ["date", "ticker"]


@query("v_panel", f"""SELECT date::VARCHAR AS date, ticker, {r('sum(total_net_buy) AS total_net_buy_sum', 'avg(total_net_buy) AS total_net_buy_mean', 'sum(buy_volume) AS buy_volume_sum', 'avg(buy_volume) AS buy_volume_mean', n=3)}, max((gross_sell = 0)::INT) AS buy_only_max FROM v_panel GROUP BY date, ticker""")
def c1_agg_panel(spark, sf):
    p = V.panel(spark, sf).withColumn("buy_only", X.flag(F.col("gross_sell") == 0))
    return shown(aggs.agg_panel(p, KEYS, ["total_net_buy", "buy_volume"], ["buy_only"]), *KEYS, "total_net_buy_sum", "total_net_buy_mean", "buy_volume_sum", "buy_volume_mean", "buy_only_max", digits=3)


@query("v_panel", f"""SELECT date::VARCHAR AS date, ticker, members, buyers, sellers, {r('buyers / members AS buyer_share', 'sellers / members AS seller_share')} FROM (SELECT date, ticker, count(DISTINCT broker) AS members, count(DISTINCT broker) FILTER (total_net_buy > 0) AS buyers, count(DISTINCT broker) FILTER (total_net_buy < 0) AS sellers FROM v_panel GROUP BY ALL)""")
def c2_breadth(spark, sf):
    return shown(aggs.breadth(V.panel(spark, sf), KEYS, "broker", "total_net_buy"), *KEYS, "members", "buyers", "sellers", "buyer_share", "seller_share")


def group_sql(name, members):
    f = f"FILTER (broker IN {members})"
    return f"""{r(f'coalesce(sum(total_net_buy) {f}, 0) AS {name}_sum', f'avg(total_net_buy) {f} AS {name}_mean', f'coalesce(sum(abs(total_net_buy)) {f}, 0) AS {name}_abs', n=3)}, count(DISTINCT broker) {f} AS {name}_members,
      count(*) FILTER (broker IN {members} AND total_net_buy > 0) AS {name}_buyers, count(*) FILTER (broker IN {members} AND total_net_buy < 0) AS {name}_sellers, coalesce(sum(buy_freq + sell_freq) {f}, 0)::BIGINT AS {name}_freq"""


@query("v_panel", f"SELECT date::VARCHAR AS date, ticker, {group_sql('x', ('B1', 'B2', 'B3'))}, {group_sql('y', ('B10', 'B11'))} FROM v_panel GROUP BY date, ticker")
def c3_group_totals(spark, sf):
    p = V.panel(spark, sf).withColumn("freq", F.col("buy_freq") + F.col("sell_freq"))
    g = aggs.group_totals(p, KEYS, "broker", {"x": ["B1", "B2", "B3"], "y": ["B10", "B11"]}, "total_net_buy", "freq")
    return shown(g, *g.columns, digits=3)


@query("v_panel", f"""WITH s AS (SELECT date, ticker, total_net_buy / sum(total_net_buy) OVER (PARTITION BY date, ticker) AS s, row_number() OVER (PARTITION BY date, ticker ORDER BY total_net_buy DESC, broker) AS rn FROM v_panel WHERE total_net_buy > 0)
  SELECT date::VARCHAR AS date, ticker, {r('sum(s * s) AS hhi', 'max(s) AS top1', 'sum(s) FILTER (rn <= 3) AS top3')} FROM s GROUP BY date, ticker""")
def c4_concentration(spark, sf):
    return shown(aggs.concentration(V.panel(spark, sf), KEYS, "broker", "total_net_buy"), *KEYS, "hhi", "top1", "top3")


@query("v_panel", f"""WITH s AS (SELECT *, total_net_buy / nullif(sum(abs(total_net_buy)) OVER (PARTITION BY date, ticker), 0) AS s, avg_buy_price / nullif(avg_sell_price, 0) - 1 AS a FROM v_panel)
  SELECT date::VARCHAR AS date, ticker, {r('sum(s * abs(s)) AS signed_hhi', 'max(abs(s)) AS top_share', 'max(a) AS aggression_max', 'avg(a) AS aggression_mean')} FROM s GROUP BY date, ticker""")
def c5_signed_concentration(spark, sf):
    g = aggs.signed_concentration(V.panel(spark, sf), KEYS, "total_net_buy", "avg_buy_price", "avg_sell_price")
    return shown(g, *g.columns)


@query("v_panel", f"""SELECT date::VARCHAR AS date, ticker, {', '.join(f"floor(coalesce(sum(total_net_buy) FILTER (broker = '{b}'), 0) * 1e3 + 0.4871) / 1e3 AS {b}_total_net_buy, max((broker = '{b}')::INT) AS {b}_present" for b in ('B0', 'B7'))},
  {r("coalesce(sum(total_net_buy) FILTER (broker IN ('B1', 'B4')), 0) AS some", n=3)} FROM v_panel GROUP BY date, ticker""")
def c6_c7_members(spark, sf):
    p = V.panel(spark, sf)
    g = aggs.pivot_members(p, KEYS, "broker", ["B0", "B7"], ["total_net_buy"]).join(aggs.member_sum(p, KEYS, "broker", ["B1", "B4"], "total_net_buy", "some"), KEYS)
    return shown(g, *KEYS, "B0_total_net_buy", "B0_present", "B7_total_net_buy", "B7_present", "some", digits=3)


@query("v_panel", f"""WITH f AS (SELECT date, ticker, coalesce(sum(gross_buy - gross_sell) FILTER (broker IN ('B5', 'B6')), 0) AS net, sum(gross_buy + gross_sell) FILTER (broker IN ('B5', 'B6')) / nullif(sum(gross_buy + gross_sell), 0) AS part FROM v_panel GROUP BY ALL HAVING bool_or(broker IN ('B5', 'B6')))
  SELECT date::VARCHAR AS date, ticker, {r('net AS foreign_net_buy', 'part AS foreign_participation', f"{stat('avg', 'net', 5, 3)} AS foreign_ma_5", f"(net - {stat('avg', 'net', 5, 3)}) / nullif({stat('stddev_samp', 'net', 20, 10)}, 0) AS foreign_z_20", n=3)} FROM f""")
def c8_foreign_flow(spark, sf):
    f = W.foreign_flow(V.panel(spark, sf).withColumn("gross_turnover", F.col("gross_buy") + F.col("gross_sell")), ["b5", "b6"])
    return shown(f, *KEYS, "foreign_net_buy", "foreign_participation", "foreign_ma_5", "foreign_z_20", digits=3)


@query("v_panel", f"""WITH a AS (SELECT *, abs(total_net_buy) AS x FROM v_panel)
  SELECT date::VARCHAR AS date, broker, ticker, {r('x / nullif(sum(x) OVER (PARTITION BY date, broker), 0) AS specificity', 'sum(x) OVER (PARTITION BY date, broker) / nullif(sum(x) OVER (PARTITION BY date), 0) AS member_share', 'sum(x) OVER (PARTITION BY date, ticker) / nullif(sum(x) OVER (PARTITION BY date), 0) AS entity_share')} FROM a""")
def c9_context_shares(spark, sf):
    p = aggs.context_shares(V.panel(spark, sf).withColumn("x", F.abs("total_net_buy")), "date", "broker", "ticker", "x")
    return shown(p, "date", "broker", "ticker", "specificity", "member_share", "entity_share")


SUMMARY = "count(*) AS rows, count(DISTINCT date) AS days, count(DISTINCT ticker) AS entities, " + r("avg((ret > 0)::INT) AS hit_rate", "avg((ret < -0.005)::INT) AS tail_rate", "avg(ret) AS mean", "quantile_cont(ret, 0.5) AS median", "quantile_cont(ret, 0.1) AS p10", "quantile_cont(ret, 0.9) AS p90")


@query("v_pred", f"""WITH b AS (SELECT *, CASE WHEN pred_proba > 0.5 THEN 'hi' ELSE 'lo' END AS bucket FROM v_pred WHERE ret IS NOT NULL) SELECT bucket, {SUMMARY} FROM b GROUP BY bucket UNION ALL SELECT 'all', {SUMMARY} FROM b""")
def c10_group_summary(spark, sf):
    p = V.predictions(spark, sf).filter("ret is not null").withColumn("bucket", F.when(F.col("pred_proba") > 0.5, "hi").otherwise("lo"))
    g = aggs.group_summary(p, ["bucket"], "date", "ticker", "ret", F.col("ret") > 0, F.col("ret") < -0.005)
    return shown(g, *g.columns, days=())


@query("v_panel", "\nUNION ALL\n".join(f"SELECT '{k}' AS key, count(*) AS n, min(c)::DOUBLE AS least, {r('quantile_cont(c, 0.05) AS p05', 'quantile_cont(c, 0.5) AS median', 'quantile_cont(c, 0.95) AS p95')}, max(c)::DOUBLE AS most, (SELECT string_agg(k, ',' ORDER BY c, k) FROM (SELECT {k}::VARCHAR AS k, count(*) AS c FROM v_panel GROUP BY {k} ORDER BY c, k LIMIT 20)) AS lowest FROM (SELECT count(*) AS c FROM v_panel GROUP BY {k})" for k in ("date", "ticker")))
def c11_profile_quantiles(spark, sf):
    p = V.panel(spark, sf)
    out = aggs.profile_quantiles(p, "date").unionByName(aggs.profile_quantiles(p, "ticker"))
    return shown(out, *out.columns, days=())


@query("v_pred", "\nUNION ALL\n".join(f"SELECT '{d}' AS dim, {d}::VARCHAR AS value, count(*) AS n, {r('avg(ret) AS mean_net', 'sum(ret * pred_proba) AS sum_weighted')} FROM p GROUP BY {d}" for d in ("ticker", "tier")).replace("SELECT 'ticker'", "WITH p AS (SELECT *, CASE WHEN entry_price > 100000 THEN 'high' ELSE 'low' END AS tier FROM v_pred WHERE ret IS NOT NULL) SELECT 'ticker'", 1))
def c12_attribution(spark, sf):
    p = V.predictions(spark, sf).filter("ret is not null").withColumns({"tier": F.when(F.col("entry_price") > 100000, "high").otherwise("low"), "weighted": F.col("ret") * F.col("pred_proba")})
    g = aggs.attribution(p, ["ticker", "tier"], "ret", "weighted")
    return shown(g, *g.columns)


@query("v_pred", f"""WITH d AS (SELECT label_hit AS y, pred_proba AS p FROM v_pred WHERE label_hit IS NOT NULL), s AS (SELECT p, sum(y) AS pos, count(*) AS n FROM d GROUP BY p),
  c AS (SELECT *, sum(pos) OVER (ORDER BY p DESC) AS cp, sum(n) OVER (ORDER BY p DESC) AS cn, sum(pos) OVER () AS tp, sum(n) OVER () AS tn FROM s),
  k AS (SELECT sum((n - pos) * (cp - pos + pos / 2)) / max(tp * (tn - tp)) AS auc, sum(pos * cp / cn) / max(tp) AS ap FROM c),
  m AS (SELECT count(*) AS n, avg(y) AS base_rate, avg((p - y) ** 2) AS brier, avg(-CASE WHEN y = 1 THEN ln(greatest(least(p, 1 - 1e-15), 1e-15)) ELSE ln(1 - greatest(least(p, 1 - 1e-15), 1e-15)) END) AS log_loss,
    sum((p >= 0.5 AND y = 1)::INT) / nullif(sum((p >= 0.5)::INT), 0) AS precision, sum((p >= 0.5 AND y = 1)::INT) / nullif(sum(y), 0) AS recall FROM d)
  SELECT n, {r('base_rate', 'brier', 'log_loss', '"precision" AS "precision"', 'recall', 'auc', 'ap AS average_precision', '2 * "precision" * recall / nullif("precision" + recall, 0) AS f1')} FROM m, k""")
def c13_class_metrics(spark, sf):
    m = aggs.class_metrics(V.predictions(spark, sf), "label_hit", "pred_proba")
    return shown(m, "n", "base_rate", "brier", "log_loss", "precision", "recall", "auc", "average_precision", "f1")


@query("", f"""WITH d AS (SELECT l.quality AS y, d.n_chars / 100000 AS p, d.source, d.doc_id FROM labels l JOIN documents d USING (doc_id)), t AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY p DESC, doc_id) AS rn FROM d),
  k AS (SELECT source, {', '.join(f'avg(y) FILTER (rn <= {k}) AS p{k}, max(y) FILTER (rn <= {k}) AS h{k}' for k in (1, 3, 5))} FROM t GROUP BY source) """ + " UNION ALL ".join(f"SELECT {k} AS k, {r(f'avg(p{k}) AS precision', f'avg(h{k}) AS any_hit')} FROM k" for k in (1, 3, 5)))
def c14_topk_metrics(spark, sf):
    docs = V.table(spark, sf, "documents").select("doc_id", "source", (F.col("n_chars") / 100000).alias("p"))
    d = V.table(spark, sf, "labels").select("doc_id", "quality").join(docs, "doc_id")
    return shown(aggs.topk_metrics(d, "source", "quality", "p", "doc_id", [1, 3, 5]), "k", "precision", "any_hit")


@query("", f"""WITH s AS (SELECT DISTINCT o_custkey % 20 AS g, o_orderpriority || (o_orderkey % 50) AS i FROM orders), n AS (SELECT g, count(*) AS n FROM s GROUP BY g), c AS (SELECT x.g AS a, y.g AS b, count(*) AS common FROM s x JOIN s y ON x.i = y.i AND x.g < y.g GROUP BY ALL)
  SELECT a, b, common, {r('common / (p.n + q.n - common) AS jaccard')} FROM c JOIN n p ON p.g = a JOIN n q ON q.g = b""")
def c15_jaccard(spark, sf):
    s = V.table(spark, sf, "orders").select((F.col("o_custkey") % 20).alias("g"), F.concat("o_orderpriority", F.col("o_orderkey") % 50).alias("i"))
    return shown(aggs.jaccard(s, "g", "i"), "a", "b", "common", "jaccard")


@query("", f"""WITH s AS (SELECT o_custkey % 20 AS g, o_orderpriority || (o_orderkey % 50) AS i, max(o_totalprice) AS gain FROM orders GROUP BY ALL), k AS (SELECT *, row_number() OVER (PARTITION BY g ORDER BY gain DESC, i) AS rank FROM s)
  SELECT i, count(*) AS groups, {r('avg(rank) AS mean_rank')}, count(*) = (SELECT count(DISTINCT g) FROM k) AS everywhere FROM k GROUP BY i""")
def c15_mean_rank(spark, sf):
    s = V.table(spark, sf, "orders").select((F.col("o_custkey") % 20).alias("g"), F.concat("o_orderpriority", F.col("o_orderkey") % 50).alias("i"), "o_totalprice")
    return shown(aggs.mean_rank(s, "g", "i", "o_totalprice"), "i", "groups", "mean_rank", "everywhere")


@query("", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count(DISTINCT {c}) AS \"distinct\", {r(f'quantile_cont({c}, 0.5) AS median', n=4)} FROM lineitem" for c in ("l_quantity", "l_extendedprice")))
def c16_profile(spark, sf):
    return shown(aggs.approx_profile(V.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"]), "column", "distinct", "median", digits=4)


@query("", " UNION ALL ".join(f"SELECT '{c}' AS \"column\", count({c}) AS n, 0 AS nulls, min({c}) AS low, max({c}) AS high, true AS distinct_near, true AS median_near FROM lineitem" for c in ("l_quantity", "l_extendedprice")))
def c16_merged_sketches(spark, sf):
    """Sketches of each shipping day, stored, then merged; whether their estimates keep to their error bounds."""
    rows, columns = V.table(spark, sf, "lineitem"), ["l_quantity", "l_extendedprice"]
    path = shared_folder(spark, "sketches")
    quantiles.profile_sketches(rows, F.to_date("l_shipdate"), columns).write.parquet(path)
    merged = quantiles.merged_profile(spark.read.parquet(path), [0.5])
    exact = aggs.approx_profile(rows, columns).select("column", F.col("distinct").alias("exact"))
    ranks = quantiles.shares_below(rows, merged.select("column", F.col("quantiles")[0].alias("point")))
    near = (F.col("n") == 0) | ((F.col("under") <= 0.54) & (F.col("upto") >= 0.46))
    told = merged.join(exact, "column")
    return told.join(ranks, "column").select("column", "n", "nulls", "low", "high", (F.abs(F.col("distinct") - F.col("exact")) <= 0.08 * F.col("exact")).alias("distinct_near"), near.alias("median_near"))
