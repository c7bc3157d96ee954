"""Views that give the star-schema tables the shapes of market tables, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.functions.exprs import safe_div
from flowmart.operators.bars import first_of, last_of


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def week(c: str) -> Column:
    return F.to_date(F.date_trunc("week", F.col(c).cast("timestamp")))


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """(date, broker, ticker): flows of suppliers in parts, by week."""
    rows = table(spark, sf, "lineitem").select(
        week("l_shipdate").alias("date"), F.concat(F.lit("B"), F.col("l_suppkey") % 25).alias("broker"), F.concat(F.lit("T"), F.col("l_partkey") % 40).alias("ticker"),
        (F.col("l_returnflag") == "R").alias("sell"), (F.col("l_extendedprice") * (1 - F.col("l_discount"))).alias("value"), F.col("l_quantity").alias("volume"),
    )
    part = lambda x, c: F.round(F.coalesce(F.sum(F.when(c, x)), F.lit(0.0)), 4)
    sell, buy = F.col("sell"), ~F.col("sell")
    g = rows.groupBy("date", "broker", "ticker").agg(
        part(F.col("value"), buy).alias("gross_buy"), part(F.col("value"), sell).alias("gross_sell"), part(F.col("volume"), buy).alias("buy_volume"), part(F.col("volume"), sell).alias("sell_volume"),
        F.sum(buy.cast("long")).alias("buy_freq"), F.sum(sell.cast("long")).alias("sell_freq"),
    )
    return g.withColumns({"total_net_buy": F.round(F.col("gross_buy") - F.col("gross_sell"), 4), "avg_buy_price": safe_div("gross_buy", "buy_volume"), "avg_sell_price": safe_div("gross_sell", "sell_volume")})


def daily(spark: SparkSession, sf: str) -> DataFrame:
    """(date, ticker): bars of orders, by week."""
    rows = table(spark, sf, "orders").select(week("o_orderdate").alias("date"), F.concat(F.lit("T"), F.col("o_custkey") % 20).alias("ticker"), "o_orderdate", "o_orderkey", F.col("o_totalprice").alias("p"))
    order = ("o_orderdate", "o_orderkey")
    g = rows.groupBy("date", "ticker").agg(first_of("p", *order).alias("open"), F.max("p").alias("high"), F.min("p").alias("low"), last_of("p", *order).alias("close"), F.count("*").cast("double").alias("volume"))
    return g


def ticks(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select(F.col("event_type").alias("ticker"), F.col("ts").cast("timestamp").alias("ts"), "event_id", F.col("value").alias("price"), F.lit(1.0).alias("volume"), "user_id", "props")


def hourly(spark: SparkSession, sf: str) -> DataFrame:
    """(ticker, ts): bars of events by hour, with date and hour."""
    g = ticks(spark, sf).groupBy("ticker", F.date_trunc("hour", "ts").alias("bar"))
    g = g.agg(first_of("price", "ts", "event_id").alias("open"), F.max("price").alias("high"), F.min("price").alias("low"), last_of("price", "ts", "event_id").alias("close"), F.sum("volume").alias("volume"))
    return g.withColumnRenamed("bar", "ts").withColumns({"date": F.to_date("ts"), "hour": F.hour("ts")})


def index(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "orders")
    return rows.groupBy(F.to_date("o_orderdate").alias("date"), F.col("o_orderpriority").alias("symbol")).agg(F.round(F.avg("o_totalprice"), 4).alias("close"))


def members(spark: SparkSession, sf: str) -> DataFrame:
    """Brokers with the region of the lowest supplier that maps to them."""
    s, n, r = (table(spark, sf, t) for t in ("supplier", "nation", "region"))
    rows = s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey).join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
    rows = rows.select(F.concat(F.lit("B"), F.col("s_suppkey") % 25).alias("broker"), "s_suppkey", F.col("r_name").alias("category"), "s_acctbal")
    return rows.groupBy("broker").agg(F.min_by("category", "s_suppkey").alias("category"), F.round(F.sum("s_acctbal"), 4).alias("balance"))


def predictions(spark: SparkSession, sf: str) -> DataFrame:
    """(date, ticker): a score from arithmetic on the key, a risk, and the return to the next open."""
    from flowmart.operators.labels import label_next_open

    out = label_next_open(daily(spark, sf), ["ticker"], 0.02, -0.02)
    k = F.date_diff("date", F.lit("1990-01-01")) * 31 + F.substring("ticker", 2, 9).cast("int") * 977
    return out.select("date", "ticker", (F.pmod(k, F.lit(1009)) / 1009).alias("pred_proba"), (F.pmod(k * 7, F.lit(101)) / 202).alias("risk_norm"), F.col("close").alias("entry_price"), F.col("next_open").alias("exit_price"),
                      (F.col("next_ret") / 100).alias("ret"), F.col("label_hit"), "volume")


VIEWS = {
    "v_panel": """SELECT *, round(gross_buy - gross_sell, 4) AS total_net_buy, gross_buy / nullif(buy_volume, 0) AS avg_buy_price, gross_sell / nullif(sell_volume, 0) AS avg_sell_price FROM (
        SELECT date_trunc('week', l_shipdate)::DATE AS date, 'B' || (l_suppkey % 25) AS broker, 'T' || (l_partkey % 40) AS ticker,
          round(coalesce(sum(l_extendedprice * (1 - l_discount)) FILTER (l_returnflag <> 'R'), 0), 4) AS gross_buy, round(coalesce(sum(l_extendedprice * (1 - l_discount)) FILTER (l_returnflag = 'R'), 0), 4) AS gross_sell,
          round(coalesce(sum(l_quantity) FILTER (l_returnflag <> 'R'), 0), 4) AS buy_volume, round(coalesce(sum(l_quantity) FILTER (l_returnflag = 'R'), 0), 4) AS sell_volume,
          count(*) FILTER (l_returnflag <> 'R') AS buy_freq, count(*) FILTER (l_returnflag = 'R') AS sell_freq
        FROM lineitem GROUP BY ALL)""",
    "v_daily": """SELECT date_trunc('week', o_orderdate)::DATE AS date, 'T' || (o_custkey % 20) AS ticker, arg_min(o_totalprice, (o_orderdate, o_orderkey)) AS open, max(o_totalprice) AS high, min(o_totalprice) AS low,
          arg_max(o_totalprice, (o_orderdate, o_orderkey)) AS close, count(*)::DOUBLE AS volume FROM orders GROUP BY ALL""",
    "v_ticks": "SELECT event_type AS ticker, ts, event_id, value AS price, 1.0::DOUBLE AS volume, user_id, props FROM events",
    "v_hourly": """SELECT event_type AS ticker, date_trunc('hour', ts) AS ts, arg_min(value, (events.ts, event_id)) AS open, max(value) AS high, min(value) AS low, arg_max(value, (events.ts, event_id)) AS close, count(*)::DOUBLE AS volume,
          date_trunc('hour', events.ts)::DATE AS date, hour(date_trunc('hour', events.ts)) AS hour FROM events GROUP BY event_type, date_trunc('hour', events.ts)""",
    "v_index": "SELECT o_orderdate::DATE AS date, o_orderpriority AS symbol, round(avg(o_totalprice), 4) AS close FROM orders GROUP BY ALL",
    "v_members": """SELECT 'B' || (s_suppkey % 25) AS broker, arg_min(r_name, s_suppkey) AS category, round(sum(s_acctbal), 4) AS balance
          FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey GROUP BY ALL""",
}
#: Built on v_daily, so it comes after it.
VIEWS["v_pred"] = """SELECT date, ticker, (k % 1009) / 1009 AS pred_proba, (k * 7 % 101) / 202 AS risk_norm, close AS entry_price, next_open AS exit_price, (next_open - close) / close / 100 AS ret,
          CASE WHEN next_open IS NOT NULL THEN ((next_open - close) / close >= 0.02)::INT END AS label_hit, volume
        FROM (SELECT *, lead(open) OVER (PARTITION BY ticker ORDER BY date) AS next_open, date_diff('day', DATE '1990-01-01', date) * 31 + substr(ticker, 2)::INT * 977 AS k FROM v_daily)"""


def with_views(names: str, body: str) -> str:
    """SQL with the named views as common table expressions."""
    wanted = names.split()
    if "v_pred" in wanted:
        wanted = ["v_daily", *[v for v in wanted if v != "v_daily"]]
    ctes = ",\n".join(f"{n} AS ({VIEWS[n]})" for n in wanted)
    more = body.strip()
    if not ctes:
        return more
    for start in ("WITH RECURSIVE ", "WITH "):
        if more.startswith(start):
            return f"{start}{ctes},\n{more[len(start):]}"
    return f"WITH {ctes}\n{more}"
