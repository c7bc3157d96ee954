"""Queries of joins, set operations, upserts and checks."""

from pyspark.sql import functions as F

from flowmart.functions import exprs as X
from flowmart.operators import checks
from flowmart.operators import joins as J
from flowmart.operators import modules
from flowmart.plans import views as V
from flowmart.plans.catalog import day, query, r, rd, shown
from flowmart.sources import readers as R
from flowmart.sources import sinks as S


@query("v_panel v_members", "SELECT date::VARCHAR AS date, ticker, broker, category FROM v_panel LEFT JOIN v_members USING (broker)")
def d1_left_join_checked(spark, sf):
    out = J.left_join_checked(V.panel(spark, sf).select("date", "ticker", "broker"), V.members(spark, sf).select("broker", "category"), ["broker"])
    return out.select(day().alias("date"), "ticker", "broker", "category")


@query("v_daily v_index", f"""WITH m AS (SELECT date, avg(close) AS market FROM v_index GROUP BY date), t AS (SELECT date, ticker, high - low AS spread FROM v_daily)
  SELECT date::VARCHAR AS date, ticker, close, {r('market', 'spread', n=3)} FROM v_daily LEFT JOIN t USING (date, ticker) LEFT JOIN m USING (date)""")
def d2_join_modules(spark, sf):
    d = V.daily(spark, sf)
    modules = {"market": V.index(spark, sf).groupBy("date").agg(F.avg("close").alias("market")), "bars": d.select("date", "ticker", (F.col("high") - F.col("low")).alias("spread"))}
    return shown(J.join_modules(d.select("date", "ticker", "close"), modules), "date", "ticker", "close", "market", "spread", digits=3)


@query("v_panel v_daily", f"SELECT p.date::VARCHAR AS date, p.broker, p.ticker, {r('p.total_net_buy / nullif(d.close * d.volume, 0) AS net_to_turnover', 'abs(p.total_net_buy) / nullif(d.close * d.volume, 0) AS abs_to_turnover')}, (d.close IS NOT NULL)::INT AS has_daily FROM v_panel p LEFT JOIN v_daily d USING (date, ticker)")
def d3_market_join(spark, sf):
    d = V.daily(spark, sf).select("date", "ticker", (F.col("close") * F.col("volume")).alias("turnover"))
    p = V.panel(spark, sf).join(d, ["date", "ticker"], "left")
    return shown(p.withColumns({"net_to_turnover": X.safe_div("total_net_buy", "turnover"), "abs_to_turnover": X.safe_div(F.abs("total_net_buy"), "turnover"), "has_daily": X.flag(F.col("turnover").isNotNull())}), "date", "broker", "ticker", "net_to_turnover", "abs_to_turnover", "has_daily")


@query("v_index", """SELECT date::VARCHAR AS date, max(close) FILTER (symbol = '1-URGENT') AS "s_1-URGENT", max(close) FILTER (symbol = '5-LOW') AS "s_5-LOW" FROM v_index GROUP BY date""")
def d4_outer_by_symbol(spark, sf):
    return J.outer_by_symbol(V.index(spark, sf), "date", "symbol", "close", ["1-URGENT", "5-LOW"], "s_").withColumn("date", day())


@query("", "SELECT event_id, b AS band FROM events LEFT JOIN (VALUES (0, 100, 'a'), (100, 250, 'b'), (250, 400, 'c')) t(lo, hi, b) ON value >= lo AND value < hi")
def d5_band_join(spark, sf):
    bands = spark.createDataFrame([(0.0, 100.0, "a"), (100.0, 250.0, "b"), (250.0, 400.0, "c")], "lo double, hi double, band string")
    return J.band_join(V.table(spark, sf, "events").select("event_id", "value"), bands, "value").select("event_id", "band")


ASOF = """SELECT p.date::VARCHAR AS date, p.broker, p.ticker, d.close, d.date::VARCHAR AS date_found FROM v_panel p ASOF LEFT JOIN v_daily d ON p.ticker = d.ticker AND p.date {} d.date"""


@query("v_panel v_daily", ASOF.format(">="))
def d6_asof_join(spark, sf):
    out = J.asof_join(V.panel(spark, sf).select("date", "broker", "ticker"), V.daily(spark, sf), ["ticker"], "date", ["close"])
    return out.select(day().alias("date"), "broker", "ticker", "close", day("date_found").alias("date_found"))


@query("v_panel v_daily", "SELECT date, broker, ticker, CASE WHEN date_diff('day', date_found::DATE, date::DATE) <= 10 THEN close END AS close FROM (" + ASOF.format(">") + ")")
def d6_asof_join_strict(spark, sf):
    out = J.asof_join(V.panel(spark, sf).select("date", "broker", "ticker"), V.daily(spark, sf), ["ticker"], "date", ["close"], strict=True, max_age_days=10)
    return out.select(day().alias("date"), "broker", "ticker", "close")


@query("v_daily", "SELECT date::VARCHAR AS date, (lead(date) OVER (ORDER BY date))::VARCHAR AS next_date, row_number() OVER (ORDER BY date) AS n FROM (SELECT DISTINCT date FROM v_daily)")
def d7_next_session(spark, sf):
    d = V.daily(spark, sf)
    return J.next_session(d).join(R.calendar(d), "date").select(day().alias("date"), day("next_date").alias("next_date"), F.col("n").cast("long").alias("n"))


@query("v_panel v_daily", "SELECT date::VARCHAR AS date, broker, ticker FROM v_panel WHERE ticker IN (SELECT ticker FROM v_daily WHERE close > 100000)")
def d8_semi_filter(spark, sf):
    keys = V.daily(spark, sf).filter("close > 100000").select("ticker")
    return J.semi_filter(V.panel(spark, sf), keys).select(day().alias("date"), "broker", "ticker")


FILL = """SELECT date, ticker, close, 'primary' AS src FROM v_daily WHERE ticker NOT IN ('T1', 'T2') UNION ALL SELECT date, ticker, sum(gross_buy), 'fallback' FROM v_panel WHERE ticker IN ('T1', 'T3', 'T30') AND (date, ticker) NOT IN (SELECT (date, ticker) FROM v_daily WHERE ticker NOT IN ('T1', 'T2')) GROUP BY ALL"""


@query("v_daily v_panel", f"SELECT date::VARCHAR AS date, ticker, {r('close', n=3)}, src FROM ({FILL})")
def d9_fill_missing(spark, sf):
    primary = V.daily(spark, sf).filter("ticker not in ('T1', 'T2')").select("date", "ticker", "close", F.lit("primary").alias("src"))
    fallback = V.panel(spark, sf).groupBy("date", "ticker").agg(F.sum("gross_buy").alias("close")).withColumn("src", F.lit("fallback"))
    wanted = spark.createDataFrame([("T1",), ("T3",), ("T30",)], "ticker string")
    return shown(J.fill_missing(primary, fallback, ["date", "ticker"], wanted), "date", "ticker", "close", "src", digits=3)


@query("", "SELECT o_orderkey, CASE WHEN year(o_orderdate) <= 1998 THEN 'old' ELSE 'new' END AS src FROM orders")
def d10_insert_new(spark, sf):
    """Orders up to 1998 are there, those from 1997 on come; two years are in both."""
    o, year = V.table(spark, sf, "orders"), F.year("o_orderdate")
    part = lambda c, src: o.filter(c).select("o_orderkey", F.lit(src).alias("src"))
    return J.insert_new(part(year >= 1997, "new"), part(year <= 1998, "old"), ["o_orderkey"])


@query("v_panel", "SELECT d.date::VARCHAR AS date, b.broker FROM (SELECT DISTINCT date FROM v_panel) d, (SELECT DISTINCT broker FROM v_panel) b WHERE (d.date, b.broker) NOT IN (SELECT (date, broker) FROM v_panel WHERE ticker <> 'T1')")
def d11_missing_keys(spark, sf):
    p = V.panel(spark, sf)
    return J.missing_keys(p.select("date"), p.select("broker"), p.filter("ticker != 'T1'")).select(day().alias("date"), "broker")


@query("v_members", """SELECT broker, broker NOT IN ('B3', 'B4') AS is_active, CASE WHEN category = 'ASIA' AND broker NOT IN ('B3', 'B4') THEN '2024-02-01' WHEN category = 'ASIA' THEN NULL ELSE '2020-01-01' END AS first_seen,
  CASE WHEN broker IN ('B3', 'B4') THEN '2023-01-01' ELSE '2024-02-01' END AS last_seen, CASE WHEN category = 'ASIA' THEN 'new' WHEN broker IN ('B3', 'B4') THEN CASE WHEN category = 'EUROPE' THEN 'same' ELSE 'deactivated' END WHEN category = 'EUROPE' THEN 'reactivated' ELSE 'same' END AS transition
  FROM v_members WHERE NOT (category = 'ASIA' AND broker IN ('B3', 'B4'))""")
def d13_scd_merge(spark, sf):
    m = V.members(spark, sf)
    at = lambda s: F.lit(s).cast("timestamp")
    existing = m.filter("category != 'ASIA'").select("broker", (F.col("category") != "EUROPE").alias("is_active"), at("2020-01-01").alias("first_seen"), at("2023-01-01").alias("last_seen"), at("2022-01-01").alias("last_change"))
    out = J.scd_merge(existing, m.filter("broker not in ('B3', 'B4')"), "broker", at("2024-02-01"))
    return out.select("broker", "is_active", day("first_seen").alias("first_seen"), day("last_seen").alias("last_seen"), "transition")


@query("v_members", "WITH m AS (SELECT category, broker IN ('B3', 'B4') AS gone FROM v_members WHERE NOT (category = 'ASIA' AND broker IN ('B3', 'B4'))) SELECT count(*) FILTER (category = 'ASIA') AS new, count(*) FILTER (gone AND category NOT IN ('ASIA', 'EUROPE')) AS deactivated, "
       "count(*) FILTER (NOT gone AND category = 'EUROPE') AS reactivated, count(*) FILTER (category <> 'ASIA' AND gone = (category = 'EUROPE')) AS same, count(*) FILTER (NOT gone) AS active, count(*) AS members FROM m")  # fmt: skip
def d13_scd_counts(spark, sf):
    m = V.members(spark, sf)
    at = lambda s: F.lit(s).cast("timestamp")
    existing = m.filter("category != 'ASIA'").select("broker", (F.col("category") != "EUROPE").alias("is_active"), at("2020-01-01").alias("first_seen"), at("2023-01-01").alias("last_seen"), at("2022-01-01").alias("last_change"))
    return J.scd_counts(J.scd_merge(existing, m.filter("broker not in ('B3', 'B4')"), "broker", at("2024-02-01")))


@query("", "SELECT o_custkey, o_orderkey, o_totalprice FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders) WHERE rn = 1")
def k1_dedup_keep(spark, sf):
    return J.dedup_keep(V.table(spark, sf, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"]).select("o_custkey", "o_orderkey", "o_totalprice")


@query("v_panel v_daily", "SELECT CASE WHEN d.ticker IS NULL THEN 'left' WHEN p.ticker IS NULL THEN 'right' ELSE 'both' END AS side, coalesce(p.ticker, d.ticker) AS ticker FROM (SELECT DISTINCT ticker FROM v_panel) p FULL JOIN (SELECT DISTINCT ticker FROM v_daily WHERE ticker <> 'T5') d USING (ticker)")
def k3_key_sets(spark, sf):
    return J.key_sets(V.panel(spark, sf), V.daily(spark, sf).filter("ticker != 'T5'"), ["ticker"]).select("side", "ticker")


@query("v_daily", "SELECT date::VARCHAR AS date, ticker, close, NULL::VARCHAR AS note FROM v_daily WHERE year(date) <> 1997 UNION ALL SELECT date::VARCHAR, ticker, close * 2, 'again' FROM v_daily WHERE year(date) = 1997 AND ticker < 'T3'")
def h2_h4_replace_dates(spark, sf):
    d = V.daily(spark, sf).select("date", "ticker", "close")
    new = d.filter("year(date) = 1997 and ticker < 'T3'").withColumns({"close": F.col("close") * 2, "note": F.lit("again")})
    return S.replaced(d.filter(F.year("date") != 1997).unionByName(d.filter(F.year("date") == 1997).join(new.select("date").distinct(), "date")), new).withColumn("date", day())


@query("v_daily", """SELECT date::VARCHAR AS date, ticker, CASE WHEN ticker IN ('T1', 'T2') THEN -close ELSE close END AS close, CASE WHEN ticker = 'T2' THEN '2024-02-01' ELSE '2024-01-01' END AS inserted, CASE WHEN ticker IN ('T1', 'T2') THEN '2024-02-01' ELSE '2024-01-01' END AS updated FROM v_daily""")
def h3_upsert(spark, sf):
    d, at = V.daily(spark, sf).select("date", "ticker", "close"), lambda s: F.lit(s).cast("timestamp")
    existing = d.filter("ticker != 'T2'").withColumns({"_inserted_at": at("2024-01-01"), "_updated_at": at("2024-01-01")})
    new = d.filter("ticker in ('T1', 'T2')").select("date", "ticker", F.explode(F.array(F.struct(F.col("close").alias("close"), F.lit(1).alias("scraped")), F.struct((-F.col("close")).alias("close"), F.lit(2).alias("scraped")))).alias("x")).select("date", "ticker", "x.*")
    out = S.upsert(existing, new, ["date", "ticker"], at("2024-02-01"), "scraped")
    return out.select(day().alias("date"), "ticker", "close", day("_inserted_at").alias("inserted"), day("_updated_at").alias("updated"))


@query("v_daily v_index", """WITH t AS (SELECT max(date) AS d FROM v_daily), m AS (SELECT date, max(close) AS market FROM v_index GROUP BY date) SELECT v.date::VARCHAR AS date, ticker, CASE WHEN ticker < 'T5' THEN close + 1 ELSE close END AS close, market FROM v_daily v JOIN t ON v.date = t.d LEFT JOIN m ON m.date = v.date""")
def h5_seed_and_fill(spark, sf):
    d = V.daily(spark, sf).select("date", "ticker", "close")
    last = F.lit(d.agg(F.max("date")).first()[0])
    market = V.index(spark, sf).groupBy("date").agg(F.max("close").alias("market"))
    out = S.seed_and_fill(d, [d.filter("ticker < 'T5'").withColumn("close", F.col("close") + 1), market], last)
    return out.select(day().alias("date"), "ticker", "close", "market")


@query("v_daily", "SELECT date::VARCHAR AS date, ticker FROM v_daily WHERE date_diff('day', date, (SELECT max(date) FROM v_daily)) <= 365")
def h7_prune(spark, sf):
    d = V.daily(spark, sf)
    return S.prune(d, "date", d.agg(F.max("date")).first()[0], 365).select(day().alias("date"), "ticker")


@query("v_panel", f"""SELECT 'avg_buy_price' AS "column", sum((avg_buy_price IS NULL)::INT)::BIGINT AS nulls, 0::BIGINT AS infinite, {r('avg((avg_buy_price IS NULL)::INT) AS null_share')} FROM v_panel UNION ALL SELECT 'avg_sell_price', sum((avg_sell_price IS NULL)::INT)::BIGINT, 0, {r('avg((avg_sell_price IS NULL)::INT) AS null_share')} FROM v_panel""")
def n2_null_profile(spark, sf):
    return shown(checks.null_profile(V.panel(spark, sf), ["avg_buy_price", "avg_sell_price"]), "column", "nulls", "infinite", "null_share")


@query("v_panel", """SELECT 'net' AS "check", count(*) AS rows, 0::BIGINT AS mismatches FROM v_panel UNION ALL SELECT 'price', count(*), sum((gross_buy <> buy_volume)::INT)::BIGINT FROM v_panel""")
def n3_formula_checks(spark, sf):
    p = V.panel(spark, sf)
    return checks.formula_checks(p, {"net": (F.col("total_net_buy"), F.col("gross_buy") - F.col("gross_sell")), "price": (F.col("gross_buy"), F.col("buy_volume"))}, tol=1e-3)


@query("v_daily", """SELECT 'close' AS "column", sum((ticker NOT IN ('T1', 'T9'))::INT)::BIGINT AS compared, sum((ticker = 'T1')::INT)::BIGINT AS only_left, sum((ticker = 'T9')::INT)::BIGINT AS only_right, sum((ticker = 'T2')::INT)::BIGINT AS different FROM v_daily
  UNION ALL SELECT 'volume', sum((ticker NOT IN ('T1', 'T9'))::INT)::BIGINT, sum((ticker = 'T1')::INT)::BIGINT, sum((ticker = 'T9')::INT)::BIGINT, 0 FROM v_daily""")
def n4_compare_tables(spark, sf):
    d = V.daily(spark, sf).select("date", "ticker", "close", "volume")
    other = d.filter("ticker != 'T1'").withColumn("close", F.when(F.col("ticker") == "T2", F.col("close") + 5).otherwise(F.col("close")))
    return checks.compare_tables(d.filter("ticker != 'T9'"), other, ["date", "ticker"])


@query("v_panel", "WITH d AS (SELECT date, count(*) AS rows, count(DISTINCT broker) AS members FROM v_panel GROUP BY date) SELECT date::VARCHAR AS latest, rows, members, (SELECT count(*) FROM d) AS days, 'STALE' AS state FROM d ORDER BY d.date DESC LIMIT 1")
def n6_freshness(spark, sf):
    return checks.freshness(V.panel(spark, sf), "date", "broker", F.lit("2030-01-01").cast("date"), 3000, 10).withColumn("latest", day("latest"))


@query("v_ticks", "WITH h AS (SELECT ts::DATE AS d, hour(ts)::INT AS hour, count(DISTINCT ticker) AS entities FROM v_ticks GROUP BY ALL) SELECT d::VARCHAR AS latest, hour, entities, hour >= 14 AS ready FROM h WHERE d = (SELECT max(d) FROM h) AND entities >= 3 ORDER BY hour DESC LIMIT 1")
def n6_latest_hour(spark, sf):
    return checks.latest_hour(V.ticks(spark, sf), "ts", "ticker", 14, 3).withColumn("latest", day("latest"))


@query("v_panel", f"SELECT date::VARCHAR AS date, brkm_broker, ticker, {r('gross_buy AS flow_gross_buy', 'gross_sell AS flow_gross_sell', 'avg_buy_price AS pc_avg_buy_price', n=3)}, buy_freq AS act_buy_freq FROM (SELECT *, broker AS brkm_broker FROM v_panel)")
def b8_column_families(spark, sf):
    p = R.column_families(V.panel(spark, sf), {"flow_": ["gross_buy", "gross_sell", "no_such"], "pc_": ["avg_buy_price"], "act_": ["buy_freq"], "brkm_": ["broker"]})
    return shown(p, "date", "brkm_broker", "ticker", "flow_gross_buy", "flow_gross_sell", "pc_avg_buy_price", "act_buy_freq", digits=3)


@query("", """WITH c AS (SELECT date, row_number() OVER (ORDER BY date) AS n FROM (SELECT DISTINCT o_orderdate::DATE AS date FROM orders)),
  w AS (SELECT unnest(generate_series((SELECT min(date) FROM c), (SELECT max(date) FROM c), INTERVAL 1 DAY))::DATE AS date)
  SELECT w.date::VARCHAR AS date, n FROM w LEFT JOIN c USING (date) WHERE isodow(w.date) < 6""")
def g13_calendar(spark, sf):
    """Weekdays from the first to the last day with orders, numbered where the calendar has them."""
    d = R.calendar(V.table(spark, sf, "orders").select(F.to_date("o_orderdate").alias("date")))
    first, last = d.agg(F.min("date"), F.max("date")).first()
    return R.weekdays(spark, first, last).join(d, "date", "left").select(day().alias("date"), "n")


@query("v_daily v_hourly", """SELECT 'daily' AS source, date::VARCHAR AS date, ticker, close, NULL::INT AS hour FROM v_daily UNION ALL SELECT 'hourly', date::VARCHAR, ticker, close, hour::INT FROM v_hourly""")
def k2_concat(spark, sf):
    d = V.daily(spark, sf).select(F.lit("daily").alias("source"), "date", "ticker", "close")
    h = V.hourly(spark, sf).select("hour", "close", "date", "ticker", F.lit("hourly").alias("source"))
    return J.concat([d, h]).select("source", day().alias("date"), "ticker", "close", "hour")


@query("v_daily v_index", f"""WITH m AS (SELECT date, max(close) - min(close) AS index_range FROM v_index GROUP BY date), t AS (SELECT date, ticker, (high - low) / nullif(close, 0) AS bar_range FROM v_daily)
  SELECT date::VARCHAR AS date, ticker, {r('index_range', 'bar_range', n=4)} FROM v_daily LEFT JOIN t USING (date, ticker) LEFT JOIN m USING (date)""")
def m4_feature_modules(spark, sf):
    """Two modules of different grain, each checked and joined to the core rows."""
    sources = {"daily": V.daily(spark, sf), "index": V.index(spark, sf)}
    made = [
        modules.Module("index_range", "market", lambda s: s["index"].groupBy("date").agg((F.max("close") - F.min("close")).alias("index_range"))),
        modules.Module("bar_range", "ticker", lambda s: s["daily"].select("date", "ticker", X.safe_div(F.col("high") - F.col("low"), "close").alias("bar_range"))),
    ]
    out = J.join_modules(sources["daily"].select("date", "ticker"), {m.name: m.run(sources) for m in made})
    return shown(out, "date", "ticker", "index_range", "bar_range", digits=4)


_ = rd
