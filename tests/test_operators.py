"""Operators on small inline tables: edge cases, and those that SQL can't check."""

import datetime
import os
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from flowmart.functions import exprs as X
from flowmart.operators import adx, checks, modules, quantiles, ranks, scans
from flowmart.operators import bars as B
from flowmart.operators import joins as J
from flowmart.operators import labels as L
from flowmart.operators import policy as P
from flowmart.operators import windows as W
from flowmart.sources import readers as R
from flowmart.sources import sinks as S

D = datetime.date


def one(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_expressions_on_nulls_and_edges(spark):
    df = spark.createDataFrame([(1.0, 0.0), (None, 2.0), (3.0, 2.0), (float("nan"), 1.0)], "a double, b double").withColumn("a", X.real("a"))
    assert one(df, X.safe_div("a", "b"), X.clip("a", 0.0, 2.0), X.flag(F.col("a") > 0)) == [(None, 1.0, 1), (None, None, 0), (1.5, 2.0, 1), (None, None, 0)]
    prices = spark.createDataFrame([(p,) for p in (None, -1.0, 0.0, 199.0, 200.0, 500.0, 5000.0, 5001.0)], "p double")
    assert one(prices, X.tick_size("p"), X.limit_pct("p")) == [(None, None), (1, None), (1, None), (1, 0.35), (2, 0.35), (5, 0.25), (25, 0.25), (25, 0.2)]
    assert [r[0] for r in one(prices, X.spread_frac("p"))][:3] == [0.0, 0.0, 0.0]
    assert one(prices.limit(1), X.normalize_symbol(F.lit(" bb-ri.jk")), X.normalize_symbol(F.lit("a.b.JK"), keep_dots=False)) == [("BBRI", "AB")]
    assert one(prices.limit(1), X.normalize_status(F.lit(" sus "))) == [("SUSPENDED",)]


def test_zone_and_fold(spark):
    t = spark.createDataFrame([("BBRI", "2026-05-08 14:00:00", 4000.0, 100.0), ("BBRI", "2026-05-08 14:01:00", 4020.0, 150.0), ("BBRI", "2026-05-08 14:59:00", 4010.0, 200.0), ("BBRI", "2026-05-08 15:00:00", 4050.0, 300.0)], "ticker string, t string, p double, v double")
    t = t.withColumn("ts", F.col("t").cast("timestamp"))
    b = B.resample_ohlcv(t, ["ticker"], F.date_trunc("hour", "ts"), ["ts"], "p", "v").orderBy("bucket").first()
    assert (b.open, b.high, b.low, b.close, b.volume) == (4000, 4020, 4000, 4010, 450)
    utc = t.select(F.to_utc_timestamp("ts", "Asia/Jakarta").cast("string")).first()[0]
    assert utc == "2026-05-08 07:00:00"


def test_fill_missing_is_idempotent_and_keeps_the_primary(spark):
    p = spark.createDataFrame([("BBRI", 1)], "ticker string, v int")
    f = spark.createDataFrame([("BBRI", 9), ("TLKM", 2)], "ticker string, v int")
    u = spark.createDataFrame([("BBRI",), ("TLKM",), ("ASII",)], "ticker string")
    first = J.fill_missing(p, f, ["ticker"], u)
    again = J.fill_missing(first, f, ["ticker"], u)
    assert sorted(map(tuple, first.collect())) == sorted(map(tuple, again.collect())) == [("BBRI", 1), ("TLKM", 2)]


def test_checked_joins_refuse(spark):
    a, b = spark.createDataFrame([(1, 2)], "k int, x int"), spark.createDataFrame([(1, 2), (1, 3)], "k int, y int")
    with pytest.raises(ValueError, match="unique"):
        J.left_join_checked(a, b, ["k"])
    with pytest.raises(ValueError, match="both sides"):
        J.left_join_checked(a, a, ["k"])


def test_next_session_and_settlement(spark):
    days = [D(2026, 4, 30), D(2026, 5, 4), D(2026, 5, 5)]
    px = spark.createDataFrame([(d, t, v) for d, t, v in zip(days, "AAA", (100.0, 110.0, 90.0), strict=True)], "date date, ticker string, exit_price double")
    picks = spark.createDataFrame([(days[0], "A", 100.0), (days[1], "A", 100.0), (days[2], "A", 100.0), (days[0], "B", 100.0)], "date date, ticker string, entry_price double")
    got = {(r.date, r.ticker): (r.status, r.gross, r.net) for r in L.exits_on_next_session(picks, px, 0.004).collect()}
    assert got[days[0], "A"] == ("closed", pytest.approx(0.1), pytest.approx(0.096)) and got[days[1], "A"] == ("closed", pytest.approx(-0.1), pytest.approx(-0.104))
    assert got[days[2], "A"][0] == "pending" and got[days[0], "B"][0] == "missing"


def test_splits():
    days = [D(2020, 1, 1) + datetime.timedelta(days=i) for i in range(200)]
    w = L.rolling_windows(days, 3, 20, 50)
    assert [x["train_end"] for x in w] == [days[-51], days[-71], days[-91]] and [x["oot_start"] for x in w] == [days[-50], days[-70], days[-90]] and [x["oot_end"] for x in w] == [days[-1], days[-21], days[-41]]
    with pytest.raises(ValueError):
        L.rolling_windows(days[:50], 2, 20, 50)
    folds = L.walk_forward(days, 3, 20, 60)
    assert [len(t) for t, _ in folds] == [140, 160, 180] and all(max(t) < min(v) for t, v in folds)
    assert R.warmup_start(D(2026, 5, 4), [1], 5) == D(2026, 4, 27)


def test_capped_weights(spark):
    def brute(s, cap):
        w = np.array(s) / sum(s)
        for _ in range(10):
            over = w > cap
            if not over.any() or over.all():
                w[over] = cap
                break
            excess = (w[over] - cap).sum()
            w[over] = cap
            w[~over] += w[~over] / w[~over].sum() * excess
        return np.minimum(w, cap)

    r = random.Random(3)
    cases = [([r.random() for _ in range(r.randint(1, 8))], r.choice([0.15, 0.25, 0.5, 1.0])) for _ in range(40)] + [([0.0, 0.0], 0.5)]
    df = spark.createDataFrame([(i, s, c) for i, (s, c) in enumerate(cases)], "i int, s array<double>, c double")
    for i, w in one(df, "i", P.capped_weights(F.col("s"), F.col("c"))):
        s, c = cases[i]
        assert w == pytest.approx(list(brute(s, c)) if sum(s) else [0.0] * len(s))


def test_adx_against_a_loop(spark):
    r, n = random.Random(1), 5
    rows, price = [], 100.0
    for i in range(60):
        price *= 1 + r.uniform(-0.03, 0.03)
        rows.append((D(2020, 1, 1) + datetime.timedelta(days=i), "A", price * 1.01, price * 0.98, price))
    bars = spark.createDataFrame(rows, "date date, ticker string, high double, low double, close double")
    got = [(x.adx, x.di_plus) for x in adx.wilder_adx(bars, n, 9).orderBy("date").collect()]

    def smooth(xs):
        out, m, seen = [], None, 0
        for x in xs:
            if x is not None:
                m, seen = x if m is None else m + (x - m) / n, seen + 1
            out.append(m if seen >= n else None)
        return out

    tr, plus, minus = [], [], []
    for i, (_, _, h, low, _) in enumerate(rows):
        pc = rows[i - 1][4] if i else None
        tr.append(max(h - low, abs(h - pc), abs(low - pc)) if i else h - low)
        up, down = (h - rows[i - 1][2], rows[i - 1][3] - low) if i else (0, 0)
        plus.append(up if up > down and up > 0 else 0.0)
        minus.append(down if down > up and down > 0 else 0.0)
    a, p, m = smooth(tr), smooth(plus), smooth(minus)
    dip = [100 * y / x if x else None for x, y in zip(a, p, strict=True)]
    dim = [100 * y / x if x else None for x, y in zip(a, m, strict=True)]
    dx = [None if x is None or x + y == 0 else 100 * abs(x - y) / (x + y) for x, y in zip(dip, dim, strict=True)]
    for (ga, gp), wa, wp in zip(got, smooth(dx), dip, strict=True):
        assert (ga is None) == (wa is None) and (ga is None or ga == pytest.approx(wa)) and (gp is None) == (wp is None) and (gp is None or gp == pytest.approx(wp))


def test_wilder_means_in_blocks(spark):
    """Against the mean over the whole series: gaps, unknown values at either end, blocks without any, no rows."""
    r, n = random.Random(2), 4
    rows = [(k, D(2020, 1, 1) + datetime.timedelta(days=i), None if i < 3 or 40 <= i < 60 or r.random() < 0.3 else r.uniform(-5, 5), 1e6 + i) for k in ("A", "B") for i in range(120) if r.random() < 0.8]
    rows += [("C", D(2020, 1, 1), None, 1.0), (None, D(2020, 1, 1), 2.0, 1.0)]
    df = spark.createDataFrame(rows, "k string, date date, x double, y double")
    want = {}
    for k in ("A", "B", "C", None):
        own = sorted((d, x, y) for kk, d, x, y in rows if kk == k)
        s = pd.DataFrame(own, columns=["d", "x", "y"])
        means = s[["x", "y"]].astype(float).ewm(alpha=1 / n, adjust=False, min_periods=n).mean()
        want |= {(k, d): tuple(None if v != v else v for v in m) for d, m in zip(s["d"], means.to_numpy().tolist(), strict=True)}
    for width in (1, 7, 1000):
        got = scans.wilder_means(df.filter("k is not null"), ["k"], "date", ["x", "y"], n, width).collect()
        assert len(got) == len(rows) - 1
        for g in got:
            assert [v if v is None else pytest.approx(v, rel=1e-9, abs=1e-9) for v in want[g.k, g.date]] == [g.x, g.y]
    assert scans.wilder_means(df.filter("false"), ["k"], "date", ["x"], n).count() == 0


def test_asof_in_time_blocks(spark):
    """One key with all rows, blocks without right rows, ties, rows without time or key."""
    r = random.Random(3)
    at = lambda: D(2020, 1, 1) + datetime.timedelta(days=r.randrange(400))
    right = [("A", d, i) for i, d in enumerate(sorted({at() for _ in range(40)} - {D(2020, 5, 1) + datetime.timedelta(days=i) for i in range(90)}))] + [(None, D(2020, 3, 1), 7), ("A", None, 99)]
    left = [(i, "A", at()) for i in range(300)] + [(300, None, D(2020, 4, 1)), (301, "A", None), (302, "B", D(2020, 4, 1)), (303, "A", D(2019, 1, 1)), (303, "A", D(2019, 1, 1))]
    a, b = spark.createDataFrame(left, "n int, k string, d date"), spark.createDataFrame(right, "k string, d date, v int")
    for strict in (False, True):
        want = sorted((n, max(((t, v) for kk, t, v in right if kk == k and d and t and (t < d if strict else t <= d)), default=(None, None))[1]) for n, k, d in left)
        for width in (1, 30, 5000):
            out = J.asof_join(a, b, ["k"], "d", ["v"], strict=strict, width=width)
            assert sorted((x.n, x.v) for x in out.collect()) == want
        stamped = J.asof_join(a.withColumn("d", F.col("d").cast("timestamp")), b.withColumn("d", F.col("d").cast("timestamp")), ["k"], "d", ["v"], strict=strict, width=9)
        assert sorted((x.n, x.v) for x in stamped.collect()) == want
        numbers = lambda df: df.withColumn("d", F.unix_date("d"))
        assert sorted((x.n, x.v) for x in J.asof_join(numbers(a), numbers(b), ["k"], "d", ["v"], strict=strict, width=20).collect()) == want
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "_block" in plan and not any("hashpartitioning(k" in x and "_block" not in x and "_last" not in x for x in plan.splitlines() if "Window" in x)
    assert J.asof_join(a, b.filter("false"), ["k"], "d", ["v"]).filter("v is not null").count() == 0 and J.asof_join(a.filter("false"), b, ["k"], "d", ["v"]).count() == 0


def test_streaks_and_days_since(spark):
    r = random.Random(9)
    rows = [(t, i, r.choice([True, False, None])) for t in "ab" for i in range(30)]
    df = spark.createDataFrame(rows, "k string, date int, c boolean")
    df = W.with_streak(W.with_days_since(df, F.col("c"), "since", ["k"]), F.col("c"), "run", ["k"])
    last, run = {}, {}
    for k, d, c, since, n in one(df.orderBy("k", "date"), "k", "date", "c", "since", "run"):
        assert since == (None if k not in last else d - 1 - last[k])
        run[k] = run.get(k, 0) + 1 if c else 0
        assert n == run[k]
        if c:
            last[k] = d


def test_global_rank_has_no_table_wide_window(spark):
    r = random.Random(2)
    vals = [r.choice([None, 1.0, 2.5, 7.0, r.random()]) for _ in range(500)]
    df = ranks.global_pct_rank(spark.createDataFrame(list(enumerate(vals)), "i int, v double"), "v", "p", buckets=8)
    known = sorted(v for v in vals if v is not None)
    for i, p in one(df, "i", "p"):
        v = vals[i]
        assert p is None if v is None else p == pytest.approx((sum(x < v for x in known) + (known.count(v) + 1) / 2) / len(known))


def test_writes(spark, tmp_path):
    path, now = f"{tmp_path}/t", lambda n: F.lit(n).cast("timestamp")
    first = spark.createDataFrame([("2024-01-01", "A", 1.0), ("2024-01-02", "A", 2.0)], "date string, ticker string, v double")
    S.write_upsert(spark, path, first, ["date", "ticker"], now(1))
    more = spark.createDataFrame([("2024-01-02", "A", 5.0, 1), ("2024-01-02", "B", 6.0, 1)], "date string, ticker string, v double, extra int")
    for n in (2, 3):
        S.write_upsert(spark, path, more, ["date", "ticker"], now(n))
    got = sorted((str(r.date), r.ticker, r.v, r._inserted_at.timestamp(), r._updated_at.timestamp()) for r in spark.read.option("mergeSchema", True).parquet(path).collect())
    assert got == [("2024-01-01", "A", 1.0, 1.0, 1.0), ("2024-01-02", "A", 5.0, 1.0, 3.0), ("2024-01-02", "B", 6.0, 2.0, 3.0)]


def test_modules(spark):
    modules.REGISTRY.clear()

    @modules.feature_module("m", "market")
    def build(sources):
        return sources["x"].groupBy("date").agg(F.max("v").alias("top"))

    core = spark.createDataFrame([(1, "A"), (2, "A")], "date int, ticker string")
    out = modules.assemble(core, {"x": spark.createDataFrame([(1, 3), (1, 4)], "date int, v int")})
    assert sorted(map(tuple, out.collect())) == [(1, "A", 4), (2, "A", None)]
    with pytest.raises(ValueError, match="repeats"):
        modules.assemble(core.withColumn("top", F.lit(1)), {"x": spark.createDataFrame([(1, 3)], "date int, v int")})


def test_audit_finds_a_feature_that_looks_ahead(spark):
    src = spark.createDataFrame([(D(2020, 1, i), "A", float(i * i)) for i in range(1, 20)], "date date, ticker string, close double")
    w = W.by(["ticker"])
    honest = lambda d: d.withColumn("f", F.lag("close").over(w))
    peeking = lambda d: d.withColumn("f", F.lead("close").over(w))
    cut = F.lit(D(2020, 1, 10))
    bad = lambda b: sum(r.different for r in checks.lookahead_audit(b, src, ["date", "ticker"], cut).collect())
    assert bad(honest) == 0 and bad(peeking) == 1


def test_bootstrap_reruns_agree(spark):
    d = spark.createDataFrame([(D(2020, 1, i), 0.01 * (-1) ** i) for i in range(1, 20)], "date date, net_return double")
    a, b = (sorted(map(tuple, P.block_bootstrap(d, 20, 5, 15).collect())) for _ in "ab")
    assert a == b and len(a) == 20 and all(x[2] <= 0 for x in a)


def test_no_window_over_a_fact_table(spark):
    """The as-of join must not become a range join."""
    left = spark.createDataFrame([("A", D(2020, 1, 5))], "k string, date date")
    right = spark.createDataFrame([("A", D(2020, 1, 5), 1), ("A", D(2020, 1, 3), 2)], "k string, date date, v int")
    out = J.asof_join(left, right, ["k"], "date", ["v"], strict=True)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert one(out, "v") == [(2,)] and "NestedLoop" not in plan and "Cartesian" not in plan


def test_column_families(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a int, b int, flow_c int")
    assert R.column_families(df, {"flow_": ["a", "flow_c", "none"]}).columns == ["flow_a", "b", "flow_c"]
    with pytest.raises(ValueError, match="taken"):
        R.column_families(df.withColumn("c", F.lit(1)), {"flow_": ["c"]})


def test_frequency_surge_uses_earlier_rows_of_one_key(spark):
    d = spark.createDataFrame([("A", i, i, 1) for i in range(1, 8)] + [("B", 1, 100, 0), ("B", 2, None, 5)], "ticker string, date int, buy_freq int, sell_freq int")
    got = {(r.ticker, r.date): r for r in W.frequency_surge(d).collect()}
    assert got["A", 2].buy_freq_ma_5 is None and got["A", 3].buy_freq_ma_5 == 1.5
    assert got["A", 5].freq_surge is None and got["A", 6].freq_surge == 6 / 4  # the row before over the mean of 2 to 6
    assert got["B", 1].freq_surge is None and got["B", 2].buy_freq_ma_5 is None


def test_group_rolling_leaves_the_current_row_out(spark):
    rows = [("A", i, x, 2, 1, 3.0) for i, x in enumerate([1.0, 2.0, None, 4.0, -1.0, 6.0])]
    d = spark.createDataFrame(rows, "ticker string, date int, g_sum double, g_members int, g_buyers int, g_abs double").withColumns({"members": F.lit(4), "g_buy_freq": F.lit(1)})
    got = W.group_rolling(d, "g").orderBy("date").collect()
    assert [r.g_sum_3 for r in got] == [0, 1, 3, 3, 6, 3] and [r.g_streak for r in got] == [1, 2, 2, 3, 0, 1]
    assert [r.g_sum_7 for r in got] == [0, 0, 0, 0, 7, 6] and got[0].g_participation == 0.5


def test_risk_score_means_what_is_there(spark):
    d = spark.createDataFrame([(i, float(i), None if i == 1 else float(i)) for i in range(1, 5)] + [(9, None, None)], "id int, a double, b double")
    got = {r.id: r.risk_norm for r in ranks.risk_score(d, ["a", "b"]).collect()}
    assert got[1] == 0.25 and got[4] == 1.0 and abs(got[9] - (got[2] + got[3]) / 2) < 1e-12
    assert {r.risk_norm for r in ranks.risk_score(d, []).collect()} == {0.5}


def test_foreign_flow_by_members_or_columns(spark):
    d = spark.createDataFrame([(1, "A", "Foreign", 30.0, 10.0, 40.0), (1, "A", "X", 5.0, 55.0, 60.0), (1, "B", "X", 1.0, 1.0, 2.0)], "date int, ticker string, broker string, gross_buy double, gross_sell double, gross_turnover double")
    (r,) = W.foreign_flow(d, ["FOREIGN"]).collect()
    assert (r.ticker, r.foreign_net_buy, r.foreign_participation) == ("A", 20.0, 0.4)
    assert W.foreign_flow(d, ["none"]).count() == 0
    by_column = W.foreign_flow(d.withColumns({"foreign_buy": F.lit(3.0), "foreign_sell": F.lit(1.0)}), ["none"])
    assert {r.ticker: r.foreign_net_buy for r in by_column.collect()} == {"A": 4.0, "B": 2.0}


def test_day_state_on_late_and_unordered_rows(spark, tmp_path):
    """One row for each closed day; order of arrival doesn't count, rows behind the watermark and odd rows do not either."""
    from flowmart.plans.q_streams import to_end
    from flowmart.streaming import streams as T

    at = lambda d, h: datetime.datetime(2024, 1, d, h)
    batches = [
        [("A", at(1, 12), 3, 90.0, 1.0), ("A", at(1, 10), 1, 100.0, 1.0), ("B", at(1, 9), 2, 5.0, None), (None, at(1, 9), 9, 500.0, 1.0), ("A", at(1, 11), 8, None, 1.0)],
        [("A", at(1, 13), 4, 80.0, 2.0), ("B", at(2, 1), 5, 200.0, 1.0)],
        [("A", at(1, 11), 6, 1000.0, 1.0), ("A", at(2, 1), 7, 10.0, 1.0), ("B", at(2, 3), 7, 120.0, 1.0)],
        [("A", at(4, 1), 10, 1.0, 1.0)],
    ]
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, "ticker string, ts timestamp, event_id long, price double, volume double").coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        for f in (tmp_path / "in").glob("part-*"):
            if f.stat().st_mtime < 2e9:
                os.utime(f, (2e9 + i, 2e9 + i))
    stream = T.stream_events(spark, f"file://{tmp_path}/in", "ticker string, ts timestamp, event_id long, price double, volume double", files_per_batch=1)
    out = to_end(T.stream_state(stream, 100.0), "day_state")
    # the row of 1000 came when the watermark stood at 2 January 00:00, so its day was over
    assert sorted(tuple(r) for r in out.collect()) == [("A", "2024-01-01", 3, pytest.approx(87.5), 100.0, True, True), ("A", "2024-01-02", 1, 10.0, 10.0, False, False), ("B", "2024-01-01", 1, None, 5.0, False, False), ("B", "2024-01-02", 2, 160.0, 200.0, True, False)]


def test_exact_quantiles_by_counted_buckets(spark):
    """Very common values, negative ones, nulls and NaN, several rounds, one value, none."""
    r = random.Random(4)
    values = [r.choice([0.0, 0.0, -3.5, r.gauss(0, 1e3), r.random() * 1e-9, float(r.randrange(20))]) for _ in range(3_000)]
    df = spark.createDataFrame([(v,) for v in [*values, None, float("nan")]], "v double").repartition(3)
    shares = [0.0, 0.01, 0.25, 0.5, 0.501, 0.9, 1.0]
    for buckets, small in ((4, 20), (16, 300), (256, 10_000)):
        assert quantiles.exact_quantiles(df, "v", shares, buckets, small) == pytest.approx(np.quantile(values, shares).tolist())
    assert quantiles.exact_quantiles(df.filter("v = 0"), "v", [0.5], 4, 2) == [0.0] and quantiles.exact_quantiles(df.filter("v is null"), "v", [0.5]) == []


def test_sketches_merge(spark):
    rows = [(i % 7, float(i % 1000), None if i % 3 else 1.0) for i in range(20_000)] + [(9, None, None), (9, float("nan"), None)]
    s = quantiles.profile_sketches(spark.createDataFrame(rows, "d int, x double, y double"), "d", ["x", "y"])
    assert s.count() == 16
    for days in ([0, 1, 2, 3, 4, 5, 6, 9], [2, 5], [9]):
        got = {r.column: r for r in quantiles.merged_profile(s.filter(F.col("day").isin(days)), [0.1, 0.5]).collect()}
        x = [v for d, v, _ in rows if d in days and v is not None and v == v]
        assert (got["x"].n, got["x"].nulls) == (len(x), sum(d in days for d, _, _ in rows) - len(x))
        if x:
            assert abs(got["x"].distinct - len(set(x))) <= 0.08 * len(set(x)) and all(abs(sum(v <= q for v in x) / len(x) - p) < 0.04 for p, q in zip((0.1, 0.5), got["x"].quantiles, strict=True))
        else:
            assert (got["x"].distinct, got["x"].quantiles) == (0, None)


def test_shares_below(spark):
    """Ties with the point, nulls and NaN, a column without values, one without a point, no points at all."""
    df = spark.createDataFrame([(1.0, None, 1), (2.0, None, 2), (2.0, float("nan"), 3), (5.0, None, 4), (None, None, 5), (float("nan"), None, 6)], "x double, y double, z int").repartition(3)
    points = spark.createDataFrame([("x", 2.0), ("y", 1.0), ("z", None)], "column string, point double")
    assert sorted(map(tuple, quantiles.shares_below(df, points).collect())) == [("x", 0.25, 0.75), ("y", None, None), ("z", None, None)]
    assert quantiles.shares_below(df, points.limit(0)).collect() == []
    assert [tuple(r) for r in quantiles.shares_below(df.limit(0), points.limit(1)).collect()] == [("x", None, None)]


def test_ledger_of_batches(spark, tmp_path):
    """A replay, an older batch that comes late, a crash between staging and swap, two writers at once."""
    path, at = f"file://{tmp_path}/t", lambda n: F.lit(n).cast("timestamp")
    batch = lambda *rows: spark.createDataFrame(rows, "date string, k int, v int")
    now = lambda: sorted((r.date, r.k, r.v) for r in spark.read.parquet(path).withColumn("date", F.col("date").cast("string")).collect())
    put = lambda n, rows, name="a", **how: S.ledger_upsert(spark, path, batch(*rows), ["date", "k"], at(n), name, n, **how)
    d = "2024-01-01"
    assert put(1, [(d, 1, 10), (d, 2, 20), (d, 2, 21)]) == "done" and now() == [(d, 1, 10), (d, 2, 21)]
    assert put(3, [(d, 1, 30), ("2024-01-02", 5, 50)]) == "done" and put(3, [(d, 1, 99)]) == "known"
    assert put(2, [(d, 1, 11), (d, 2, 22), (d, 3, 33)]) == "done" and now() == [(d, 1, 30), (d, 2, 22), (d, 3, 33), ("2024-01-02", 5, 50)]

    def crash():
        raise KeyboardInterrupt

    with pytest.raises(KeyboardInterrupt):
        put(4, [(d, 3, 44)], before_swap=crash)
    assert (d, 3, 33) in now() and S.ledger(spark, path).filter("number = 4").count() == 1
    assert put(4, [(d, 3, 44)]) == "done" and (d, 3, 44) in now()

    others = iter([lambda: put(1, [(d, 7, 70)], "b")])
    assert put(5, [(d, 8, 80)], before_swap=lambda: next(others, lambda: None)()) == "done"
    assert {(d, 7, 70), (d, 8, 80)} <= set(now())
    assert S.ledger(spark, path).filter("state = 'done'").count() == 6 and put(6, []) == "done" and len(now()) == 6


def test_stream_chain_drops_repeats_and_late_rows(spark, tmp_path):
    from flowmart.plans.q_streams import to_end
    from flowmart.streaming import streams as T

    at = lambda h, m: datetime.datetime(2024, 1, 1, h, m)
    batches = [[(1, "A", at(9, 5), 10.0, 1.0), (1, "A", at(9, 5), 10.0, 1.0), (2, "A", at(9, 40), 20.0, 3.0)], [(2, "A", at(9, 40), 20.0, 3.0), (3, "A", at(11, 0), 5.0, 1.0)], [(4, "A", at(9, 10), 99.0, 1.0), (5, "A", at(10, 55), 7.0, 1.0)], [(6, "A", at(15, 0), 1.0, 1.0)]]
    schema = "event_id long, ticker string, ts timestamp, price double, volume double"
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(f"file://{tmp_path}/in")
        for f in (tmp_path / "in").glob("part-*"):
            if f.stat().st_mtime < 2e9:
                os.utime(f, (2e9 + i, 2e9 + i))
    once = T.stream_dedup(T.stream_events(spark, f"file://{tmp_path}/in", schema, files_per_batch=1), ["event_id"], "ts", "10 minutes")
    bars = T.stream_bars(once, ["ticker"], "ts", ["ts", "event_id"], "price", "volume", "1 hour", None, "30 minutes")
    got = sorted((r.bucket.hour, r.bucket.minute, r.open, r.close, r.ticks, r.vwap) for r in to_end(bars, "chain").collect())
    # event 4 came when the watermark stood at 10:50; event 5 was still in time
    assert got == [(8, 30, 10.0, 10.0, 1, 10.0), (9, 0, 10.0, 20.0, 2, 17.5), (9, 30, 20.0, 20.0, 1, 20.0), (10, 0, 7.0, 7.0, 1, 7.0), (10, 30, 7.0, 5.0, 2, 6.0), (11, 0, 5.0, 5.0, 1, 5.0)]
