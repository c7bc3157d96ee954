"""Aggregations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from flowmart.functions.exprs import flag, safe_div
from flowmart.operators.quantiles import exact_quantiles, merged_profile, profile_sketches


def agg_panel(df: DataFrame, keys: Sequence[str], cols: Sequence[str], flags: Sequence[str] = ()) -> DataFrame:
    """Sum (0 if all are null) and mean of every column, maximum of flags, in one grouping."""
    made = [e for c in cols for e in (F.coalesce(F.sum(c), F.lit(0)).alias(f"{c}_sum"), F.avg(c).alias(f"{c}_mean"))]
    return df.groupBy(*keys).agg(*made, *[F.max(c).alias(f"{c}_max") for c in flags])


def breadth(df: DataFrame, keys: Sequence[str], member: str, net: str) -> DataFrame:
    """Distinct members, buyers and sellers, and their shares."""
    out = df.groupBy(*keys).agg(
        F.count_distinct(member).alias("members"), F.count_distinct(F.when(F.col(net) > 0, F.col(member))).alias("buyers"), F.count_distinct(F.when(F.col(net) < 0, F.col(member))).alias("sellers")
    )
    return out.withColumns({"buyer_share": safe_div("buyers", "members"), "seller_share": safe_div("sellers", "members")})


def group_totals(df: DataFrame, keys: Sequence[str], member: str, groups: Mapping[str, Sequence[str]], net: str, freq: str) -> DataFrame:
    """Totals over several sets of members in one pass: sum, mean, absolute sum, members, buyers, sellers, trades."""
    made = []
    for name, members in groups.items():
        own = F.col(member).isin(*members)
        x = F.when(own, F.col(net))
        made += [
            F.coalesce(F.sum(x), F.lit(0.0)).alias(f"{name}_sum"), F.avg(x).alias(f"{name}_mean"), F.coalesce(F.sum(F.abs(x)), F.lit(0.0)).alias(f"{name}_abs"),
            F.count_distinct(F.when(own, F.col(member))).alias(f"{name}_members"), F.coalesce(F.sum(flag(x > 0)), F.lit(0)).alias(f"{name}_buyers"),
            F.coalesce(F.sum(flag(x < 0)), F.lit(0)).alias(f"{name}_sellers"), F.coalesce(F.sum(F.when(own, F.col(freq))), F.lit(0)).alias(f"{name}_freq"),
        ]
    return df.groupBy(*keys).agg(*made)


def concentration(df: DataFrame, keys: Sequence[str], member: str, value: str) -> DataFrame:
    """Of the shares of positive flow in each group: sum of squares, largest, and sum of the three largest (ties by member)."""
    up = df.filter(F.col(value) > 0)
    share = up.withColumn("_s", F.col(value) / F.sum(value).over(Window.partitionBy(*keys)))
    share = share.withColumn("_rn", F.row_number().over(Window.partitionBy(*keys).orderBy(F.desc(value), member)))
    return share.groupBy(*keys).agg(F.sum(F.col("_s") * F.col("_s")).alias("hhi"), F.max("_s").alias("top1"), F.sum(F.when(F.col("_rn") <= 3, F.col("_s"))).alias("top3"))


def signed_concentration(df: DataFrame, keys: Sequence[str], value: str, price: str, ref_price: str) -> DataFrame:
    """Shares of net flow in its absolute total, with sign; and how far prices paid stand from the reference price."""
    total = F.sum(F.abs(value)).over(Window.partitionBy(*keys))
    rows = df.withColumn("_s", safe_div(F.col(value), total)).withColumn("_a", safe_div(F.col(price), ref_price) - 1)
    return rows.groupBy(*keys).agg(F.sum(F.col("_s") * F.abs("_s")).alias("signed_hhi"), F.max(F.abs("_s")).alias("top_share"), F.max("_a").alias("aggression_max"), F.avg("_a").alias("aggression_mean"))


def pivot_members(df: DataFrame, keys: Sequence[str], member: str, members: Sequence[str], cols: Sequence[str]) -> DataFrame:
    """{member}_{col} and {member}_present for named members; 0 where a member has no row."""
    made = []
    for m in members:
        own = F.col(member) == m
        made += [F.coalesce(F.sum(F.when(own, F.col(c))), F.lit(0)).alias(f"{m}_{c}") for c in cols] + [F.max(flag(own)).alias(f"{m}_present")]
    return df.groupBy(*keys).agg(*made)


def member_sum(df: DataFrame, keys: Sequence[str], member: str, members: Sequence[str], value: str, name: str) -> DataFrame:
    return df.groupBy(*keys).agg(F.coalesce(F.sum(F.when(F.col(member).isin(*members), F.col(value))), F.lit(0.0)).alias(name))


def context_shares(df: DataFrame, date: str, member: str, entity: str, value: str) -> DataFrame:
    """Totals of the row's member, entity and market on its day, and three ratios. The market's total is the sum of the
    entities' totals, joined back by day: no window holds a whole day."""
    per_member = df.groupBy(date, member).agg(F.sum(value).alias("member_day"))
    per_entity = df.groupBy(date, entity).agg(F.sum(value).alias("entity_day"))
    market = per_entity.groupBy(date).agg(F.sum("entity_day").alias("market_day"))
    out = df.join(per_member, [date, member], "left").join(per_entity, [date, entity], "left").join(market, date, "left")
    return out.withColumns({"specificity": safe_div(value, "member_day"), "member_share": safe_div("member_day", "market_day"), "entity_share": safe_div("entity_day", "market_day")})


def group_summary(df: DataFrame, keys: Sequence[str], date: str, entity: str, ret: str, hit: Column, tail: Column, total: bool = True) -> DataFrame:
    """Rows, days, entities, hit and tail rates and the distribution of returns for each group, and for all of them
    (the key is then 'all')."""
    made = [
        F.count("*").alias("rows"), F.count_distinct(date).alias("days"), F.count_distinct(entity).alias("entities"), F.avg(flag(hit)).alias("hit_rate"), F.avg(flag(tail)).alias("tail_rate"),
        F.avg(ret).alias("mean"), F.percentile(ret, 0.5).alias("median"), F.percentile(ret, 0.1).alias("p10"), F.percentile(ret, 0.9).alias("p90"),
    ]
    if not total:
        return df.groupBy(*keys).agg(*made)
    out = df.rollup(*keys).agg(F.grouping_id().alias("_g"), *made).filter(F.col("_g").isin(0, (1 << len(keys)) - 1))
    return out.withColumns({k: F.when(F.col("_g") > 0, "all").otherwise(F.col(k).cast("string")) for k in keys}).drop("_g")


def profile_quantiles(df: DataFrame, key: str, extreme: int = 20) -> DataFrame:
    """Least, 5 %, median, 95 % and most rows of a key value, how many values there are, and the `extreme` values
    with the fewest rows (ties to the smaller), as text in that order."""
    counts = df.groupBy(key).count()
    shares = (0.0, 0.05, 0.5, 0.95, 1.0)
    q = exact_quantiles(counts, "count", shares) or [None] * len(shares)
    lowest = counts.orderBy("count", key).limit(extreme).agg(F.array_sort(F.collect_list(F.struct("count", key))).alias("x"))
    told = counts.agg(F.count("*").alias("n")).join(lowest, how="cross")
    return told.select(F.lit(key).alias("key"), "n", *[F.lit(v).cast("double").alias(name) for v, name in zip(q, ("least", "p05", "median", "p95", "most"), strict=True)], F.array_join(F.transform(F.col("x")[key], lambda k: k.cast("string")), ",").alias("lowest"))


def attribution(df: DataFrame, dims: Sequence[str], net: str, weighted: str) -> DataFrame:
    """Count, mean and weighted sum for each value of each dimension, in one pass over the rows."""
    sides = F.explode(F.array(*[F.struct(F.lit(d).alias("dim"), F.col(d).cast("string").alias("value")) for d in dims])).alias("_d")
    rows = df.select(sides, net, weighted).select("_d.*", net, weighted)
    return rows.groupBy("dim", "value").agg(F.count("*").alias("n"), F.avg(net).alias("mean_net"), F.sum(weighted).alias("sum_weighted"))


def class_metrics(df: DataFrame, y: str, p: str) -> DataFrame:
    """AUC, average precision, log-loss, Brier score, and precision, recall, F1 at 0.5.

    Only the distinct scores are ordered, and their running counts come from sums of sums: rows are first counted by
    score, scores by bucket of 1/256, so that no window holds all rows.
    """
    by_score = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull()).groupBy(F.col(p).alias("s")).agg(F.sum(F.col(y).cast("long")).alias("pos"), F.count("*").alias("n"))
    by_score = by_score.withColumn("b", F.floor(F.col("s") * 256))
    buckets = by_score.groupBy("b").agg(F.sum("pos").alias("bp"), F.sum("n").alias("bn"))
    down = Window.orderBy(F.desc("b")).rowsBetween(Window.unboundedPreceding, -1)
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    buckets = buckets.select("b", F.coalesce(F.sum("bp").over(down), F.lit(0)).alias("p0"), F.coalesce(F.sum("bn").over(down), F.lit(0)).alias("n0"), F.sum("bp").over(every).alias("tp"), F.sum("bn").over(every).alias("tn"))
    within = Window.partitionBy("b").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, 0)
    c = by_score.join(F.broadcast(buckets), "b").withColumns({"cp": F.col("p0") + F.sum("pos").over(within), "cn": F.col("n0") + F.sum("n").over(within)})
    neg = F.col("n") - F.col("pos")
    ranked = c.agg(
        (F.sum(neg * (F.col("cp") - F.col("pos") + F.col("pos") / 2)) / F.max(F.col("tp") * (F.col("tn") - F.col("tp")))).alias("auc"),
        (F.sum(F.col("pos") * F.col("cp") / F.col("cn")) / F.max("tp")).alias("average_precision"),
    )
    q = F.greatest(F.least(F.col(p), F.lit(1 - 1e-15)), F.lit(1e-15))
    said = F.col(p) >= 0.5
    plain = df.filter(F.col(y).isNotNull() & F.col(p).isNotNull()).agg(
        F.count("*").alias("n"), F.avg(F.col(y).cast("double")).alias("base_rate"), F.avg((F.col(p) - F.col(y)) ** 2).alias("brier"),
        F.avg(-F.when(F.col(y) == 1, F.log(q)).otherwise(F.log(1 - q))).alias("log_loss"),
        safe_div(F.sum(flag(said & (F.col(y) == 1))), F.sum(flag(said))).alias("precision"), safe_div(F.sum(flag(said & (F.col(y) == 1))), F.sum(F.col(y))).alias("recall"),
    )
    f1 = safe_div(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return plain.join(ranked, how="cross").withColumn("f1", f1)


def topk_metrics(df: DataFrame, day: str, y: str, p: str, tie: str, ks: Sequence[int]) -> DataFrame:
    """For each k the mean over days of the precision in the day's top k, and the share of days with any hit in it."""
    top = df.withColumn("_rn", F.row_number().over(Window.partitionBy(day).orderBy(F.desc(p), tie))).filter(F.col("_rn") <= max(ks))
    days = top.groupBy(day).agg(*[f(F.when(F.col("_rn") <= k, F.col(y).cast("double"))).alias(f"{name}{k}") for k in ks for name, f in (("p", F.avg), ("h", F.max))])
    one = days.agg(*[F.avg(f"{name}{k}").alias(f"{name}{k}") for k in ks for name in "ph"])
    return one.select(F.explode(F.array(*[F.struct(F.lit(k).alias("k"), F.col(f"p{k}").alias("precision"), F.col(f"h{k}").alias("any_hit")) for k in ks])).alias("x")).select("x.*")


def jaccard(df: DataFrame, group: str, item: str) -> DataFrame:
    """Overlap of every two groups' sets of items, by a join on the item."""
    sets = df.select(group, item).distinct()
    sizes = sets.groupBy(group).count()
    a, b = sets.withColumnRenamed(group, "a"), sets.withColumnRenamed(group, "b")
    common = a.join(b, item).filter("a < b").groupBy("a", "b").agg(F.count("*").alias("common"))
    na, nb = sizes.withColumnsRenamed({group: "a", "count": "na"}), sizes.withColumnsRenamed({group: "b", "count": "nb"})
    return common.join(na, "a").join(nb, "b").select("a", "b", "common", (F.col("common") / (F.col("na") + F.col("nb") - F.col("common"))).alias("jaccard"))


def mean_rank(df: DataFrame, group: str, item: str, gain: str) -> DataFrame:
    """item, groups (that have it), mean_rank (by falling gain within a group, ties to the smaller item) and everywhere:
    whether all groups have it. An item that a group has twice counts there by its largest gain."""
    each = df.groupBy(group, item).agg(F.max(gain).alias("_gain"))
    ranked = each.withColumn("_rank", F.row_number().over(Window.partitionBy(group).orderBy(F.desc("_gain"), item)))
    many = ranked.select(group).distinct().agg(F.count("*").alias("_many"))
    g = ranked.groupBy(item).agg(F.count("*").alias("groups"), F.avg("_rank").alias("mean_rank"))
    return g.join(many, how="cross").select(item, "groups", "mean_rank", (F.col("groups") == F.col("_many")).alias("everywhere"))


def approx_profile(df: DataFrame, cols: Sequence[str], exact: bool = True) -> DataFrame:
    """Distinct values and medians; with exact=False by the sketches of profile_sketches(), merged over one day that
    holds all rows, for tables where exact ones cost too much."""
    if not exact:
        return merged_profile(profile_sketches(df, F.lit(0), cols), [0.5]).select("column", "distinct", F.col("quantiles")[0].alias("median"))
    one = df.agg(*[F.count_distinct(c).alias(c) for c in cols])
    middle = {c: (exact_quantiles(df, c, [0.5]) or [None])[0] for c in cols}
    return one.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("distinct"), F.lit(middle[c]).cast("double").alias("median")) for c in cols])).alias("x")).select("x.*")


def conditional_lift(df: DataFrame, key: str, won: str, least: int, z: float = 1.96) -> DataFrame:
    """Win rate of each member with at least so many events, its lift over the base rate and its lower Wilson bound."""
    base = df.agg(F.avg(F.col(won).cast("double")).alias("base"))
    g = df.groupBy(key).agg(F.count("*").alias("n"), F.avg(F.col(won).cast("double")).alias("rate")).filter(F.col("n") >= least).join(base, how="cross")
    n, p = F.col("n"), F.col("rate")
    low = (p + z * z / (2 * n) - z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n))) / (1 + z * z / n)
    return g.select(key, "n", "rate", (p - F.col("base")).alias("lift"), low.alias("wilson_low"))
