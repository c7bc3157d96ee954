"""Weighted means that go on from row to row, computed in blocks of time.

y = (1 - w) y + w x is a linear recurrence. Within a block the rows' steps compose to y_in -> p y_in + q, by running
sums; the blocks' own steps are folded over the small table of (key, block), which gives every block what goes into it;
then each row takes its own step. So a long series is as many tasks as it has blocks, and no Python runs.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import log

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def wilder_means(df: DataFrame, by: Sequence[str], date: str, columns: Sequence[str], n: int, width: int = 128) -> DataFrame:
    """df with each of `columns` replaced by its Wilder mean: the first known value, then (n - 1) / n of the last mean and
    1 / n of the new value; null until n values are known.

    A null value leaves the mean as it is, but the weight of the past falls by every row that goes by: after a gap it
    is (1 - 1/n)^rows against 1/n. `date` is a date, unique within a key; a block has `width` days, which bounds its
    rows. Running sums within a block hold powers of 1 - 1/n up to `width`, so `width` is cut where they would overflow.
    """
    keep = 1 - 1 / n
    width = max(1, min(width, int(300 / -log(keep)))) if n > 1 else width
    wait = f"pow({keep!r}D, g) / (pow({keep!r}D, g) + {1 / n!r}D)"  # of the last mean, after g rows
    rows = df.withColumn("_b", F.floor(F.unix_date(date) / width))
    block = Window.partitionBy(*by, "_b")
    order = block.orderBy(date)
    past = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.withColumn("_i", F.row_number().over(order))
    for c in columns:
        seen = F.last(F.when(F.col(c).isNotNull(), F.col("_i")), ignorenulls=True)
        rows = rows.withColumns({f"_k_{c}": F.count(c).over(past), f"_s_{c}": seen.over(past), f"_l_{c}": seen.over(order.rowsBetween(Window.unboundedPreceding, -1))})
        # From the second known value of the block on its step is known: the last mean's weight a, or 1 at a null.
        a = F.when(F.col(c).isNotNull() & F.col(f"_l_{c}").isNotNull(), F.expr(wait.replace("g)", f"_i - _l_{c})")))
        rows = rows.withColumn(f"_a_{c}", a)
        rows = rows.withColumn(f"_p_{c}", F.coalesce(F.sum(F.log(f"_a_{c}")).over(past), F.lit(0.0)))
        rows = rows.withColumn(f"_q_{c}", F.exp(f"_p_{c}") * F.coalesce(F.sum((1 - F.col(f"_a_{c}")) * F.col(c) * F.exp(-F.col(f"_p_{c}"))).over(past), F.lit(0.0)))
    ends = [
        x
        for c in columns
        for x in (
            F.min_by(F.struct(F.col("_i").alias("i"), F.col(c).alias("x")), F.when(F.col(c).isNotNull(), F.col("_i"))).alias(f"_f_{c}"),
            F.max_by(F.struct(F.exp(f"_p_{c}").alias("p"), F.col(f"_q_{c}").alias("q"), F.col(f"_k_{c}").alias("k"), F.col(f"_s_{c}").alias("s")), "_i").alias(f"_e_{c}"),
        )
    ]
    blocks = rows.groupBy(*by, "_b").agg(F.max("_i").alias("_n"), *ends)
    parts = ", ".join(f"_f_{c}, _e_{c}" for c in columns)
    series = blocks.groupBy(*by).agg(F.expr(f"array_sort(collect_list(struct(_b, _n, {parts})))").alias("_all"))
    for c in columns:
        # z: what goes into the next block: the mean, how many rows have gone by since the last value, how many values.
        none = "struct(cast(null as double) as y, 0L as g, 0L as k)"
        enter = f"if(z.y is null, b._f_{c}.x, {wait.replace('g)', f'z.g + b._f_{c}.i)')} * z.y + (1 - {wait.replace('g)', f'z.g + b._f_{c}.i)')}) * b._f_{c}.x)"
        step = f"if(b._e_{c}.k = 0, struct(z.y as y, z.g + b._n as g, z.k as k), struct(b._e_{c}.p * ({enter}) + b._e_{c}.q as y, cast(b._n - b._e_{c}.s as bigint) as g, z.k + b._e_{c}.k as k))"
        series = series.withColumn(f"_z_{c}", F.expr(f"aggregate(_all, struct({none} as z, cast(array() as array<struct<y:double,g:bigint,k:bigint,f:struct<i:int,x:double>>>) as into), (t, b) -> struct(element_at(transform(array(t.z), z -> {step}), 1) as z, concat(t.into, array(struct(t.z.y as y, t.z.g as g, t.z.k as k, b._f_{c} as f))) as into)).into"))
    into = series.select(*by, F.explode(F.arrays_zip(F.col("_all._b").alias("_b"), *[F.col(f"_z_{c}") for c in columns])).alias("_x")).select(*by, F.col("_x._b").alias("_b"), *[F.col(f"_x._z_{c}") for c in columns])
    out = rows.join(into, [*by, "_b"])
    for c in columns:
        z = f"_z_{c}"
        enter = wait.replace("g)", f"{z}.g + {z}.f.i)")
        first = f"if({z}.y is null, {z}.f.x, {enter} * {z}.y + (1 - {enter}) * {z}.f.x)"
        mean = f"if(_k_{c} = 0, {z}.y, exp(_p_{c}) * ({first}) + _q_{c})"
        out = out.withColumn(c, F.expr(f"if({z}.k + _k_{c} >= {n}, {mean}, null)"))
    return out.select(*df.columns)
