"""Average directional index: two rounds of Wilder means, each by blocks of time."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowmart.operators.scans import wilder_means


def wilder_adx(daily: DataFrame, n: int = 14, width: int = 128) -> DataFrame:
    """(date, ticker, adx, di_plus, di_minus, di_diff) from daily bars (date, ticker, high, low, close), unique by date
    and ticker; null until n values are known. `width` is the length in days of the blocks that a series is cut into.

    The previous bar of a block's first one is carried in from the last block that has rows.
    """
    keys = ["ticker"]
    rows = daily.select("date", "ticker", "high", "low", "close", F.floor(F.unix_date("date") / width).alias("_b"))
    ends = rows.groupBy(*keys, "_b").agg(F.max_by(F.struct("high", "low", "close"), "date").alias("_end"))
    ends = ends.select(*keys, "_b", F.lag("_end").over(Window.partitionBy(*keys).orderBy("_b")).alias("_in"))
    own = F.lag(F.struct("high", "low", "close")).over(Window.partitionBy(*keys, "_b").orderBy("date"))
    rows = rows.withColumn("_own", own).join(ends, [*keys, "_b"]).withColumn("_was", F.coalesce("_own", "_in"))
    up, down = F.col("high") - F.col("_was.high"), F.col("_was.low") - F.col("low")
    moves = rows.select(
        "date",
        "ticker",
        F.greatest(F.col("high") - F.col("low"), F.abs(F.col("high") - F.col("_was.close")), F.abs(F.col("low") - F.col("_was.close"))).alias("range"),
        F.when((up > down) & (up > 0), up).otherwise(0.0).alias("plus"),
        F.when((down > up) & (down > 0), down).otherwise(0.0).alias("minus"),
    )
    m = wilder_means(moves, keys, "date", ["range", "plus", "minus"], n, width)
    share = lambda c: 100 * F.col(c) / F.nullif("range", F.lit(0.0))
    m = m.select("date", "ticker", share("plus").alias("di_plus"), share("minus").alias("di_minus"))
    total = F.col("di_plus") + F.col("di_minus")
    m = m.withColumn("adx", 100 * F.abs(F.col("di_plus") - F.col("di_minus")) / F.nullif(total, F.lit(0.0)))
    m = wilder_means(m, keys, "date", ["adx"], n, width)
    return m.select("date", "ticker", "adx", "di_plus", "di_minus", (F.col("di_plus") - F.col("di_minus")).alias("di_diff"))
