"""Column expressions. All are null-aware: a missing input gives null unless said otherwise; nothing raises under ANSI."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed values of the market: steps of (price from, value), lowest first.
TICKS = ((0, 1), (200, 2), (500, 5), (2000, 10), (5000, 25))
SPREAD_TICKS = ((0, 2.5), (200, 2.0), (500, 1.5), (2000, 1.5), (5000, 1.0))


def col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def real(c) -> Column:
    """Double, with NaN and text that is no number as null."""
    x = col(c).try_cast("double")
    return F.when(~F.isnan(x), x)


def safe_div(n, d) -> Column:
    """Null where the denominator is 0 or missing."""
    return F.when(col(d) != 0, col(n) / col(d))


def clip(c, low=None, high=None) -> Column:
    """Null stays null."""
    x = col(c)
    y = F.greatest(x, F.lit(low)) if low is not None else x
    y = F.least(y, F.lit(high)) if high is not None else y
    return F.when(x.isNotNull(), y)


def flag(cond: Column) -> Column:
    """1 or 0; a comparison with null is 0."""
    return F.coalesce(cond, F.lit(False)).cast("int")


def steps(c, table: Sequence[tuple[float, float]], from_open: bool = False) -> Column:
    """The value of the last step whose start is at most c (below c, if from_open)."""
    x, out = col(c), F.lit(None)
    for start, value in table:
        out = F.when(x > start if from_open else x >= start, F.lit(value)).otherwise(out)
    return out


def tick_size(price) -> Column:
    return steps(price, ((float("-inf"), 1), *TICKS[1:]))


def spread_frac(price) -> Column:
    """Ticks of spread as a share of the price; 0 for a price that is missing or not above 0."""
    p = col(price)
    return F.when(p > 0, tick_size(p) * steps(p, SPREAD_TICKS) / p).otherwise(0.0)


def limit_pct(price) -> Column:
    """The upper daily limit: 35 % up to 200, 25 % up to 5000, 20 % above; null if not above 0."""
    p = col(price)
    return F.when(p <= 0, None).when(p <= 200, 0.35).when(p <= 5000, 0.25).when(p > 5000, 0.20)


def range_place(c, low, high, flat: float | None = None) -> Column:
    """Where c lies between low and high, 0 to 1; `flat` where there is no range."""
    place = clip(safe_div(col(c) - col(low), col(high) - col(low)), 0.0, 1.0)
    return place if flat is None else F.when(col(high) > col(low), place).when(col(c).isNotNull(), F.lit(flat))


def bucket(rules: Sequence[tuple[Column, str]], otherwise: str, last_wins: bool = False) -> Column:
    """The label of the first rule that holds, or of the last one."""
    out = F.lit(otherwise)
    for cond, label in rules if last_wins else reversed(rules):
        out = F.when(F.coalesce(cond, F.lit(False)), F.lit(label)).otherwise(out)
    return out


def cut(c, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """Bins closed on the right, the lowest edge included; outside of all edges null."""
    x, out = col(c), F.lit(None).cast("string")
    for low, high, label in reversed(list(zip(edges, edges[1:], labels, strict=False))):
        above = x >= low if low == edges[0] else x > low
        out = F.when(above & (x <= high), F.lit(label)).otherwise(out)
    return out


def ln(c) -> Column:
    """Natural logarithm: minus infinity of 0, NaN below it."""
    return F.when(col(c) == 0, F.lit(float("-inf"))).when(col(c) < 0, F.lit(float("nan"))).otherwise(F.log(col(c)))


def sigmoid(c, most: float = 30.0) -> Column:
    return 1 / (1 + F.exp(-clip(c, -most, most)))


def close_enough(a, b, rtol: float = 1e-9, atol: float = 1e-9) -> Column:
    """Both null, or within tolerance."""
    a, b = col(a), col(b)
    return F.coalesce((a.isNull() & b.isNull()) | (F.abs(a - b) <= atol + rtol * F.abs(b)), F.lit(False))


def normalize_symbol(c, keep_dots: bool = True) -> Column:
    """Upper case, only letters, digits and dots, and no market suffix .JK; without dots, if asked."""
    kept = F.regexp_replace(F.regexp_replace(F.upper(F.trim(col(c))), r"[^A-Z0-9.]", ""), r"\.JK$", "")
    return kept if keep_dots else F.regexp_replace(kept, r"\.", "")


def normalize_status(c) -> Column:
    """ACTIVE, SUSPENDED, DELISTED by code or by what the text holds; otherwise the text itself, upper case."""
    s = F.upper(F.trim(col(c)))
    known = F.when(s.isin("A", "N"), "ACTIVE").when(s.isin("S", "SP", "SUS", "I"), "SUSPENDED").when(s.isin("D", "DEL"), "DELISTED")
    return known.when(s.contains("DELIST"), "DELISTED").when(s.contains("SUSPEN"), "SUSPENDED").when(s.contains("ACTIV"), "ACTIVE").otherwise(s)


def coalesce_keys(columns: Sequence[str]) -> Column:
    """The first of the columns that isn't blank."""
    return F.coalesce(*[F.nullif(F.trim(col(c).cast("string")), F.lit("")) for c in columns])


def category_mix(c, mixes: Mapping[str, tuple[int, int, int]], otherwise: tuple[int, int, int] = (34, 33, 33)) -> Column:
    """struct(foreign, local, retail) in percent: of the first name that the text holds, else the even mix."""
    for mix in (*mixes.values(), otherwise):
        if sum(mix) != 100:
            raise ValueError(f"the mix {mix} doesn't add up to 100")
    made = lambda m: F.struct(*[F.lit(v).alias(n) for v, n in zip(m, ("foreign", "local", "retail"), strict=True)])
    text, out = F.lower(col(c)), made(otherwise)
    for name, mix in reversed(mixes.items()):
        out = F.when(text.contains(name.lower()), made(mix)).otherwise(out)
    return out


def argmax_label(labels: Mapping[str, str], otherwise: str = "Unknown") -> Column:
    """The label of the largest column, the first one on ties; `otherwise` where all are missing or none is above 0."""
    best = F.greatest(*[F.coalesce(col(c), F.lit(0)) for c in labels], F.lit(0))
    return bucket([((col(c) == best) & (best > 0), label) for c, label in labels.items()], otherwise)


def stop_take_fill(low, high, close, take: float, stop: float) -> Column:
    """The pessimistic return: the stop if it was reached, else the take, else the close."""
    return F.when(col(low) <= stop, F.lit(stop)).when(col(high) >= take, F.lit(take)).otherwise(col(close))


def all_of(conds: Sequence[Column]) -> Column:
    """A conjunction in which a missing value fails."""
    return reduce(Column.__and__, [F.coalesce(c, F.lit(False)) for c in conds], F.lit(True))


def sample_skew(x: Column, over) -> Column:
    """Bias-corrected skewness over a frame, from three values on."""
    n = F.count(x).over(over)
    return F.when((n >= 3) & (F.stddev_pop(x).over(over) > 0), F.skewness(x).over(over) * F.sqrt(n * (n - 1)) / (n - 2))


def sample_kurtosis(x: Column, over) -> Column:
    """Bias-corrected excess kurtosis over a frame, from four values on."""
    n = F.count(x).over(over)
    return F.when((n >= 4) & (F.stddev_pop(x).over(over) > 0), ((n + 1) * F.kurtosis(x).over(over) + 6) * (n - 1) / ((n - 2) * (n - 3)))
