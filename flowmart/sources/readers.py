"""Reading and normalising raw tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowmart.functions.exprs import col, normalize_symbol, real
from flowmart.operators.joins import dedup_keep
from flowmart.sources.specs import TableSpec


def read_range(spark: SparkSession, path: str, time_col: str, first: date, last: date, columns: Sequence[str] | None = None) -> DataFrame:
    """Rows from first to last, both days whole, and the columns asked for. Filter and columns reach the scan."""
    df = spark.read.parquet(path)
    df = df.filter((F.col(time_col) >= F.lit(first.isoformat())) & (F.col(time_col) < F.lit((last + timedelta(days=1)).isoformat())))
    return df.select(*columns) if columns else df


def require_columns(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    missing = [c for c in columns if c not in df.columns]
    if missing:
        raise ValueError(f"columns are missing: {', '.join(missing)}")
    return df


def normalize_panel(df: DataFrame, aliases: Mapping[str, str], keys: Sequence[str], numbers: Sequence[str], order: Sequence[str | Column], date_col: str = "date") -> DataFrame:
    """Renames, text keys trimmed and upper-cased, dates as days, numbers coerced (bad ones null), rows without key
    dropped, and of each key the last by `order`."""
    df = require_columns(df.withColumnsRenamed({k: v for k, v in aliases.items() if k in df.columns and v not in df.columns}), [*keys])
    df = df.withColumns({k: F.nullif(F.upper(F.trim(F.col(k).cast("string"))), F.lit("")) for k in keys if k != date_col})
    if date_col in df.columns:
        df = df.withColumn(date_col, F.col(date_col).try_cast("date"))
    df = df.withColumns({n: real(n) for n in numbers if n in df.columns})
    return dedup_keep(df.dropna(subset=[*keys]), keys, order)


def coerce_schema(df: DataFrame, spec: TableSpec, zero_if_null: Sequence[str] = ()) -> DataFrame:
    """Exactly the declared columns and types; what can't be cast or isn't there is null, or 0 where asked."""
    made = []
    for f in spec.schema.fields:
        c = F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        made.append((F.coalesce(c, F.lit(0).cast(f.dataType)) if f.name in zero_if_null else c).alias(f.name))
    return df.select(*made)


def number_from_text(c) -> Column:
    return F.regexp_replace(col(c).cast("string"), ",", "").try_cast("double")


def flatten_payload(df: DataFrame, array_col: str, header: Sequence[str], value: str = "value", volume: str = "volume", texts: Sequence[str] = ()) -> DataFrame:
    """A row for each header and element: numbers without their commas, avg_price = value / volume, else 0."""
    rows = df.select(*header, F.explode(array_col).alias("_e")).select(*header, *[F.col(f"_e.{t}") for t in texts], number_from_text(F.col(f"_e.{value}")).alias(value), number_from_text(F.col(f"_e.{volume}")).alias(volume))
    return rows.withColumn("avg_price", F.when(F.col(volume) > 0, F.col(value) / F.col(volume)).otherwise(0.0))


def parse_event_json(df: DataFrame, json_col: str, schema: str, fields: Mapping[str, str], keep: str | None = None) -> DataFrame:
    """Other columns of df, and named paths into the parsed text. Lines that don't parse, or don't fit `keep` (SQL), go."""
    parsed = df.withColumn("_j", F.from_json(json_col, schema, {"mode": "PERMISSIVE"}))
    out = parsed.select(*[c for c in df.columns if c != json_col], *[F.col(f"_j.{path}").alias(name) for name, path in fields.items()])
    out = out.dropna(how="all", subset=list(fields))
    return out.filter(keep) if keep else out


def clean_bars(df: DataFrame, ts: str = "datetime", zone: str = "Asia/Jakarta", first_hour: int = 9, last_hour: int = 16) -> DataFrame:
    """Bars of the session by local clock (last_hour:00 included) with open, close and some volume; adds local_ts."""
    df = df.withColumn("local_ts", F.from_utc_timestamp(F.col(ts).cast("timestamp"), zone))
    minute = F.hour("local_ts") * 60 + F.minute("local_ts")
    return df.filter(minute.between(first_hour * 60, last_hour * 60)).dropna(subset=["open", "close"]).filter("volume > 0")


def shift_range(df: DataFrame, ts: str, first: str, last: str, offset: str, keys: Sequence[str], order: Sequence[str | Column]) -> DataFrame:
    """Moves the times of a range by an interval ("7 hours"), then keeps the last row of each key."""
    moved = F.when(F.col(ts).between(F.lit(first), F.lit(last)), F.col(ts) + F.expr(f"INTERVAL {offset}")).otherwise(F.col(ts))
    return dedup_keep(df.withColumn(ts, moved), keys, order)


def choose_time_scheme(df: DataFrame, ts: str, ticker: str, offsets: Sequence[int], hours: Sequence[int]) -> DataFrame:
    """The clock of each (date, ticker) among those `offsets` hours ahead: the one that covers most distinct session
    hours, the first on ties. Keeps the session's bars, the last of each hour; adds date, hour and scheme."""
    tried = df.withColumn("_s", F.explode(F.array(*[F.struct(F.lit(i).alias("scheme"), (F.col(ts) + F.expr(f"INTERVAL {h} hours")).alias("at")) for i, h in enumerate(offsets)])))
    tried = tried.select(*df.columns, F.col("_s.scheme").alias("scheme"), F.to_date("_s.at").alias("date"), F.hour("_s.at").alias("hour")).filter(F.col("hour").isin(*hours))
    cover = tried.groupBy("date", ticker, "scheme").agg(F.count_distinct("hour").alias("_n"))
    best = dedup_keep(cover, ["date", ticker], [F.desc("_n"), "scheme"], keep="first").drop("_n")
    return dedup_keep(tried.join(best, ["date", ticker, "scheme"], "left_semi"), ["date", ticker, "hour"], [ts])


def universe(master: DataFrame, ticker: str = "ticker", status: str | None = "status") -> DataFrame:
    """Distinct tickers of a table, only the active ones if it has a status."""
    rows = master.filter(F.col(status) == "ACTIVE") if status else master
    return rows.select(normalize_symbol(ticker).alias("ticker")).dropna().distinct()


def column_families(df: DataFrame, families: Mapping[str, Sequence[str]]) -> DataFrame:
    """Puts each family's prefix before the columns listed for it. Columns that df lacks are passed over, those that
    have the prefix keep their names; a name that is taken is an error."""
    named = {c: c if c.startswith(prefix) else f"{prefix}{c}" for prefix, cols in families.items() for c in cols if c in df.columns}
    after = [named.get(c, c) for c in df.columns]
    twice = sorted({c for c in after if after.count(c) > 1})
    if twice:
        raise ValueError(f"names taken: {', '.join(twice)}")
    return df.withColumnsRenamed(named)


def weekdays(spark: SparkSession, first: date, last: date) -> DataFrame:
    days = spark.range(1).select(F.explode(F.sequence(F.lit(first), F.lit(last))).alias("date"))
    return days.filter(~F.dayofweek("date").isin(1, 7))


def warmup_start(first: date, windows: Sequence[int], mult: int = 5) -> date:
    """The day that lies max(windows) * mult business days before first."""
    left, day = max(windows) * mult, first
    while left:
        day -= timedelta(days=1)
        left -= day.weekday() < 5
    return day


def calendar(df: DataFrame, date_col: str = "date") -> DataFrame:
    """The distinct dates in order, numbered from 1. One row for each day: small after the distinct."""
    days = df.select(date_col).dropna().distinct()
    return days.withColumn("n", F.row_number().over(Window.orderBy(date_col)))
