"""All registered queries of the library, and their SQL."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowmart.plans.views import with_views

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(views: str = "", sql: str | None = None) -> Callable:
    """Registers a query under its function's name, with its SQL over the named views."""

    def register(f: Callable[[SparkSession, str], DataFrame]) -> Callable:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = with_views(views, sql)
        return f

    return register


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder that driver and executors share: in spark.checkpoint.dir, else in the checkpoint folder that was set;
    where all is one machine, else in the warehouse."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not named and not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    named = named or f"{spark.conf.get('spark.sql.warehouse.dir')}/_shared"
    return f"{named.rstrip('/')}/{label}-{uuid.uuid4().hex}"


def rd(c: str | Column, n: int = 6) -> Column:
    """In steps of 10^-n, so that sums in another order give the same value. Values change step a little above the
    middle between two, where no quotient of short decimals lies."""
    c = F.col(c) if isinstance(c, str) else c
    return F.floor(c * float(10**n) + 0.4871) / float(10**n)


def day(c: str = "date") -> Column:
    """A date as text."""
    return F.col(c).cast("date").cast("string")


def shown(df: DataFrame, *cols: str, days: tuple[str, ...] = ("date",), digits: int = 6) -> DataFrame:
    """The columns asked for: dates as text, doubles rounded."""
    kinds = dict(df.dtypes)
    made = [day(c).alias(c) if c in days else rd(c, digits).alias(c) if kinds[c] in ("double", "float") else F.col(c) for c in cols]
    return df.select(*made)


def r(*cols: str, n: int = 6) -> str:
    """SQL: columns (or `expression AS name`) in the steps of rd()."""
    out = []
    for c in cols:
        expr, _, name = c.rpartition(" AS ")
        out.append(f"floor(({expr or name}) * 1e{n} + 0.4871) / 1e{n} AS {name}")
    return ", ".join(out)


from flowmart.plans import q_aggs, q_bars, q_joins, q_policy, q_rows, q_streams, q_windows  # noqa: E402, F401  they register themselves
