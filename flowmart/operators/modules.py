"""Feature modules: named builders with a declared grain, checked when they are built."""

from __future__ import annotations

import warnings
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowmart.operators.joins import assert_unique, join_modules

REGISTRY: dict[str, Module] = {}
GRAINS = {"ticker": ("date", "ticker"), "market": ("date",)}


@dataclass(frozen=True)
class Module:
    name: str
    grain: str
    build: Callable[[Mapping[str, DataFrame]], DataFrame]

    def run(self, sources: Mapping[str, DataFrame], most_null: float = 0.5) -> DataFrame:
        """The module's table, with a unique key; columns that are null in more than `most_null` of the rows are warned of."""
        out, keys = self.build(sources), GRAINS[self.grain]
        missing = [k for k in keys if k not in out.columns]
        if missing:
            raise ValueError(f"module {self.name} lacks {', '.join(missing)}")
        assert_unique(out, keys)
        cols = [c for c in out.columns if c not in keys]
        row = out.agg(F.count("*").alias("_n"), *[F.count(c).alias(c) for c in cols]).first()
        sparse = [c for c in cols if row["_n"] and row[c] < (1 - most_null) * row["_n"]]
        if sparse:
            warnings.warn(f"module {self.name}: mostly null: {', '.join(sparse)}", stacklevel=2)
        return out


def feature_module(name: str, grain: str = "ticker") -> Callable:
    """Registers build(sources) -> DataFrame under a name."""
    if grain not in GRAINS:
        raise ValueError(f"unknown grain: {grain}")

    def register(build: Callable[[Mapping[str, DataFrame]], DataFrame]) -> Callable:
        REGISTRY[name] = Module(name, grain, build)
        return build

    return register


def assemble(core: DataFrame, sources: Mapping[str, DataFrame], names: Sequence[str] | None = None) -> DataFrame:
    """core with the features of all (or the named) registered modules."""
    return join_modules(core, {n: REGISTRY[n].run(sources) for n in (names or REGISTRY)})
