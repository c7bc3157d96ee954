"""Declared tables: key, columns and types."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableSpec:
    name: str
    key: tuple[str, ...]
    ddl: str

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)
