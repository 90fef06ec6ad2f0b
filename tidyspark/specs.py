"""Declared table contracts: schema, keys, references, text limits.

A ``TableSpec`` replaces hand-written DDL that no engine enforces: the schema is
used when reading, the key/reference/NULL/length rules are checked by
``tidyspark.operators.audit.audit``.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import types as T


@dataclass(frozen=True)
class ForeignKey:
    columns: tuple[str, ...]
    ref_table: str
    ref_columns: tuple[str, ...]


@dataclass(frozen=True)
class TableSpec:
    name: str
    schema: T.StructType | None = None
    primary_key: tuple[str, ...] = ()
    natural_key: tuple[str, ...] = ()
    not_null: tuple[str, ...] = ()
    foreign_keys: tuple[ForeignKey, ...] = ()
    max_length: dict = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return [] if self.schema is None else [f.name for f in self.schema.fields]


def fk(columns, ref_table: str, ref_columns=None) -> ForeignKey:
    cols = (columns,) if isinstance(columns, str) else tuple(columns)
    refs = cols if ref_columns is None else (
        (ref_columns,) if isinstance(ref_columns, str) else tuple(ref_columns))
    return ForeignKey(cols, ref_table, refs)
