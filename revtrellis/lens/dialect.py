"""The few expressions that Spark SQL and the checking engine spell differently.

A lens entity is written once as SQL text; these helpers fill in the spelling.
``t`` also records which tables an entity reads.
"""

from __future__ import annotations


class Dialect:
    """Common part: table names are collected while an entity is rendered."""

    def __init__(self) -> None:
        self.tables: list[str] = []

    def _note(self, name: str) -> None:
        if name not in self.tables:
            self.tables.append(name)


class SparkText(Dialect):
    def t(self, name: str) -> str:
        self._note(name)
        return "{" + name + "}"

    def add_days(self, day: str, n: str) -> str:
        return f"date_add({day}, CAST({n} AS INT))"

    def at_minute(self, day: str, minutes: str) -> str:
        return f"timestampadd(MINUTE, CAST({minutes} AS INT), CAST({day} AS TIMESTAMP_NTZ))"

    def idiv(self, a: str, b: str) -> str:
        return f"({a} div {b})"

    def struct(self, **fields: str) -> str:
        return "named_struct(" + ", ".join(f"'{k}', {v}" for k, v in fields.items()) + ")"

    def array(self, *items: str) -> str:
        return "array(" + ", ".join(items) + ")"

    def explode(self, *items: str) -> str:
        return "explode(" + self.array(*items) + ")"


class DuckText(Dialect):
    def t(self, name: str) -> str:
        self._note(name)
        return name

    def add_days(self, day: str, n: str) -> str:
        return f"({day} + CAST({n} AS INTEGER))"

    def at_minute(self, day: str, minutes: str) -> str:
        return f"(CAST({day} AS TIMESTAMP) + to_minutes(CAST({minutes} AS BIGINT)))"

    def idiv(self, a: str, b: str) -> str:
        return f"({a} // {b})"

    def struct(self, **fields: str) -> str:
        return "{" + ", ".join(f"'{k}': {v}" for k, v in fields.items()) + "}"

    def array(self, *items: str) -> str:
        return "[" + ", ".join(items) + "]"

    def explode(self, *items: str) -> str:
        return "unnest(" + self.array(*items) + ")"
