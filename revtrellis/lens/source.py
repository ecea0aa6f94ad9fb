"""The lens as a table source, and as the WITH clause of a checking query."""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from revtrellis.lens.dialect import DuckText, SparkText
from revtrellis.lens.entities import ENTITIES, RAW_TABLES


class LensSource:
    """Raw test tables by their own name, entities by theirs."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        if name not in self._frames:
            self._frames[name] = self._build(name)
        return self._frames[name]

    def _build(self, name: str) -> DataFrame:
        if name in RAW_TABLES:
            return self.spark.read.parquet(f"{self.path}/{name}.parquet")
        q = SparkText()
        text = ENTITIES[name](q)
        return self.spark.sql(text, **{t: self.table(t) for t in q.tables})


def with_entities(sql: str) -> str:
    """Prefix a checking query with the entities it names."""
    parts: dict[str, str] = {}

    def need(text: str) -> None:
        for name in re.findall(r"\b[a-z_]+\b", text):
            if name in ENTITIES and name not in parts:
                body = ENTITIES[name](DuckText())
                parts[name] = ""
                need(body)
                del parts[name]
                parts[name] = body

    need(sql)
    if not parts:
        return sql
    head = ",\n".join(f"{name} AS ({body})" for name, body in parts.items())
    body = sql.strip()
    return f"WITH {head}{',' + body[4:] if body[:5].upper() == 'WITH ' else chr(10) + body}"
