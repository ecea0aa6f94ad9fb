"""Named tables from a folder, a catalog schema, or given DataFrames."""

from __future__ import annotations

from collections.abc import Mapping
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class TableSource(Protocol):
    spark: SparkSession

    def table(self, name: str) -> DataFrame: ...


class FolderSource:
    """One file or folder per table: ``<path>/<name><suffix>``."""

    def __init__(self, spark: SparkSession, path: str, file_format: str = "parquet", suffix: str = ".parquet"):
        self.spark, self.path, self.file_format, self.suffix = spark, path.rstrip("/"), file_format, suffix

    def table(self, name: str) -> DataFrame:
        return self.spark.read.format(self.file_format).load(f"{self.path}/{name}{self.suffix}")


class CatalogSource:
    """Tables of one catalog schema, renamed where the warehouse uses other names."""

    def __init__(self, spark: SparkSession, schema: str, names: Mapping[str, str] | None = None):
        self.spark, self.schema, self.names = spark, schema, dict(names or {})

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.schema}.{self.names.get(name, name)}")


class FrameSource:
    """Tables that already are DataFrames."""

    def __init__(self, spark: SparkSession, frames: Mapping[str, DataFrame]):
        self.spark, self.frames = spark, dict(frames)

    def table(self, name: str) -> DataFrame:
        return self.frames[name]


def scan(source: TableSource, name: str, *columns: str) -> DataFrame:
    """Read a named table, only the given columns."""
    df = source.table(name)
    return df.select(*columns) if columns else df


class SchemaError(ValueError):
    """A table does not have the columns that are declared for it."""


def schema_problems(df: DataFrame, declared: T.StructType) -> list[str]:
    """Missing and retyped columns. More columns are allowed, and so is a column that never is null where nulls are."""
    have = {f.name: f.dataType for f in df.schema.fields}
    out = []
    for field in declared.fields:
        if field.name not in have:
            out.append(f"{field.name} is missing")
        elif have[field.name].simpleString() != field.dataType.simpleString():
            out.append(f"{field.name} is {have[field.name].simpleString()}, not {field.dataType.simpleString()}")
    return out


class CheckedSource:
    """A source whose tables are held against declared schemas when they are opened, before any job runs.

    Only the declared columns are returned, so a report cannot come to depend on others.
    """

    def __init__(self, source: TableSource, schemas: Mapping[str, T.StructType]):
        self.spark, self.source, self.schemas = source.spark, source, dict(schemas)

    def table(self, name: str) -> DataFrame:
        df = self.source.table(name)
        declared = self.schemas.get(name)
        if declared is None:
            return df
        if problems := schema_problems(df, declared):
            raise SchemaError(f"{name}: {'; '.join(problems)}")
        return df.select(*declared.fieldNames())

    def check(self, *names: str) -> None:
        """All problems of the named tables (of all declared ones by default) at once."""
        found = {}
        for name in names or sorted(self.schemas):
            if problems := schema_problems(self.source.table(name), self.schemas[name]):
                found[name] = problems
        if found:
            raise SchemaError("; ".join(f"{name}: {', '.join(p)}" for name, p in found.items()))
