"""Full-refresh output: new rows are written aside, checked, and only then take the place of the old ones."""

from __future__ import annotations

import re
import uuid
from collections.abc import Callable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

Check = Callable[[DataFrame, DataFrame | None], None]


class RefreshError(ValueError):
    """The new rows did not pass a check; the old ones are still in place."""


def same_columns(new: DataFrame, old: DataFrame | None) -> None:
    """The columns and types of the old rows; order does not matter."""
    if old is not None and sorted(new.dtypes) != sorted(old.dtypes):
        gone, added = sorted(set(old.dtypes) - set(new.dtypes)), sorted(set(new.dtypes) - set(old.dtypes))
        raise RefreshError(f"columns differ: missing {gone}, new {added}")


def rows_between(least: int = 1, most: int | None = None) -> Check:
    def check(new: DataFrame, old: DataFrame | None) -> None:
        n = new.count()
        if n < least or most is not None and n > most:
            raise RefreshError(f"{n} rows; {least} to {'any number' if most is None else most} are allowed")

    return check


def rows_kept(share: float = 0.5) -> Check:
    """At least this share of the old number of rows."""

    def check(new: DataFrame, old: DataFrame | None) -> None:
        if old is not None and new.count() < share * old.count():
            raise RefreshError(f"{new.count()} rows, less than {share:g} of the {old.count()} before")

    return check


def _checked(new: DataFrame, old: DataFrame | None, checks: tuple[Check, ...]) -> None:
    for check in checks:
        check(new, old)


def _table(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None


def replace_table(df: DataFrame, name: str, partition_by: list[str] | None = None, path: str | None = None, checks: tuple[Check, ...] = ()) -> None:
    """Replace one catalog table with the given rows, which may be made from the table itself.

    The rows become a table of their own, in a folder of their own below ``path`` (by default one in the folder of the
    table's database), whose files are what the checks read. Then the names are switched, which moves no data, as the
    files do not belong to a name. Where writing, a check or the switch fails, the
    name still has the old rows, and what was written aside is dropped. Two refreshes of one table do not mix their files; the
    one that switches last stays.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex[:12]
    aside, before = f"{name}__new_{mark}", f"{name}__old_{mark}"
    path = path.rstrip("/") if path else _default_folder(spark, name)
    writer = df.write.mode("errorifexists").format("parquet").option("path", f"{path}/v-{mark}")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.saveAsTable(aside)
        _checked(spark.table(aside), _table(spark, name), checks)
        had_one = spark.catalog.tableExists(name)
        if had_one:
            spark.sql(f"ALTER TABLE {name} RENAME TO {before}")
        try:
            spark.sql(f"ALTER TABLE {aside} RENAME TO {name}")
        except Exception:
            if had_one:
                spark.sql(f"ALTER TABLE {before} RENAME TO {name}")
            raise
    except Exception:
        _drop(spark, aside, f"{path}/v-{mark}")
        raise
    if had_one:
        # Only what an earlier refresh wrote below the same folder is deleted; files elsewhere are not this table's to delete.
        _drop(spark, before, _version_folder(spark, before, path))


def _default_folder(spark: SparkSession, name: str) -> str:
    *database, table = name.split(".")
    folder = spark.catalog.getDatabase(".".join(database) or spark.catalog.currentDatabase()).locationUri
    return f"{folder.rstrip('/')}/{table}__versions"


def _version_folder(spark: SparkSession, table: str, path: str) -> str | None:
    rows = spark.sql(f"DESCRIBE TABLE EXTENDED {table}").filter("col_name = 'Location'").collect()
    folder = rows[0]["data_type"] if rows else ""
    bare = lambda p: re.sub("^[a-z0-9]+:/*", "/", p).rstrip("/")
    return folder if "/v-" in folder and bare(folder.rsplit("/v-", 1)[0]) == bare(path) else None


def _drop(spark: SparkSession, table: str, folder: str | None) -> None:
    try:
        spark.sql(f"DROP TABLE IF EXISTS {table}")
    except AnalysisException:
        pass
    if folder:
        target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
        target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


def replace_folder(df: DataFrame, path: str, partition_by: list[str] | None = None, file_format: str = "parquet", checks: tuple[Check, ...] = (), **options: object) -> None:
    """Replace one output folder with the given rows, which may be read from it.

    They are written to a folder beside it and checked there. Then the old folder is renamed away, the new one takes its name, and
    the old one is deleted; if the new one cannot take it, the old one gets its name back.
    """
    spark, mark = df.sparkSession, uuid.uuid4().hex[:12]
    aside, before = f"{path.rstrip('/')}__new_{mark}", f"{path.rstrip('/')}__old_{mark}"
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    to, new, old = hadoop(path), hadoop(aside), hadoop(before)
    system = to.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    writer = df.write.mode("errorifexists").format(file_format).options(**options)
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    try:
        writer.save(aside)
        if checks:
            read = spark.read.format(file_format).schema(df.schema).options(**options)
            had = system.exists(to)
            _checked(read.load(aside), spark.read.format(file_format).options(**options).load(path) if had and file_format == "parquet" else None, checks)
        had = system.exists(to)
        if had and not system.rename(to, old):
            raise RefreshError(f"{path} cannot be renamed")
        if not system.rename(new, to):
            if had:
                system.rename(old, to)
            raise RefreshError(f"{aside} cannot take the place of {path}")
    except Exception:
        system.delete(new, True)
        raise
    system.delete(old, True)
