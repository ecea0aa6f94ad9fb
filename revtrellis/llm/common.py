"""Helpers the operators share: sizing, shipping the package to the workers, tables in the shared folder."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from revtrellis.session import scratch_path

PACKAGE = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> SparkSession:
    """Give the Python workers this package (once per application), so that tasks can import it on any node.

    The archive is made on the driver, and Spark hands it out; no executor reads the driver's folder.
    """
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        folder = tempfile.mkdtemp(prefix="revtrellis-package-")
        path = os.path.join(folder, "revtrellis_package.zip")
        with zipfile.ZipFile(path, "w") as out:
            for top, _, names in os.walk(PACKAGE):
                for name in sorted(names):
                    if name.endswith(".py"):
                        full = os.path.join(top, name)
                        out.write(full, os.path.join("revtrellis", os.path.relpath(full, PACKAGE)))
        context.addPyFile(path)
        _SHIPPED.add(context.applicationId)
    return spark


def partitions(spark: SparkSession) -> int:
    """Number of shuffle partitions the cluster is sized for; block and shard counts follow it."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def read(spark: SparkSession, path: str, table: str, *columns: str) -> DataFrame:
    return spark.read.parquet(f"{path}/{table}.parquet").select(*columns)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows of df from a table written to the shared folder: computed once, and not lost with an executor."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bucket(column: str | Column, n: int) -> Column:
    """Bucket 0..n-1 of a value; null has one as well."""
    return F.pmod(F.xxhash64(column), F.lit(n)).cast("int")


def slices(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The same rows in small batches, so that a worker holds few texts in several forms at a time."""
    for batch in batches:
        for lo in range(0, batch.num_rows, rows):
            yield batch.slice(lo, rows)
