"""Parameter sheets and membership lists."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SCORECARD_SHEET = T.StructType(
    [
        T.StructField("team_group", T.StringType()),
        T.StructField("system", T.StringType()),
        T.StructField("metric", T.StringType()),
        T.StructField("points", T.DoubleType()),
        T.StructField("unit", T.StringType()),
        T.StructField("metric_group", T.StringType()),
        T.StructField("metric_subgroup", T.StringType()),
        T.StructField("definition", T.StringType()),
        T.StructField("targets", T.DoubleType()),
        T.StructField("denominator", T.DoubleType()),
    ]
)
SCORECARD_KEY = ("team_group", "metric")


class SheetError(ValueError):
    """More lines of a sheet are unusable than allowed."""


@dataclass(frozen=True)
class Sheet:
    """rows: the usable lines. rejects: the others, with their text cells and the reason."""

    rows: DataFrame
    rejects: DataFrame


def read_sheet(spark: SparkSession, path: str, schema: T.StructType = SCORECARD_SHEET) -> DataFrame:
    """A sheet exported as CSV: first line is the header, types are declared, not inferred."""
    return spark.read.schema(schema).option("header", True).csv(path)


def check_sheet(lines: DataFrame, schema: T.StructType, key: tuple[str, ...] = (), required: tuple[str, ...] = ()) -> Sheet:
    """Split text lines into typed rows and rejects.

    A line is rejected if a cell does not fit its type, a required cell is empty, or another line has the same key: all
    lines of that key are, since none can be told to be the right one. Empty cells are nulls of any type.
    """
    reasons = []
    for field in schema.fields:
        cell = F.nullif(F.trim(field.name), F.lit(""))
        if not isinstance(field.dataType, T.StringType):
            unfit = cell.isNotNull() & cell.try_cast(field.dataType).isNull()
            reasons.append(F.when(unfit, F.concat(F.lit(f"{field.name} is no {field.dataType.simpleString()}: "), field.name)))
        if field.name in required:
            reasons.append(F.when(cell.isNull(), F.lit(f"{field.name} is empty")))
    if key:
        # A sheet is a list of parameters, some lines per group, so the lines of a key fit anywhere.
        repeats = F.count("*").over(Window.partitionBy(*key))
        reasons.append(F.when((repeats > 1) & F.concat(*key).isNotNull(), F.concat(F.lit("repeated key: "), F.concat_ws(" / ", *key))))
    names = [f.name for f in schema.fields]
    judged = lines.select(*names, F.concat_ws("; ", *reasons).alias("reason")) if reasons else lines.select(*names, F.lit("").alias("reason"))
    typed = [F.col(f.name) if isinstance(f.dataType, T.StringType) else F.nullif(F.trim(f.name), F.lit("")).try_cast(f.dataType).alias(f.name) for f in schema.fields]
    return Sheet(judged.filter("reason = ''").select(*typed), judged.filter("reason <> ''"))


def read_checked_sheet(
    spark: SparkSession,
    path: str,
    schema: T.StructType = SCORECARD_SHEET,
    key: tuple[str, ...] = SCORECARD_KEY,
    required: tuple[str, ...] = ("metric",),
    most_rejects: int | None = 0,
) -> Sheet:
    """A sheet exported as CSV, its header checked by name, its lines as in ``check_sheet``.

    More than ``most_rejects`` rejected lines raise an error that names the first ones (null: any number is allowed).
    """
    lines = spark.read.option("header", True).option("inferSchema", False).csv(path)
    missing = [f.name for f in schema.fields if f.name not in lines.columns]
    if missing:
        raise SheetError(f"columns missing in {path}: {', '.join(missing)}")
    sheet = check_sheet(lines, schema, key, required)
    if most_rejects is not None:
        found = [r["reason"] for r in sheet.rejects.select("reason").limit(most_rejects + 1).collect()]
        if len(found) > most_rejects:
            raise SheetError(f"more than {most_rejects} lines of {path} are unusable: {' | '.join(found[:10])}")
    return sheet


def membership_flag(df: DataFrame, members: DataFrame, key: str, out: str) -> DataFrame:
    """'Y' for rows whose key is in the list, else 'N'. The list is a table, not a literal."""
    listed = members.select(key).distinct().withColumn("_listed", F.lit(True))
    return df.join(listed, key, "left").withColumn(out, F.when(F.col("_listed"), "Y").otherwise("N")).drop("_listed")


def keep_members(df: DataFrame, members: DataFrame, key: str) -> DataFrame:
    return df.join(members.select(key), key, "left_semi")
