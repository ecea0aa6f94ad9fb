"""Staged refreshes, sheets with unusable lines, declared schemas."""

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from revtrellis.lens.source import LensSource
from revtrellis.params.entity_schemas import entity_schemas
from revtrellis.sources import sinks
from revtrellis.sources.sheets import SCORECARD_SHEET, SheetError, check_sheet, read_checked_sheet
from revtrellis.sources.tables import CheckedSource, FrameSource, SchemaError


def _rows(df):
    return sorted(map(tuple, df.collect()), key=repr)


def _names(spark):
    return [t.name for t in spark.catalog.listTables() if t.name.startswith("refreshed")]


@pytest.fixture
def table(spark):
    spark.sql("DROP TABLE IF EXISTS refreshed")
    yield "refreshed"
    for name in _names(spark):
        spark.sql(f"DROP TABLE {name}")


def _failing(spark, rows):
    """Rows of which the last one fails midway through writing."""
    return spark.createDataFrame(rows, "k string, n int").repartition(4).withColumn("n", F.when(F.col("n") == 3, F.raise_error(F.lit("broken row")).cast("int")).otherwise(F.col("n")))


@pytest.mark.parametrize("partition_by", [None, ["k"]])
@pytest.mark.parametrize("external", [False, True])
def test_a_failed_refresh_keeps_the_old_rows(spark, table, tmp_path, partition_by, external):
    path = str(tmp_path / "t") if external else None
    old = [("a", 1), ("b", 2)]
    sinks.replace_table(spark.createDataFrame(old, "k string, n int"), table, partition_by, path)
    with pytest.raises(Exception, match="broken row"):
        sinks.replace_table(_failing(spark, [("a", 1), ("b", 2), ("c", 3)]), table, partition_by, path)
    with pytest.raises(sinks.RefreshError, match="missing"):
        sinks.replace_table(spark.createDataFrame([("a",)], "k string"), table, None, path, checks=(sinks.same_columns,))
    with pytest.raises(sinks.RefreshError, match="less than"):
        sinks.replace_table(spark.createDataFrame(old[:0], "k string, n int"), table, partition_by, path, checks=(sinks.rows_kept(0.5),))
    with pytest.raises(sinks.RefreshError, match="0 rows"):
        sinks.replace_table(spark.createDataFrame(old[:0], "k string, n int"), table, partition_by, path, checks=(sinks.rows_between(1),))
    assert _rows(spark.table(table).select("k", "n")) == old and _names(spark) == [table]


@pytest.mark.parametrize("partition_by", [None, ["k"]])
@pytest.mark.parametrize("external", [False, True])
def test_a_refresh_may_read_its_own_table(spark, table, tmp_path, partition_by, external):
    path = str(tmp_path / "t") if external else None
    sinks.replace_table(spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int"), table, partition_by, path)
    for _ in range(2):
        doubled = spark.table(table).filter("k <> 'b'").withColumn("n", F.col("n") * 2).select("k", "n")
        sinks.replace_table(doubled, table, partition_by, path, checks=(sinks.same_columns, sinks.rows_between(1, 5)))
    assert _rows(spark.table(table).select("k", "n")) == [("a", 4)] and _names(spark) == [table]
    if external:
        assert len(list((tmp_path / "t").iterdir())) == 1


def test_a_failed_switch_brings_the_old_name_back(spark, table, monkeypatch):
    sinks.replace_table(spark.createDataFrame([("a", 1)], "k string, n int"), table)
    plain = type(spark).sql

    def sql(self, text, *args, **kwargs):
        if text.startswith("ALTER TABLE refreshed__new_"):
            raise RuntimeError("catalog is gone")
        return plain(self, text, *args, **kwargs)

    monkeypatch.setattr(type(spark), "sql", sql)
    with pytest.raises(RuntimeError, match="catalog is gone"):
        sinks.replace_table(spark.createDataFrame([("z", 9)], "k string, n int"), table)
    monkeypatch.undo()
    assert _rows(spark.table(table)) == [("a", 1)] and _names(spark) == [table]


def test_a_folder_is_replaced_as_a_whole(spark, tmp_path):
    path = str(tmp_path / "f")
    sinks.replace_folder(spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int"), path, ["k"])
    with pytest.raises(Exception, match="broken row"):
        sinks.replace_folder(_failing(spark, [("c", 3)]), path, ["k"])
    with pytest.raises(sinks.RefreshError):
        sinks.replace_folder(spark.createDataFrame([("a", 1)], "k string, n int"), path, ["k"], checks=(sinks.rows_kept(0.9),))
    assert _rows(spark.read.parquet(path).select("k", "n")) == [("a", 1), ("b", 2)]
    sinks.replace_folder(spark.read.parquet(path).filter("k = 'a'").select("k", "n"), path, ["k"])
    assert _rows(spark.read.parquet(path).select("k", "n")) == [("a", 1)] and [p.name for p in tmp_path.iterdir()] == ["f"]


SCHEMA = T.StructType([T.StructField("g", T.StringType()), T.StructField("metric", T.StringType()), T.StructField("points", T.DoubleType()), T.StructField("on", T.DateType())])


def test_unusable_lines_are_told_apart(spark):
    lines = [("a", "m1", "5", "2024-01-31"), ("a", "m2", "five", ""), ("a", "m3", " 2.5 ", "2024-02-30"), ("b", "m1", "1", None), ("b", "m1", "2", None), ("b", "", "3", ""), (None, "m9", "", ""), (None, "m9", "", "")]
    sheet = check_sheet(spark.createDataFrame(lines, "g string, metric string, points string, on string"), SCHEMA, ("g", "metric"), ("metric",))
    assert _rows(sheet.rows.select("g", "metric", "points")) == sorted([("a", "m1", 5.0), (None, "m9", None), (None, "m9", None)], key=repr)
    reasons = {(r["g"], r["metric"], r["points"]): r["reason"] for r in sheet.rejects.collect()}
    assert reasons == {
        ("a", "m2", "five"): "points is no double: five", ("a", "m3", " 2.5 "): "on is no date: 2024-02-30", ("b", "m1", "1"): "repeated key: b / m1",
        ("b", "m1", "2"): "repeated key: b / m1", ("b", "", "3"): "metric is empty",
    }


def test_a_malformed_sheet_gives_a_report(spark, tmp_path):
    path = tmp_path / "sheet.csv"
    header = ",".join(SCORECARD_SHEET.fieldNames())
    path.write_text(f"{header}\ng,s,m1,5,u,mg,ms,d,,1\ng,s,m2,x,u,mg,ms,d,,1\n")
    with pytest.raises(SheetError, match="points is no double: x"):
        read_checked_sheet(spark, str(path))
    sheet = read_checked_sheet(spark, str(path), most_rejects=1)
    assert sheet.rows.schema == SCORECARD_SHEET and sheet.rows.count() == 1 and sheet.rejects.count() == 1
    path.write_text("team_group,metric\ng,m\n")
    with pytest.raises(SheetError, match="columns missing.*points"):
        read_checked_sheet(spark, str(path))


def test_columns_are_checked_before_any_job(spark):
    declared = {"t": T.StructType.fromDDL("a bigint, b string, c date"), "u": T.StructType.fromDDL("x int")}
    frames = {"t": spark.range(1).select(F.col("id").alias("a"), F.lit(1).alias("b"), F.lit("x").alias("more")), "u": spark.range(1).select(F.lit(1).alias("x"), F.lit(2).alias("y"))}
    source = CheckedSource(FrameSource(spark, frames), declared)
    with pytest.raises(SchemaError, match="t: b is int, not string; c is missing"):
        source.table("t")
    with pytest.raises(SchemaError, match="t: b is int"):
        source.check()
    source.check("u")
    assert source.table("u").columns == ["x"]


def test_the_test_entities_have_the_declared_columns(spark, testdata):
    CheckedSource(LensSource(spark, testdata), entity_schemas()).check()
