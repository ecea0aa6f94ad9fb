"""Shared folders, table sources and the order of sorted reports."""

from types import SimpleNamespace

import pytest

from revtrellis.catalog.registry import spark_queries
from revtrellis.session import scratch_path, shared_folder
from revtrellis.sources.tables import CatalogSource, FolderSource, FrameSource

QUERIES = spark_queries()


def _session(master, **conf):
    values = {k.replace("_", "."): v for k, v in conf.items()}
    return SimpleNamespace(conf=SimpleNamespace(get=lambda k, *default: values.get(k, *default)), sparkContext=SimpleNamespace(master=master))


def test_shared_folder_is_the_one_the_cluster_names():
    assert shared_folder(_session("yarn", spark_checkpoint_dir="hdfs:///shared", **{"spark_sql_warehouse_dir": "file:/tmp/w"})) == "hdfs:///shared"
    assert shared_folder(_session("yarn", spark_sql_warehouse_dir="s3a://bucket/w")).startswith("s3a://bucket/w/")
    assert shared_folder(_session("local[4]", spark_sql_warehouse_dir="file:/tmp/w")).startswith("file:/tmp/w/")


def test_cluster_without_shared_folder_is_an_error():
    for master in ("yarn", "spark://host:7077", "local-cluster[2,1,1024]"):
        with pytest.raises(ValueError, match="spark.checkpoint.dir"):
            shared_folder(_session(master, spark_sql_warehouse_dir="file:/tmp/w"))


def test_scratch_paths_differ(spark):
    assert scratch_path(spark, "x") != scratch_path(spark, "x")


def test_sources_name_tables(spark, testdata):
    folder = FolderSource(spark, testdata)
    rows = folder.table("region").count()
    assert rows == 5
    assert FrameSource(spark, {"r": folder.table("region")}).table("r").count() == rows
    folder.table("region").write.mode("overwrite").saveAsTable("session_test_region")
    try:
        assert CatalogSource(spark, "default", names={"area": "session_test_region"}).table("area").count() == rows
    finally:
        spark.sql("DROP TABLE session_test_region")


def _sorted(values, descending):
    present = [v for v in values if v is not None]
    return present == sorted(present, reverse=descending)


@pytest.mark.parametrize(
    "name, column, descending",
    [("srt_order_desc", "end_date", True), ("pipe_orphans", "base_price", True), ("pipe_expired_deals", "active_shops", True), ("pipe_outbound_activity", "completed_date", False)],
)
def test_reports_come_in_order(spark, testdata, name, column, descending):
    rows = QUERIES[name](spark, testdata).collect()
    assert len(rows) > 1 and _sorted([r[column] for r in rows], descending)
