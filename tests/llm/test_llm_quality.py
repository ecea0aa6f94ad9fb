"""Quality classifier: held-out accuracy and defined results."""

import pytest
from pyspark.sql import functions as F

from revtrellis.llm import quality


@pytest.fixture(scope="module")
def tables(spark):
    path = "/root/testdata/sf0.01"
    return spark.read.parquet(f"{path}/documents.parquet"), spark.read.parquet(f"{path}/labels.parquet")


def test_unseen_labels_are_predicted(spark, tables):
    docs, labels = tables
    unseen = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(3)) == 0
    scored = quality.classify(docs, labels.filter(~unseen))
    both = scored.join(labels.filter(unseen), "doc_id").toPandas()
    right = both.accepted == (both.quality == 1)
    assert len(both) > 80 and right.mean() >= 0.97
    assert both[both.quality == 1].accepted.mean() >= 0.98
    assert both.score.between(0, 1).all() and scored.count() == docs.count()


def test_rows_pass_with_all_columns(spark, tables):
    docs, labels = tables
    odd = docs.limit(150).withColumns({"score": F.lit("x"), "accepted": F.lit(1), "meta": F.array(F.lit(2))})
    extra = spark.createDataFrame([(None, None, None, None, None), (10**9, "", "xx", None, -5), (10**9, "", "xx", None, -5)], docs.schema)
    odd = odd.unionByName(extra.withColumns({"score": F.lit("x"), "accepted": F.lit(1), "meta": F.array(F.lit(2))}))
    kept = quality.accepted(odd, labels)
    assert kept.columns == odd.columns
    scores = {(r.doc_id, r.accepted) for r in quality.classify(odd, labels).collect()}
    assert {r.doc_id for r in kept.collect()} == {i for i, good in scores if good}


def test_nothing_to_learn_from(spark, tables):
    docs, labels = tables
    for few in (labels.limit(0), labels.filter("quality = 1"), labels.withColumn("quality", F.lit(None).cast("int"))):
        got = quality.classify(docs.limit(20), few).collect()
        assert len(got) == 20 and all(r.accepted and r.score == 1.0 for r in got)


def test_toxic_documents_are_rejected(spark, tables):
    docs, labels = (t.sparkSession.read.parquet(f"/root/testdata/sf0.1/{n}.parquet") for t, n in zip(tables, ("documents", "labels")))
    unseen = F.pmod(F.xxhash64("doc_id", F.lit(11)), F.lit(3)) == 0
    scored = quality.classify(docs, labels.filter(~unseen), toxic_col="toxic")
    both = scored.join(labels.filter(unseen), "doc_id").toPandas()
    toxic, clean = both[(both.toxic == 1) & (both.quality == 1)], both[(both.toxic == 0) & (both.quality == 1)]
    print(f"toxic of good quality: {len(toxic)}, {(~toxic.accepted).mean():.3f} rejected; clean ones: {len(clean)}, {clean.accepted.mean():.3f} accepted; toxic of all: {(~both[both.toxic == 1].accepted).mean():.3f}; bad: {(~both[both.quality == 0].accepted).mean():.3f}")
    assert len(toxic) > 80 and (~toxic.accepted).mean() >= 0.9
    assert clean.accepted.mean() >= 0.98
    assert scored.count() == docs.count()


def test_registered_quality_and_pipeline_reject_toxic_documents(spark):
    import corpus_pipeline
    from revtrellis.llm.queries import spark_queries

    path = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{path}/labels.parquet")
    scored = spark_queries()["op10_quality"](spark, path).join(labels, "doc_id").toPandas()
    kept = corpus_pipeline.keep_good(spark, spark.read.parquet(f"{path}/documents.parquet"), path).join(labels, "doc_id")
    toxic, clean, bad = scored[(scored.toxic == 1) & (scored.quality == 1)], scored[(scored.toxic == 0) & (scored.quality == 1)], scored[scored.quality == 0]
    assert len(toxic) > 30 and (~toxic.accepted).mean() >= 0.6  # few labels here to learn from
    assert clean.accepted.mean() >= 0.97 and bad.accepted.mean() <= 0.1
    assert kept.count() == scored.accepted.sum()


def test_labels_are_bounded_by_hash_and_counted_once_per_class(spark):
    docs = spark.createDataFrame([(i, f"word{i % 2} " * 30, "en", "web", 5) for i in range(200)] + [(None, "x", None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    labels = spark.createDataFrame([(i, i % 2, i % 2) for i in range(200)] * 2 + [(3, 0, None), (None, 1, 1), (999, 1, 0), (5, 7, None)], "doc_id long, quality int, toxic int")
    spec = quality.CoTraining(most_labels=50)
    few = quality.marks(labels, spec, "quality", "toxic")
    assert len(few) == 50 and few == {i: quality.marks(labels, quality.CoTraining(), "quality", "toxic")[i] for i in few}
    assert quality.marks(labels, quality.CoTraining(), "quality", "toxic")[3] == ([0, 1], [1])
    table = quality.features(docs, few)
    assert table.filter("size(good) > 0").count() == len([i for i in few if i < 200]) and table.filter("size(words) > 0 AND size(good) = 0").count() == 0
    plan = table._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Exchange" not in plan


def test_too_few_of_a_class_reject_nothing(spark, tables):
    docs, labels = tables
    few = labels.filter("quality = 1 AND toxic = 0").unionByName(labels.filter("quality = 0 OR toxic = 1").limit(15))
    assert quality.classify(docs, few, toxic_col="toxic").filter("NOT accepted").count() == 0
