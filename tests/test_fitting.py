"""Models made from one scan's counts against Spark's own estimators."""

import pytest
from pyspark.ml import Pipeline
from pyspark.ml.feature import IDF
from pyspark.sql import functions as F

import samples
from tramline import fixed_values as fv
from tramline.operators import classify, features, fitting, vocabulary
from tramline.session import materialise


@pytest.fixture(scope="module")
def built(spark):
    return materialise(features.build(samples.messages(spark, 40)), "fitting-built")


def test_same_as_separate_fits(built):
    counter = vocabulary.RankedCountVectorizer(inputCol="filtered_words", outputCol="tf_features", minDF=2.0)
    idf = IDF(inputCol="tf_features", outputCol="text_features")
    apart = Pipeline(stages=[classify.stop_words(), counter, idf, classify.indexers(), classify.encoder()]).fit(built)
    fused = classify.feature_stages(min_df=2.0).fit(built)
    assert fused.stages[1].vocabulary == apart.stages[1].vocabulary
    assert fused.stages[2].getScalingVec().toArray().tolist() == pytest.approx(apart.stages[2].idf.toArray().tolist())
    assert [s.labelsArray[0] for s in fused.stages[3:-1]] == list(apart.stages[3].labelsArray)
    assert list(fused.stages[-1].categorySizes) == list(apart.stages[-1].categorySizes)
    columns = ["id", classify.LABEL_INDEX, *[c for c in classify.feature_columns() if c.endswith("_vec")], "tf_features"]
    rows = [sorted(map(str, m.transform(built).select(*columns).collect())) for m in (fused, apart)]
    assert rows[0] == rows[1]


def test_counts_of_repeated_null_and_empty_words(spark):
    rows = spark.createDataFrame(
        [(["b", "a", "b"], "x"), (["a", None], None), ([], "x"), (None, "y"), (["a"], "x")], "words array<string>, c string"
    )
    found = {(r.kind, r.term): (r.tf, r.df) for r in fitting.counts(rows, "words", ["c"]).collect()}
    assert {k: v for k, v in found.items() if k != (0, None)} == {
        (-1, None): (5, 5), (0, "a"): (3, 3), (0, "b"): (2, 1), (1, "x"): (3, 3), (1, "y"): (1, 1), (1, None): (1, 1),
    }


def test_one_scan_and_a_saved_model(spark, built, plan_of, folder):
    plan = plan_of(fitting.counts(classify.stop_words().transform(built), "filtered_words", [fv.LABEL]))
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1
    model = classify.feature_stages(min_df=0.1).fit(built)
    classify.save_model(model, f"{folder}/m")
    back = classify.load_model(f"{folder}/m")
    assert classify.labels_of(back) == classify.labels_of(model)
    total = F.sum(F.size(F.unwrap_udt("text_features")["values"]))
    assert back.transform(built).agg(total).first() == model.transform(built).agg(total).first()


def test_words_are_folded_before_spark_aggregates_them(spark, built, plan_of):
    """A row per word of the text would make the aggregation's input as large as the text."""
    plan = plan_of(fitting.counts(classify.stop_words().transform(built), "filtered_words", [fv.LABEL]))
    assert "MapInArrow" in plan and "Generate" not in plan
    rows = spark.range(300, numPartitions=2).selectExpr("array_repeat('x', 100) AS words", "'c' AS c")
    found = {(r.kind, r.term): (r.tf, r.df) for r in fitting.counts(rows, "words", ["c"]).collect()}
    assert found == {(-1, None): (300, 300), (0, "x"): (30_000, 300), (1, "c"): (300, 300)}


def test_counts_by_parts_of_a_batch(spark, monkeypatch):
    rows = spark.createDataFrame([(["a", "b", "a"],), (None,), (["b", None],), ([],), (["c"],), (["a"],)], "words array<string>").coalesce(1)
    monkeypatch.setattr(fitting, "_CHUNK_WORDS", 2)
    found = {(r.kind, r.term): (r.tf, r.df) for r in fitting.counts(rows, "words").collect()}
    assert found == {(-1, None): (6, 6), (0, "a"): (3, 2), (0, "b"): (2, 2), (0, "c"): (1, 1)}


def test_no_common_word(spark, built):
    with pytest.raises(ValueError, match="minDF"):
        classify.text_stages(min_df=10_000).fit(built)
    with pytest.raises(ValueError, match="minDF"):
        classify.text_stages().fit(built.limit(0))
