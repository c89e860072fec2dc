"""Cross-validation by subtraction against Spark's own search, and edge rows."""

import pytest
from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

import samples
from tramline.operators import classify, features, folds
from tramline.session import materialise


def vectors(spark, rows):
    """Rows of (id, fold, label, values)."""
    listed = spark.createDataFrame(rows, "id string, fold int, cause_index double, v array<double>")
    return listed.select("id", "fold", "cause_index", array_to_vector("v").alias("features"))


def found(df):
    return sorted((r.smoothing, r.fold, r.n_rows, r.n_hits) for r in df.collect())


def test_same_accuracies_as_the_search(spark):
    built = materialise(features.build(samples.messages(spark, 60)), "folds-built")
    stages = classify.feature_stages(min_df=1).fit(built)
    ready = stages.transform(built).select("id", classify.LABEL_INDEX, *classify.feature_columns())
    dealt = materialise(classify.with_fold(ready, "id"), "folds-ready")
    search = classify.tune("naive_bayes", dealt, grids={"naive_bayes": {"smoothing": [0.5, 1.0, 2.0]}})
    choice = folds.choose(materialise(classify.vectors("naive_bayes", dealt), "folds-vectors"), "id", (0.5, 1.0, 2.0))
    assert list(choice.accuracies.values()) == pytest.approx(search.avgMetrics)
    assert choice.smoothing == search.bestModel.stages[-1].getSmoothing()


def test_repeated_rows_null_labels_and_absent_classes(spark):
    rows = [("a", 0, 0.0, [2.0, 0.0]), ("b", 1, 0.0, [3.0, 0.0]), ("c", 1, 1.0, [0.0, 4.0]), ("d", 0, 2.0, [0.0, 0.0])]
    rows += [("a", 0, 0.0, [2.0, 0.0])] * 2 + [("a", 0, 1.0, [0.0, 5.0]), (None, 1, 0.0, [1.0, 0.0]), ("e", 1, None, [9.0, 9.0])]
    # Fold 0 is judged by fold 1, which has no class 2: "d" cannot be right.
    assert found(folds.hits(vectors(spark, rows), "id", (1.0,))) == [(1.0, 0, 5, 4), (1.0, 1, 3, 3)]
    whole = [(a, *r[1:]) for a in (0.5, 1.0) for r in found(folds.hits(vectors(spark, rows), "id", (a,)))]
    assert found(folds.hits(vectors(spark, rows), "id", (0.5, 1.0))) == whole


def test_empty(spark):
    empty = vectors(spark, [])
    assert found(folds.hits(empty, "id")) == []
    with pytest.raises(ValueError, match="no labelled rows"):
        folds.choose(empty, "id")


def test_one_scan_for_the_sums(spark, plan_of):
    rows = materialise(vectors(spark, [("a", 0, 0.0, [1.0, 2.0])]), "folds-plan")
    plan = plan_of(folds.statistics(rows).select(F.col("total")))
    assert plan.count("FileScan parquet") == 1 and plan.count("Exchange hashpartitioning") == 1
