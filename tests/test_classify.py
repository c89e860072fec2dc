import pytest
import samples
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import functions as F

from tramline import fixed_values as fv
from tramline.operators import classify, features, vocabulary
from tramline.plans import learning
from tramline.session import materialise

SMALL_GRIDS = {
    "random_forest": {"numTrees": [5], "maxDepth": [2, 3]},
    "logistic_regression": {"regParam": [0.01, 0.1]},
    "naive_bayes": {"smoothing": [0.5, 1.0]},
}


@pytest.fixture(scope="module")
def built(spark):
    return materialise(features.build(samples.messages(spark, 30)), "test-features")


@pytest.fixture(scope="module")
def prepared(built):
    stages = classify.feature_stages().fit(built)
    return materialise(stages.transform(built).select("id", fv.LABEL, "text_content", classify.LABEL_INDEX, *classify.feature_columns()), "test-prepared")


def words_of(spark, *texts):
    return spark.createDataFrame([(t.split(),) for t in texts], "words array<string>")


def test_term_statistics(spark):
    rows = words_of(spark, "a a b", "a c", "")
    found = {r["term"]: (r["tf"], r["df"]) for r in vocabulary.term_statistics(rows).collect()}
    assert found == {"a": (3, 2), "b": (1, 1), "c": (1, 1)}


def test_ranking_breaks_ties_by_term_and_cuts(spark):
    rows = words_of(spark, "b a d", "a b c", "c b", "e e e")
    ranked = [r["term"] for r in vocabulary.ranked_terms(rows, min_df=2).collect()]
    assert ranked == ["b", "a", "c"]
    assert [r["term"] for r in vocabulary.ranked_terms(rows, min_df=1, size=2).collect()] == ["b", "e"]
    assert [r["term"] for r in vocabulary.ranked_terms(rows, min_df=0.5).collect()] == ["b", "a", "c"]


def test_vectorizer_counts_as_sparks_does(spark, built):
    theirs = CountVectorizer(inputCol="words", outputCol="v", minDF=2.0).fit(built)
    ours = vocabulary.RankedCountVectorizer(inputCol="words", outputCol="v", minDF=2.0).fit(built)
    assert set(ours.vocabulary) == set(theirs.vocabulary)

    def counts(model):
        rows = model.transform(built).select("id", F.unwrap_udt("v").alias("v")).collect()
        return {r["id"]: {model.vocabulary[i]: n for i, n in zip(r["v"]["indices"], r["v"]["values"])} for r in rows}

    assert counts(ours) == counts(theirs)


def test_vectorizer_needs_some_term(spark):
    with pytest.raises(ValueError, match="minDF"):
        vocabulary.RankedCountVectorizer(inputCol="words", outputCol="v").fit(words_of(spark, "a", "b"))


def test_stop_words(spark):
    rows = classify.stop_words().transform(words_of(spark, "le bus est dans la gare"))
    assert rows.first()["filtered_words"] == ["bus", "gare"]


def test_split_depends_on_the_key_only(spark):
    rows = spark.range(5000).withColumnRenamed("id", "k")
    train, test = classify.split(rows, "k")
    assert train.count() + test.count() == 5000 and train.intersect(test).isEmpty()
    assert abs(train.count() / 5000 - 0.8) < 0.03
    again, _ = classify.split(rows.repartition(7), "k")
    assert again.exceptAll(train).isEmpty() and train.exceptAll(again).isEmpty()
    assert classify.sample(test, "k").count() > 0
    nulls = spark.createDataFrame([(None,), (None,)], "k string")
    train, test = classify.split(nulls, "k")
    assert train.count() + test.count() == 2


def test_split_and_sample_without_key(spark):
    rows = spark.range(1000)
    train, test = classify.split(rows)
    assert train.count() + test.count() == 1000
    assert 50 < classify.sample(rows).count() < 150


def test_metrics_equal_sparks_evaluator(spark):
    rows = [(i % 3, (i * 7 % 5) % 4, 1 + i % 4) for i in range(60)]
    rows = [(float(a), float(b)) for a, b, n in rows for _ in range(n)]
    predictions = spark.createDataFrame(rows, "cause_index double, prediction double")
    ours = classify.evaluate(predictions)
    names = {"accuracy": "accuracy", "f1": "f1", "weighted_precision": "weightedPrecision",
             "weighted_recall": "weightedRecall"}
    for mine, theirs in names.items():
        evaluator = MulticlassClassificationEvaluator(labelCol="cause_index", metricName=theirs)
        assert ours[mine] == pytest.approx(evaluator.evaluate(predictions), abs=1e-12)


def test_select_best():
    assert classify.select_best({"a": {"accuracy": 0.5}, "b": {"accuracy": 0.7}, "c": {"accuracy": 0.7}}) == "b"


def test_grids_have_all_settings():
    sizes = {name: len(classify.parameter_grid(name, classify.classifier(name))) for name in fv.TUNING_GRIDS}
    assert sizes == {"random_forest": 9, "logistic_regression": 9, "naive_bayes": 3}


def test_feature_columns():
    assert len(classify.feature_columns()) == 19
    assert set(classify.feature_columns()) - set(classify.feature_columns(False)) == set(fv.LEAKY_FEATURES)


def test_assembler_drops_rows_with_unknown_features(prepared):
    hole = prepared.withColumn(
        "display_duration_hours", F.expr("CASE WHEN id LIKE '1-%' THEN NULL ELSE display_duration_hours END")
    )
    assert classify.assembler().transform(hole).count() == prepared.count() - 4


def test_naive_bayes_takes_negative_durations(prepared):
    negative = prepared.withColumn("display_duration_hours", F.lit(-5.0))
    model = classify.model_stages("naive_bayes").fit(negative)
    assert model.transform(negative).count() == prepared.count()
    unknown = prepared.withColumn("display_duration_hours", F.lit(None).cast("double"))
    assert model.transform(unknown).count() == 0


@pytest.mark.parametrize("name", ["random_forest", "logistic_regression", "naive_bayes", "gbt_one_vs_rest"])
def test_classifiers(built, prepared, name):
    small = {"random_forest": {"numTrees": 5}, "gbt_one_vs_rest": {"maxIter": 2, "maxDepth": 2}}
    model = classify.model_stages(name, **small.get(name, {})).fit(prepared)
    predictions = model.transform(prepared)
    assert all(0 <= v <= 1 for v in classify.evaluate(predictions).values())
    labels = ["ACCIDENT", "INFORMATION", "PERTURBATION", "TRAVAUX"]
    named = classify.with_cause(predictions, labels)
    assert {r[0] for r in named.select("predicted_cause").distinct().collect()} <= set(labels)
    if "probability" in predictions.columns:
        confident = classify.with_confidence(predictions)
        assert confident.filter("confidence < 25 OR confidence > 100.000001").isEmpty()
        total = F.aggregate(classify.vector_to_array("probability"), F.lit(0.0), lambda a, x: a + x)
        assert predictions.filter(F.abs(total - 1) > 1e-9).isEmpty()


def test_unknown_labels_get_the_kept_index_and_no_name(spark, built):
    rows = built.withColumn("cause", F.expr("IF(id LIKE '0-%', NULL, cause)"))
    model = Pipeline(stages=[classify.indexers()]).fit(rows)
    labels = classify.labels_of(model)
    assert labels == ["ACCIDENT", "INFORMATION", "PERTURBATION", "TRAVAUX"]
    indexed = model.transform(rows)
    assert indexed.filter("cause IS NULL").select("cause_index").distinct().collect() == [(4.0,)]
    assert classify.label_map(indexed).count() == 5
    named = classify.with_cause(indexed.withColumn("prediction", F.col("cause_index")), labels)
    assert named.filter("NOT predicted_cause <=> cause").isEmpty()


def test_train_save_load_and_score(spark, built, folder):
    done = learning.train_classifier(built, f"{folder}/classifiers", grids=SMALL_GRIDS, folds=2)
    assert set(done.base) == set(classify.CANDIDATES)
    assert done.best == classify.select_best(done.base)
    assert done.improvement == done.tuned["accuracy"] - done.base[done.best]["accuracy"]
    assert done.test_predictions.count() > 0
    preview = classify.sample_predictions(done.test_predictions, "id")
    assert preview.columns == ["cause", "prediction", "text_content"]

    loaded = classify.load_named(f"{folder}/classifiers", done.best)
    assert isinstance(loaded, PipelineModel)
    scored = learning.score_messages(loaded, samples.messages(spark, 2))
    ours = learning.score_messages(done.model, samples.messages(spark, 2))
    columns = ["id", "prediction", "predicted_cause", "confidence"]
    assert sorted(scored.select(columns).collect()) == sorted(ours.select(columns).collect())
    assert scored.filter("predicted_cause <> cause").isEmpty()
    with pytest.raises(Exception):
        classify.load_named(f"{folder}/classifiers", "no_such_model")


def test_texts_alone_are_scored_without_losing_any(spark, built):
    train = built.drop(*fv.LEAKY_FEATURES).withColumns({"severity_level": F.lit(1), "is_urgent": F.lit(0)})
    stages = classify.feature_stages().fit(train)
    model = classify.model_stages("naive_bayes", include_leaky=False).fit(stages.transform(train))
    whole = PipelineModel(stages=[*stages.stages, *model.stages])
    texts = spark.createDataFrame(list(samples.INTENTS.items()), "expected string, message string")
    scored = learning.score_messages(whole, texts)
    assert {r["expected"]: r["predicted_cause"] for r in scored.collect()} == {c: c for c in samples.INTENTS}
    assert learning.score_messages(whole, classify.one_row(spark, None)).count() == 1


def test_build_features_job(spark, folder):
    rows = samples.messages(spark, 3)
    model = learning.build_features(rows, f"{folder}/features", f"{folder}/json", f"{folder}/text_model")
    out = spark.read.parquet(f"{folder}/features")
    assert out.count() == rows.count() == spark.read.json(f"{folder}/json").count()
    assert {"filtered_words", "tf_features", "text_features"} <= set(out.columns)
    loaded = classify.load_model(f"{folder}/text_model")
    assert loaded.stages[1].vocabulary == model.stages[1].vocabulary
    assert loaded.transform(features.build(rows)).select("id", "text_features").exceptAll(
        out.select("id", "text_features")).isEmpty()


def test_trees_read_bounded_partitions(prepared, monkeypatch):
    """A partition's rows as dense bins stay under the bound; other classifiers keep their partitions."""
    rows = prepared.coalesce(1)
    assert classify.dealt(rows, ["random_forest"]).rdd.getNumPartitions() == 1
    width = classify.vectors("random_forest", rows).select(F.unwrap_udt("features")["size"]).first()[0]
    monkeypatch.setattr(classify, "_TREE_BYTES", 10 * 4 * width)
    found = classify.dealt(rows, ["naive_bayes", "random_forest"])
    sizes = [r["n"] for r in found.groupBy(F.spark_partition_id()).agg(F.count(F.lit(1)).alias("n")).collect()]
    assert found.rdd.getNumPartitions() == -(-rows.count() // 10) and max(sizes) < 20
    assert sorted(r["id"] for r in found.select("id").collect()) == sorted(r["id"] for r in rows.select("id").collect())
    assert classify.dealt(rows, ["naive_bayes"]).rdd.getNumPartitions() == 1
    assert classify.dealt(rows.limit(0), ["random_forest"]).isEmpty()


def test_boosted_trees_hold_one_class_at_a_time():
    """Each class's trees keep all rows as dense bins: several at once would not fit in memory."""
    assert classify.classifier("gbt_one_vs_rest").getParallelism() == 1
