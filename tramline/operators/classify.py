"""Message-cause classifiers: stages, training, evaluation, scoring."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    GBTClassifier,
    LogisticRegression,
    NaiveBayes,
    OneVsRest,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.ml.feature import (
    OneHotEncoder,
    SQLTransformer,
    StopWordsRemover,
    StringIndexer,
    StringIndexerModel,
    VectorAssembler,
)
from pyspark.ml.functions import vector_to_array
from pyspark.ml.tuning import CrossValidator, CrossValidatorModel, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tramline import fixed_values as fv
from tramline.operators.fitting import FeatureFit

LABEL_INDEX = "cause_index"
_FINGERPRINT_RANGE = 1 << 32
# Trees hold four bytes of each feature, zeros too, for every training row they keep: about so many
# bytes of them go to a partition.
_TREE_BYTES = 256 << 20
_TREES = ("random_forest", "gbt_one_vs_rest")
_NON_NEGATIVE = "display_duration_non_negative"


# --- splitting and sampling ---------------------------------------------------


def _in_share(key: str, share: float, purpose: str, seed: int):
    """Whether a uniform number made of the key's text falls into `share`.

    The purpose keeps draws apart: a sample of one side of a split is still a sample.
    """
    text = F.coalesce(F.col(key).cast("string"), F.lit(""))
    salted = F.concat(F.lit(f"{purpose}:{seed}:"), text)
    digits = F.substring(F.md5(salted.cast("binary")), 1, 8)
    return F.conv(digits, 16, 10).cast("bigint") < int(share * _FINGERPRINT_RANGE)


def split(
    df: DataFrame, key: str | None = None, share: float = fv.TRAIN_SHARE, seed: int = fv.SEED
) -> tuple[DataFrame, DataFrame]:
    """Training and test rows.

    With `key`, a row's side depends on its key alone: it survives recomputation,
    any partitioning and growth of the table. Without, Spark's `randomSplit`.
    """
    if key is None:
        train, test = df.randomSplit([share, 1 - share], seed=seed)
        return train, test
    in_train = _in_share(key, share, "split", seed)
    return df.filter(in_train), df.filter(~in_train)


def sample(
    df: DataFrame, key: str | None = None, share: float = fv.SAMPLE_SHARE, seed: int = fv.SEED
) -> DataFrame:
    """Rows drawn without replacement, each with probability `share`; by `key` as in `split`."""
    if key is None:
        return df.sample(False, share, seed=seed)
    return df.filter(_in_share(key, share, "sample", seed))


# --- feature stages -----------------------------------------------------------


def stop_words(input_col: str = "words", output_col: str = "filtered_words") -> StopWordsRemover:
    french = StopWordsRemover.loadDefaultStopWords(fv.STOP_WORD_LANGUAGE)
    return StopWordsRemover(inputCol=input_col, outputCol=output_col, stopWords=french)


def text_stages(min_df: float = fv.VOCABULARY_MIN_DF, size: int = fv.VOCABULARY_SIZE) -> FeatureFit:
    """Stop-word removal, term counts, TF-IDF."""
    return FeatureFit(stop_words(), min_df, size)


def _short(column: str) -> str:
    return column.removesuffix("_category")


def indexers() -> StringIndexer:
    """Label and categories by falling frequency, all counted in one pass; an unknown
    or NULL value gets the index after the last."""
    columns = [fv.LABEL, *fv.CATEGORICAL_FEATURES]
    return StringIndexer(
        inputCols=columns, outputCols=[f"{_short(c)}_index" for c in columns], handleInvalid="keep"
    )


def encoder() -> OneHotEncoder:
    names = [_short(c) for c in fv.CATEGORICAL_FEATURES]
    return OneHotEncoder(
        inputCols=[f"{n}_index" for n in names], outputCols=[f"{n}_vec" for n in names]
    )


def feature_stages(min_df: float = fv.VOCABULARY_MIN_DF, size: int = fv.VOCABULARY_SIZE) -> FeatureFit:
    """Everything between built features and the assembler, label index included."""
    return FeatureFit(stop_words(), min_df, size, indexers(), encoder())


def feature_columns(include_leaky: bool = True) -> list[str]:
    """Inputs of the assembler, in order. Leaky ones are computed from the label."""
    numeric = [c for c in fv.NUMERIC_FEATURES if include_leaky or c not in fv.LEAKY_FEATURES]
    return ["text_features", *numeric, *[f"{_short(c)}_vec" for c in fv.CATEGORICAL_FEATURES]]


def assembler(columns: list[str] | None = None) -> VectorAssembler:
    """One feature vector per row; rows with a NULL or NaN input are dropped."""
    return VectorAssembler(
        inputCols=columns or feature_columns(), outputCol="features", handleInvalid="skip"
    )


# --- classifiers --------------------------------------------------------------

_CLASSIFIERS = {
    "random_forest": RandomForestClassifier,
    "logistic_regression": LogisticRegression,
    "naive_bayes": NaiveBayes,
    "gbt_one_vs_rest": GBTClassifier,
}
# The candidates that compete; boosted trees are built on request only.
CANDIDATES = tuple(fv.TUNING_GRIDS)


def classifier(name: str, **overrides):
    settings = {**fv.MODEL_SETTINGS[name], **overrides}
    estimator = _CLASSIFIERS[name](labelCol=LABEL_INDEX, featuresCol="features", **settings)
    if name == "gbt_one_vs_rest":
        # One class at a time: each keeps all training rows as dense bins, and its tasks fill the cluster.
        return OneVsRest(
            classifier=estimator, labelCol=LABEL_INDEX, featuresCol="features", parallelism=1
        )
    return estimator


def model_stages(name: str, include_leaky: bool = True, **overrides) -> Pipeline:
    """Assembler and classifier. Naive Bayes takes no negative input: a display time
    that ends before it begins counts as 0 there."""
    columns = feature_columns(include_leaky)
    stages = []
    if name == "naive_bayes":
        # A NULL duration stays NULL, so that the assembler drops the row.
        clamp = (
            "SELECT *, CASE WHEN display_duration_hours < 0 THEN 0D "
            f"ELSE display_duration_hours END AS {_NON_NEGATIVE} FROM __THIS__"
        )
        stages.append(SQLTransformer(statement=clamp))
        columns = [_NON_NEGATIVE if c == "display_duration_hours" else c for c in columns]
    return Pipeline(stages=[*stages, assembler(columns), classifier(name, **overrides)])


def vectors(name: str, rows: DataFrame, include_leaky: bool = True) -> DataFrame:
    """Rows with the vector that the classifier would be given."""
    stages = model_stages(name, include_leaky).getStages()[:-1]
    return Pipeline(stages=stages).fit(rows).transform(rows)


def dealt(rows: DataFrame, names, include_leaky: bool = True) -> DataFrame:
    """Training rows over enough partitions for the classifiers `names`, never fewer than they have.

    Trees keep rows as dense bins, many times the size of sparse vectors, and a task reads
    its whole partition of them.
    """
    trees = [n for n in names if n in _TREES]
    if not trees:
        return rows
    vector = F.unwrap_udt("features")
    one = vectors(trees[0], rows, include_leaky).select(F.coalesce(vector["size"], F.size(vector["values"]))).first()
    parts = -(-rows.count() * one[0] * 4 // _TREE_BYTES) if one else 0
    return rows.repartition(parts) if parts > rows.rdd.getNumPartitions() else rows


# --- evaluation ---------------------------------------------------------------


def confusion(
    predictions: DataFrame, label: str = LABEL_INDEX, prediction: str = "prediction"
) -> DataFrame:
    """Row counts per (label, prediction)."""
    return predictions.groupBy(
        F.col(label).alias("label"), F.col(prediction).alias("prediction")
    ).agg(F.count(F.lit(1)).alias("n"))


def metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, f1, weighted precision and weighted recall from `confusion`, in one row.

    One pass over the predictions gives all four. Each cell speaks for two classes:
    it is support of its label and a guess of its prediction.
    """
    n, none = F.col("n"), F.lit(0).cast("bigint")
    hit = F.when(F.col("label") == F.col("prediction"), n).otherwise(none)

    def role(column, support, guessed, hits):
        return F.struct(
            F.col(column).alias("class"),
            support.alias("support"),
            guessed.alias("guessed"),
            hits.alias("hits"),
        )

    roles = F.array(role("label", n, none, hit), role("prediction", none, n, none))
    classes = (
        counts.select(F.inline(roles))
        .groupBy("class")
        .agg(*[F.sum(c).alias(c) for c in ("support", "guessed", "hits")])
    )
    zero = F.lit(0.0)
    per_class = classes.select(
        "support",
        "hits",
        F.coalesce(F.try_divide("hits", "guessed"), zero).alias("precision"),
        F.coalesce(F.try_divide("hits", "support"), zero).alias("recall"),
        F.coalesce(
            F.try_divide(2 * F.col("hits"), F.col("support") + F.col("guessed")), zero
        ).alias("f1"),
    )

    def weighted(column):
        return F.try_divide(F.sum(F.col("support") * F.col(column)), F.sum("support"))

    return per_class.agg(
        F.try_divide(F.sum("hits"), F.sum("support")).alias("accuracy"),
        weighted("f1").alias("f1"),
        weighted("precision").alias("weighted_precision"),
        weighted("recall").alias("weighted_recall"),
    )


def evaluate(predictions: DataFrame) -> dict[str, float]:
    return metrics(confusion(predictions)).first().asDict()


def select_best(results: dict[str, dict[str, float]], metric: str = "accuracy") -> str:
    """Name of the model with the highest metric; the first named wins a tie."""
    return max(results, key=lambda name: results[name][metric])


# --- tuning -------------------------------------------------------------------


def parameter_grid(name: str, estimator, grids=fv.TUNING_GRIDS) -> list:
    builder = ParamGridBuilder()
    for parameter, values in grids[name].items():
        builder = builder.addGrid(estimator.getParam(parameter), values)
    return builder.build()


FOLD = "fold"


def with_fold(rows: DataFrame, key: str, folds: int = fv.FOLDS) -> DataFrame:
    """Each row's fold by a hash of its key, whatever the order of the rows."""
    return rows.withColumn(FOLD, F.pmod(F.xxhash64(F.col(key).cast("string"), F.lit(fv.SEED)), F.lit(folds)).cast("int"))


def tune(
    name: str,
    prepared: DataFrame,
    include_leaky: bool = True,
    parallelism: int = 4,
    grids=fv.TUNING_GRIDS,
    folds: int = fv.FOLDS,
    **overrides,
) -> CrossValidatorModel:
    """Cross-validated search over the classifier's grid, by accuracy.

    Rows with a fold of their own (see `with_fold`) give the same search in any order.
    """
    stages = model_stages(name, include_leaky, **overrides)
    search = CrossValidator(
        estimator=stages,
        estimatorParamMaps=parameter_grid(name, stages.getStages()[-1], grids),
        evaluator=MulticlassClassificationEvaluator(
            labelCol=LABEL_INDEX, predictionCol="prediction", metricName="accuracy"
        ),
        numFolds=folds,
        seed=fv.SEED,
        parallelism=parallelism,
        foldCol=FOLD if FOLD in prepared.columns else "",
    )
    return search.fit(prepared)


# --- labels, scoring, persistence ---------------------------------------------


def labels_of(model: PipelineModel) -> list[str]:
    """Class names in index order, from the fitted label indexer."""
    for stage in model.stages:
        if isinstance(stage, StringIndexerModel) and LABEL_INDEX in stage.getOutputCols():
            return list(stage.labelsArray[stage.getOutputCols().index(LABEL_INDEX)])
    raise ValueError("the model holds no label indexer")


def label_map(indexed: DataFrame) -> DataFrame:
    """The distinct (index, name) pairs of an indexed table."""
    return indexed.select(LABEL_INDEX, fv.LABEL).distinct()


def with_cause(predictions: DataFrame, labels: list[str]) -> DataFrame:
    """Add the predicted class name; the index kept for unknown labels gives NULL."""
    names = F.array(*[F.lit(name) for name in labels])
    return predictions.withColumn("predicted_cause", F.get(names, F.col("prediction").cast("int")))


def with_confidence(predictions: DataFrame) -> DataFrame:
    """Add the highest class probability, in percent."""
    return predictions.withColumn(
        "confidence", F.array_max(vector_to_array("probability")) * 100
    )


def score(model: PipelineModel, features: DataFrame) -> DataFrame:
    """Prediction, class name and, where the model has probabilities, confidence."""
    predicted = with_cause(model.transform(features), labels_of(model))
    return with_confidence(predicted) if "probability" in predicted.columns else predicted


def sample_predictions(predictions: DataFrame, key: str | None = None) -> DataFrame:
    """A sample of predictions next to the truth."""
    return sample(predictions, key).select(fv.LABEL, "prediction", "text_content")


def preview(predictions: DataFrame, key: str, rows: int = 10) -> DataFrame:
    """The first predictions in the order of their key."""
    return predictions.select(key, fv.LABEL, "prediction").orderBy(key).limit(rows)


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_named(folder: str, name: str) -> PipelineModel:
    """The model saved under `name`; a model that does not load raises."""
    return load_model(f"{folder.rstrip('/')}/{name}")


def one_row(spark: SparkSession, message: str) -> DataFrame:
    """A single message to score."""
    return spark.createDataFrame([(message,)], "message string")
