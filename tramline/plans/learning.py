"""Learning from messages: features and text model, training, scoring."""

from dataclasses import dataclass

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline import fixed_values as fv
from tramline import sinks
from tramline.operators import classify, features
from tramline.session import materialise


def build_features(
    messages: DataFrame,
    out: str,
    json_out: str | None = None,
    model_out: str | None = None,
    min_df: float = fv.VOCABULARY_MIN_DF,
) -> PipelineModel:
    """Write features with TF-IDF vectors as Parquet; optionally the plain features as
    JSON and the text model. The features are computed from the messages once."""
    built = materialise(features.build(messages), "features")
    if json_out:
        sinks.write_json(built, json_out, "overwrite")
    model = classify.text_stages(min_df).fit(built)
    sinks.write_parquet(model.transform(built), out)
    if model_out:
        classify.save_model(model, model_out)
    return model


@dataclass
class Training:
    """The outcome of `train_classifier`.

    `honest` holds the best candidate's metrics without the features that are
    computed from the label; the other metrics include them if asked to.
    """

    best: str
    base: dict[str, dict[str, float]]
    honest: dict[str, float]
    tuned: dict[str, float]
    improvement: float
    model: PipelineModel
    test_predictions: DataFrame


def train_classifier(
    built: DataFrame,
    out: str | None = None,
    key: str | None = "id",
    include_leaky: bool = True,
    candidates=classify.CANDIDATES,
    grids=fv.TUNING_GRIDS,
    folds: int = fv.FOLDS,
    parallelism: int = 4,
    min_df: float = fv.VOCABULARY_MIN_DF,
    vocabulary_size: int = fv.VOCABULARY_SIZE,
) -> Training:
    """Fit the candidates on built features, tune the most accurate, and save it.

    All fitted stages see training rows only, and the saved model contains them,
    so it scores built features directly. Both sides are materialised after the
    text stages: the fits and folds then read vectors, not text.
    """
    train, test = classify.split(built, key)
    stages = classify.feature_stages(min_df, vocabulary_size).fit(train)
    columns = [classify.LABEL_INDEX, *classify.feature_columns(include_leaky)]
    kept = [c for c in (key,) if c]
    train_ready = stages.transform(train).select(*kept, *columns)
    if key:
        train_ready = classify.with_fold(train_ready, key, folds)
    train_ready = classify.dealt(materialise(train_ready, "train"), candidates, include_leaky)
    shown = [c for c in (key, fv.LABEL, "text_content") if c]
    test_ready = materialise(stages.transform(test).select(*shown, *columns), "test")

    def test_metrics(name: str, leaky: bool) -> dict[str, float]:
        fitted = classify.model_stages(name, leaky).fit(train_ready)
        return classify.evaluate(fitted.transform(test_ready))

    base = {name: test_metrics(name, include_leaky) for name in candidates}
    best = classify.select_best(base)
    honest = test_metrics(best, False) if include_leaky else base[best]

    search = classify.tune(best, train_ready, include_leaky, parallelism, grids, folds)
    predictions = search.bestModel.transform(test_ready)
    tuned = classify.evaluate(predictions)
    model = PipelineModel(stages=[*stages.stages, *search.bestModel.stages])
    if out:
        classify.save_model(model, f"{out.rstrip('/')}/{best}")
    improvement = tuned["accuracy"] - base[best]["accuracy"]
    return Training(best, base, honest, tuned, improvement, model, predictions)


# Columns that feature building reads, and the features that follow from each.
_DERIVED = {
    "begin": ("timestamp", ("display_duration_hours", "hour_of_day", "is_weekend")),
    "end": ("timestamp", ("display_duration_hours",)),
    "cause": ("string", ("severity_level", "is_urgent")),
    "title": ("string", ("title_length",)),
}


def score_messages(model: PipelineModel, messages: DataFrame) -> DataFrame:
    """Predicted cause and confidence of message rows, none left out.

    A feature that a row lacks the input for takes its default.
    """
    absent = {c: spec for c, spec in _DERIVED.items() if c not in messages.columns}
    if absent:
        messages = messages.withColumns(
            {c: F.lit(None).cast(kind) for c, (kind, _) in absent.items()}
        )
    unknown = {feature for _, derived in absent.values() for feature in derived}
    built = features.with_defaults(features.build(messages).drop(*unknown))
    built = built.fillna({c: v for c, v in fv.FEATURE_DEFAULTS.items() if c in fv.NUMERIC_FEATURES})
    return classify.score(model, built)
