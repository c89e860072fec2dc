"""Term statistics and a count vectorizer with a reproducible vocabulary."""

from pyspark import keyword_only
from pyspark.ml import Estimator
from pyspark.ml.feature import CountVectorizerModel
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCol, HasOutputCol
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline import fixed_values as fv


def term_statistics(documents: DataFrame, words: str = "words") -> DataFrame:
    """Occurrences (`tf`) and containing documents (`df`) of each term.

    One pass and one shuffle on the term: every document contributes its words
    once for `tf` and its distinct words once for `df`, and map-side aggregation
    folds frequent terms before anything is sent.
    """
    twice = documents.select(words, F.explode(F.array(F.lit(1), F.lit(0))).alias("tf"))
    seen = F.when(F.col("tf") == 1, F.col(words)).otherwise(F.array_distinct(words))
    return (
        twice.select("tf", F.explode(seen).alias("term"))
        .groupBy("term")
        .agg(F.sum("tf").alias("tf"), F.sum(1 - F.col("tf")).alias("df"))
    )


def ranked_terms(
    documents: DataFrame,
    words: str = "words",
    min_df: float = fv.VOCABULARY_MIN_DF,
    size: int = fv.VOCABULARY_SIZE,
) -> DataFrame:
    """The `size` most frequent terms in at least `min_df` documents; ties by term.

    `min_df` below 1 is a share of the documents, otherwise a number of them.
    """
    if min_df < 1:
        min_df = min_df * documents.count()
    frequent = term_statistics(documents, words).filter(F.col("df") >= min_df)
    return frequent.orderBy(F.desc("tf"), "term").limit(size)


class RankedCountVectorizer(Estimator, HasInputCol, HasOutputCol):
    """`CountVectorizer` whose vocabulary is the same on every run.

    Spark's own breaks frequency ties arbitrarily. The fitted model is Spark's
    `CountVectorizerModel`; at most `vocabSize` terms reach the driver.
    """

    minDF = Param(Params._dummy(), "minDF", "least documents per term", TypeConverters.toFloat)
    vocabSize = Param(Params._dummy(), "vocabSize", "most terms kept", TypeConverters.toInt)

    @keyword_only
    def __init__(
        self,
        *,
        inputCol=None,
        outputCol=None,
        minDF=fv.VOCABULARY_MIN_DF,
        vocabSize=fv.VOCABULARY_SIZE,
    ):
        super().__init__()
        self._setDefault(minDF=fv.VOCABULARY_MIN_DF, vocabSize=fv.VOCABULARY_SIZE)
        self._set(**self._input_kwargs)

    def _fit(self, dataset: DataFrame) -> CountVectorizerModel:
        ranked = ranked_terms(
            dataset,
            self.getInputCol(),
            self.getOrDefault(self.minDF),
            self.getOrDefault(self.vocabSize),
        )
        terms = [row["term"] for row in ranked.select("term").collect()]
        if not terms:
            raise ValueError("no term is in enough documents; lower minDF")
        return CountVectorizerModel.from_vocabulary(
            terms, inputCol=self.getInputCol(), outputCol=self.getOutputCol()
        )
