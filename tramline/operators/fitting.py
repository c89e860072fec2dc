"""Text model and indexers fitted from one scan.

One tagged aggregation counts what all fitted stages need: occurrences and documents of
each word, rows of each category, and all rows. The stages are then Spark's own models,
made from the counts: count vectorizer, IDF weights as a product, string indexer.
"""

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml import PipelineModel
from pyspark.ml.feature import CountVectorizerModel, ElementwiseProduct, OneHotEncoder, StopWordsRemover, StringIndexer, StringIndexerModel
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.session import materialise

_ROWS, _WORDS = -1, 0  # kinds of counts; the columns' follow
_CHUNK_WORDS = 1 << 19  # about so many words are counted at a time


def counts(rows: DataFrame, words: str, columns: list[str] = ()) -> DataFrame:
    """(kind, term, tf, df): one pass over the rows, folded before the shuffle.

    Words are counted in numpy, some rows of an Arrow batch at a time, so that Spark aggregates
    one row per distinct word of these and not two per word of the text.
    """

    def folded(kind, codes, terms, documents):
        size = len(terms)
        held = [np.full(size, kind, np.int32), terms, np.bincount(codes, minlength=size), documents]
        return pa.RecordBatch.from_arrays([pa.array(h) for h in held], ["kind", "term", "tf", "df"])

    def encoded(values):
        listed = values.drop_null().dictionary_encode()
        return listed.indices.to_numpy(), listed.dictionary

    def run(stream):
        for batch in stream:
            if not batch.num_rows:
                continue
            yield folded(_ROWS, np.zeros(batch.num_rows, np.int64), pa.array([None], pa.string()), [batch.num_rows])
            for kind in range(1, batch.num_columns):
                values = batch.column(kind)
                codes, terms = encoded(values)
                yield folded(kind, codes, terms, np.bincount(codes, minlength=len(terms)))
                if values.null_count:
                    codes = np.zeros(values.null_count, np.int64)
                    yield folded(kind, codes, pa.array([None], pa.string()), [values.null_count])
            lists = batch.column(0)
            step = max(1, batch.num_rows * _CHUNK_WORDS // max(1, len(lists.flatten())))
            for start in range(0, batch.num_rows, step):
                part = lists.slice(start, step)
                values = part.flatten()
                owners = pc.list_parent_indices(part).filter(values.is_valid()).to_numpy().astype(np.int64)
                codes, terms = encoded(values)
                if len(terms):
                    pairs = owners * len(terms) + codes
                    pairs.sort()
                    first = np.append(True, pairs[1:] != pairs[:-1])
                    yield folded(_WORDS, codes, terms, np.bincount(pairs[first] % len(terms), minlength=len(terms)))
        pa.default_memory_pool().release_unused()

    listed = F.col(words).cast("array<string>").alias("_0")
    each = rows.select(listed, *[F.col(c).cast("string").alias(f"_{k}") for k, c in enumerate(columns, 1)])
    each = each.mapInArrow(run, "kind int, term string, tf bigint, df bigint")
    return each.groupBy("kind", "term").agg(F.sum("tf").alias("tf"), F.sum("df").alias("df"))


class FeatureFit:
    """Fits stop-word removal, term counts and TF-IDF and, if given, indexer and encoder.

    Words tie by name, as categories do. NULL words and categories are not counted.
    """

    def __init__(
        self,
        remover: StopWordsRemover,
        min_df: float,
        size: int,
        indexer: StringIndexer | None = None,
        encoder: OneHotEncoder | None = None,
    ):
        self.remover, self.min_df, self.size, self.indexer, self.encoder = remover, min_df, size, indexer, encoder

    def fit(self, rows: DataFrame) -> PipelineModel:
        words, columns = self.remover.getOutputCol(), self.indexer.getInputCols() if self.indexer else []
        known = materialise(counts(self.remover.transform(rows), words, columns), "feature-counts")
        number = known.filter(F.col("kind") == _ROWS).agg(F.sum("tf")).first()[0] or 0
        least = self.min_df * number if self.min_df < 1 else self.min_df
        common = known.filter((F.col("kind") == _WORDS) & F.col("term").isNotNull() & (F.col("df") >= least))
        terms = common.orderBy(F.desc("tf"), "term").limit(self.size).select("term", "df").collect()
        if not terms:
            raise ValueError("no term is in enough documents; lower minDF")
        vectorizer = CountVectorizerModel.from_vocabulary([t.term for t in terms], inputCol=words, outputCol="tf_features")
        listed = known.sparkSession.createDataFrame([(float(t.df),) for t in terms], "df double")
        weights = [w for (w,) in listed.select(F.log((F.lit(number) + 1.0) / (F.col("df") + 1.0))).collect()]
        scaled = ElementwiseProduct(scalingVec=Vectors.dense(weights), inputCol="tf_features", outputCol="text_features")
        stages = [self.remover, vectorizer, scaled]
        if self.indexer:
            indexers = self._indexers(known, columns)
            # The encoder takes its widths from the indexers' metadata and reads no row.
            stages += [*indexers, self.encoder.fit(PipelineModel(stages=indexers).transform(rows))]
        return PipelineModel(stages=stages)

    def _indexers(self, known: DataFrame, columns: list[str]) -> list[StringIndexerModel]:
        """A model per column: Spark's Python side pads lists of labels of unequal lengths."""
        ranked = known.filter((F.col("kind") > _WORDS) & F.col("term").isNotNull()).orderBy("kind", F.desc("tf"), "term")
        labels = [[] for _ in columns]
        for row in ranked.select("kind", "term").collect():  # as many as the indexer holds
            labels[row.kind - 1].append(row.term)
        invalid = self.indexer.getHandleInvalid()
        named = zip(columns, self.indexer.getOutputCols(), labels, strict=True)
        return [StringIndexerModel.from_arrays_of_labels([held], [c], [out], invalid) for c, out, held in named]
