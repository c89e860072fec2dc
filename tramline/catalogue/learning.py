"""Text model, indexers, classifiers and their checks."""

from pyspark.ml import Pipeline, PipelineModel
from pyspark.sql import functions as F

from tramline import fixed_values as fv
from tramline import sources
from tramline.catalogue import text as text_queries
from tramline.catalogue import views
from tramline.functions import text
from tramline.operators import classify, features, folds, vocabulary
from tramline.plans import learning
from tramline.session import materialise, work_folder


def _worded(spark, sf):
    clean = text.strip_html(F.col("message"))
    return views.messages(spark, sf).select("id", text.clean_tokens(clean).alias("words"))


def _filtered(spark, sf):
    return classify.stop_words().transform(_worded(spark, sf)).select("id", "filtered_words")


def _text_model(spark, sf):
    """Term counts and TF-IDF of all messages."""
    words = materialise(_worded(spark, sf), "words")
    return classify.text_stages().fit(words).transform(words)


def _built(spark, sf):
    """All features, computed once and read back by every later step."""
    return materialise(features.build(views.messages(spark, sf)).drop("message"), "features")


def _vector(column):
    return F.unwrap_udt(column)


def ml_stopwords(spark, sf):
    return _filtered(spark, sf).select("id", text.joined(F.col("filtered_words")).alias("filtered_words"))


def ml_vocabulary(spark, sf):
    return vocabulary.ranked_terms(_filtered(spark, sf), "filtered_words")


def ml_tf(spark, sf):
    """Distinct vocabulary terms and their occurrences per message."""
    counts = _vector("tf_features")["values"]
    total = F.aggregate(counts, F.lit(0.0), lambda a, x: a + x)
    return _text_model(spark, sf).select(
        "id", F.size(counts).alias("terms"), total.alias("occurrences")
    )


def ml_tfidf(spark, sf):
    weights = _vector("text_features")["values"]
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    return _text_model(spark, sf).select(
        "id", F.size(weights).alias("terms"), F.round(total, 4).alias("weight")
    )


def _categories(spark, sf):
    words = F.size(text.tokens(text.strip_html(F.col("message"))))
    return views.messages(spark, sf).select(
        "id", "cause", "pattern", text.length_band(words).alias("message_length_category")
    )


def _indexed(spark, sf):
    rows = materialise(_categories(spark, sf), "categories")
    return Pipeline(stages=[classify.indexers(), classify.encoder()]).fit(rows).transform(rows)


def ml_string_index(spark, sf):
    return _indexed(spark, sf).select("id", "cause_index", "pattern_index", "message_length_index")


def distinct_label_map(spark, sf):
    return classify.label_map(_indexed(spark, sf))


def ml_one_hot(spark, sf):
    """Width and set position of each one-hot vector; none for the dropped last one."""
    columns = []
    for name in ("pattern", "message_length"):
        vector = _vector(f"{name}_vec")
        columns += [
            vector["size"].alias(f"{name}_width"),
            F.get(vector["indices"], F.lit(0)).alias(f"{name}_position"),
        ]
    return _indexed(spark, sf).select("id", *columns)


def ml_assemble_skip(spark, sf):
    """Messages whose features are all known, with the width of their vector."""
    built = _built(spark, sf)
    prepared = classify.feature_stages().fit(built).transform(built)
    assembled = classify.assembler().transform(prepared)
    return assembled.select("id", _vector("features")["size"].alias("width"))


def ml_train_test_split(spark, sf):
    train, test = classify.split(views.messages(spark, sf).select("id"), "id")
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


def split_counts(spark, sf):
    return ml_train_test_split(spark, sf).groupBy("side").agg(F.count(F.lit(1)).alias("n"))


def split_random(spark, sf):
    train, test = classify.split(views.table(spark, sf, "documents").select("doc_id"))
    return train.withColumn("side", F.lit("train")).unionByName(test.withColumn("side", F.lit("test")))


def sample_rows(spark, sf):
    return classify.sample(views.table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber"))


def sample_by_key(spark, sf):
    rows = views.table(spark, sf, "orders").select("o_orderkey", "o_totalprice")
    return classify.sample(rows, "o_orderkey")


def _rounded_metrics(predictions):
    found = classify.metrics(classify.confusion(predictions))
    return found.select(*[F.round(c, 9).alias(c) for c in found.columns])


def ml_metrics(spark, sf):
    """The four metrics of a made-up prediction over all order lines."""
    predictions = views.table(spark, sf, "lineitem").selectExpr(
        "CAST(l_linenumber % 4 AS DOUBLE) AS cause_index",
        "CAST(IF(l_partkey % 3 = 0, l_suppkey % 5, l_linenumber % 4) AS DOUBLE) AS prediction",
    )
    return _rounded_metrics(predictions)


def _trained(spark, sf, name):
    """A classifier fitted on the training side, and its test predictions."""
    train, test = classify.split(_built(spark, sf), "id")
    stages = classify.feature_stages().fit(train)
    columns = [classify.LABEL_INDEX, *classify.feature_columns()]
    # The texts are shown for test rows only: training rows are written without.
    inputs = materialise(stages.transform(train).select(*columns), "train")
    test = stages.transform(test).select("id", fv.LABEL, "text_content", *columns)
    model = classify.model_stages(name).fit(classify.dealt(inputs, [name]))
    labels = classify.labels_of(stages)
    return classify.with_cause(model.transform(test), labels)


def _score(name):
    def run(spark, sf):
        return _trained(spark, sf, name).select("id", "cause", "prediction", "predicted_cause")

    return run


def ml_model_metrics(spark, sf):
    return _rounded_metrics(_trained(spark, sf, "naive_bayes"))


def ml_score_confidence(spark, sf):
    scored = classify.with_confidence(_trained(spark, sf, "naive_bayes"))
    return scored.select("id", "predicted_cause", F.round("confidence", 4).alias("confidence"))


def ml_sample_predictions(spark, sf):
    return classify.sample_predictions(_trained(spark, sf, "naive_bayes"), "id")


def ml_build_features_job(spark, sf):
    """Features and text model by the job; the saved model applied to the written words."""
    root = work_folder(spark, "features-job")
    learning.build_features(views.messages(spark, sf), f"{root}/features", model_out=f"{root}/models/text")
    written = sources.read_parquet(spark, f"{root}/features").drop("filtered_words", "tf_features", "text_features")
    weights = _vector("text_features")["values"]
    total = F.aggregate(weights, F.lit(0.0), lambda a, x: a + x)
    model = classify.load_named(f"{root}/models", "text")
    return model.transform(written).select("id", F.size(weights).alias("terms"), F.round(total, 4).alias("weight"))


def _training(spark, sf, out):
    return learning.train_classifier(
        _built(spark, sf),
        out,
        include_leaky=False,
        candidates=("naive_bayes", "logistic_regression"),
        grids={"naive_bayes": {"smoothing": [0.5, 1.0]}, "logistic_regression": {"regParam": [0.01, 0.1]}},
    )


def ml_train_best(spark, sf):
    """Accuracy of each candidate and of the tuned best one, from two settings each."""
    done = _training(spark, sf, None)
    rows = [(name, "base", m["accuracy"]) for name, m in done.base.items()]
    rows.append((done.best, "tuned", done.tuned["accuracy"]))
    return spark.createDataFrame(rows, "model string, stage string, accuracy double")


def ml_save_load_score(spark, sf):
    """All messages scored by the tuned model, saved and loaded by its name."""
    out = work_folder(spark, "models")
    done = _training(spark, sf, out)
    model = classify.load_named(out, done.best)
    scored = learning.score_messages(model, views.messages(spark, sf))
    return scored.select("id", "predicted_cause", F.round("confidence", 4).alias("confidence"))


def ml_load_score_messages(spark, sf):
    """Unseen messages with all their times, scored by the job with a model saved and loaded."""
    folder, built = work_folder(spark, "models"), _built(spark, sf)
    train, test = classify.split(built, "id")
    stages = classify.feature_stages().fit(train)
    ready = materialise(stages.transform(train).select(classify.LABEL_INDEX, *classify.feature_columns()), "train")
    fitted = classify.model_stages("naive_bayes").fit(ready)
    classify.save_model(PipelineModel(stages=[*stages.stages, *fitted.stages]), f"{folder}/naive_bayes")
    unseen = views.messages(spark, sf).filter(F.col("end").isNotNull()).join(test.select("id"), "id", "left_semi")
    scored = learning.score_messages(classify.load_named(folder, "naive_bayes"), unseen)
    return scored.select("id", "predicted_cause", F.round("confidence", 4).alias("confidence"))


def ml_bayes_folds(spark, sf):
    """Cross-validation of naive Bayes: each smoothing on each fold of the training side."""
    train, _ = classify.split(_built(spark, sf), "id")
    stages = classify.feature_stages().fit(train)
    ready = stages.transform(train).select("id", classify.LABEL_INDEX, *classify.feature_columns())
    digits = F.substring(F.md5(F.concat(F.lit(f"fold:{fv.SEED}:"), "id").cast("binary")), 1, 8)
    dealt = ready.withColumn(classify.FOLD, (F.conv(digits, 16, 10).cast("bigint") % fv.FOLDS).cast("int"))
    vectors = classify.vectors("naive_bayes", dealt).select("id", classify.FOLD, classify.LABEL_INDEX, "features")
    return folds.hits(materialise(vectors, "vectors"), "id")


def ml_preview(spark, sf):
    """The ten predictions of the smallest ids: a report's first rows."""
    return classify.preview(_trained(spark, sf, "naive_bayes"), "id")


QUERIES = {
    "ml_stopwords": ml_stopwords,
    "ml_vocabulary": ml_vocabulary,
    "ml_tf": ml_tf,
    "ml_tfidf": ml_tfidf,
    "ml_string_index": ml_string_index,
    "distinct_label_map": distinct_label_map,
    "ml_one_hot": ml_one_hot,
    "ml_assemble_skip": ml_assemble_skip,
    "ml_train_test_split": ml_train_test_split,
    "split_counts": split_counts,
    "split_random": split_random,
    "sample_rows": sample_rows,
    "sample_by_key": sample_by_key,
    "ml_metrics": ml_metrics,
    "ml_rf_score": _score("random_forest"),
    "ml_lr_score": _score("logistic_regression"),
    "ml_nb_score": _score("naive_bayes"),
    "ml_gbt_ovr_score": _score("gbt_one_vs_rest"),
    "ml_model_metrics": ml_model_metrics,
    "ml_score_confidence": ml_score_confidence,
    "ml_sample_predictions": ml_sample_predictions,
    "ml_build_features_job": ml_build_features_job,
    "ml_train_best": ml_train_best,
    "ml_save_load_score": ml_save_load_score,
    "ml_load_score_messages": ml_load_score_messages,
    "ml_bayes_folds": ml_bayes_folds,
    "ml_preview": ml_preview,
}


def _terms_sql(fitted_on="TRUE"):
    """Words without stop words, and the vocabulary of the rows that `fitted_on` holds for."""
    stops = ", ".join("'" + w.replace("'", "''") + "'" for w in fv.STOP_WORDS)
    return f"""{views.CLEAN_SQL},
filtered AS (
  SELECT *, list_filter(words, lambda w: w NOT IN ({stops})) AS kept, {fitted_on} AS fitted FROM worded),
terms AS (SELECT id, fitted, unnest(kept) AS term FROM filtered),
counts AS (SELECT id, fitted, term, count(*) AS n FROM terms GROUP BY 1, 2, 3),
vocabulary AS (
  SELECT term, CAST(sum(n) AS BIGINT) AS tf, count(*) AS df FROM counts WHERE fitted
  GROUP BY 1 HAVING count(*) >= {fv.VOCABULARY_MIN_DF}
  ORDER BY tf DESC, term LIMIT {fv.VOCABULARY_SIZE})"""


def _index_sql(column, source):
    """Names by falling frequency, then alphabet; NULL comes after the last."""
    return f"""
{column}_ranks AS (
  SELECT {column}, row_number() OVER (ORDER BY count(*) DESC, {column}) - 1 AS position
  FROM {source} WHERE {column} IS NOT NULL GROUP BY 1)"""


_INDEXED_SQL = f"""{views.CLEAN_SQL},
banded AS (
  SELECT id, cause, pattern,
         CASE WHEN len(words) < 30 THEN 'short' WHEN len(words) < 100 THEN 'medium' ELSE 'long' END AS band
  FROM worded),
{_index_sql("cause", "banded")}, {_index_sql("pattern", "banded")}, {_index_sql("band", "banded")},
indexed AS (
  SELECT id, banded.cause, pattern_ranks.position AS pattern_position, band_ranks.position AS band_position,
         coalesce(cause_ranks.position, (SELECT count(*) FROM cause_ranks)) AS cause_position
  FROM banded LEFT JOIN cause_ranks USING (cause) LEFT JOIN pattern_ranks USING (pattern)
              LEFT JOIN band_ranks USING (band))"""


def _in_share_sql(key, share, purpose):
    digits = f"substr(md5('{purpose}:{fv.SEED}:' || {key}), 1, 8)"
    return f"CAST('0x' || {digits} AS BIGINT) < {int(share * 2**32)}"


def _bayes_features_sql():
    """The features in long form: (message, feature, value), and the rows with their classes."""
    in_train = _in_share_sql("doc_id", fv.TRAIN_SHARE, "split")
    numeric = "\n  UNION ALL ".join(
        f"SELECT id, 'n:{c}', {'greatest(display_duration_hours, 0)' if c == 'display_duration_hours' else c}"
        " FROM rows"
        for c in fv.NUMERIC_FEATURES
    )
    return f"""WITH {_terms_sql(in_train)},
built AS ({text_queries.FEATURES_SQL}),
rows AS (SELECT built.*, fitted FROM built JOIN filtered USING (id) WHERE built."end" IS NOT NULL),
{_index_sql("cause", "(SELECT built.cause FROM built JOIN filtered USING (id) WHERE fitted)")},
known AS (
  SELECT id, fitted, rows.cause, coalesce(position, (SELECT count(*) FROM cause_ranks)) AS class
  FROM rows LEFT JOIN cause_ranks USING (cause)),
x(id, feature, value) AS (
  SELECT id, 't:' || term,
         n * ln(((SELECT count(*) FROM filtered WHERE fitted) + 1.0) / (df + 1.0))
  FROM counts JOIN vocabulary USING (term)
  UNION ALL SELECT id, 'p:' || pattern, 1 FROM rows
    WHERE pattern IN (SELECT built.pattern FROM built JOIN filtered USING (id) WHERE fitted)
  UNION ALL SELECT id, 'l:' || message_length_category, 1 FROM rows
    WHERE message_length_category IN (
      SELECT message_length_category FROM built JOIN filtered USING (id) WHERE fitted)
  UNION ALL {numeric}),
width AS (
  SELECT (SELECT count(*) FROM vocabulary) + {len(fv.NUMERIC_FEATURES)}
         + (SELECT count(DISTINCT built.pattern) FROM built JOIN filtered USING (id) WHERE fitted)
         + (SELECT count(DISTINCT message_length_category) FROM built JOIN filtered USING (id) WHERE fitted) AS w)"""


def _bayes_sql():
    """Multinomial naive Bayes with add-one smoothing over the same features."""
    return f"""{_bayes_features_sql()},
sums AS (
  SELECT class, feature, sum(value) AS s FROM x JOIN known USING (id) WHERE fitted GROUP BY 1, 2),
classes AS (
  SELECT class, ln(n + 1.0) - ln((SELECT count(*) FROM known WHERE fitted) + count(*) OVER ()) AS prior,
         ln((SELECT sum(s) FROM sums WHERE sums.class = sizes.class) + w) AS norm
  FROM (SELECT class, count(*) AS n FROM known WHERE fitted GROUP BY 1) AS sizes, width),
scores AS (
  SELECT id, classes.class AS class,
         any_value(prior) + sum(value * (coalesce(ln(s + 1.0), 0) - norm)) AS score
  FROM x JOIN known USING (id) CROSS JOIN classes
         LEFT JOIN sums ON sums.class = classes.class AND sums.feature = x.feature
  WHERE NOT fitted GROUP BY 1, 2),
best AS (
  SELECT id, arg_max(class, score) AS class, max(score) AS top FROM scores GROUP BY 1),
answers AS (
  SELECT best.id AS id, best.class AS class, any_value(cause_ranks.cause) AS predicted_cause,
         100 / sum(exp(score - top)) AS confidence
  FROM best JOIN scores USING (id) LEFT JOIN cause_ranks ON cause_ranks.position = best.class
  GROUP BY 1, 2)"""


def _bayes_folds_sql():
    """Each held-out fold by each smoothing's model of the other folds."""
    digits = f"substr(md5('fold:{fv.SEED}:' || id), 1, 8)"
    settings = ", ".join(f"({a})" for a in folds.SMOOTHINGS)
    return f"""{_bayes_features_sql()},
folded AS (
  SELECT id, class, CAST('0x' || {digits} AS BIGINT) % {fv.FOLDS} AS fold FROM known WHERE fitted),
held AS (SELECT DISTINCT fold AS g FROM folded),
sums AS (
  SELECT g, class, feature, sum(value) AS s FROM x JOIN folded USING (id) JOIN held ON fold <> g GROUP BY 1, 2, 3),
sizes AS (SELECT g, class, count(*) AS n FROM folded JOIN held ON fold <> g GROUP BY 1, 2),
classes AS (
  SELECT g, class, n, sum(n) OVER (PARTITION BY g) AS total, count(*) OVER (PARTITION BY g) AS k,
         (SELECT sum(s) FROM sums WHERE sums.g = sizes.g AND sums.class = sizes.class) AS mass
  FROM sizes),
settings(a) AS (VALUES {settings}),
scores AS (
  SELECT folded.id AS id, any_value(folded.class) AS truth, fold, CAST(a AS DOUBLE) AS a, classes.class AS class,
         any_value(ln(n + a) - ln(total + a * k)) + sum(value * (ln(coalesce(s, 0) + a) - ln(mass + a * w))) AS score
  FROM folded JOIN classes ON classes.g = fold CROSS JOIN settings CROSS JOIN width JOIN x ON x.id = folded.id
       LEFT JOIN sums ON sums.g = fold AND sums.class = classes.class AND sums.feature = x.feature
  GROUP BY folded.id, fold, a, classes.class),
chosen AS (SELECT id, any_value(truth) AS truth, fold, a, arg_max(class, score) AS class FROM scores GROUP BY id, fold, a)
SELECT a AS smoothing, CAST(fold AS INTEGER) AS fold, count(*) AS n_rows, count(*) FILTER (class = truth) AS n_hits
FROM chosen GROUP BY 1, 2"""


# From rows of (label, prediction).
_METRICS_SQL = """
kinds AS (SELECT label AS kind FROM predicted UNION SELECT prediction FROM predicted),
tallies AS (
  SELECT kind, count(*) FILTER (label = kind) AS support,
         count(*) FILTER (prediction = kind) AS guessed,
         count(*) FILTER (label = kind AND prediction = kind) AS hits
  FROM kinds, predicted GROUP BY 1),
rates AS (
  SELECT support, hits,
         CASE WHEN guessed = 0 THEN 0 ELSE hits / guessed END AS p,
         CASE WHEN support = 0 THEN 0 ELSE hits / support END AS r
  FROM tallies)
SELECT round(sum(hits) / sum(support), 9)::DOUBLE AS accuracy,
       round(sum(support * CASE WHEN p + r = 0 THEN 0 ELSE 2 * p * r / (p + r) END) / sum(support), 9)::DOUBLE AS f1,
       round(sum(support * p) / sum(support), 9)::DOUBLE AS weighted_precision,
       round(sum(support * r) / sum(support), 9)::DOUBLE AS weighted_recall
FROM rates"""


def oracles():
    terms = _terms_sql()
    bayes = _bayes_sql()
    tfidf = f"""WITH {terms}
SELECT id, CAST(count(vocabulary.term) AS INTEGER) AS terms,
       round(coalesce(sum(n * ln(((SELECT count(*) FROM filtered) + 1.0) / (df + 1.0))), 0), 4)::DOUBLE AS weight
FROM filtered LEFT JOIN counts USING (id) LEFT JOIN vocabulary USING (term) GROUP BY id"""
    numeric = len(fv.NUMERIC_FEATURES)
    side = f"CASE WHEN {_in_share_sql('doc_id', fv.TRAIN_SHARE, 'split')} THEN 'train' ELSE 'test' END AS side"
    return {
        "ml_stopwords": f"WITH {terms} SELECT id, array_to_string(kept, '|') AS filtered_words FROM filtered",
        "ml_vocabulary": f"WITH {terms} SELECT term, tf, df FROM vocabulary",
        "ml_tf": f"""WITH {terms}
SELECT id, CAST(count(vocabulary.term) AS INTEGER) AS terms,
       coalesce(sum(CASE WHEN vocabulary.term IS NOT NULL THEN n END), 0)::DOUBLE AS occurrences
FROM filtered LEFT JOIN counts USING (id) LEFT JOIN vocabulary USING (term) GROUP BY id""",
        "ml_build_features_job": tfidf,
        "ml_tfidf": tfidf,
        "ml_string_index": f"""WITH {_INDEXED_SQL}
SELECT id, CAST(cause_position AS DOUBLE) AS cause_index, CAST(pattern_position AS DOUBLE) AS pattern_index,
       CAST(band_position AS DOUBLE) AS message_length_index
FROM indexed""",
        "distinct_label_map": f"""WITH {_INDEXED_SQL}
SELECT DISTINCT CAST(cause_position AS DOUBLE) AS cause_index, cause FROM indexed""",
        "ml_one_hot": f"""WITH {_INDEXED_SQL}
SELECT id, CAST((SELECT count(*) FROM pattern_ranks) AS INTEGER) AS pattern_width,
       CAST(pattern_position AS INTEGER) AS pattern_position,
       CAST((SELECT count(*) FROM band_ranks) AS INTEGER) AS message_length_width,
       CAST(band_position AS INTEGER) AS message_length_position
FROM indexed""",
        "ml_assemble_skip": f"""WITH {terms},
widths AS (
  SELECT (SELECT count(*) FROM vocabulary) + {numeric} + (SELECT count(DISTINCT pattern) FROM messages)
         + (SELECT count(DISTINCT CASE WHEN len(words) < 30 THEN 1 WHEN len(words) < 100 THEN 2 ELSE 3 END)
            FROM worded) AS width)
SELECT id, CAST(width AS INTEGER) AS width FROM messages, widths WHERE "end" IS NOT NULL""",
        "ml_train_test_split": f"SELECT CAST(doc_id AS VARCHAR) AS id, {side} FROM documents",
        "split_counts": f"SELECT {side}, count(*) AS n FROM documents GROUP BY 1",
        "ml_nb_score": f"""{bayes}
SELECT id, cause, CAST(answers.class AS DOUBLE) AS prediction, predicted_cause
FROM answers JOIN known USING (id)""",
        "ml_score_confidence": f"""{bayes}
SELECT id, predicted_cause, round(confidence, 4) AS confidence FROM answers""",
        "ml_load_score_messages": f"""{bayes}
SELECT id, predicted_cause, round(confidence, 4) AS confidence FROM answers""",
        "ml_sample_predictions": f"""{bayes}
SELECT cause, CAST(answers.class AS DOUBLE) AS prediction, text_content
FROM answers JOIN rows USING (id) WHERE {_in_share_sql('id', fv.SAMPLE_SHARE, 'sample')}""",
        "ml_preview": f"""{bayes}
SELECT id, cause, CAST(answers.class AS DOUBLE) AS prediction
FROM answers JOIN rows USING (id) ORDER BY id LIMIT 10""",
        "ml_bayes_folds": _bayes_folds_sql(),
        "sample_by_key": f"""
SELECT o_orderkey, o_totalprice FROM orders WHERE {_in_share_sql('o_orderkey', fv.SAMPLE_SHARE, 'sample')}""",
        "ml_metrics": f"""WITH predicted AS (
  SELECT l_linenumber % 4 AS label,
         CASE WHEN l_partkey % 3 = 0 THEN l_suppkey % 5 ELSE l_linenumber % 4 END AS prediction
  FROM lineitem), {_METRICS_SQL}""",
        "ml_model_metrics": f"""{bayes},
predicted AS (SELECT known.class AS label, answers.class AS prediction FROM answers JOIN known USING (id)),
{_METRICS_SQL}""",
    }
