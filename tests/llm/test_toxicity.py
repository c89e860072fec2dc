"""The string kernel against its definition, and held-out accuracy."""

import tracemalloc
from itertools import combinations

import numpy as np
import pytest

from tramline.llm import catalogue, common, toxicity

SF_DIR = "/root/testdata/sf0.01"


def brute_kernel(a, b):
    """Every pair of subsequences, one by one."""

    def weights(unit):
        framed = "\x01" * (toxicity.FRAME - 1) + unit + "\x01"
        out = {}
        for places in combinations(range(len(framed)), toxicity.LENGTH):
            span = places[-1] - places[0] + 1
            if span <= toxicity.SPAN:
                key = tuple(framed[p] for p in places)
                out[key] = out.get(key, 0) + toxicity.DECAY**span
        return out

    x, y = weights(a), weights(b)
    raw = sum(v * y.get(k, 0) for k, v in x.items())
    value = (raw / np.sqrt(toxicity._norm(len(a)) * toxicity._norm(len(b)))) ** toxicity.POWER
    return 0 if value < toxicity.FLOOR else value


def test_kernel():
    units = ["idiot", "id", "idxiot", "moron", "ido", "aaaaaa", "o", "clownidiot"]
    found = toxicity.Landmarks.of(units[:5]).kernels(units)
    wanted = np.array([[brute_kernel(u, z) for z in units[:5]] for u in units])
    assert np.allclose(found, wanted, atol=1e-5)
    assert found[0, 0] == found[0].max() and found[2, 0] > found[3, 0]


def test_units():
    assert toxicity.sentences("You i d i o t! A dog, id.iot###\n\n x 7 ...") == [["you", "idiot"], ["dog", "idiot"], ["x7"]]
    assert toxicity.sentences("") == [] == toxicity.sentences(" .. !\n")
    assert [len(u) for u in toxicity.sentences("q" * 150)[0]] == [64, 64, 22]


@pytest.fixture(scope="module")
def model():
    clean = [f"the red thing. what a {w} you are, {w}" for w in ("red", "blue", "small", "wooden", "idea") * 12]
    toxic = [f"the red thing. what a {w} you are, {w}" for w in ("fatuous", "wretched", "lumpkin") * 12]
    return toxicity.train([(t, 0) for t in clean] + [(t, 1) for t in toxic])


def test_gaps_and_inserted_characters(model):
    scores = toxicity.Scorer(model).scores(
        ["a fatuous one", "a f a t u o u s one", "a fat-uous, one", "FATUOUS!!!", "small and red", "", " . "]
    )
    assert min(scores[:4]) > 0.5 > max(scores[4:])
    stretched = toxicity.Scorer(model).scores(["a " + "fatuous"[:i] + "x" + "fatuous"[i:] for i in range(8)])
    assert min(stretched) > 5 * max(scores[4:]) and sum(s > 0.5 for s in stretched) >= 4


def test_batches_do_not_matter(model):
    texts = ["a fatuous one", "a b c", "x" * 1000, "lump kin lumpkin", ""] * 3
    together = toxicity.Scorer(model).scores(texts)
    assert together == [toxicity.Scorer(model).scores([t])[0] for t in texts]


def test_edge_rows(spark, model):
    rows = [(1, None, "a"), (1, "", "b"), (2, "a wretched one " * 9000, "c"), (None, "fine", "d"), (2, "same", "e"), (2, "same", "e")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score string")
    found = [(r.doc_id, r.score) for r in toxicity.score(docs, model).collect()]
    assert len(found) == 6 and found.count(found[-1]) == 2
    empty = spark.createDataFrame([], docs.schema)
    assert toxicity.score(empty, model).count() == 0
    assert {r.score for r in toxicity.score(docs, None).collect()} == {0.0}
    kept = toxicity.reject(docs, model, 0.5)
    assert kept.columns == docs.columns and sorted(r.score for r in kept.collect()) == ["a", "b", "d", "e", "e"]


def test_reject_keeps_any_column_names(spark, model):
    docs = spark.createDataFrame([("fine", 1, 2, 3)], "text string, _toxicity int, `a.b` int, c0 int")
    kept = toxicity.reject(docs, model, 0.5)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [("fine", 1, 2, 3)]


def test_training_needs_both_classes(spark):
    assert toxicity.train([]) is None
    assert toxicity.train([("only clean", 0), (None, 1)]) is None
    docs = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1), (2, 0), (3, None), (1, 1)], "doc_id long, toxic int")
    sample = common.labelled_sample(docs, labels, "toxic", 10, 1)
    assert sorted(map(tuple, sample.collect())) == [(1, "a", 1), (2, "", 0)]
    assert toxicity.fit(sample) is None
    assert toxicity.fit(sample.limit(0)) is None


def test_training_memory():
    """Newton steps hold a few copies of the matrix at most, none of it in double precision."""
    pick = np.random.default_rng(1)
    full = np.c_[pick.normal(size=(100_000, 64)), np.ones(100_000)].astype(np.float32)
    y = np.where(full[:, 0] + pick.normal(size=len(full)) > 0, 1.0, -1.0)
    tracemalloc.start()
    w, bias = toxicity._svm(full, y, np.ones(len(full)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert w[0] > 10 * np.abs(w[1:]).max() and len(w) == 64 and abs(bias) < 0.1
    assert peak < 2.8 * full.nbytes


def test_query_held_out(spark):
    found = catalogue.op9_toxicity(spark, "/root/testdata/sf0.1").toPandas()
    labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet").toPandas()
    known = found.merge(labels, on="doc_id")
    known = known[known.held_out]
    toxic = known.toxic == 1
    assert len(found) == 10_000 and found.score.between(0, 1).all()
    assert known.predicted[toxic].mean() > 0.85
    assert known.predicted[~toxic].mean() < 0.03
