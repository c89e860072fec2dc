"""Subword features, training and held-out accuracy."""

import numpy as np
import pytest

from tramline.llm import catalogue, quality

SF_DIR = "/root/testdata/sf0.1"


def test_features():
    words = ["ab", "a", "x" * 100, "é\x01b", "ab"]
    owner, bucket = quality.features(words)
    counts = np.bincount(owner)
    # Framed "ab" has three pairs, two triples, one of four, and itself.
    assert counts[0] == 7 and counts[1] == 4 and list(owner) == sorted(owner)
    assert sorted(bucket[owner == 0]) == sorted(bucket[owner == 4])
    assert all(sorted(quality.features([w])[1]) == sorted(bucket[owner == k]) for k, w in enumerate(words))
    assert len(quality.features([])[0]) == 0


def test_every_character_of_long_words_counts():
    word = "".join(chr(0x4E00 + k) for k in range(1000))
    assert len(quality.features([word])[1]) == 1 + sum(1002 - n + 1 for n in quality.NGRAMS)
    grams = set(quality.features([word])[1])
    for at in (30, 500, 970):
        assert len(grams - set(quality.features([word[:at] + "!" + word[at + 1 :]])[1])) > 5


def test_long_unseen_words_are_read_whole(model):
    # Both ends are the same; only what stands between tells them apart.
    texts = ["x" * 30 + part * 40 + "x" * 30 for part in ("weather", "CHEAP!!")]
    good, bad = quality.Scorer(model).scores(texts)
    assert good > bad + 0.1


@pytest.fixture(scope="module")
def model():
    good = [("some calm words about the weather and a walk " * (1 + k % 3), 1) for k in range(40)]
    bad = [("BUY!! NOW!! CHEAP!! " * (1 + k % 3), 0) for k in range(15)] + [("was was was was was was " * 5, 0)] * 10
    return quality.train(good + bad)


def test_scores(model):
    texts = ["a walk about the weather", "CHEAP!! NOW!!", "was was was was was", "", "BUY!! " * 5000]
    together = quality.Scorer(model).scores(texts)
    assert together[0] > 0.5 > max(together[1:3]) and together[4] < 0.5
    assert np.allclose(together, [quality.Scorer(model).scores([t])[0] for t in texts])
    assert all(0 <= s <= 1 for s in together)


def test_edge_rows(spark, model):
    rows = [(1, None, 2.0), (1, "", 0.0), (None, "BUY!!", 1.0), (2, "same", 0.0), (2, "same", 0.0)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, score double")
    found = [(r.doc_id, r.score) for r in quality.score(docs, model).collect()]
    assert len(found) == 5 and found.count(found[-1]) == 2
    assert quality.score(docs.limit(0), model).count() == 0
    assert {r.score for r in quality.score(docs, None).collect()} == {0.5}
    assert quality.train([]) is None and quality.train([("a", 1), (None, 1)]) is None
    assert quality.train([(None, 0), ("", 1)]) is not None


def test_query_held_out(spark):
    found = catalogue.op7_quality(spark, SF_DIR).toPandas()
    assert len(found) == 10_000 and found.score.between(0, 1).all()
    known = found.merge(spark.read.parquet(f"{SF_DIR}/labels.parquet").toPandas(), on="doc_id")
    known = known[known.held_out]
    assert (known.predicted == known.quality).mean() > 0.98
    assert known.predicted[known.quality == 0].mean() < 0.05
