"""Best-first search against scoring every document."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tramline.llm import ranked_search as rs


def terms(text):
    folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", folded)


def brute(docs, items, top=10):
    """(item, rank, id, score) of all rows."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b) for i, b in bags if b]
    words, holding = sum(sum(b.values()) for _, b in bags), Counter(t for _, b in bags for t in b)
    queries = {}
    for i, t in items:
        queries.setdefault(i, set()).update(terms(t))
    out = []
    for item, query in queries.items():
        scores = []
        for i, b in bags:
            m = 10 + 90 * sum(b.values()) * len(bags) // words
            score = 0
            for t in query & b.keys():
                w = math.floor(1000 * math.log((2 * len(bags) + 2) / (2 * holding[t] + 1)))
                score += w * (10**9 * b[t] // (1000 * b[t] + 8 * m))
            if score > 0:
                scores.append((-score, i is None, i or 0, i))
        out += [(item, k, x[3], -x[0]) for k, x in enumerate(sorted(scores)[:top], 1)]
    return out


@pytest.fixture(scope="module")
def corpus():
    pick = random.Random(1)
    words = [f"w{int(40 * pick.random() ** 3)}" for _ in range(5000)]
    docs = [(k, " ".join(pick.sample(words, pick.randint(1, 60)))) for k in range(400)]
    docs += [(500 + k, docs[k % 3][1]) for k in range(90)]  # many equal scores
    docs += [(900, None), (901, ""), (902, " .,- "), (903, "W1 É w1é w2_w3"), (904, "w39 " * 5000)]
    items = [(k, " ".join(pick.sample(words, pick.randint(1, 12)))) for k in range(40)]
    return docs, items + [(100, None), (101, ""), (102, "nowhere"), (103, "w1é É"), (0, "w39"), (104, docs[1][1])]


def found(df):
    return sorted(tuple(r) for r in df.collect())


@pytest.mark.parametrize("leaf, shard, round_terms", [(1, 64, 10**6), (1 << 10, 1 << 15, 10**6), (20, 50, 30)])
def test_search(spark, corpus, monkeypatch, leaf, shard, round_terms):
    monkeypatch.setattr(rs, "LEAF_POSTINGS", leaf)
    monkeypatch.setattr(rs, "SHARD_DOCS", shard)
    docs, items = corpus
    rows = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    wanted = spark.createDataFrame(items, "item_id long, text string")
    assert found(rs.search(rows, wanted, round_terms=round_terms)) == sorted(brute(docs, items))


@pytest.mark.parametrize("seed", range(6))
@pytest.mark.parametrize("leaf", [1, 7, 1000])
def test_shard(monkeypatch, seed, leaf):
    monkeypatch.setattr(rs, "LEAF_POSTINGS", leaf)
    pick = np.random.default_rng(seed)
    full = pick.integers(0, 50, (12, 300)) * (pick.random((12, 300)) < pick.random((12, 1)))
    term, doc = np.nonzero(full)
    shuffled = pick.permutation(len(term))
    shard = rs.Shard(300, term[shuffled], doc[shuffled], full[term, doc][shuffled])
    for top in (1, 10, 400):
        query = [(t, int(pick.integers(0, 30))) for t in pick.permutation(14)[:5]]
        best = rs.Best(top)
        shard.search(query, list(range(1000, 1300)), best)
        scores = sum((w * full[t] for t, w in query if t < 12), np.zeros(300, int))
        wanted = sorted((-s, 1000 + d) for d, s in enumerate(scores) if s > 0)[:top]
        assert sorted((-s, d) for s, _, d in best.held) == wanted


def test_few_intervals_are_opened(monkeypatch):
    """One document holds far more than others: the bounds leave most of the shard alone."""
    monkeypatch.setattr(rs, "LEAF_POSTINGS", 1)
    docs = 10_000
    impact = np.r_[np.full(docs, 10), np.full(20, 900)]
    term, doc = np.r_[np.zeros(docs, int), np.ones(20, int)], np.r_[np.arange(docs), np.arange(20) * 137]
    shard, opened = rs.Shard(docs, term, doc, impact), []
    search = rs.Shard.range_max
    monkeypatch.setattr(rs.Shard, "range_max", lambda self, a, b: opened.append(1) or search(self, a, b))
    best = rs.Best(10)
    shard.search([(0, 1), (1, 5)], list(range(docs)), best)
    assert sorted(d for _, _, d in best.held) == [137 * k for k in range(10)] and len(opened) < 200


def test_edge_rows(spark):
    docs = [(None, "a b"), (None, "a b"), (3, "a b"), (3, "a b"), (4, "b")]
    rows = spark.createDataFrame([(*d, 1) for d in docs], "doc_id long, text string, `score.x` int")
    items = spark.createDataFrame([("x", "A"), ("x", "b"), (None, "a")], "item_id string, text string")
    out = [(r.item, r.rank, r.id) for r in rs.search(rows, items).collect()]
    assert sorted(out, key=str) == sorted(
        [("x", 1, 3), ("x", 2, 3), ("x", 3, None), ("x", 4, None), ("x", 5, 4)]
        + [(None, 1, 3), (None, 2, 3), (None, 3, None), (None, 4, None)],
        key=str,
    )
    named = rows.selectExpr("CAST(doc_id AS STRING) AS doc_id", "text")
    assert {r.id for r in rs.search(named, items).collect()} == {"3", "4", None}
    assert rs.search(rows.limit(0), items).count() == 0
    assert rs.search(rows, items.limit(0)).count() == 0
