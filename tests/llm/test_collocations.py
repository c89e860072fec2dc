"""Phrases against plain counting of every phrase."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tramline.llm import collocations as co


def brute(docs, least, longest, top):
    counts, totals = defaultdict(Counter), Counter()
    for lang, text in docs:
        folded = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", folded):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang or "und"] += len(words)
            for n in range(1, longest + 1):
                counts[lang or "und"].update(tuple(words[i : i + n]) for i in range(len(words) - n + 1))
    out = []
    for lang, f in counts.items():
        candidates = {p: a for p, a in f.items() if a >= least and len(p) > 1}
        rows = []
        for p, a in candidates.items():
            inside = {q[i : i + len(p)] for q, b in candidates.items() if b >= a and len(q) > len(p) for i in range(len(q))}
            if p in inside:
                continue
            cuts = [(1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k, f[p[:k]], f[p[k:]]) for k in range(1, len(p))]
            score, _, left, right = min(cuts)
            rows.append((-score, -a, " ".join(p).encode(), left, right))
        for k, (score, a, p, left, right) in enumerate(sorted(rows)[:top], 1):
            out.append((lang, k, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


@pytest.fixture(scope="module")
def corpus():
    pick = random.Random(2)
    words = ["The", "the", "of", "é", "Ärger", "ärger", "a1", "new york", "\x1cx", "#"] + [f"v{i}" for i in range(30)]

    def text():
        out = []
        for _ in range(pick.randint(0, 40)):
            out += ["in terms of the", "state-of-the-art model"] if pick.random() < 0.15 else []
            out.append(words[int(len(words) * pick.random() ** 2)] + pick.choice(["", "", "", ",", ".\n", "!", ":", "\r"]))
        return pick.choice([" ", "\t", "  "]).join(out)

    docs = [(pick.choice(["en", "en", "en", "de", None]), text()) for _ in range(300)]
    return docs + [("en", None), (None, ""), ("fr", "x " * 400), ("fr", "a b c d e f g. " * 30), ("it", ".,;:!?")]


@pytest.mark.parametrize("least, longest, top, known", [(5, 5, 2000, 10**6), (5, 5, 2000, 0), (3, 5, 7, 120), (20, 2, 50, 0), (1, 5, 2000, 10**6)])
def test_collocations(spark, corpus, monkeypatch, least, longest, top, known):
    monkeypatch.setattr(co, "KNOWN_WORDS", known)
    monkeypatch.setattr(co, "KNOWN_PAIRS", known)
    monkeypatch.setattr(co, "COUNT_WORDS", 1000)
    monkeypatch.setattr(co, "BLOCK_WORDS", 300)
    monkeypatch.setattr(co, "TEXT_BYTES", 200)
    monkeypatch.setattr(co, "TILE", 8)
    corpus = corpus[-120:] if least == 1 else corpus
    docs = spark.createDataFrame(corpus, "lang string, text string").repartition(3)
    found = co.collocations(docs, least, longest, top)
    assert sorted(tuple(r) for r in found.collect()) == brute(corpus, least, longest, top)


@pytest.mark.parametrize("size", [0, 1, 50, 5000])
@pytest.mark.parametrize("share", [0, 1 / 16, 2])
def test_tiles(monkeypatch, size, share):
    monkeypatch.setattr(co, "TILE", 16)
    monkeypatch.setattr(co, "DENSE_SHARE", share)
    pick = np.random.default_rng(size)
    left, right = ((100 * pick.random(size) ** 3).astype(np.int64) for _ in range(2))
    wanted = Counter(zip(left.tolist(), right.tolist()))
    found = list(zip(*(x.tolist() for x in co.count_pairs(left, right))))
    assert len(found) == len(wanted) and {(a, b): n for a, b, n in found} == wanted


def test_products_beyond_64_bits(spark):
    rows = [(["x", 3_000_000_019, 4_000_000_007, 5_000_000_000_000_003, 6_000_000_011])]
    made = spark.createDataFrame(rows, "k string, a long, l long, n long, r long")
    exact = made.selectExpr(
        "CAST(1000 AS DECIMAL(38,0)) * CAST(a AS DECIMAL(38,0)) * CAST(n AS DECIMAL(38,0)) AS top",
        "CAST(l AS DECIMAL(38,0)) * CAST(r AS DECIMAL(38,0)) AS under",
    ).selectExpr("top div under AS s")
    _, a, left, n, right = rows[0]
    assert exact.first().s == 1000 * a * n // (left * right)


def test_ranks(spark):
    pick = random.Random(1)
    rows = [(f"k{i}", pick.randint(1, 5)) for i in range(500)]
    found = co.ranked(spark.createDataFrame(rows, "key string, n long").repartition(7), "key").collect()
    assert [(r.key, r.n) for r in sorted(found, key=lambda r: r.id)] == sorted(rows, key=lambda r: (-r[1], r[0]))
    assert sorted(r.id for r in found) == list(range(500))


def test_edge_rows(spark):
    rows = [(1, None, None, "x"), (2, "en", "", "y")] + [(3, None, "Same words here", "z")] * 3
    docs = spark.createDataFrame(rows, "id int, lang string, text string, `words.n` string")
    assert [tuple(r) for r in co.collocations(docs, least=3).collect()] == [
        ("und", 1, "same words here", 3, 3, 3, 9, 3000)
    ]
    assert co.collocations(docs, least=4).count() == 0
    assert co.collocations(docs.limit(0)).count() == 0
