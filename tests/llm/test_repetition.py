"""Repetition coverage against plain counting."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from hypothesis import given
from hypothesis import strategies as st

from tramline.llm import repetition

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    words, out = WORD.findall(text), {}
    for n in (repetition.REPEAT_WORDS, *repetition.COVERAGE_PERCENT):
        grams = [tuple(words[i : i + n]) for i in range(len(words) - n + 1)]
        times = Counter(grams)
        inside = {i + k for i, g in enumerate(grams) if times[g] > 1 for k in range(n)}
        out[n] = (len(inside), sum(len(words[i]) for i in inside))
    lines = [x for x in text.split("\n") if WORD.search(x)]
    again = [x for i, x in enumerate(lines) if x in lines[:i]]
    found = {
        "n_words": len(words),
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(text.count(c) for c in "#*$%&|<>"),
        "n_dup_lines": len(again),
        "n_repeat_words": out[repetition.REPEAT_WORDS][0],
        "dup_line_chars": sum(len(w) for x in again for w in WORD.findall(x)),
    }
    return found | {f"dup_chars_{n}": out[n][1] for n in repetition.COVERAGE_PERCENT}


def same(texts):
    found = repetition.measured(texts)
    assert [{k: int(v[i]) for k, v in found.items()} for i in range(len(texts))] == [brute(t) for t in texts]


@given(st.lists(st.text("ab é#\n\t\x1c|", max_size=120), max_size=5))
def test_measures(texts):
    same(texts)


def test_repeated_texts():
    pick = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    texts = ["", "one", " ".join(pick.choice(words) for _ in range(3000)), "a b c d e " * 500, "same line\n" * 70]
    same(texts + texts)


def test_colliding_hashes_count_for_nothing(monkeypatch):
    pick = random.Random(4)
    text = " ".join(pick.choice("abcd") for _ in range(300))
    monkeypatch.setattr(repetition, "_mixed", lambda numbers: np.zeros(len(numbers), np.uint64))
    same([text, text[:100]])


def test_verdicts():
    pick = random.Random(5)
    varied = " ".join(str(pick.random()) for _ in range(60))
    tenth = " ".join(str(pick.random()) for _ in range(10))
    texts = [varied, varied + " " + varied, " ".join([varied, tenth, tenth]), "few words", ""]
    failed, kept = repetition.verdicts(repetition.measured(texts))
    assert failed.tolist() == [False, True, False, True, True]
    # Twenty of eighty words repeat in windows of ten: over a fifth.
    assert kept.tolist() == [True, False, False, False, False]
    lines = "\n".join([varied[:200]] * 2 + [varied])
    assert not repetition.verdicts(repetition.measured([lines]))[1][0]


def test_long_text_in_parts():
    texts = ["a b " * 10, "x" * (repetition.BATCH_CHARS + 1), "c d", "", "e"]
    assert list(repetition._parts(texts)) == [(0, 1), (1, 2), (2, 5)]
    assert list(repetition._parts([])) == []


ROWS = [(1, None, "k"), (1, "", None), (None, "a b", "x"), (2, "a a a a " * 30, "y"), (2, "a a a a " * 30, "y")]


def test_edge_rows(spark):
    docs = spark.createDataFrame(ROWS, "doc_id long, text string, `kept.t` string")
    found = repetition.measure(docs)
    assert found.columns[0] == "doc_id" and found.columns[-2:] == ["base_failed", "kept"]
    assert sorted((r.doc_id or 0, r.n_words, r.kept) for r in found.collect()) == [
        (0, 2, False), (1, 0, False), (1, 0, False), (2, 120, False), (2, 120, False)
    ]
    assert repetition.measure(docs.limit(0)).count() == 0


def test_keeps_all_columns(spark):
    text = " ".join(f"word{i}" for i in range(80))
    rows = [(k, t, "z", 1.5) for k, t in enumerate([text, None, text, "short"])]
    docs = spark.createDataFrame(rows, "c0 long, text string, kept string, `base.failed` double")
    kept = repetition.keep(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect())) == [rows[0], rows[2]]


def test_query(spark):
    from tramline.llm import catalogue

    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").collect()
    found = {r.doc_id: r for r in catalogue.op13_repetition(spark, "/root/testdata/sf0.001").collect()}
    assert len(found) == len(docs)
    for d in docs:
        wanted, row = brute(d.text or ""), found[d.doc_id]
        assert all(row[m] == wanted[m] for m in repetition.MEASURES[:5])


@pytest.mark.parametrize("name", ["op13_repetition", "op12_collocations", "op11_ranked_search"])
def test_sql(spark, name):
    import check

    from tramline.llm import catalogue

    sf_dir = "/root/testdata/sf0.01"
    ok, rows, note = check.compare(spark, check.connect(sf_dir), sf_dir, catalogue.QUERIES[name], catalogue.oracles()[name])
    assert ok and rows, note
