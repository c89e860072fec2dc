"""Contained items against every pair, in Python and in SQL."""

import re

import check
import pytest

from tramline.llm import catalogue, decontaminate, oracles


def shingles(text):
    words = re.findall(r"[^\W_]+", (text or "").lower())
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def brute(docs, items):
    out = []
    for d, text in docs:
        for i, item in set(items):
            theirs = shingles(item)
            shared = len(theirs & shingles(text))
            if theirs and shared >= 0.8 * len(theirs):
                out.append((d, i, shared, len(theirs)))
    return sorted(set(out), key=str)


def test_edge_rows(spark):
    item = " ".join(f"Word{k}" for k in range(24))
    words = item.split()
    damaged = [" ".join(words[:k] + ["other"] + words[k + 1 :]) for k in range(24)]
    repeated = "one two three four five " * 6
    items = [(1, item), (2, repeated), (3, "too short"), (4, None), (5, ""), (6, "exactly five words are here"), (1, item)]
    filler = " ".join(f"f{k}" for k in range(5000))
    docs = [(10 + k, f"{filler} {d}, {filler}") for k, d in enumerate(damaged)]
    docs += [(40, item.upper().replace(" ", " -- ")), (41, None), (42, ""), (43, "word0 word1"), (44, repeated), (44, repeated)]
    docs += [(45, "EXACTLY: five, words\nare here!"), (46, " ".join(words[:22])), (47, " ".join(words[:23]))]
    docs_df = spark.createDataFrame([(d, t, "clash", 0) for d, t in docs], "doc_id long, text string, item string, h int")
    items_df = spark.createDataFrame(items, "item_id long, text string")
    found = [tuple(r) for r in decontaminate.contained(docs_df, items_df).collect()]
    assert sorted(found, key=str) == brute(docs, items)
    leaked = {d for d, *_ in found}
    kept = decontaminate.decontaminate(docs_df, items_df)
    assert kept.columns == docs_df.columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted(d for d, _ in docs if d not in leaked)
    assert decontaminate.contained(docs_df.limit(0), items_df).count() == 0
    assert decontaminate.decontaminate(docs_df, items_df.limit(0)).count() == len(docs)


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_query(spark, sf_dir):
    db = check.connect(sf_dir)
    ok, rows, note = check.compare(spark, db, sf_dir, catalogue.op5_decontaminate, oracles.LEAKS)
    assert ok and rows, note


def test_null_and_shared_ids_and_clashing_names(spark):
    item = "one two three four five six seven"
    docs = spark.createDataFrame(
        [(None, f"a {item} b", 1), (1, item, 2), (1, "clean text of this same id", 3), (2, "clean", 4)],
        "doc_id long, text string, `c0.hit` int",
    )
    items = spark.createDataFrame([(None, item)], "item_id long, text string")
    assert sorted((r.doc or 0, r.item) for r in decontaminate.contained(docs, items).collect()) == [(0, None), (1, None)]
    kept = decontaminate.decontaminate(docs, items)
    assert kept.columns == docs.columns and [tuple(r) for r in kept.collect()] == [(2, "clean", 4)]
