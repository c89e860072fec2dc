"""Suffix automata and removed passages against every window."""

import hashlib
import random

import pytest
from hypothesis import given
from hypothesis import strategies as st

from tramline.llm import catalogue, substring_dedup

N = substring_dedup.WINDOW


@given(st.lists(st.text("ab", max_size=12), max_size=5), st.text("abc", max_size=15))
def test_matching_statistics(texts, probe):
    automaton = substring_dedup.Automaton()
    for text in texts:
        automaton.add(text)
    wanted = [
        max(k for k in range(end + 1) if any(probe[end - k : end] in t for t in texts) or not k)
        for end in range(1, len(probe) + 1)
    ]
    assert list(automaton.matches(probe)) == wanted


@given(st.lists(st.binary(max_size=8), max_size=30))
def test_word_hashes(parts):
    data, size = b" ".join(parts), substring_dedup._HASHED_AT_ONCE
    words, hashes = data.split(), substring_dedup._hashes(data).tolist()
    assert len(hashes) == len(words) and len(set(hashes)) == len(set(words))
    long = [b"q" * (size - 1), b"r" * size, b"s" * (size + 1), *words, b"t" * 40_000, b"u" * 40_000, *words]
    found = substring_dedup._hashes(b"\n".join(long)).tolist()
    assert len(found) == len(long) and len(set(found)) == len(set(long)) and found[3 : 3 + len(words)] == hashes
    assert found[1] == substring_dedup._hashes(b"r" * size).item()


def brute(rows):
    def words(text):
        return (text or "").encode().split()

    first = {}
    for d, text in rows:
        if d is not None:
            w = words(text)
            for k in range(len(w) - N + 1):
                key = tuple(w[k : k + N])
                first[key] = min(first.get(key, d), d)
    out = []
    for d, text in rows:
        w = words(text)
        gone = set()
        for k in range(len(w) - N + 1):
            if d is not None and first[tuple(w[k : k + N])] < d:
                gone |= set(range(k, k + N))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((d, len(w), len(gone), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def found(df):
    from pyspark.sql import functions as F

    rows = df.select("doc_id", "n_words", "n_removed", F.sha2("text", 256)).collect()
    return sorted(map(tuple, rows), key=str)


@pytest.mark.parametrize("block", [1_500, 6 << 20])
def test_edge_rows(spark, block, monkeypatch):
    monkeypatch.setattr(substring_dedup, "BLOCK_BYTES", block)
    pick = random.Random(block)
    passages = [" ".join(f"w{pick.randrange(60)}" for _ in range(pick.randint(10, 70))) for _ in range(25)]
    rows = []
    for d in range(60):
        parts = [pick.choice(passages) for _ in range(3)] + [" ".join(f"x{pick.randrange(999)}" for _ in range(20))]
        rows.append((pick.randrange(1000), "\n\t ".join(parts)))
    rows += [(5, None), (6, ""), (7, "few words"), (None, passages[0] * 2), (8, "r " * 40), (9, "r " * 12), (10, "r " * 13)]
    rows += [(11, passages[1] + " é\xa0é " + passages[1]), (12, passages[1]), (12, passages[1]), (rows[0][0], rows[1][1])]
    rows += [(-3, " ".join(passages) * 3)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, spans string").repartition(3)
    assert found(substring_dedup.deduplicate(docs)) == brute(rows)
    assert substring_dedup.deduplicate(docs.limit(0)).count() == 0


def test_ids_are_whole_numbers(spark):
    with pytest.raises(TypeError, match="whole numbers"):
        substring_dedup.deduplicate(spark.createDataFrame([("a", "x")], "doc_id string, text string"))


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    got = catalogue.op3_substring_dedup(spark, sf_dir).collect()
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got), key=str) == brute(rows)
    assert sum(r.n_removed for r in got) > 1000
