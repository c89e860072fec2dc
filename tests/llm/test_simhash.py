"""Fingerprints, the trie join and whole groups against brute force."""

import random

import numpy as np
import pytest
import xxhash
from brute import parts_of

from tramline.llm import catalogue, simhash


def brute_print(text):
    words = [w for w in "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "").replace("\t", " ").replace("\n", " ").split(" ") if w]
    shingles = [words[i : i + 4] for i in range(len(words) - 3)] or ([words] if words else [])
    hashes = [xxhash.xxh64(" ".join(s), seed=42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def brute(rows):
    prints = [(i, brute_print(t)) for i, t in rows]
    distinct = sorted({fp for _, fp in prints})
    links = [(a, b) for k, a in enumerate(distinct) for b in distinct[k + 1 :] if (a ^ b).bit_count() <= 4]
    part = parts_of(distinct, links)
    least = {}
    for i, fp in prints:
        least[part[fp]] = min(least.get(part[fp], i), i)
    return sorted((i, f"{fp:016x}", least[part[fp]]) for i, fp in prints)


@pytest.mark.parametrize("depth", [0, 3])
def test_trie_join(depth):
    draw = np.random.default_rng(depth)
    base = draw.integers(0, 2**60, 150, dtype=np.uint64)
    flipped = [base[:60] ^ np.uint64(sum(1 << int(b) for b in draw.choice(60, k, replace=False))) for k in (1, 3, 4, 5)]
    values = np.unique(np.concatenate([base, *flipped]))
    top = [values[values >> np.uint64(60 if not depth else 59) == p] for p in (0, 1)]
    for left, right in [(values, None)] if not depth else [(top[0] & np.uint64(2**61 - 1), None)]:
        x, y = simhash.near_pairs(left, right, depth, 4)
        found = list(zip(x.tolist(), y.tolist()))
        wanted = {(a, b) for a in left.tolist() for b in left.tolist() if a < b and (a ^ b).bit_count() <= 4}
        assert len(found) == len(set(found)) and set(found) == wanted


def test_links_across_prefixes(spark):
    draw = np.random.default_rng(8)
    base = draw.integers(0, 2**63, 80, dtype=np.uint64) * np.uint64(2)
    masks = [1 << 63, 1 << 58 | 1 << 57, 0xF << 60, 0x1F << 59, 0x11 << 58 | 5]
    values = np.unique(np.concatenate([base, *[base ^ np.uint64(m) for m in masks]]))
    prints = spark.createDataFrame([(int(v),) for v in values.view(np.int64)], "fp long")
    found = [tuple(sorted((r.x, r.y))) for r in simhash.links(prints).collect()]
    signed = values.view(np.int64).tolist()
    wanted = {tuple(sorted((signed[i], signed[j]))) for i in range(len(values)) for j in range(i) if int(values[i] ^ values[j]).bit_count() <= 4}
    assert len(found) == len(set(found)) and set(found) == wanted


def rows_of(df):
    return sorted((r.doc_id, r.fingerprint, r.component_id) for r in df.collect())


def test_edge_rows(spark):
    pick = random.Random(2)
    text = [" ".join(f"w{pick.randrange(500)}" for _ in range(120)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(text)] + [(20, None), (21, ""), (22, " \n"), (23, "One"), (24, "oNE"), (25, "É e a b c"), (26, "b\xa0c")]
    rows += [(30 + i, t.replace("w7", "x7", 1) + " end") for i, t in enumerate(text)] + [(3, text[3])] * 2 + [(60, text[0] * 300)]
    docs = spark.createDataFrame([(*r, "clash") for r in rows], "doc_id long, text string, fp string")
    assert rows_of(simhash.near_duplicates(docs)) == brute(rows)
    kept = sorted(r.doc_id for r in simhash.keep_one(docs).collect())
    assert kept == sorted(i for i, _, c in brute(rows) if i == c)
    empty = spark.createDataFrame([], docs.schema)
    assert simhash.near_duplicates(empty).count() == 0 == simhash.keep_one(empty).count()


def test_query(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert rows_of(catalogue.op8_simhash(spark, sf_dir)) == brute(rows)
