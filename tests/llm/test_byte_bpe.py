"""Chunked encoding against the tokenizer's own, for whole texts."""

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest

from tramline.llm import byte_bpe, catalogue

PATH = public_tokenizers.path(catalogue.MULTI_RANKS)
PATTERN = public_tokenizers.PATTERN


@pytest.fixture(scope="module")
def whole():
    with open(PATH, "rb") as file:
        return byte_bpe.tokenizer(file.read(), PATTERN)


def _texts():
    pick = random.Random(3)
    parts = ["a", "bc", " ", "  ", "\n", "'s", "'", "é", "12", "…", "՘", "\U00011de0", " ", "!!", "漢字", "👍🏽"]
    mixed = ["".join(pick.choice(parts) for _ in range(n)) for n in (1, 39, 40, 41, 200, 999)]
    return [*mixed, "", None, "x" * 500, " " * 300 + "y", " " * 12_000 + "z", "\r\n" * 90, "don't " * 60, "same", "same"]


@pytest.mark.parametrize("chunk,overlap", [(40, 7), (13, 13), (1000, 50)])
def test_ids_are_those_of_the_whole_text(spark, whole, chunk, overlap):
    rows = [(i // 2, t, "clash") for i, t in enumerate(_texts())] + [(None, "no id " * 30, "x")] * 2
    docs = spark.createDataFrame(rows, "doc_id long, text string, ids string")
    coded = byte_bpe.encode(docs, PATH, PATTERN, chunk_chars=chunk, overlap_chars=overlap)
    found = byte_bpe.decode(coded, PATH, PATTERN).collect()

    def ids_of(text):
        ends = byte_bpe.match_ends(text, PATTERN)
        spans = list(zip([0, *ends], ends))
        return [i for a, b in spans for i in whole._encode_single_piece(text[a:b])]

    wanted = [(d, np.array(ids_of(t or ""), "<u4").tobytes(), (t or "").encode()) for d, t, _ in rows]
    got = [(r.doc_id, bytes(r.ids), bytes(r.decoded)) for r in found]
    assert sorted(got, key=str) == sorted(wanted, key=str)
    assert all(r.n_tokens * 4 == len(r.ids) for r in found)


def test_match_by_match_is_the_library(whole):
    for text in _texts():
        if text and len(text) < 5000:
            ends = byte_bpe.match_ends(text, PATTERN)
            ids = [i for a, b in zip([0, *ends], ends) for i in whole._encode_single_piece(text[a:b])]
            assert ids == whole.encode_ordinary(text)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert catalogue.token_digests(docs).count() == 0


def test_query(spark, whole):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    found = catalogue.op2_byte_bpe(spark, sf_dir).collect()
    assert len(found) == len(texts)
    for r in found:
        ids = np.array(whole.encode_ordinary(texts[r.doc_id]), "<u4").tobytes()
        assert (r.n_tokens, r.ids_sha256) == (len(ids) // 4, hashlib.sha256(ids).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()
