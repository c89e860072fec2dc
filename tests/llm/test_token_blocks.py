"""Token blocks: exact round trips, the file format, and the query against the library."""

import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tramline.llm import catalogue, token_blocks

PATH = public_tokenizers.path(catalogue.BYTE_BPE)
LIBRARY = token_blocks._tokenizer(token_blocks.common.file_bytes(PATH))
ENCODER = token_blocks._encoder(token_blocks.common.file_bytes(PATH))


@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(50, 90), min_size=1, max_size=300))
def test_block_round_trip(ids):
    block = token_blocks.pack_block(np.array(ids, np.uint32))
    assert token_blocks.unpack_block(memoryview(block)).tolist() == ids


def test_outliers_go_to_the_exception_list():
    ids = np.full(1000, 7, np.uint32)
    ids[::100] = 2**32 - 1
    block = token_blocks.pack_block(ids)
    base, last, width, high_width, exceptions = token_blocks._BLOCK.unpack_from(block)
    assert (base, last, width, high_width, exceptions) == (7, 999, 0, 32, 10)
    assert len(block) == token_blocks._BLOCK.size + 10 * 2 + 10 * 4


def test_reader_finds_any_stretch():
    ids = np.random.default_rng(1).integers(0, 60_000, 3 * token_blocks.BLOCK_IDS + 5).astype(np.uint32)
    reader = token_blocks.Reader(token_blocks.pack_file(ids))
    for start, count in ((0, len(ids)), (0, 0), (4095, 2), (8192, 4096), (len(ids) - 1, 1), (len(ids), 0)):
        assert (reader.ids(start, count) == ids[start : start + count]).all()
    with pytest.raises(IndexError):
        reader.ids(len(ids), 1)
    with pytest.raises(ValueError, match="not a file"):
        token_blocks.Reader(b"x" * 100)


@given(st.lists(st.sampled_from(["a", "é", "'s", " ", "  ", "\n", "\x1c", "\xa0", "12", "!", "word"]), max_size=30))
def test_word_by_word_is_the_library(parts):
    text = "".join(parts)
    tokenizer = LIBRARY
    whole = tokenizer.encode(text, add_special_tokens=False).ids
    assert token_blocks.WordEncoder(tokenizer).encode([text])[0].tolist() == whole


def expected(rows):
    tokenizer = Tokenizer.from_file(PATH)
    tokenizer.encode_special_tokens = True
    out, start = [], 0
    for i, text in sorted(rows, key=lambda r: (r[0] is not None, r[0])):
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 0]
        out.append((i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def found(df):
    return sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in df.collect()), key=lambda r: r[1])


def written(spark, folder, docs):
    from pyspark.sql import functions as F

    token_blocks.write(docs, folder, PATH)
    return token_blocks.read(spark, folder).withColumn("ids_crc32", F.crc32("ids"))


def test_edge_rows(spark, folder, monkeypatch):
    monkeypatch.setattr(token_blocks, "FILE_IDS", 50)
    rows = [(i * 7 % 40, "word " * (i % 9)) for i in range(40)] + [(90, None), (91, ""), (None, "x"), (95, "<|endoftext|> é " * 5000)]
    docs = spark.createDataFrame([(a, b, "c", 1) for a, b in rows], "doc_id long, text string, ids string, part int")
    assert found(written(spark, f"{folder}/a", docs)) == expected(rows)
    twins = spark.createDataFrame([(1, "same")] * 3, "doc_id long, text string")
    assert found(written(spark, f"{folder}/b", twins)) == expected([(1, "same")] * 3)
    empty = spark.createDataFrame([], docs.schema)
    assert found(written(spark, f"{folder}/c", empty)) == []


@pytest.mark.parametrize("kind", ["tinyint", "int", "long", "string"])
def test_id_types(spark, folder, kind, monkeypatch):
    monkeypatch.setattr(token_blocks, "RANGE_BYTES", 4)
    docs = spark.createDataFrame([(1, "one two"), (2, None), (3, "three")], "doc_id int, text string")
    typed = docs.withColumn("doc_id", docs.doc_id.cast(kind))
    back = token_blocks.read(spark, _written(typed, folder))
    assert dict(back.dtypes)["doc_id"] == dict(typed.dtypes)["doc_id"]
    assert [int(r.doc_id) for r in sorted(back.collect(), key=lambda r: r.start)] == [1, 2, 3]


def _written(docs, folder):
    token_blocks.write(docs, f"{folder}/types", PATH)
    return f"{folder}/types"


@given(st.lists(st.text(st.sampled_from("ab1²é'_ \n\t.!sαж́-½ªʰ\x1c\x85中")), max_size=20))
def test_pieces_give_the_ids_of_whole_texts(texts):
    whole = [c.ids for c in LIBRARY.encode_batch_fast(texts, add_special_tokens=False)]
    assert [c.tolist() for c in ENCODER.encode(texts)] == whole and ENCODER.cut is token_blocks._pieces


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()]
    assert found(catalogue.op4_token_blocks(spark, sf_dir)) == expected(rows)
