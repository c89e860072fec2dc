"""Token ids as patched frame-of-reference blocks.

A file holds the ids of many documents, one after another, in blocks of BLOCK_IDS. Of
each block the minimum is subtracted and the rest packed in as many bits as the
PERCENTILE smallest share of its values needs; the values that need more are
exceptions, stored as a list of places and high bits. The index gives the start of
every block, so any document is read by unpacking the blocks it lies in.

Documents are dealt out by ranges of their ids, about RANGE_BYTES of text each, and sorted; each task encodes its range
and packs it into files of about FILE_IDS ids, whole documents each. A file is one row
of a Parquet table: range, number within the range, bytes, and its documents with
their counts. Positions in the whole follow from the counts: one number per range is
summed on the driver, the files of a range by a window, documents within their file.

File format, all little-endian: magic "PFB1", u32 block size, u64 number of ids, u32
number of blocks, then per block a u64 offset from the file's start, then the blocks:
u32 minimum, u16 count - 1, u8 width, u8 width of the high bits, u16 exceptions, the
packed low bits, u16 exception places, the packed high bits.

Defined results: a null text counts as empty and gives the end id alone; rows with equal
ids follow each other, ordered by a hash of their text; null ids come first; other
columns are dropped; an empty table gives no files.
"""

import functools
import json
import re
import struct
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tramline.llm import common

MAGIC = b"PFB1"
BLOCK_IDS = 4096
PERCENTILE = 90
FILE_IDS = 1 << 20
# Distinct words whose ids a Python worker keeps, from task to task.
KEPT_WORDS = 1_000_000
# Text bytes that a range of ids takes, and so a task.
RANGE_BYTES = 64 << 20
# Letters and digits with a space before them, and what stands between such words. Two
# white spaces or an apostrophe before a word belong to it.
_PIECE = re.compile(r" ?[^\W_]++|(?:(?! [^\W_])[\W_])++(?:(?:(?<=\s\s)|(?<='))[^\W_]++)?+")
# Scripts whose letters and digits Unicode's versions agree about end here.
_OTHER_SCRIPT = re.compile("[^\x00-\u052f]")
# A space beside other white space, and where to cut a text that has one.
_IRREGULAR = re.compile(r" \s|\s ")
_CUT = re.compile(r"(?<=\S)(?= \S)")
_HEAD = struct.Struct("<4sIQI")
_BLOCK = struct.Struct("<IHBBH")


def _pack(values: np.ndarray, width: int) -> bytes:
    """The low `width` bits of 32-bit values, one value after another."""
    if not width:
        return b""
    kind = "<u2" if width <= 16 else "<u4"
    bits = np.unpackbits(values.astype(kind).view(np.uint8), bitorder="little").reshape(len(values), -1)
    return np.packbits(bits[:, :width], bitorder="little").tobytes()


def _unpack(data: memoryview, count: int, width: int) -> np.ndarray:
    if not width:
        return np.zeros(count, np.uint32)
    kind = np.dtype("<u2" if width <= 16 else "<u4")
    bits = np.zeros((count, kind.itemsize * 8), np.uint8)
    packed = np.unpackbits(np.frombuffer(data, np.uint8), count=count * width, bitorder="little")
    bits[:, :width] = packed.reshape(count, width)
    return np.packbits(bits, bitorder="little").view(kind).astype(np.uint32)


def _packed_bytes(count: int, width: int) -> int:
    return (count * width + 7) // 8


def pack_block(ids: np.ndarray) -> bytes:
    """One block of at most 65,536 ids below 2**32."""
    base = int(ids.min())
    rest = (ids - np.uint32(base)).astype(np.uint32)
    within = max(0, -(-len(rest) * PERCENTILE // 100) - 1)
    width = int(np.partition(rest, within)[within]).bit_length()
    high = (rest.astype(np.uint64) >> np.uint64(width)).astype(np.uint32)
    places = np.flatnonzero(high)
    high_width = int(high.max()).bit_length()
    low = rest & np.uint32((1 << width) - 1)
    head = _BLOCK.pack(base, len(ids) - 1, width, high_width, len(places))
    return head + _pack(low, width) + places.astype("<u2").tobytes() + _pack(high[places], high_width)


def unpack_block(data: memoryview) -> np.ndarray:
    base, last, width, high_width, exceptions = _BLOCK.unpack_from(data)
    at = _BLOCK.size
    size = _packed_bytes(last + 1, width)
    out = _unpack(data[at : at + size], last + 1, width)
    at += size
    places = np.frombuffer(data[at : at + 2 * exceptions], "<u2")
    at += 2 * exceptions
    high = _unpack(data[at : at + _packed_bytes(exceptions, high_width)], exceptions, high_width)
    out[places] |= (high.astype(np.uint64) << np.uint64(width)).astype(np.uint32)
    return out + np.uint32(base)


def pack_file(ids: np.ndarray) -> bytes:
    blocks = [pack_block(ids[i : i + BLOCK_IDS]) for i in range(0, len(ids), BLOCK_IDS)]
    start = _HEAD.size + 8 * len(blocks)
    offsets = start + np.cumsum([0, *map(len, blocks)])[: len(blocks)]
    head = _HEAD.pack(MAGIC, BLOCK_IDS, len(ids), len(blocks))
    return b"".join([head, offsets.astype("<u8").tobytes(), *blocks])


class Reader:
    """Ids of a file by their position in it; unpacks only the blocks that are asked for."""

    def __init__(self, data: bytes):
        magic, self.block, self.count, blocks = _HEAD.unpack_from(data)
        if magic != MAGIC:
            raise ValueError("not a file of token blocks")
        self.data = memoryview(data)
        self.offsets = np.frombuffer(data, "<u8", blocks, _HEAD.size)
        self._unpacked = functools.lru_cache(maxsize=8)(self._unpack)

    def _unpack(self, k: int) -> np.ndarray:
        return unpack_block(self.data[int(self.offsets[k]) :])

    def ids(self, start: int, count: int) -> np.ndarray:
        if start < 0 or start + count > self.count:
            raise IndexError("outside this file")
        if not count:
            return np.zeros(0, np.uint32)
        blocks = [self._unpacked(k) for k in range(start // self.block, -(-(start + count) // self.block))]
        skip = start % self.block
        return np.concatenate(blocks)[skip : skip + count]


def _tokenizer(content: bytes) -> Tokenizer:
    out = Tokenizer.from_str(content.decode())
    out.encode_special_tokens = True
    out.no_padding()
    out.no_truncation()
    return out


class WordEncoder:
    """Ids of whole texts, each distinct word encoded once.

    A byte-level tokenizer always cuts before a space that stands between two other
    characters than white space, so the stretches between such cuts are encoded on
    their own and give the ids of the whole text. One with the usual pattern (`fine`) also
    cuts where letters and digits end.
    """

    def __init__(self, tokenizer, fine: bool = False):
        self.tokenizer, self.known = tokenizer, {}
        self.cut = _pieces if fine else _words

    def _learn(self, words: set[str]) -> None:
        new = words.difference(self.known)
        if len(self.known) + len(new) > KEPT_WORDS:
            self.known, new = {}, words
        listed = list(new)
        for begin in range(0, len(listed), 10_000):
            part = listed[begin : begin + 10_000]
            coded = self.tokenizer.encode_batch_fast(part, add_special_tokens=False)
            self.known.update((w, np.array(c.ids, "<u4").tobytes()) for w, c in zip(part, coded, strict=True))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        cut = [self.cut(t) for t in texts]
        self._learn(set(chain.from_iterable(cut)))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<u4") for words in cut]


@functools.lru_cache(maxsize=1)
def _encoder(content: bytes) -> WordEncoder:
    settings = json.loads(content)
    cutter = settings.get("pre_tokenizer") or {}
    usual = cutter.get("type") == "ByteLevel" and cutter.get("use_regex", True) and not cutter.get("add_prefix_space")
    return WordEncoder(_tokenizer(content), bool(usual and not settings.get("normalizer")))


def _pieces(text: str) -> list[str]:
    return _words(text) if _OTHER_SCRIPT.search(text) else _PIECE.findall(text)


def _words(text: str) -> list[str]:
    if _IRREGULAR.search(text):
        return _CUT.split(text)
    first, *rest = text.split(" ")
    return [first, *[" " + word for word in rest]]


def write(
    docs: DataFrame, folder: str, tokenizer_path: str, end_id: int = 0, id_column: str = "doc_id", text_column: str = "text"
) -> None:
    """Writes the table of files to `folder`: part, file, n, ids (of documents), counts, data."""
    spark = docs.sparkSession
    common.ship(spark)
    content = spark.sparkContext.broadcast(common.file_bytes(tokenizer_path))
    id_type = dict(docs.dtypes)[id_column]

    def rows(stream):
        """(document id, its ids with the end id, the document id's type)"""
        encoder = _encoder(content.value)
        for batch in stream:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                coded = encoder.encode([t or "" for t in part.column("text").to_pylist()])
                for document, ids in zip(part.column("id").to_pylist(), coded, strict=True):
                    yield document, np.append(ids, np.uint32(end_id)), part.column("id").type

    def run(stream):
        part, file, held = TaskContext.get().partitionId(), 0, []
        size = 0
        for *row, kind in rows(stream):
            held.append(row)
            size += len(row[1])
            if size >= FILE_IDS:
                yield _file_row(part, file, held, kind)
                file, held, size = file + 1, [], 0
        if held:
            yield _file_row(part, file, held, kind)

    texts = docs.select(F.col(common.quoted(id_column)).alias("id"), F.col(common.quoted(text_column)).alias("text"))
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // RANGE_BYTES))
    keyed = texts.withColumn("tie", F.xxhash64("text"))
    ranged = keyed.repartitionByRange(parts, "id", "tie").sortWithinPartitions("id", "tie").drop("tie")
    packed = ranged.mapInArrow(run, f"part int, file int, n long, ids array<{id_type}>, counts array<long>, data binary")
    packed.write.parquet(folder)


def _file_row(part: int, file: int, held: list, kind: pa.DataType) -> pa.RecordBatch:
    ids = np.concatenate([i for _, i in held])
    columns = {
        "part": pa.array([part], pa.int32()),
        "file": pa.array([file], pa.int32()),
        "n": pa.array([len(ids)], pa.int64()),
        "ids": pa.array([[d for d, _ in held]], pa.list_(kind)),
        "counts": pa.array([[len(i) for _, i in held]], pa.list_(pa.int64())),
        "data": pa.array([pack_file(ids)], pa.binary()),
    }
    return pa.RecordBatch.from_pydict(columns)


def read(spark: SparkSession, folder: str, id_column: str = "doc_id") -> DataFrame:
    """(id_column, start, n_tokens, ids) of every document; ids as little-endian unsigned 32-bit integers."""
    common.ship(spark)
    files = spark.read.parquet(folder)
    id_type = files.schema["ids"].dataType.elementType.simpleString()
    sums = files.groupBy("part").agg(F.sum("n").alias("n")).collect()  # one number per range
    before, total = {}, 0
    for r in sorted(sums, key=lambda r: r.part):
        before[r.part] = total
        total += r.n
    earlier = Window.partitionBy("part").orderBy("file").rowsBetween(Window.unboundedPreceding, -1)
    starts = files.select("part", "file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"))

    def run(stream):
        for batch in stream:
            for row in range(batch.num_rows):
                one = {n: batch.column(n)[row].as_py() for n in batch.schema.names}
                reader, at, ids, starts = Reader(one["data"]), 0, [], []
                for count in one["counts"]:
                    ids.append(reader.ids(at, count).astype("<u4").tobytes())
                    starts.append(before[one["part"]] + one["before"] + at)
                    at += count
                columns = [
                    batch.column("ids")[row].values,
                    pa.array(starts, pa.int64()),
                    pa.array(one["counts"], pa.int64()),
                    pa.array(ids, pa.large_binary()),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["id", "start", "n_tokens", "ids"])

    placed = files.join(starts, ["part", "file"])
    out = placed.select("part", "before", "ids", "counts", "data").mapInArrow(
        run, f"id {id_type}, start long, n_tokens long, ids binary"
    )
    return out.withColumnRenamed("id", id_column)
