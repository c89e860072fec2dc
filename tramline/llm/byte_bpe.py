"""Byte-level BPE: overlapping chunks, stitched where pre-token boundaries agree.

A text longer than one chunk is cut into chunks that overlap. Every chunk is
pre-tokenised on its own, in parallel; two neighbours are stitched at the first
boundary that both have in their overlap. The pattern looks at no character before a
match, so from a common boundary on both scans are the same. The pieces between
stitches are then encoded, again in parallel, and their ids put in order. Where an
overlap holds no common boundary (a run of letters longer than it), the two chunks
become one and are scanned again, so the ids are those of the whole text always.

Decoding concatenates the raw bytes of the ids.

Defined results: a null text counts as empty; an empty text has no ids; equal rows
stay as many rows; a null id is an id like any other; other columns are dropped.
"""

import base64
import functools
from collections.abc import Iterator

import pyarrow as pa
import regex
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import common

CHUNK_CHARS = 1 << 15
OVERLAP_CHARS = 1 << 9
# A match may depend on so many characters after it (those of a contraction).
LOOKAHEAD = 2
# The library's scan recurses on white space; longer runs are encoded match by match.
SPACE_RUN = 5_000

_PIECES = pa.schema([("key", pa.string()), ("piece", pa.int64()), ("text", pa.large_string())])


def tokenizer(vocabulary: bytes, pattern: str) -> tiktoken.Encoding:
    """The tokenizer of a rank file's content; kept by the Python worker."""

    def make():
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, vocabulary.splitlines())}
        return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})

    return common.held("ranks", (vocabulary, pattern), make)


@functools.lru_cache(maxsize=1)
def _reclassed() -> dict[int, str]:
    """Characters whose class differs between the tokenizer's Unicode tables and those
    of `regex`, each with one that both put where the tokenizer puts it."""
    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([i]): i for i in range(256)}
    out = {}
    for pattern, stand_in in ((r"\p{L}", "é"), (r"\p{N}", "²")):
        one = tiktoken.Encoding("class", pat_str=pattern, mergeable_ranks=single, special_tokens={})
        theirs = set(bytes(one.encode_ordinary(every)).decode())
        ours = set(regex.findall(pattern, every))
        out |= {ord(c): "¤" for c in ours - theirs if ord(c) not in out}
        out |= {ord(c): stand_in for c in theirs - ours}
    return out


def match_ends(text: str, pattern: str, start: int = 0) -> list[int]:
    """Where the matches of the tokenizer's pattern end, scanning from `start`."""
    if not text.isascii():
        text = text.translate(_reclassed())
    return [m.end() for m in regex.compile(pattern).finditer(text, start)]


def stitches(text: str, after: int, pattern: str) -> list[int]:
    """Where a piece may end at or after a character, relative to it."""
    last = len(text) - LOOKAHEAD
    return [e - after for e in match_ends(text, pattern) if after <= e < last and not text[e - 1].isspace()]


def _chunked(docs: DataFrame, chunk: int, overlap: int) -> DataFrame:
    """(key, no, chunks, text): chunk `no` starts at character no * chunk."""
    schema = pa.schema([("key", pa.string()), ("no", pa.int64()), ("chunks", pa.int64()), ("text", pa.large_string())])

    def cut(rows):
        for key, text in rows:
            chunks = max(1, -(-len(text) // chunk))
            for no in range(chunks):
                yield key, no, chunks, text[no * chunk : (no + 1) * chunk + overlap]

    def run(stream: Iterator[pa.RecordBatch]):
        yield from common.batches(cut(common.records(stream, "key", "text")), schema, lambda r: len(r[3]))

    return docs.select("key", "text").mapInArrow(run, "key string, no long, chunks long, text string")


def _scanned(chunks: DataFrame, pattern: str, chunk: int, overlap: int) -> DataFrame:
    """Adds each chunk's boundaries in the overlap with the chunk before and after it.

    A match that ends near a chunk's end may be another one in the whole text: no
    boundary there. None after white space either: how a run of it is matched depends
    on what follows it, which the piece before the stitch would not have.
    """
    schema = pa.schema(
        [("key", pa.string()), ("no", pa.int64()), ("chunks", pa.int64()), ("text", pa.large_string())]
        + [(name, pa.list_(pa.int64())) for name in ("head", "tail")]
    )

    def scan(rows):
        for key, no, count, text in rows:
            head = [e for e in (0, *match_ends(text, pattern)) if e <= overlap]
            yield key, no, count, text, head, stitches(text, chunk, pattern)

    def run(stream):
        rows = common.records(stream, "key", "no", "chunks", "text")
        yield from common.batches(scan(rows), schema, lambda r: len(r[3]) + 8 * len(r[4]) + 8 * len(r[5]))

    out = "key string, no long, chunks long, text string, head array<long>, tail array<long>"
    return chunks.mapInArrow(run, out)


def stitched(chunks, pattern: str, chunk: int) -> Iterator[str]:
    """The pieces of one text, from its chunks (text, head, tail) in order."""
    held, tail = "", []  # from the last stitch on; its boundaries relative to the next chunk
    done = 0  # characters of the next chunk that `held` has already
    for text, head, own_tail in chunks:
        common_ends = sorted(set(tail) & set(head))
        if not held:
            held, tail = text, own_tail
        elif common_ends:
            at = common_ends[0]
            yield held[: len(held) - done + at]
            held, tail = text[at:], [e for e in own_tail]
        else:
            start = len(held) - done  # where this chunk starts in the longer text
            held += text[done:]
            tail = stitches(held, start + chunk, pattern)
        done = max(0, len(text) - chunk)
    if held:
        yield held


def _stitch(scanned: DataFrame, pattern: str, chunk: int) -> DataFrame:
    """(key, piece, text) of the long texts; each task streams sorted chunks."""

    def pieces(rows):
        chunk_rows, key, copy = [], None, 0
        for row in rows:
            # Equal rows give equal chunks: each is wanted once here.
            if row[0] == key and chunk_rows and row[1] < len(chunk_rows):
                continue
            if row[0] != key and chunk_rows:
                yield from ((key, i, t) for i, t in enumerate(stitched(chunk_rows, pattern, chunk)))
                chunk_rows = []
            key = row[0]
            chunk_rows.append((row[3], row[4], row[5]))
        if chunk_rows:
            yield from ((key, i, t) for i, t in enumerate(stitched(chunk_rows, pattern, chunk)))

    def run(stream):
        rows = common.records(stream, "key", "no", "chunks", "text", "head", "tail")
        yield from common.batches(pieces(rows), _PIECES, lambda r: len(r[2]))

    ordered = scanned.repartition("key").sortWithinPartitions("key", "no")
    return ordered.mapInArrow(run, "key string, piece long, text string")


def _ids_of(text: str, encoding: tiktoken.Encoding, pattern: str) -> bytes:
    if regex.search(r"\s{%d}" % SPACE_RUN, text) is None:
        return encoding.encode_to_numpy(text, disallowed_special=()).astype("<u4").tobytes()
    ends = match_ends(text, pattern)
    spans = zip([0, *ends], ends)
    ids = [i for a, b in spans for i in encoding._encode_single_piece(text[a:b])]
    return b"".join(i.to_bytes(4, "little") for i in ids)


def _encoded(texts: DataFrame, columns: str, vocabulary, pattern: str) -> DataFrame:
    """Replaces `text` by `ids`; `columns` are the others with their types."""
    names = [c.split()[0] for c in columns.split(", ")]

    def run(stream):
        encoding = tokenizer(vocabulary.value, pattern)
        for batch in stream:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                texts = part.column("text").to_pylist()
                ids = pa.array([_ids_of(t, encoding, pattern) for t in texts], pa.large_binary())
                yield pa.RecordBatch.from_arrays([*(part.column(n) for n in names), ids], [*names, "ids"])

    return texts.select(*names, "text").mapInArrow(run, f"{columns}, ids binary")


def encode(
    docs: DataFrame,
    vocabulary_path: str,
    pattern: str,
    id_column: str = "doc_id",
    text_column: str = "text",
    chunk_chars: int = CHUNK_CHARS,
    overlap_chars: int = OVERLAP_CHARS,
) -> DataFrame:
    """(id_column, ids, n_tokens) per row; ids are little-endian unsigned 32-bit integers."""
    spark = docs.sparkSession
    common.ship(spark)
    id_type = dict(docs.dtypes)[id_column]
    vocabulary = spark.sparkContext.broadcast(common.file_bytes(vocabulary_path))
    texts = docs.select(F.col(id_column).alias("id"), F.coalesce(text_column, F.lit("")).alias("text"))
    is_long = F.length("text") > chunk_chars
    short = _encoded(texts.filter(~is_long), f"id {id_type}", vocabulary, pattern)

    long = texts.filter(is_long).withColumn("key", common.row_key("id", "text"))
    chunks = _chunked(long, chunk_chars, overlap_chars).repartition("key", "no")
    pieces = _stitch(_scanned(chunks, pattern, chunk_chars, overlap_chars), pattern, chunk_chars)
    coded = _encoded(pieces.repartition("key", "piece"), "key string, piece long", vocabulary, pattern)
    joined = _concatenated(coded)
    whole = long.select("id", "key").join(joined, "key").select("id", "ids")
    return short.unionByName(whole).select(
        F.col("id").alias(id_column), "ids", (F.length("ids") / 4).cast("long").alias("n_tokens")
    )


def _concatenated(pieces: DataFrame) -> DataFrame:
    """(key, ids): the pieces' ids in order; each task streams sorted pieces."""
    schema = pa.schema([("key", pa.string()), ("ids", pa.large_binary())])

    def whole(rows):
        held, key = [], None
        for row_key, ids in rows:
            if held and row_key != key:
                yield key, b"".join(held)
                held = []
            key = row_key
            held.append(ids)
        if held:
            yield key, b"".join(held)

    def run(stream):
        yield from common.batches(whole(common.records(stream, "key", "ids")), schema, lambda r: len(r[1]))

    return pieces.repartition("key").sortWithinPartitions("key", "piece").mapInArrow(run, "key string, ids binary")


def decode(encoded: DataFrame, vocabulary_path: str, pattern: str) -> DataFrame:
    """Adds `decoded`, the raw bytes of `ids` (as made by `encode`) one after another."""
    import numpy as np

    common.ship(encoded.sparkSession)
    vocabulary = encoded.sparkSession.sparkContext.broadcast(common.file_bytes(vocabulary_path))
    columns = ", ".join(f"`{n}` {t}" for n, t in encoded.dtypes)

    def run(stream):
        encoding = tokenizer(vocabulary.value, pattern)
        for batch in stream:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                ids = (np.frombuffer(i or b"", "<u4").tolist() for i in part.column("ids").to_pylist())
                decoded = pa.array(map(encoding.decode_bytes, ids), pa.large_binary())
                names = [*part.schema.names, "decoded"]
                yield pa.RecordBatch.from_arrays([*part.columns, decoded], names)

    return encoded.mapInArrow(run, f"{columns}, decoded binary")
