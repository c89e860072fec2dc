"""Removal of word passages that an earlier document has, by suffix automata.

A window is WINDOW consecutive words. A window's anchor is the smallest hash of the
ANCHOR-word grams in it, so equal windows have equal anchors, and a document is cut into
segments: runs of windows with one anchor. The corpus is sharded by anchor. A shard
keeps the suffix automaton of its reference segments and streams the segments by
ascending document id: matching statistics give the spans of WINDOW words or more that
an earlier document has, then the segment's own words go into the automaton. So every
document is compared with all earlier ones, yet only where they share an anchor, and an
automaton never holds more than the texts of one anchor.

Anchors that only one document has are dropped first, by their hashes alone. Tasks
resolve what they can see before anything is shuffled: of one anchor or segment that
many documents of a block share, one goes on, so a passage in a third of all documents
sends one row per block.

Defined results: words are what ASCII white space separates, unchanged; windows are
judged on the input; a null text has no words; documents with a null id keep all words
and are no reference; rows with equal ids are never earlier than each other; ids are whole
numbers, and others raise; other columns are dropped.
"""

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import IntegralType

from tramline.llm import common

WINDOW = 13
ANCHOR = 4
BUCKETS = 256
BLOCK_BYTES = 6 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)
# A word's hash is a polynomial in a byte's number, whose white space is 0.
_HASHED_AT_ONCE = 1 << 16
_BASE = 0xD1342543DE82EF95
_SPACES = np.frombuffer(b" \t\n\v\f\r", np.uint8)
_NUMBER = np.arange(1, 257, dtype=np.uint64) * _MIX
_NUMBER ^= _NUMBER >> np.uint64(29)
_NUMBER[_SPACES] = 0


def _powers(base: int) -> np.ndarray:
    out = np.full(_HASHED_AT_ONCE, base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWER, _INVERSE = _powers(_BASE), _powers(pow(_BASE, -1, 1 << 64))


def _packed(texts: DataFrame, id_type: str) -> DataFrame:
    """(id, key, text) with the texts compressed: whole texts are most of what is shuffled."""

    def run(stream):
        pack = zstandard.ZstdCompressor(level=3).compress
        for batch in stream:
            for begin in range(0, batch.num_rows, 1000):
                part = batch.slice(begin, 1000)
                packed = [None if t is None else pack(t.encode()) for t in part.column("text").to_pylist()]
                arrays = [part.column("id"), part.column("key"), pa.array(packed, pa.large_binary())]
                yield pa.RecordBatch.from_arrays(arrays, ["id", "key", "text"])

    return texts.select("id", "key", "text").mapInArrow(run, f"id {id_type}, key long, text binary")


def _unpacked(packed: bytes | None) -> bytes:
    return zstandard.decompress(packed) if packed else b""


def _hashed(data: bytes) -> np.ndarray:
    """Hashes of the words of at most _HASHED_AT_ONCE bytes."""
    number = _NUMBER[np.frombuffer(data, np.uint8)]
    inside = number != 0
    inside[1:] &= ~inside[:-1]
    first = np.flatnonzero(inside)
    if not len(first):
        return np.zeros(0, np.uint64)
    out = np.add.reduceat(number * _POWER[: len(number)], first) * _INVERSE[first]
    return out ^ (out >> np.uint64(31))


def _hashes(data: bytes) -> np.ndarray:
    """Hashes of a text's words. Different words may share one: it only tells where to look."""
    if len(data) <= _HASHED_AT_ONCE:
        return _hashed(data)
    out, held, size = [], [], 0
    for word in data.split():
        size += len(word) + 1
        if size > _HASHED_AT_ONCE:
            out.append(_hashed(b" ".join(held)))
            held, size = [], len(word) + 1
        if len(word) <= _HASHED_AT_ONCE:
            held.append(word)
        else:
            out.append(np.array([xxhash.xxh64_intdigest(word)], np.uint64))
            size = 0
    return np.concatenate([*out, _hashed(b" ".join(held))])


def segments(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor, first window, windows) of each segment of one text."""
    hashes = _hashes(data)
    windows = len(hashes) - WINDOW + 1
    if windows < 1:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    grams = len(hashes) - ANCHOR + 1
    gram = np.zeros(grams, np.uint64)
    for k in range(ANCHOR):
        gram = (gram ^ hashes[k : k + grams]) * _MIX
        gram ^= gram >> np.uint64(32)
    anchor = gram[:windows]
    for k in range(1, WINDOW - ANCHOR + 1):
        anchor = np.minimum(anchor, gram[k : k + windows])
    first = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
    return anchor[first], first, np.diff(np.append(first, windows))


class Automaton:
    """Suffix automaton of many word sequences."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length = [-1], [0]

    def _clone(self, p: int, word, q: int) -> int:
        clone = len(self.next)
        self.next.append(dict(self.next[q]))
        self.link.append(self.link[q])
        self.length.append(self.length[p] + 1)
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def add(self, words) -> None:
        last = 0
        for word in words:
            if (q := self.next[last].get(word)) is not None:
                last = q if self.length[q] == self.length[last] + 1 else self._clone(last, word, q)
                continue
            state, p = len(self.next), last
            self.next.append({})
            self.link.append(0)
            self.length.append(self.length[last] + 1)
            while p >= 0 and word not in self.next[p]:
                self.next[p][word] = state
                p = self.link[p]
            if p >= 0:
                q = self.next[p][word]
                self.link[state] = q if self.length[q] == self.length[p] + 1 else self._clone(p, word, q)
            last = state

    def matches(self, words):
        """The length of the longest stretch ending at each word that was added before."""
        state = size = 0
        for word in words:
            while state and word not in self.next[state]:
                state = self.link[state]
                size = self.length[state]
            if (q := self.next[state].get(word)) is not None:
                state, size = q, size + 1
            yield size


def spans_of(sizes) -> list[tuple[int, int]]:
    """Maximal spans covered by matches of WINDOW words or more."""
    out: list[tuple[int, int]] = []
    for end, size in enumerate(sizes, 1):
        if size >= WINDOW:
            start = end - size
            while out and out[-1][1] >= start:
                start = min(start, out.pop()[0])
            out.append((start, end))
    return out


_ANCHORS = pa.schema(
    [
        ("bucket", pa.int32()),
        ("docs", pa.list_(pa.int64())),  # ids, for blobs; or one id with shared anchors
        ("anchors", pa.binary()),
        ("rows", pa.binary()),  # place in docs of each anchor; null: known to be shared
    ]
)


def _blocks(stream, plain, *columns):
    """Lists of (id, text, ...) of about BLOCK_BYTES; `plain` gives a text's bytes."""
    held, size = [], 0
    for doc, text, *rest in common.records(stream, *columns):
        text = plain(text)
        held.append((doc, text, *rest))
        size += len(text) + 64
        if size >= BLOCK_BYTES:
            yield held
            held, size = [], 0
    if held:
        yield held


def _anchor_rows(stream):
    """Per block and bucket its anchors with their documents; and anchors shared in the block."""
    for block in _blocks(stream, str.encode, "id", "text"):
        ids = [doc for doc, _ in block]
        found = [np.unique(segments(text)[0]) for _, text in block]
        anchor = np.concatenate(found)
        if not len(anchor):
            continue
        row = np.repeat(np.arange(len(block), dtype=np.uint32), [len(f) for f in found])
        order = np.lexsort((row, anchor))
        anchor, row = anchor[order], row[order]
        first = np.concatenate([[True], anchor[1:] != anchor[:-1]])
        number = np.array(ids)[row]
        group = np.cumsum(first) - 1
        low, high = np.full(group[-1] + 1, np.iinfo(np.int64).max), np.full(group[-1] + 1, np.iinfo(np.int64).min)
        np.minimum.at(low, group, number)
        np.maximum.at(high, group, number)
        shared = (low < high)[group]
        out = []
        by_row = np.argsort(row[shared], kind="stable")
        shared_row, shared_anchor = row[shared][by_row], anchor[shared][by_row]
        cuts = np.flatnonzero(np.diff(shared_row)) + 1
        for r, a in zip(np.split(shared_row, cuts), np.split(shared_anchor, cuts), strict=True):
            if len(r):
                out.append((int(r[0]) % BUCKETS, [ids[r[0]]], a.tobytes(), None))
        anchor, row = anchor[first], row[first]  # one per block goes on
        bucket = (anchor >> np.uint64(40)) % np.uint64(BUCKETS)
        order = np.argsort(bucket, kind="stable")
        anchor, row, bucket = anchor[order], row[order], bucket[order]
        cuts = np.flatnonzero(np.diff(bucket)) + 1
        for b, a, r in zip(np.split(bucket, cuts), np.split(anchor, cuts), np.split(row, cuts), strict=True):
            used, place = np.unique(r, return_inverse=True)
            width = "<u2" if len(used) < 1 << 16 else "<u4"
            out.append((int(b[0]), [ids[u] for u in used], a.tobytes(), place.astype(width).tobytes()))
        yield from common.batches(out, _ANCHORS, lambda x: len(x[2]) + 8 * len(x[1]))


def _shared_anchors(stream):
    """(id, anchors): anchors of a document that another one has too."""
    schema = pa.schema([("id", pa.int64()), ("anchors", pa.binary())])

    def found():
        open_: dict[int, list] = {}
        for bucket, docs, anchors, rows in common.records(stream, "bucket", "docs", "anchors", "rows"):
            if rows is None:
                yield docs[0], anchors
            else:
                a = np.frombuffer(anchors, "<u8")
                place = np.frombuffer(rows, "<u2" if len(rows) == 2 * len(a) else "<u4")
                open_.setdefault(bucket, []).append((a, np.array(docs)[place]))
        for parts in open_.values():
            anchor, doc = (np.concatenate(c) for c in zip(*parts, strict=True))
            order = np.lexsort((doc, anchor))
            anchor, doc = anchor[order], doc[order]
            start = np.flatnonzero(np.concatenate([[True], anchor[1:] != anchor[:-1]]))
            size = np.diff(np.append(start, len(anchor)))
            several = np.repeat(doc[start] < doc[start + size - 1], size)
            order = np.argsort(doc[several], kind="stable")
            anchor, doc = anchor[several][order], doc[several][order]
            cuts = np.flatnonzero(np.diff(doc)) + 1
            for d, a in zip(np.split(doc, cuts), np.split(anchor, cuts), strict=True):
                if len(d):
                    yield int(d[0]), a.tobytes()

    yield from common.batches(found(), schema, lambda r: len(r[1]))


_SEGMENTS = pa.schema(
    [
        ("anchor", pa.int64()),
        ("id", pa.int64()),
        ("key", pa.int64()),  # tells apart documents of one id
        ("starts", pa.list_(pa.int32())),
        ("text", pa.binary()),
        ("end", pa.int32()),
    ]
)


def _segment_rows(stream):
    """Segments with a shared anchor, one document's per block and text; and the spans of the others."""
    for block in _blocks(stream, _unpacked, "id", "text", "key", "shared"):
        where: dict[tuple[int, bytes], dict[tuple[int, int], list[int]]] = {}
        for doc, data, key, shared in block:
            anchor, first, windows = segments(data)
            words = data.split()
            wanted = np.isin(anchor, np.concatenate([np.frombuffer(s, "<u8") for s in shared]))
            numbers = anchor[wanted].view(np.int64).tolist()
            for a, s, n in zip(numbers, first[wanted].tolist(), windows[wanted].tolist(), strict=True):
                text = b" ".join(words[s : s + n + WINDOW - 1])
                where.setdefault((a, text), {}).setdefault((doc, key), []).append(s)
        out = []
        for (a, text), docs in where.items():
            earliest, _ = min(docs)
            length = text.count(b" ") + 1
            for (doc, key), starts in docs.items():
                if doc == earliest:
                    out.append((a, doc, key, starts, text, None))
                else:
                    out.append((key ^ doc, doc, key, starts, None, length))
        yield from common.batches(out, _SEGMENTS, lambda r: 60 + len(r[4] or b""))


_SPANS = pa.schema([("id", pa.int64()), ("key", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])


def _span_rows(stream):
    """Streams a shard's segments by anchor and document id; yields covered spans."""

    def found():
        anchor, doc, automaton, seen, pending = None, None, None, set(), []

        def learn():
            """Makes the segments of the document that is over part of the reference."""
            nonlocal automaton
            for text in pending:
                if text not in seen:
                    if automaton is not None:
                        automaton.add(text.split(b" "))
                    seen.add(text)
            pending.clear()

        for a, d, key, starts, text, end in common.records(stream, *_SEGMENTS.names):
            if text is None:
                yield from ((d, key, s, s + end) for s in starts)
                continue
            if a != anchor:
                anchor, doc, automaton, seen, pending = a, d, None, set(), []
            elif d != doc:
                learn()
                doc = d
            pending.append(text)
            if not seen:
                continue
            words = text.split(b" ")
            if text in seen:
                spans = [(0, len(words))]
            else:
                if automaton is None:  # built when the anchor has a second text
                    automaton = Automaton()
                    for known in sorted(seen):
                        automaton.add(known.split(b" "))
                spans = spans_of(automaton.matches(words))
            yield from ((d, key, s + x, s + y) for s in starts for x, y in spans)

    yield from common.batches(found(), _SPANS, lambda r: 16)


def covered(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, key, spans): word spans (start, end) of a document that earlier documents have.

    `key` is xxhash64 of the text, which tells documents of one id apart.
    """
    common.ship(docs.sparkSession)
    if not isinstance(docs.select(common.quoted(id_column)).schema[0].dataType, IntegralType):
        raise TypeError(f"{id_column} must hold whole numbers, which tell the earlier document")
    columns = [F.col(common.quoted(id_column)).cast("long").alias("id"), F.col(common.quoted(text_column)).alias("text")]
    texts = docs.select(*columns).withColumn("key", F.xxhash64("text")).filter("id IS NOT NULL AND text IS NOT NULL")
    anchors = texts.mapInArrow(_anchor_rows, "bucket int, docs array<long>, anchors binary, rows binary")
    shared = anchors.repartition("bucket").mapInArrow(_shared_anchors, "id long, anchors binary")
    wanted = shared.groupBy("id").agg(F.collect_list("anchors").alias("shared"))
    found = _packed(texts, "long").join(wanted, "id").mapInArrow(
        _segment_rows, "anchor long, id long, key long, starts array<int>, text binary, end int"
    )
    dealt = found.repartition("anchor").sortWithinPartitions("anchor", "id")
    spans = dealt.mapInArrow(_span_rows, "id long, key long, start int, end int")
    return spans.groupBy("id", "key").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id_column, text, n_words, n_removed) of every row: text is the kept words, one space between."""
    id_type = dict(docs.dtypes)[id_column]
    spans = covered(docs, id_column, text_column)
    texts = docs.select(F.col(common.quoted(id_column)).alias("id"), F.col(common.quoted(text_column)).alias("text"))

    def run(stream):
        names = ["id", "text", "n_words", "n_removed"]
        for batch in stream:
            for begin in range(0, batch.num_rows, 500):
                part = batch.slice(begin, 500)
                kept, counts, removed = [], [], []
                for text, spans in common.records([part], "text", "spans"):
                    words = _unpacked(text).split()
                    flags = np.zeros(len(words) + 1, np.int64)
                    for span in spans or ():
                        flags[span["start"]] += 1
                        flags[span["end"]] -= 1
                    keep = np.cumsum(flags[:-1]) == 0
                    kept.append(b" ".join([w for w, k in zip(words, keep.tolist(), strict=True) if k]).decode())
                    counts.append(len(words))
                    removed.append(len(words) - int(keep.sum()))
                arrays = [part.column("id"), pa.array(kept, pa.large_string())]
                arrays += [pa.array(c, pa.int64()) for c in (counts, removed)]
                yield pa.RecordBatch.from_arrays(arrays, names)

    packed = _packed(texts.withColumn("key", F.xxhash64("text")), id_type)
    joined = packed.join(spans, ["id", "key"], "left")
    return joined.mapInArrow(run, f"id {id_type}, text string, n_words long, n_removed long").withColumnRenamed("id", id_column)
