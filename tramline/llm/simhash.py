"""SimHash near-duplicates by a self-join of a binary trie.

A document's fingerprint has a bit set if more than half of its word shingles' hashes
have it. Distinct fingerprints form a binary trie. Pairs of trie nodes of one depth are
followed down together, the differing bits added up on the way, and a pair is dropped
as soon as they exceed the budget. The top PREFIX_BITS levels are walked by Spark: each
pair of prefixes within the budget is a group of its own, so a fingerprint goes only to
the groups of prefixes near its own; tasks walk the levels below. Copies share a
fingerprint and take part once. Links between fingerprints then go through distributed
union-find.

PREFIX_BITS deals the work into 2 ** PREFIX_BITS subtrees; raise it with the corpus
(a fingerprint is sent once for each prefix near its own).

Defined results: words are what ASCII white space separates; A-Z are lower-cased; a null
or blank text has fingerprint zero, linked like any other; other columns are dropped; a
null id never names a component unless it is alone.
"""

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import common
from tramline.llm.graph import components
from tramline.session import materialise

SHINGLE_WORDS = 4
SEED = 42
MOST_BITS = 4
PREFIX_BITS = 6


def fingerprint(text: str, words: int = SHINGLE_WORDS) -> int:
    parts = text.encode().lower().split()
    if not parts:
        return 0
    joined = b" ".join(parts)
    ends = np.cumsum([len(p) + 1 for p in parts])
    starts = np.concatenate([[0], ends[:-1]])
    n = max(1, len(parts) - words + 1)
    last = (ends[words - 1 :] if len(parts) >= words else ends[-1:]) - 1
    spans = zip(starts[:n].tolist(), last.tolist(), strict=True)
    hashes = np.fromiter((xxhash.xxh64_intdigest(joined[a:b], SEED) for a, b in spans), np.uint64, n)
    counts = np.zeros(64, np.int64)
    for begin in range(0, n, 1 << 16):
        part = hashes[begin : begin + (1 << 16)]
        counts += np.unpackbits(part.astype(">u8").view(np.uint8)).reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * counts > n).tobytes(), "big")


def fingerprints(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, fp): the fingerprint as a signed 64-bit number."""
    common.ship(docs.sparkSession)
    id_type = dict(docs.dtypes)[id_column]

    def run(stream):
        common.release()
        for batch in stream:
            for start in range(0, batch.num_rows, 1000):
                part = batch.slice(start, 1000)
                found = np.array([fingerprint(t or "") for t in part.column("text").to_pylist()], np.uint64)
                yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(found.view(np.int64))], ["id", "fp"])

    texts = docs.select(F.col(id_column).alias("id"), F.col(text_column).alias("text"))
    return texts.mapInArrow(run, f"id {id_type}, fp long")


class Trie:
    """Levels of a binary trie over sorted distinct fingerprints, below a common prefix."""

    def __init__(self, values: np.ndarray, depth: int):
        self.values = values
        # Per level: first fingerprint of each node (with an end), and its children's numbers.
        self.first = [np.array([0, len(values)])]
        self.children = []
        for level in range(depth, 64):
            bit = (values >> np.uint64(63 - level)) & np.uint64(1)
            above = np.zeros(len(values), bool)
            above[self.first[-1][:-1]] = True
            starts = above.copy()
            starts[1:] |= bit[1:] != bit[:-1]
            first = np.flatnonzero(starts)
            child = np.full((len(self.first[-1]) - 1, 2), -1, np.int32)
            parent = np.cumsum(above)[first] - 1
            child[parent, bit[first].astype(int)] = np.arange(len(first))
            self.children.append(child)
            self.first.append(np.append(first, len(values)))


def near_pairs(left: np.ndarray, right: np.ndarray | None, depth: int, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Pairs at most `most` bits apart of two subtrees' sorted fingerprints, or within one.

    The subtrees' roots are `depth` bits down; what differs above counts as well.
    """
    a, b = Trie(left, depth), Trie(left if right is None else right, depth)
    shift = np.uint64(64 - depth)
    above = int(np.bitwise_count((left[0] ^ b.values[0]) >> shift)) if depth else 0
    found_a, found_b = [], []
    # Depth-first over blocks of node pairs, so that the open pairs stay few.
    stack = [(0, np.array([0], np.int32), np.array([0], np.int32), np.array([above], np.int8))]
    while stack:
        level, x, y, errors = stack.pop()
        if len(x) > 1 << 18:
            half = len(x) // 2
            stack += [(level, x[:half], y[:half], errors[:half]), (level, x[half:], y[half:], errors[half:])]
            continue
        wide_x = a.first[level][x + 1] - a.first[level][x]
        wide_y = b.first[level][y + 1] - b.first[level][y]
        if depth + level == 64 or (wide_x * wide_y).sum() <= 2 * len(x):
            i = np.repeat(a.first[level][x], wide_x * wide_y)
            j = np.repeat(b.first[level][y], wide_x * wide_y)
            inner = np.arange(len(i)) - np.repeat(np.cumsum(wide_x * wide_y) - wide_x * wide_y, wide_x * wide_y)
            i, j = i + inner // np.repeat(wide_y, wide_x * wide_y), j + inner % np.repeat(wide_y, wide_x * wide_y)
            near = np.bitwise_count(a.values[i] ^ b.values[j]) <= most
            if right is None:
                near &= i < j
            found_a.append(a.values[i[near]])
            found_b.append(b.values[j[near]])
            continue
        below = []
        for p in (0, 1):
            for q in (0, 1):
                more = errors + np.int8(p != q)
                child_x, child_y = a.children[level][x, p], b.children[level][y, q]
                keep = (child_x >= 0) & (child_y >= 0) & (more <= most)
                if right is None:
                    keep &= child_x <= child_y
                below.append((child_x[keep], child_y[keep], more[keep]))
        parts = [np.concatenate(c) for c in zip(*below, strict=True)]
        if len(parts[0]):
            stack.append((level + 1, *parts))
    return np.concatenate(found_a or [left[:0]]), np.concatenate(found_b or [left[:0]])


def links(prints: DataFrame, most: int = MOST_BITS, prefix_bits: int = PREFIX_BITS) -> DataFrame:
    """(x, y) of distinct fingerprints (column fp) at most `most` bits apart, each pair once."""
    common.ship(prints.sparkSession)
    width = 1 << prefix_bits
    near = [[q for q in range(width) if (p ^ q).bit_count() <= most] for p in range(width)]
    table = F.array(*[F.array(*[F.lit(q) for q in qs]) for qs in near])
    own = F.shiftrightunsigned("fp", 64 - prefix_bits).cast("int")
    spread = prints.select("fp", own.alias("p")).select("fp", "p", F.explode(F.get(table, F.col("p"))).alias("q"))
    dealt = spread.select("fp", "p", F.least("p", "q").alias("left"), F.greatest("p", "q").alias("right"))

    def join(group: pa.Table) -> pa.Table:
        prefix = group.column("p").to_numpy()
        fp = group.column("fp").to_numpy().view(np.uint64)
        low, high = prefix.min(), prefix.max()
        sides = group.column("left")[0].as_py(), group.column("right")[0].as_py()
        x = y = fp[:0]
        if sides[0] == sides[1]:
            x, y = near_pairs(np.sort(fp), None, prefix_bits, most)
        elif (low, high) == sides:
            x, y = near_pairs(np.sort(fp[prefix == low]), np.sort(fp[prefix == high]), prefix_bits, most)
        return pa.table({"x": x.view(np.int64), "y": y.view(np.int64)})

    return dealt.groupBy("left", "right").applyInArrow(join, "x long, y long")


def near_duplicates(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id_column, fingerprint as 16 hex digits, component_id) of every row."""
    prints = materialise(fingerprints(docs, id_column, text_column), "fingerprints")
    firsts = materialise(prints.groupBy("fp").agg(F.min("id").alias("id")), "distinct-fingerprints")
    near = links(firsts.select("fp"))
    named = materialise(components(near), "fingerprint-components")  # of fingerprints
    grouped = firsts.join(named.withColumnRenamed("node", "fp"), "fp", "left")
    group = F.coalesce("component", "fp")
    smallest = grouped.groupBy(group.alias("group")).agg(F.min("id").alias("component_id"))
    of = materialise(
        grouped.select("fp", group.alias("group")).join(smallest, "group").select("fp", "component_id"), "components"
    )
    hexed = F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint")
    return prints.join(of, "fp").select(F.col("id").alias(id_column), hexed, "component_id")


def keep_one(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents without those whose group has one of a smaller id."""
    found = near_duplicates(docs, id_column, text_column)
    gone = found.filter(F.col(id_column) != F.col("component_id")).select(id_column).distinct()
    return docs.join(gone, id_column, "left_anti")
