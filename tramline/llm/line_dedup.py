"""Near-duplicate lines across a corpus: one line of each group stays.

A line's signature has BANDS bands of BAND_ROWS MinHash values each, over its shingles of
EXACT characters at every position; two lines whose shingle sets have similarity s share a
band with probability 1 - (1 - s ** BAND_ROWS) ** BANDS, whatever their lengths. In a
band's bucket every line is compared with the bucket's first. Then the bucket's other lines
are compared; in a crowded bucket, of more than CROWD lines, only those that share one of their
rarest shingles, as similar lines must (prefix filter), so that unlike lines of one template are
not paired. Lines that already link to one line are not compared again: they are of one
component. Pairs are left out if more than
SKETCH_DIFFER of SKETCH bits, of the bands' and further MinHash values, differ; a similar pair has a chance of
one in a hundred thousand of that. A pair links if the Jaccard similarity of all its shingles
is at least SIMILARITY. Of each component of links the first line, by document id and place,
stays; every other occurrence goes.

Shingles are hashed and compared in numpy and Python, within tasks; Spark deals the lines,
buckets, pairs and components. Only hashes travel until pairs that may link are known: sketches
are compared inside a bucket's task, which gives close pairs only, and lines without any go.

Defined results: lines end at a line feed and are compared without white space around
them; blank lines always stay; a null text stays null; rows with one document id are one
document, whose equal lines at one place are one line; other columns stay, whatever their names.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tramline.llm import common
from tramline.llm.common import quoted
from tramline.llm.graph import components
from tramline.session import let_go, materialise

EXACT = 5
SIMILARITY = 0.8
BANDS, BAND_ROWS = 24, 5
SKETCH, SKETCH_DIFFER = 128, 30
CROWD = 2048
SEED, SKETCH_SEED = 11, 12
# Characters hashed at a time; longer lines are hashed in overlapping parts.
PIECE = 1 << 16
# Distinct lines whose bands a worker holds, and the parts that it deals them to.
HELD_LINES = 1 << 16
PARTS, PART_SHIFT = 1 << 10, np.uint64(54)
# Rows of pairs in an Arrow batch, and hashes of lines that are kept while their pairs are judged.
PAIR_ROWS, JUDGED_HASHES = 1 << 18, 1 << 22
# Pairs within so many shingles of SIMILARITY are judged by the shingles themselves.
CLASHES = 4
# Ids that are sent to all lines; bits of one bitmap as Spark makes them, and of all bitmaps that are sent.
SENT_IDS = 1 << 20
BITMAP, MAP_BITS = 1 << 15, 1 << 27


def _settled(df: DataFrame, purpose: str) -> DataFrame:
    """`df` materialised; the shuffles it came from are let go."""
    done = materialise(df, purpose)
    del df
    let_go(done.sparkSession)
    return done


def lines_of(docs: DataFrame, id_column: str, text_column: str) -> DataFrame:
    """(id, place, line, a, b) of each line that is not blank; (a, b) is its 128-bit hash."""
    lines = F.split(F.col(quoted(text_column)), "\n")
    split = docs.select(F.col(quoted(id_column)).alias("id"), F.posexplode(lines).alias("place", "raw"))
    trimmed = split.select("id", "place", F.expr("trim(BOTH ' \t\r\f' FROM raw)").alias("line")).filter("line <> ''")
    return trimmed.withColumns({"a": F.xxhash64("line"), "b": F.xxhash64(F.lit(1), "line")})


def _mixed(text: str) -> np.ndarray:
    """A 64-bit hash of the EXACT characters that start at each position."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4")
    n = len(codes) - EXACT + 1
    h = codes[:n].astype(np.uint64)
    for i in range(1, EXACT):
        h *= np.uint64(0x9E3779B97F4A7C15)
        h += codes[i : i + n]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    return h


def _hashed(text: str) -> np.ndarray:
    """A 32-bit hash of the EXACT characters that start at each position."""
    return (_mixed(text) >> np.uint64(32)).astype(np.uint32)


def _parts(lines: list[str]):
    """Groups of (line number, part), of about PIECE characters; no line twice in a group."""
    group, size = [], 0
    for i, line in enumerate(lines):
        for start in range(0, max(len(line) - EXACT, 0) + 1, PIECE):
            part = line[start : start + PIECE + EXACT - 1]
            if len(part) < EXACT:
                continue
            if size + len(part) > PIECE and group:
                yield group
                group, size = [], 0
            group.append((i, part))
            size += len(part)
    if group:
        yield group


def _drawn(n: int, seed: int) -> np.ndarray:
    """The turns and the odd factors of `n` hash functions."""
    pick = np.random.default_rng(seed)
    turns = pick.integers(0, 1 << 32, n, dtype=np.uint32)
    return np.stack([turns, pick.integers(0, 1 << 32, n, dtype=np.uint32) | np.uint32(1)])


def signatures(lines: list[str]) -> np.ndarray:
    """SKETCH MinHash values, the bands' first, one row a line; lines below EXACT characters have the largest values."""
    n = SKETCH
    turns, factors = np.hstack([_drawn(BANDS * BAND_ROWS, SEED), _drawn(n - BANDS * BAND_ROWS, SKETCH_SEED)])
    found = np.full((n, len(lines)), 0xFFFFFFFF, np.uint32)
    for group in _parts(lines):
        sizes = np.array([len(part) for _, part in group])
        # Each part's own shingles; those across to the next part are left out.
        own = np.ones(sizes.sum() - EXACT + 1, bool)
        for k in range(1, EXACT):
            own[np.cumsum(sizes)[:-1] - k] = False
        hashes = _hashed("".join(part for _, part in group))[own]
        counts = sizes - EXACT + 1
        starts, rows = np.cumsum(counts) - counts, [i for i, _ in group]
        x, least = np.empty_like(hashes), np.empty((n, len(group)), np.uint32)
        for k in range(n):
            # In place: a new array of this size would cost more than its values.
            np.bitwise_xor(hashes, turns[k], out=x)
            np.multiply(x, factors[k], out=x)
            np.minimum.reduceat(x, starts, out=least[k])
        found[:, rows] = np.minimum(found[:, rows], least)
    return found.T


def bands_of(values: np.ndarray) -> np.ndarray:
    """BANDS 64-bit keys, one row a line, of its first MinHash values."""
    keys = np.empty((len(values), BANDS), np.uint64)
    for j in range(BANDS):
        key = np.full(len(values), j + 1, np.uint64)
        for k in range(j * BAND_ROWS, (j + 1) * BAND_ROWS):
            key = (key ^ values[:, k]) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        keys[:, j] = key
    return keys


def sketches(values: np.ndarray) -> np.ndarray:
    """SKETCH bits in 64-bit words, one row a line; each bit is one of a MinHash value's own."""
    # A value is a minimum, so its high bits are mostly 0: a mixed bit is taken.
    bits = (values * np.uint32(0x2C1B3C6D)) >> np.uint32(31)
    return np.packbits(np.ascontiguousarray(bits, np.uint8), axis=1).view("<i8")


def _once(batch, known: np.ndarray) -> tuple[np.ndarray, list[str]]:
    """The hashes and texts of a batch of (a, line), equal lines once and none of the known ones."""
    a, first = np.unique(batch.column(0).to_numpy(), return_index=True)
    new = ~np.isin(a, known)
    return a[new], batch.column(1).take(pa.array(first[new])).to_pylist()


def _dealt(a: np.ndarray, keys: np.ndarray, words: np.ndarray) -> pa.RecordBatch:
    """(part, bands, lines, sketches): the lines' (band, line) pairs and sketches by parts of the keys."""
    keys, held = keys.ravel(), np.repeat(a, BANDS)
    parts = [(x >> PART_SHIFT).astype(np.uint16) for x in (keys, a.view(np.uint64))]
    orders = [np.argsort(x, kind="stable") for x in parts]
    low, held, words = keys[orders[0]].astype("<u4"), held[orders[0]], np.column_stack([a, words])[orders[1]]
    edges = [np.searchsorted(x[order], np.arange(PARTS + 1)).tolist() for x, order in zip(parts, orders, strict=True)]
    spans = [list(zip(e, e[1:], strict=False)) for e in edges]
    columns = [
        pa.array(np.arange(PARTS), pa.int32()),
        *(pa.array([x[i:j].tobytes() for i, j in spans[k]], pa.binary()) for k, x in ((0, low), (0, held), (1, words))),
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "bands", "lines", "sketches"])


def _banded(stream):
    common.release()
    held, known = [], np.zeros(0, np.int64)
    for batch in stream:
        a, lines = _once(batch, known)
        values = signatures(lines)
        held.append((a, bands_of(values), sketches(values)))
        del values
        known = np.concatenate([known, a])
        if len(known) >= HELD_LINES:
            yield _dealt(*map(np.concatenate, zip(*held, strict=True)))
            held, known = [], np.zeros(0, np.int64)
    if held:
        yield _dealt(*map(np.concatenate, zip(*held, strict=True)))
    del held, known
    common.release()


def _joined(column, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def _bucketed(table: pa.Table) -> pa.Table:
    """A part's buckets of more than one distinct line, and its lines' sketches."""
    part = table.column("part")[0].as_py()
    low, a = _joined(table.column("bands"), "<u4"), _joined(table.column("lines"), "<i8")
    order = np.lexsort((a, low))
    low, a = low[order], a[order]
    new = np.ones(len(a), bool)
    new[1:] = (low[1:] != low[:-1]) | (a[1:] != a[:-1])
    low, a = low[new], a[new]
    kept = np.zeros(len(low), bool)
    kept[1:] = low[1:] == low[:-1]
    kept[:-1] |= kept[1:]
    band = low[kept].astype(np.int64) | part << 32
    words = _joined(table.column("sketches"), "<i8").reshape(-1, 3)
    words = words[np.unique(words[:, 0], return_index=True)[1]]
    n, m = len(band), len(words)
    columns = [
        pa.concat_arrays([pa.array(band), pa.nulls(m, pa.int64())]),
        pa.array(np.r_[a[kept], words[:, 0]]),
        *(pa.concat_arrays([pa.nulls(n, pa.int64()), pa.array(np.ascontiguousarray(words[:, k]))]) for k in (1, 2)),
    ]
    return pa.Table.from_arrays(columns, ["band", "a", "s", "t"])


def _signed(lines: DataFrame) -> DataFrame:
    """(band, a, s, t): members of buckets with more than one distinct line, then lines with their sketches.

    Lines below EXACT characters are similar to no other. Pairs of band and line travel as bytes,
    by PARTS parts of the bands; a bucket's key is its part and 32 more bits, so a few buckets may
    be two bands' in one, whose lines are compared all the same.
    """
    common.ship(lines.sparkSession)
    long = lines.filter(F.length("line") >= EXACT).select("a", "line")
    dealt = long.mapInArrow(_banded, "part int, bands binary, lines binary, sketches binary")
    return dealt.groupBy("part").applyInArrow(_bucketed, "band long, a long, s long, t long")


def _members(signed: DataFrame) -> DataFrame:
    return signed.filter("band IS NOT NULL").select("band", "a")


def _buckets(lines: DataFrame) -> DataFrame:
    """(band, a): members of buckets with more than one distinct line."""
    return _members(_signed(lines))


def _close() -> F.Column:
    """Whether the sketches (s, t) and (s_o, t_o) of a pair allow SIMILARITY."""
    differ = [F.bit_count(F.col(c).bitwiseXOR(F.col(f"{c}_o"))) for c in ("s", "t")]
    return differ[0] + differ[1] <= SKETCH_DIFFER


def _others(rows: DataFrame, *names: str) -> DataFrame:
    """`rows` as the other side of pairs, with the given columns as they are."""
    renamed = {"a": "other"} | {c: f"{c}_o" for c in rows.columns if c != "a" and c not in names}
    return rows.withColumnsRenamed(renamed)


def _by_buckets(batches, *names: str) -> tuple[np.ndarray, list[np.ndarray]]:
    """Where each row's bucket begins, and the columns `names`, by bucket and line."""
    table = pa.Table.from_batches(batches)
    band, a = (table.column(c).to_numpy() for c in ("band", "a"))
    order = np.lexsort((a, band))
    band = band[order]
    starts = np.flatnonzero(np.r_[True, band[1:] != band[:-1]][: len(band)])
    return np.repeat(starts, np.diff(np.r_[starts, len(band)])), [table.column(c).to_numpy()[order] for c in names]


def _sizes(start: np.ndarray) -> np.ndarray:
    """Each row's bucket's rows."""
    return np.bincount(start, minlength=len(start))[start]


def _near(s: np.ndarray, t: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Whether the sketches of rows `i` and `j` allow SIMILARITY."""
    differ = [np.bitwise_count((x[i] ^ x[j]).view(np.uint64)) for x in (s, t)]
    return differ[0] + differ[1] <= SKETCH_DIFFER


def _meeting(start: np.ndarray, rows: np.ndarray, s: np.ndarray, t: np.ndarray):
    """Pairs (i, j) of rows of one bucket whose sketches are close, `rows` and their later ones, by steps between them."""
    end, step = start + _sizes(start), 1
    while len(rows := rows[rows + step < end[rows]]):
        near = _near(s, t, rows, rows + step)
        yield rows[near], rows[near] + step
        step += 1


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines that are close to their bucket's first; then the members that the second round needs."""
    start, (band, a, s, t) = _by_buckets(batches, "band", "a", "s", "t")
    size, rows = _sizes(start), np.arange(len(start))
    close = (rows > start) & _near(s, t, rows, start)
    pairs = np.unique(np.column_stack([a[close], a[start[close]]]), axis=0)
    needed = size > CROWD
    # The first is compared already.
    for i, j in _meeting(start, np.flatnonzero((rows > start) & ~needed), s, t):
        needed[i] = needed[j] = True
    none = pa.nulls(len(pairs), pa.int64())
    members = [x[needed] for x in (band, a, a[start], size, s, t)]
    firsts = [none, *(pa.array(np.ascontiguousarray(x)) for x in pairs.T), none, none, none]
    columns = [pa.concat_arrays([x, pa.array(y, pa.int64())]) for x, y in zip(firsts, members, strict=True)]
    yield pa.RecordBatch.from_arrays(columns, ["band", "a", "first", "size", "s", "t"])


def _paired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(a, other): close pairs of a bucket's lines that have different roots."""
    start, (a, root, s, t) = _by_buckets(batches, "a", "root", "s", "t")
    found, size = [np.zeros((2, 0), np.int64)], 0

    def batch():
        pairs = np.unique(np.hstack(found), axis=1)
        return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(x)) for x in pairs], ["a", "other"])

    for i, j in _meeting(start, np.arange(len(start)), s, t):
        new = root[i] != root[j]
        found.append(np.stack([a[i[new]], a[j[new]]]))
        size += found[-1].shape[1]
        if size >= PAIR_ROWS:
            yield batch()
            found, size = found[:1], 0
    yield batch()


def _in_buckets(rows: DataFrame, run, columns: str) -> DataFrame:
    """`run` over whole buckets, PARTS groups of them."""
    common.ship(rows.sparkSession)
    return rows.groupBy(F.shiftright("band", 32).alias("part")).applyInArrow(run, columns)


def _near_rows(members: DataFrame, sketched: DataFrame) -> DataFrame:
    """(band, a, first, size, s, t): pairs (a, first), without a band, then members that have other close ones.

    Of a crowded bucket, all members.
    """
    both = members.join(sketched, "a").select("band", "a", "s", "t")
    return _in_buckets(both, _compared, "band long, a long, first long, size long, s long, t long")


def _held(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """`lines` whose hash `a` is among the distinct `ids`; few others are shuffled.

    Up to SENT_IDS ids are sent to the lines; of more, bitmaps of MAP_BITS in all, before the join.
    """
    if ids.count() <= SENT_IDS:
        return lines.join(F.broadcast(ids), "a", "left_semi")
    bits = MAP_BITS
    spot = F.pmod("a", F.lit(bits))
    places = ids.select(F.floor(spot / BITMAP).alias("bucket"), (spot % BITMAP).alias("bit")).repartition("bucket")
    maps = places.groupBy("bucket").agg(F.bitmap_construct_agg("bit").alias("map"))
    named = lines.withColumns({"bucket": F.floor(spot / BITMAP), "bit": (spot % BITMAP).cast("int")})
    byte = F.conv(F.hex(F.substring("map", F.floor(F.col("bit") / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    marked = F.expr("getbit(byte, bit % 8) = 1")
    near = named.join(F.broadcast(maps), "bucket").withColumn("byte", byte).filter(marked)
    return near.select(lines.columns).join(ids, "a", "left_semi")


def shingles(line: str) -> set[str]:
    return {line[i : i + EXACT] for i in range(max(len(line) - EXACT, 0) + 1)}


def similar(x: set[str], y: set[str]) -> bool:
    small, large = sorted((len(x), len(y)))
    if small < SIMILARITY * large:
        return False
    shared = len(x & y)
    return shared >= SIMILARITY * (len(x) + len(y) - shared)


def _distinct(hashes: np.ndarray) -> np.ndarray:
    """The distinct hashes, sorted; np.unique takes several times as long."""
    hashes.sort()
    new = np.ones(len(hashes), bool)
    np.not_equal(hashes[1:], hashes[:-1], out=new[1:])
    return hashes[new]


def _verdicts(rows):
    """Whether each pair of texts is similar: by 64-bit hashes of their shingles, near the limit by the shingles."""
    held, size = {}, 0
    for pair in rows:
        for text in pair:
            if text not in held:
                held[text] = _distinct(_mixed(text))
                size += len(held[text])
        small, large = sorted((held[text] for text in pair), key=len)
        # By so many shingles the pair is above the limit; hashes that clash by chance could move it by one or two.
        above = len(small) - SIMILARITY * len(large)
        if above >= -CLASHES:
            both = np.concatenate([small, large])
            both.sort()
            shared = np.count_nonzero(both[1:] == both[:-1])
            above = shared - SIMILARITY * (len(small) + len(large) - shared)
        yield above > 0 if abs(above) > CLASHES else similar(*map(shingles, pair))
        if size > JUDGED_HASHES:
            held, size = {}, 0


def _judged(stream):
    for batch in stream:
        near = pa.array([bool(v) for v in _verdicts(common.records([batch], "x", "y"))], pa.bool_())
        names = [n for n in batch.schema.names if n not in ("x", "y")]
        yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), near], [*names, "near"])


def _links(pairs: DataFrame, lines: DataFrame) -> DataFrame:
    """(a, other, u, v): the pairs that link, with the first places of their lines."""
    pairs = _settled(pairs, "line-pairs")
    ids = materialise(pairs.select(F.explode(F.array("a", "other")).alias("a")).distinct(), "line-ids")
    node = F.min(F.struct("id", "place", "a", "b")).alias("node")
    found = _held(lines, ids).groupBy("a", "b", "line").agg(node)
    texts = materialise(found.select("a", "line", "node"), "line-texts")
    left = texts.select("a", F.col("node").alias("u"), F.col("line").alias("x"))
    right = texts.select(F.col("a").alias("other"), F.col("node").alias("v"), F.col("line").alias("y"))
    both = pairs.join(left, "a").join(right, "other").select("a", "other", "u", "v", "x", "y")
    out = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in both.schema.fields[:4])
    judged = both.mapInArrow(_judged, f"{out}, near boolean")
    return _settled(judged.filter("near").drop("near"), "line-links")


def _shingled(stream):
    schema = pa.schema([("a", pa.int64()), ("n", pa.int64()), ("h", pa.int64())])
    for batch in stream:
        for a, line in common.records([batch], "a", "line"):
            h = np.unique(_hashed(line)).astype(np.int64)
            columns = [np.full(len(h), a), np.full(len(h), len(h)), h]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], schema=schema)


def _rooted(sketched: DataFrame, links: DataFrame) -> DataFrame:
    """Adds `root`: the smallest line that a line links to in two steps by (a, other), else itself."""
    first = links.groupBy("a").agg(F.min("other").alias("step"))
    second = first.select(F.col("a").alias("step"), F.col("step").alias("root"))
    roots = first.join(second, "step", "left").select("a", F.coalesce("root", "step").alias("root"))
    return sketched.join(roots, "a", "left").withColumn("root", F.coalesce("root", "a"))


def _crowded_pairs(crowded: DataFrame, lines: DataFrame) -> DataFrame:
    """(a, other): lines of crowded buckets that share a value of their prefixes, one of them failed, and may be similar.

    Lines with n shingles, and similarity SIMILARITY to another, have all but 1 - SIMILARITY
    of them in common with it: the rarest beyond that share meet, in whatever bucket. Sketches
    travel with the prefixes, so that most pairs end where they meet.
    """
    known = materialise(crowded.groupBy("a", "root", "s", "t").agg(F.max("failed").alias("failed")), "line-crowded")
    held = _held(lines.select("a", "line"), known.select("a")).distinct()
    every = materialise(held.mapInArrow(_shingled, "a long, n long, h long"), "line-shingles")
    counted = every.join(every.groupBy("h").count(), "h")
    # Hash collisions may take shingles together: one more than the bound.
    place = F.row_number().over(Window.partitionBy("a").orderBy("count", "h"))
    prefix = F.floor(F.col("n") * (1 - SIMILARITY) + 1e-6) + 2
    short = counted.withColumn("place", place).filter(F.col("place") <= prefix).select("a", "n", "h")
    rare = materialise(short.join(known, "a"), "line-prefixes")
    probes = rare.filter("failed").drop("failed")
    sized = F.least("n", "n_o") + 1 >= SIMILARITY * F.greatest("n", "n_o")
    met = probes.join(_others(rare.drop("failed"), "h"), "h")
    return met.filter((F.col("root") != F.col("root_o")) & sized & _close()).select("a", "other")


def _second_pairs(near: DataFrame, first_round: DataFrame, lines: DataFrame) -> DataFrame:
    """(a, other), each pair once: what lines may still link to in their buckets."""
    rooted = materialise(_rooted(near.filter("band IS NOT NULL"), first_round), "line-rooted")
    small, crowded = rooted.filter(F.col("size") <= CROWD), rooted.filter(F.col("size") > CROWD)
    within = _in_buckets(small.select("band", "a", "root", "s", "t"), _paired, "a long, other long")
    # Lines of the first's root need not be compared with each other.
    firsts = crowded.filter("a = first").select("band", F.col("root").alias("first_root"))
    failed = crowded.join(firsts, "band").withColumn("failed", F.col("root") != F.col("first_root"))
    touched = failed.join(failed.filter("failed").select("band").distinct(), "band", "left_semi")
    pairs = within.unionByName(_crowded_pairs(touched, lines))
    return pairs.selectExpr("least(a, other) AS a", "greatest(a, other) AS other").distinct()


def removed_places(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """(id, places): sorted places of the lines to remove, for documents that have some."""
    lines = lines_of(docs, id_column, text_column)
    signed = _settled(_signed(lines), "line-buckets")
    near = _settled(_near_rows(_members(signed), signed.filter("band IS NULL").select("a", "s", "t")), "line-near")
    by_first = near.filter("band IS NULL").select("a", F.col("first").alias("other")).distinct()
    first_round = _links(by_first, lines)
    second_round = _links(_second_pairs(near, first_round, lines), lines)
    parts = components(first_round.unionByName(second_round).select("u", "v"))
    later = parts.filter("node <> component").select(F.col("node.a").alias("a"), F.col("node.b").alias("b"), F.lit(True).alias("later"))

    occurrences = lines.select("id", "place", "a", "b")
    firsts = occurrences.groupBy("a", "b").agg(
        F.min(F.struct("id", "place")).alias("kept"), F.count(F.lit(1)).alias("n")
    )
    judged = firsts.join(later, ["a", "b"], "left").filter("n > 1 OR later")
    gone = occurrences.join(materialise(judged, "line-verdicts"), ["a", "b"]).filter(
        (F.struct("id", "place") != F.col("kept")) | F.coalesce("later", F.lit(False))
    )
    return gone.groupBy("id").agg(F.array_sort(F.collect_set("place")).alias("places"))


def deduplicate(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The documents, their texts without the removed lines; adds n_lines and n_removed."""
    # Names of their own, since `docs` may have any.
    columns = {c: f"c{i}" for i, c in enumerate(docs.columns)}
    named = docs.toDF(*columns.values())
    text, found = F.col(columns[text_column]), removed_places(docs, id_column, text_column)
    gone = found.toDF("gone_id", "gone_places")
    lines = F.split(text, "\n")
    kept = F.array_join(F.filter(lines, lambda _, i: ~F.array_contains("gone_places", i)), "\n")
    joined = named.join(gone, F.col(columns[id_column]).eqNullSafe(F.col("gone_id")), "left")
    texts = {columns[text_column]: F.when(F.col("gone_places").isNull(), text).otherwise(kept)}
    return joined.select(
        *[texts.get(c, F.col(c)).alias(n) for n, c in columns.items()],
        F.coalesce(F.size(lines), F.lit(0)).alias("n_lines"),
        F.coalesce(F.size("gone_places"), F.lit(0)).alias("n_removed"),
    )
