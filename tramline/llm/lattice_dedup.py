"""Near-duplicate embeddings by lattice hashing.

Each of TABLES random projections takes a unit vector to eight dimensions, where it is
decoded to the nearest point of a scaled E8 lattice. A vector is put into that point's
cell and into the cells of the PROBES - 1 next nearest lattice points, so two vectors
meet if their neighbourhoods share a cell in any table. Vectors that meet are compared
by cosine in double precision. A pair that meets more than once counts only in the first
of its common cells, so links are counted without a list of all pairs; every cell also
reports a forest of its links, which union-find joins to components.

Equal vectors take part once, with their number. A cell of more than BLOCK_ROWS vectors
is cut into blocks, and pairs of blocks are compared in tasks of their own.

Defined results: vectors are compared only under equal labels that are not null and with
equal lengths; null, empty and zero vectors and those with null or non-finite components
link with nothing; equal ids stay rows of their own; other columns are dropped.
"""

import functools
from itertools import combinations, product

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tramline.llm import common
from tramline.llm.graph import components
from tramline.session import materialise

LEAST_COSINE = 0.93
TABLES = 12
PROBES = 3
# Lattice scale, relative to how much a projection shortens a vector.
WIDTH = 0.42
BLOCK_ROWS = 2048
SEED = 6
_PAIR_ROWS = 1 << 18


def _minimal_vectors() -> np.ndarray:
    """Zero and the 240 shortest vectors of E8."""
    out = [np.zeros(8)]
    for i, j in combinations(range(8), 2):
        for signs in product((1, -1), repeat=2):
            v = np.zeros(8)
            v[[i, j]] = signs
            out.append(v)
    halves = (np.array(s) for s in product((0.5, -0.5), repeat=8))
    return np.array(out + [h for h in halves if h.prod() > 0])


_NEAR = _minimal_vectors()
_NEAR_SQUARED = (_NEAR**2).sum(axis=1)
_MIX = np.random.default_rng(SEED).integers(1 << 20, 1 << 62, 9, dtype=np.int64) | 1


def _even(y: np.ndarray) -> np.ndarray:
    """The nearest integer points with an even sum."""
    point = np.rint(y)
    off = y - point
    odd = np.flatnonzero(point.sum(axis=1) % 2 != 0)
    worst = np.abs(off[odd]).argmax(axis=1)
    point[odd, worst] += np.where(off[odd, worst] >= 0, 1, -1)
    return point


def decode(y: np.ndarray) -> np.ndarray:
    """The nearest E8 point of each row."""
    whole, half = _even(y), _even(y - 0.5) + 0.5
    nearer = ((y - whole) ** 2).sum(axis=1) <= ((y - half) ** 2).sum(axis=1)
    return np.where(nearer[:, None], whole, half)


@functools.lru_cache(maxsize=8)
def _projections(length: int) -> np.ndarray:
    draw = np.random.default_rng([SEED, length])
    if length <= 8:
        return np.stack([np.eye(length, 8)] * TABLES)
    return np.stack([np.linalg.qr(draw.standard_normal((length, 8)))[0] for _ in range(TABLES)])


def cells(units: np.ndarray) -> np.ndarray:
    """(rows, TABLES, PROBES): numbers of the cells of unit vectors, nearest first."""
    out = np.empty((len(units), TABLES, PROBES), np.int64)
    width = WIDTH * np.sqrt(8 / max(8, units.shape[1]))
    for t, projection in enumerate(_projections(units.shape[1])):
        for begin in range(0, len(units), 4096):
            # Rounding makes a row's cells independent of the rows it is computed with.
            y = np.round(units[begin : begin + 4096] @ projection / width, 9)
            point = decode(y)
            far = np.round(_NEAR_SQUARED - 2 * (y - point) @ _NEAR.T, 9)
            nearest = np.argpartition(far, PROBES, axis=1)[:, : PROBES + 1]
            order = np.lexsort((nearest, np.take_along_axis(far, nearest, axis=1)), axis=1)[:, :PROBES]
            chosen = _NEAR[np.take_along_axis(nearest, order, axis=1)]
            points = (2 * (point[:, None, :] + chosen)).astype(np.int64)
            out[begin : begin + 4096, t] = points @ _MIX[:8] + _MIX[8:] * (t + 1)
    return out


def _units(vectors: pa.Array, length: int) -> np.ndarray:
    flat = np.asarray(vectors.flatten(), float).reshape(-1, length)
    scaled = flat / np.abs(flat).max(axis=1, keepdims=True)  # squares neither overflow nor vanish
    return scaled / np.linalg.norm(scaled, axis=1, keepdims=True)


def _distinct(vectors: DataFrame) -> DataFrame:
    """(a, b, label, length, vector, id, n): valid vectors once each, under a 128-bit key."""
    bad = F.exists("vector", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    valid = vectors.filter("label IS NOT NULL AND size(vector) > 0").filter(~bad)
    valid = valid.filter(F.exists("vector", lambda x: x != 0))
    key = {s: F.xxhash64(F.lit(i), "label", "vector") for i, s in enumerate("ab")}
    grouped = valid.groupBy("label", "vector").agg(F.min("id").alias("id"), F.count(F.lit(1)).alias("n"))
    return grouped.withColumns(key | {"length": F.size("vector")})


def _placed(distinct: DataFrame) -> DataFrame:
    """(a, b, cell): one row per table and probe."""

    def run(stream):
        for batch in stream:
            lengths = batch.column("length").to_numpy()
            for length in np.unique(lengths):
                part = batch.filter(pa.array(lengths == length))
                found = cells(_units(part.column("vector"), int(length))).reshape(part.num_rows, -1)
                each = found.shape[1]
                columns = [np.repeat(part.column(c).to_numpy(), each) for c in "ab"]
                yield pa.RecordBatch.from_arrays([*map(pa.array, columns), pa.array(found.ravel())], ["a", "b", "cell"])

    return distinct.select("a", "b", "length", "vector").mapInArrow(run, "a long, b long, cell long")


def _compared(stream, least: float):
    """Streams sorted rows; yields (a, b, links, x, y): links counted here, and a forest edge."""
    names = ["label", "length", "cell", "i", "j"]
    held = None

    def groups():
        nonlocal held
        for batch in stream:
            table = pa.Table.from_batches([batch] if held is None else [held, batch])
            batch = table.combine_chunks().to_batches()[0]
            keys = np.array([batch.column(n).to_numpy() for n in names])
            cuts = np.flatnonzero((keys[:, 1:] != keys[:, :-1]).any(axis=0)) + 1
            starts = [0, *cuts.tolist()]
            for begin, end in zip(starts, starts[1:], strict=False):
                if end - begin > 1:
                    yield batch.slice(begin, end - begin)
            held = batch.slice(starts[-1])
        if held is not None and held.num_rows > 1:
            yield held

    out = []
    for group in groups():
        out += _group(group, least)
        if len(out) >= 50_000:
            yield _links_batch(out)
            out = []
    if out:
        yield _links_batch(out)


def _links_batch(rows):
    columns = map(list, zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["a", "b", "links", "x", "y"])


def _group(group: pa.RecordBatch, least: float) -> list:
    vectors = _units(group.column("vector"), group.column("length")[0].as_py())
    near = vectors @ vectors.T >= least
    i, j, own = (group.column(c).to_numpy() for c in ("i", "j", "own"))
    near &= np.triu(np.ones(near.shape, bool), 1)
    if i[0] != j[0]:
        near &= own[:, None] != own[None, :]
    left, right = np.nonzero(near)
    if not len(left):
        return []
    a, b, n = (group.column(c).to_numpy() for c in ("a", "b", "n"))
    rows = np.unique(np.concatenate([left, right]))
    codes = np.zeros((len(vectors), TABLES * PROBES), np.int64)
    codes[rows] = np.sort(cells(vectors[rows]), axis=2).reshape(len(rows), -1)
    here = group.column("cell")[0].as_py()
    links = np.zeros(len(vectors), np.int64)
    root = np.arange(len(vectors))
    for begin in range(0, len(left), _PAIR_ROWS):
        x, y = left[begin : begin + _PAIR_ROWS], right[begin : begin + _PAIR_ROWS]
        first = _first_common(codes, x, y) == here
        np.add.at(links, x[first], n[y[first]])
        np.add.at(links, y[first], n[x[first]])
    while True:  # smallest place reachable inside the group
        before = root.copy()
        np.minimum.at(root, left, root[right])
        np.minimum.at(root, right, root[left])
        root = root[root]
        if (root == before).all():
            break
    return [(a[r], b[r], links[r], a[root[r]], b[root[r]]) for r in rows.tolist()]


def _first_common(codes: np.ndarray, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The first cell, table by table, that each pair has in common."""
    out = np.zeros(len(x), np.int64)
    open_ = np.arange(len(x))
    for t in range(TABLES):
        part = slice(t * PROBES, (t + 1) * PROBES)
        for p in range(t * PROBES, (t + 1) * PROBES):
            if not len(open_):
                return out
            mine = codes[x[open_], p]
            found = (codes[y[open_], part] == mine[:, None]).any(axis=1)
            out[open_[found]] = mine[found]
            open_ = open_[~found]
    return out


def near_duplicates(
    embeddings: DataFrame,
    least: float = LEAST_COSINE,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    label_column: str = "label",
) -> DataFrame:
    """(id_column, n_links, component_id, kept) of every row."""
    common.ship(embeddings.sparkSession)
    names = {id_column: "id", vector_column: "vector", label_column: "label"}
    rows = embeddings.select(*[F.col(c).alias(n) for c, n in names.items()])
    distinct = materialise(_distinct(rows), "distinct-vectors")
    placed = materialise(_placed(distinct), "lattice-cells")
    light = placed.join(distinct.select("a", "b", "label", "length"), ["a", "b"])
    cell = ["label", "length", "cell"]
    crowded = light.groupBy(*cell).agg(F.ceil(F.count(F.lit(1)) / BLOCK_ROWS).cast("int").alias("blocks")).filter("blocks > 1")
    blocked = light.join(materialise(crowded, "crowded-cells"), cell, "left")
    own = F.when(F.col("blocks").isNull(), 0).otherwise(F.pmod(F.xxhash64("a", "b"), F.col("blocks"))).cast("int")
    others = F.sequence(F.lit(0), F.coalesce("blocks", F.lit(1)) - 1)
    dealt = blocked.withColumn("own", own).withColumn("other", F.explode(others))
    dealt = dealt.select("a", "b", "cell", "own", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"))
    label_number = F.xxhash64("label").alias("label")  # any type; a clash only compares more
    full = dealt.join(distinct.select("a", "b", label_number, "length", "vector", "n"), ["a", "b"])
    sorted_rows = full.repartition("label", *cell[1:], "i", "j").sortWithinPartitions("label", *cell[1:], "i", "j")
    found = materialise(
        sorted_rows.mapInArrow(lambda s: _compared(s, least), "a long, b long, links long, x long, y long"), "vector-links"
    )
    counts = found.groupBy("a", "b").agg(F.sum("links").alias("links"))
    parts = components(found.select(F.struct("a", "b"), F.struct(F.col("x").alias("a"), F.col("y").alias("b"))))
    named = parts.select("node.*", F.struct("component.*").alias("root"))
    grouped = distinct.join(named, ["a", "b"], "left").join(counts, ["a", "b"], "left")
    grouped = grouped.withColumn("root", F.coalesce("root", F.struct("a", "b")))
    smallest = grouped.groupBy("root").agg(F.min("id").alias("component_id"))
    judged = materialise(
        grouped.join(smallest, "root").select(
            "a", "b", "component_id", (F.coalesce("links", F.lit(0)) + F.col("n") - 1).alias("n_links")
        ),
        "vector-components",
    )
    keyed = rows.select("id", *[F.xxhash64(F.lit(i), "label", "vector").alias(s) for i, s in enumerate("ab")])
    joined = keyed.join(judged, ["a", "b"], "left")
    component = F.coalesce("component_id", "id")
    return joined.select(
        F.col("id").alias(id_column),
        F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
        component.alias("component_id"),
        F.col("id").eqNullSafe(component).alias("kept"),
    )
