"""Lattice decoding, and links and groups of vectors against all pairs."""

import numpy as np
import pytest
from brute import parts_of

from tramline.llm import catalogue, lattice_dedup


def test_decoding_is_nearest():
    draw = np.random.default_rng(0)
    y = draw.standard_normal((300, 8)) * 2
    near = lattice_dedup.decode(y)
    assert ((2 * near) % 1 == 0).all() and (near.sum(axis=1) % 2 == 0).all()
    around = near[:, None, :] + lattice_dedup._NEAR
    best = ((y[:, None, :] - around) ** 2).sum(axis=2).min(axis=1)
    assert np.allclose(best, ((y - near) ** 2).sum(axis=1))
    assert len({tuple(v) for v in lattice_dedup._NEAR.tolist()}) == 241


def brute(rows):
    def valid(label, v):
        return label is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)

    links = []
    for k, (i, v, label) in enumerate(rows):
        for j, w, other in rows[:k]:
            if valid(label, v) and valid(other, w) and label == other and len(v) == len(w):
                a, b = np.array(v, float), np.array(w, float)
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93:
                    links.append((i, j))
    part = parts_of([i for i, _, _ in rows], links)
    return sorted((i, sum(i in pair for pair in links), part[i], part[i] == i) for i, _, _ in rows)


def found(df):
    return sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in df.collect())


def vectors():
    draw = np.random.default_rng(4)
    base = draw.standard_normal((40, 16))
    rows = [(i, v.tolist(), i % 3) for i, v in enumerate(base)]
    for k in range(40):
        for size in (0.0, 0.05, 0.25, 0.3):
            v = base[k] + size * draw.standard_normal(16)
            rows.append((len(rows), (v * 10.0 ** draw.integers(-3, 4)).tolist(), k % 3))
    odd = [None, [], [0.0] * 16, [1.0, None] * 8, [float("nan")] * 16, [float("inf")] * 16, [1.0, 2.0], [2.0, 4.0]]
    return rows + [(len(rows) + k, v, 0) for k, v in enumerate(odd)] + [(900, base[0].tolist(), None)]


@pytest.mark.parametrize("block", [2048, 3])
def test_edge_rows(spark, block, monkeypatch):
    monkeypatch.setattr(lattice_dedup, "BLOCK_ROWS", block)
    rows = vectors()
    table = spark.createDataFrame([(*r, "clash") for r in rows], "vec_id long, embedding array<double>, label int, cell string")
    assert found(lattice_dedup.near_duplicates(table)) == brute(rows)
    empty = spark.createDataFrame([], table.schema)
    assert lattice_dedup.near_duplicates(empty).count() == 0


def test_query_and_recall(spark):
    sf_dir = "/root/testdata/sf0.01"
    rows = [(r.vec_id, r.embedding, r.label) for r in spark.read.parquet(f"{sf_dir}/embeddings.parquet").collect()]
    wanted, got = brute(rows), found(catalogue.op6_lattice_dedup(spark, sf_dir))
    assert sum(r[1] for r in got) >= 0.99 * sum(r[1] for r in wanted)
    assert got == wanted
