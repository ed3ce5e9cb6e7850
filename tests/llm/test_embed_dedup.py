"""Embedding near-duplicates against all pairs."""

import numpy as np
import pytest

from ledgerlake.llm import embed_dedup as ed


def brute(rows, threshold):
    n = len(rows)
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if o else None for (_, v), o in zip(rows, ok)]
    links, up = [0] * n, list(range(n))

    def root(i):
        while up[i] != i:
            i = up[i]
        return i
    for i in range(n):
        for j in range(i):
            if ok[i] and ok[j] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold:
                links[i] += 1
                links[j] += 1
                up[root(i)] = root(j)
    least = {}
    for i, (name, _) in enumerate(rows):
        least[root(i)] = min(name, least.get(root(i), name))
    return {(name, links[i], least[root(i)], name == least[root(i)]) for i, (name, _) in enumerate(rows)}


def vectors(seed, n, d):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(6, d))
    rows = []
    for i in range(n):
        near = rng.random() < 0.6
        v = centres[rng.integers(6)] + rng.normal(size=d) * 0.25 if near else rng.normal(size=d)
        rows.append((1000 - i, [float(np.float32(x)) for x in v * rng.uniform(0.01, 100)]))
    same = rows[0][1]
    rows += [(2000 + i, same) for i in range(30)]  # a group of copies
    rows += [(3000, None), (3001, []), (3002, [0.0] * d), (3003, [float("nan")] + [1.0] * (d - 1)), (3004, [None] + [1.0] * (d - 1)),
             (3005, [float("inf")] + [1.0] * (d - 1)), (3006, [1.0] * (d + 1)), (3007, [2.0] * (d + 1))]
    return rows


@pytest.mark.parametrize("tile", [4096, 16])
def test_links_and_components_equal_all_pairs(spark, monkeypatch, tile):
    monkeypatch.setattr(ed, "ROWS", tile)
    rows = vectors(tile, 150, 24)
    df = spark.createDataFrame([(i, v, i) for i, v in rows], "vec_id long, embedding array<float>, links long")
    assert {tuple(r) for r in ed.near_duplicates(df.repartition(4), 0.9).collect()} == brute(rows, 0.9)


def test_null_ids_and_empty_table(spark):
    df = spark.createDataFrame([(None, [1.0, 0.0]), (7, [1.0, 0.01]), (None, [0.0, 1.0])], "vec_id long, embedding array<double>")
    got = sorted(map(tuple, ed.near_duplicates(df).collect()), key=str)
    assert got == [(7, 1, 7, True), (None, 0, None, False), (None, 1, 7, False)]
    assert ed.near_duplicates(df.limit(0)).count() == 0


def test_bound_never_loses_a_pair():
    rng = np.random.default_rng(3)
    x = rng.normal(size=(300, 10)) * np.linspace(3, 0.1, 10)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    found = {(int(a), int(b)) for i, j in ed.linked_pairs(x, x, 4, 0.9, True) for a, b in zip(i, j)}
    want = {(i, j) for i in range(300) for j in range(i + 1, 300) if x[i] @ x[j] >= 0.9}
    assert found >= want and all(x[i] @ x[j] >= 0.9 - 1e-6 for i, j in found)


def test_rows_that_repeat_an_id_count_apart(spark):
    v = spark.createDataFrame([(1, [1.0, 0.0]), (1, [0.0, 1.0]), (2, [1.0, 0.01]), (0, [0.0, -1.0]), (0, [0.01, 1.0])],
                              "vec_id long, embedding array<double>")
    got = sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in ed.near_duplicates(v, 0.9).collect())
    assert got == [(0, 0, 0, True), (0, 1, 0, True), (1, 1, 0, False), (1, 1, 1, True), (2, 1, 1, False)]
