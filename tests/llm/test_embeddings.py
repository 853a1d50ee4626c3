import numpy as np
import pytest

from refloom.llm import embeddings as E


def vectors():
    r = np.random.default_rng(5)
    centres = r.normal(size=(12, 16))
    rows = [c + r.normal(size=16) * s for c in centres for s in (0.05, 0.1, 0.2, 0.3, 0.35) for _ in range(4)]
    rows = [v.astype(np.float32).tolist() for v in rows]
    rows += [rows[0]] * 5 + [[2 * x for x in rows[3]], [1e-30 * x for x in rows[4]], [1e30 * x for x in rows[5]]]
    odd = [None, [0.0] * 16, [], [float("nan")] * 16, [float("inf")] + [1.0] * 15, [None] + [1.0] * 15, [1.0, 2.0], [1.0, 2.1]]
    return rows + odd


def slow(rows, threshold):
    ok = [v is not None and len(v) > 0 and all(x is not None and np.isfinite(x) for x in v) and any(v) for _, v in rows]
    n = len(rows)
    link = np.zeros((n, n), bool)
    for a in range(n):
        for b in range(n):
            if a != b and ok[a] and ok[b] and len(rows[a][1]) == len(rows[b][1]):
                x, y = (np.array(rows[k][1], np.float32).astype(float) for k in (a, b))
                x, y = x / np.abs(x).max(), y / np.abs(y).max()
                link[a, b] = x @ y / np.sqrt(x @ x) / np.sqrt(y @ y) >= threshold
    comp = np.arange(n)
    for _ in range(n):
        comp = np.minimum(comp, np.where(link, comp[None, :], n).min(axis=1))
    low = [min((rows[k][0] for k in np.flatnonzero(comp == c) if rows[k][0] is not None), default=None) for c in comp]
    return sorted(((rows[k][0], int(link[k].sum()), low[k], rows[k][0] is not None and rows[k][0] == low[k]) for k in range(n)), key=str)


@pytest.mark.parametrize(("threshold", "tile", "tile_bytes", "centre_bytes"), [(0.9, 200_000, 1 << 25, 1 << 25), (0.97, 5, 1 << 25, 1 << 25), (0.9, 200_000, 1000, 0)])
def test_against_brute_force(spark, monkeypatch, threshold, tile, tile_bytes, centre_bytes):
    monkeypatch.setattr(E, "TILE_BYTES", tile_bytes)
    monkeypatch.setattr(E, "CENTRE_BYTES", centre_bytes)
    rows = [(k * 7 % 1000, v) for k, v in enumerate(vectors())] + [(None, vectors()[0]), (None, None)]
    df = spark.createDataFrame([(i, v, 1, "x") for i, v in rows], "vec_id long, embedding array<float>, key int, root string")
    got = sorted((tuple(r) for r in E.near_duplicates(df, threshold=threshold, tile=tile).collect()), key=str)
    assert got == slow(rows, threshold)


def test_small_tables(spark):
    schema = "vec_id long, embedding array<float>"
    assert E.near_duplicates(spark.createDataFrame([], schema)).count() == 0
    assert [tuple(r) for r in E.near_duplicates(spark.createDataFrame([(1, None)], schema)).collect()] == [(1, 0, 1, True)]
    assert sorted(tuple(r) for r in E.near_duplicates(spark.createDataFrame([(1, [1.0]), (2, [3.0]), (3, [-1.0])], schema)).collect()) == [(1, 1, 1, True), (2, 1, 1, False), (3, 0, 3, True)]


def test_bounds_are_rigorous():
    r = np.random.default_rng(2)
    u = E.unit_vectors(r.normal(size=(300, 64)) ** 3)
    q, s, e = E.quantise(u)
    near = (q.astype(float) @ q.T.astype(float)) * s[:, None] * s[None, :]
    assert (np.abs(near - u @ u.T) <= e[:, None] + e[None, :] + e[:, None] * e[None, :] + 1e-12).all()
    links, root, recomputed = E.link_tiles(u, None, np.ones(300, np.int64), None, 0.3)
    exact = u @ u.T >= 0.3
    np.fill_diagonal(exact, False)
    assert (links == exact.sum(axis=1)).all() and 0 < recomputed < 300 * 299 / 20
