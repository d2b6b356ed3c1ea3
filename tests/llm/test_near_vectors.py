import math

import numpy as np
import pytest

from cladeweave.llm import near_vectors as nv

ROWS = "vec_id long, embedding array<float>, label int, n_links string"


def brute(rows):
    def usable(v, label):
        return label is not None and v is not None and all(x is not None and math.isfinite(x) for x in v) and any(v)

    n = len(rows)
    unit = [np.array(v, float) / np.linalg.norm(np.array(v, float)) if usable(v, l) else None for _, v, l in rows]
    near = {i: set() for i in range(n)}
    for i in range(n):
        for j in range(i):
            if unit[i] is not None and unit[j] is not None and rows[i][2] == rows[j][2]:
                if len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= 0.93:
                    near[i].add(j)
                    near[j].add(i)
    out = []
    for i in range(n):
        seen, todo = {i}, [i]
        while todo:
            for x in near[todo.pop()] - seen:
                seen.add(x)
                todo.append(x)
        known = [rows[x][0] for x in seen if rows[x][0] is not None]
        least = min(known) if known else None
        out.append((rows[i][0], len(near[i]), least, rows[i][0] == least))
    return sorted(out, key=str)


def check(spark, rows):
    got = nv.near_vectors(spark.createDataFrame([(*r, "x") for r in rows], ROWS)).collect()
    assert sorted(((r.vec_id, r.n_links, r.component_id, r.kept) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize("tile", [5, 1024])
def test_like_brute_force(spark, monkeypatch, tile):
    monkeypatch.setattr(nv, "TILE", tile)
    rng, rows = np.random.default_rng(tile), []
    for i in range(140):
        if rows and rng.random() < 0.5:
            v = np.array(rows[rng.integers(len(rows))][1]) * rng.choice([1, 1, 3]) + rng.choice([0, 0.12, 0.3]) * rng.normal(size=20)
        else:
            v = rng.normal(size=20)
        rows.append((i, np.float32(v).tolist(), int(rng.integers(3))))
    check(spark, rows)


def test_odd_rows(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 0.0], 0), (1, [1.0, 0.0], 0), (None, [2.0, 0.1], 0), (4, [1.0, 0.0], None), (5, None, 0), (6, [], 0),
            (7, [0.0, 0.0], 0), (8, [nan, 1.0], 0), (9, [inf, 1.0], 0), (10, [None, 1.0], 0), (11, [1.0, 0.0, 0.0], 0),
            (12, [1.0], 0), (13, [5.0], 0), (None, None, None), (14, [-0.0, 1.0], 3), (15, [0.0, 1.0], 3),
            (16, [1e30, 1e30], 5), (17, [2e30, 2e30], 5), (18, [1e-30, 1e-30], 5), (None, [0.3, 0.1], 6)]
    check(spark, rows)
    check(spark, [])


def test_no_pair_is_lost_by_the_bounds():
    rng = np.random.default_rng(0)
    x = rng.normal(size=(200, 64)) * np.linspace(3, 0.1, 64)
    x = np.vstack([x, x[:100] + 0.2 * rng.normal(size=(100, 64))])
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    axes = np.linalg.eigh(u.T @ u)[1][:, ::-1]
    i, j = nv.linked_pairs(x, x, axes, 0.93)
    assert set(zip(i.tolist(), j.tolist())) == set(zip(*map(lambda a: a.tolist(), np.nonzero(u @ u.T >= 0.93))))
