"""Neighbour graphs and whitening against numpy."""

import numpy as np
import pytest

from pulsefold.llm import graphs, neighbours, whitening
from pulsefold.llm.queries import QUERIES


def brute_links(rows, cosine=0.93):
    """{row number: (links, smallest id reachable)}"""
    ok = [i for i, (_, e, label) in enumerate(rows) if label is not None and e and all(v is not None and np.isfinite(v) for v in e) and any(e)]
    linked = {i: set() for i in range(len(rows))}
    for i in ok:
        for j in ok:
            a, b = rows[i][1], rows[j][1]
            if i != j and rows[i][2] == rows[j][2] and len(a) == len(b) and np.dot(a, b) / (np.linalg.norm(a) * np.linalg.norm(b)) >= cosine:
                linked[i].add(j)
    out = {}
    for i in range(len(rows)):
        seen, stack = {i}, [i]
        while stack:
            for j in linked[stack.pop()] - seen:
                seen.add(j)
                stack.append(j)
        out[i] = len(linked[i]), min(rows[j][0] for j in seen)
    return out


def clustered(seed=3):
    draw = np.random.default_rng(seed)
    rows = []
    for k in range(60):
        middle = draw.normal(size=8)
        for _ in range(draw.integers(1, 9)):
            rows.append((middle + draw.normal(size=8) * 0.2, k % 2))
    rows += [(rows[0][0], rows[0][1])] * 5 + [(rows[0][0], 1 - rows[0][1])] * 3
    rows = [(int(i) + 100, [float(np.float32(x)) for x in v], int(label)) for i, (v, label) in zip(draw.permutation(len(rows)), rows, strict=True)]
    nan, inf = float("nan"), float("inf")
    return rows + [(1, None, 0), (2, [], 0), (3, [0.0] * 8, 0), (4, [None] + [1.0] * 7, 0), (5, [nan] * 8, 0), (6, [inf] + [1.0] * 7, 0), (7, [1.0] * 8, None),
                   (8, [1.0] * 3, 0), (9, [2.0] * 3, 0), (10, [1.0] * 8, 1), (10, [-1.0] * 8, 1), (11, [-1.0] * 8, 1)]


@pytest.mark.parametrize("kind", ["float", "double"])
def test_links_equal_brute_force(spark, frame, kind):
    rows = clustered()
    want = sorted((rows[i][0], *v) for i, v in brute_links(rows).items())
    df = frame(f"vec_id long, embedding array<{kind}>, label int, cell string, id string, home int", *[(*r, "x", "y", 1) for r in rows])
    for settings in (neighbours.Settings(), neighbours.Settings(region_rows=40, shard_rows=20, slack=1.0, recall=0.9)):
        got = neighbours.group(df, settings).collect()
        assert sorted((r.vec_id, r.n_links, r.component_id) for r in got) == want
        assert all(r.kept == (r.vec_id == r.component_id) for r in got)


def test_links_of_nothing(spark, frame):
    assert neighbours.group(frame("vec_id long, embedding array<float>, label int")).count() == 0
    only = neighbours.group(frame("vec_id long, embedding array<float>, label int", (5, None, 1), (6, [1.0], None))).collect()
    assert sorted((r.vec_id, r.n_links, r.component_id, r.kept) for r in only) == [(5, 0, 5, True), (6, 0, 6, True)]


def test_search_finds_what_lies_in_range():
    draw = np.random.default_rng(1)
    points = neighbours.unit(np.repeat(draw.normal(size=(150, 16)), 6, 0) + draw.normal(size=(900, 16)) * 0.15).astype(np.float32)
    adjacency, start = graphs.build(points, 16, 32, 1.2)
    assert ((adjacency >= 0).sum(1) >= 1).all() and (adjacency != np.arange(900)[:, None]).all()
    who, node = graphs.within(points, adjacency, graphs.both_ways(adjacency), np.array([start]), points, 32, 0.93, 0.03)
    truth = points @ points.T >= 0.93
    found = np.zeros_like(truth)
    found[who, node] = True
    assert not (found & ~truth).any() and found.sum() >= 0.98 * truth.sum()


def test_pruning_drops_what_a_kept_neighbour_covers():
    angle = np.array([0.0, 0.1, 0.12, -0.5, 1.0])
    points = np.stack([np.cos(angle), np.sin(angle)], 1)
    near = np.array([[1, 2, 3, 4, 1]])
    kept = graphs.prune(points, np.array([0]), near, (points[near[0]] @ points[0])[None], 4, 1.05)
    assert kept[0].tolist() == [1, 3, -1, -1]


def test_audit_measures_recall(spark, frame):
    rows = clustered()
    df = frame("vec_id long, embedding array<float>, label int", *rows)
    nodes, found, recall = neighbours.linked_nodes(df, neighbours.Settings(audited=10_000))
    assert recall == 1.0
    half = found.where("pmod(id, 2) = 0").groupBy("id").agg({"links": "sum"}).withColumnRenamed("sum(links)", "links")
    assert 0.2 < neighbours.audit(nodes, half, "<f4", neighbours.Settings(audited=10_000)) < 0.8


def brute_whitening(x, k=4):
    fit = np.unique(x, axis=0)
    n, s = len(fit), fit.sum(0)
    a = fit - s / n
    e, v = np.linalg.eigh(a.T @ a / n)
    e, v = e[::-1], v[:, ::-1]
    return n, s, e[:k] / e.sum(), (x - s / n) @ v[:, :k] / np.sqrt(e[:k])


def test_whitening_equals_eigenvectors(spark, frame):
    draw = np.random.default_rng(2)
    data = (draw.normal(size=(300, 6)) @ draw.normal(size=(6, 6)) * [1, 2, 3, 1e-2, 5, 1] + [0, 1000, 0, 0, 0, -3]).astype(np.float32).astype(float)
    data[100:200] = data[0]
    nan = float("nan")
    rows = [(i, list(map(float, v))) for i, v in enumerate(data)]
    df = frame("vec_id long, embedding array<float>, n int, component string", *[(*r, 1, "x") for r in rows + [
        (900, None), (901, [nan] * 6), (902, [None] * 6), (903, [1.0, 2.0]), (904, [])]])
    got = whitening.whiten(df).collect()
    x = np.floor(data * 256).astype(int)
    n, s, explained, want = brute_whitening(x)
    assert len(got) == 1200 and n == 200
    by = {(r.vec_id, r.component): r for r in got}
    for c in range(1, 5):
        mine = np.array([by[i, c].whitened for i in range(300)])
        sign = np.sign(mine @ want[:, c - 1])
        np.testing.assert_allclose(sign * mine, want[:, c - 1], atol=1e-8)
        assert abs(by[0, c].explained / explained[c - 1] - 1) < 1e-9
    assert all(r.identity_error < 1e-9 and r.n == 200 for r in got)
    assert all(by[i, 1].deviation == int(((n * x[i] - s) ** 2).sum()) for i in range(300))


def test_whitening_of_dependent_and_missing_spread(spark, frame):
    draw = np.random.default_rng(4)
    base = draw.integers(-50, 50, size=(80, 2)) / 256
    flat = np.column_stack([base, base.sum(1), np.full(80, 3.0), base[:, 0] * 2])
    df = frame("vec_id long, embedding array<double>", *[(i, list(map(float, v))) for i, v in enumerate(flat)])
    got = whitening.whiten(df).collect()
    assert {r.component for r in got} == {1, 2} and max(r.identity_error for r in got) < 1e-6
    assert abs(sum({r.component: r.explained for r in got}.values()) - 1) < 1e-9
    assert whitening.whiten(frame("vec_id long, embedding array<float>", (1, [1.0, 2.0]), (2, [1.0, 2.0]))).count() == 0
    assert whitening.whiten(frame("vec_id long, embedding array<float>")).count() == 0


def test_deviation_beyond_64_bit_products():
    x = np.array([[2**44, -(2**44)], [5, 7]])
    exact = whitening.deviations(x, 2**20, [3, 4])
    assert exact.tolist() == [[2**64 - 3, -(2**64) - 4], [5 * 2**20 - 3, 7 * 2**20 - 4]]


def test_queries_on_the_smallest_tables(spark, events_dir):
    rows = [(r.vec_id, list(r.embedding), r.label) for r in spark.read.parquet(f"{events_dir}/embeddings.parquet").collect()]
    got = {r.vec_id: (r.n_links, r.component_id) for r in QUERIES["op11_flat_graph"](spark, events_dir).collect()}
    assert got == {rows[i][0]: v for i, v in brute_links(rows).items()}
    x = np.floor(np.array([r[1] for r in rows]) * 256).astype(int)
    _, _, explained, _ = brute_whitening(x)
    got = QUERIES["op12_cholesky_whitening"](spark, events_dir).where("vec_id = 0").orderBy("component").collect()
    np.testing.assert_allclose([r.explained for r in got], explained, rtol=1e-9)
