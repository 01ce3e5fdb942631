"""Nearest neighbours and near-duplicate vectors against brute force."""

import tracemalloc

import numpy as np
import pytest

from ledgerferry.llm import covertree, neighbours
from ledgerferry.llm.components import components

SCHEMA = "vec_id long, embedding array<float>, label int, id string, dim int, score double"


def frame(spark, vectors):
    rows = [(i, v, 0, "x", 1, 0.5) for i, v in vectors]
    return spark.createDataFrame(rows, SCHEMA)


def awkward(n, seed, dim=8):
    """Clusters, exact copies, mirrored and scaled vectors, and rows that take no part."""
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(n // 6, dim))
    rows = []
    for i in range(n):
        v = centres[rng.integers(len(centres))] + rng.normal(size=dim) * rng.choice([0, 0.05, 0.2, 2])
        rows.append((i, [float(np.float32(x)) for x in v * rng.choice([1, 1, 3, 1e-3])]))
    odd = [None, [], [0.0] * dim, [None] + [1.0] * (dim - 1), [float("nan")] * dim, [float("inf")] + [0.0] * (dim - 1)]
    rows += [(10_000 + 100 * i, v) for i, v in enumerate(odd)] + [(None, [1.0] * dim)]
    rows += [rows[0], rows[3], (20_000, [1.0, 2.0]), (20_100, [1.0, 2.125]), (20_200, [-1.0, 0.0])]
    return rows


def valid(rows):
    out = {}
    for i, v in rows:
        if i is not None and v and None not in v and np.isfinite(v).all() and any(v):
            out.setdefault(i, np.array(v, np.float64))
    return out


@pytest.mark.parametrize("blocks", [(16_384, 8_192), (3, 40)])
def test_nearest_equals_brute_force(spark, monkeypatch, blocks):
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", blocks[0])
    monkeypatch.setattr(neighbours, "CANDIDATE_BLOCK", blocks[1])
    monkeypatch.setattr(neighbours, "TILE_C", 16)
    rows = awkward(400, 1)
    held = valid(rows)
    got = {}
    for r in neighbours.nearest(frame(spark, rows), "id % 20 = 0").collect():
        got.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    queries = [i for i in held if i % 20 == 0]
    assert sorted(got) == sorted(queries)
    for q in queries:
        all_rows = sorted((float(neighbours.exact(held[q][None], v[None])[0]), i) for i, v in held.items() if i != q and len(v) == len(held[q]))
        assert sorted(got[q]) == [(k + 1, i, d) for k, (d, i) in enumerate(all_rows[:10])]


def test_quantisation_bounds_hold():
    rng = np.random.default_rng(4)
    for dim, scale in ((3, 1.0), (64, 1e-6), (200, 1e6)):
        x, y = rng.normal(size=(50, dim)) * scale, rng.normal(size=(60, dim)) * scale
        a, b = neighbours.Quantised(x), neighbours.Quantised(y)
        true = np.sqrt(((x[:, None] - y[None]) ** 2).sum(2))
        assert (np.abs(a.distance(slice(0, 50), b, slice(0, 60)) - true) <= a.lost[:, None] + b.lost + 1e-9 * scale).all()


def test_ties_go_to_the_smaller_id(spark):
    rows = [(i, [1.0, 0.0] if i else [0.0, 1.0]) for i in range(40)]
    got = [r["vec_id"] for r in sorted(neighbours.nearest(frame(spark, rows), "id = 0").collect(), key=lambda r: r["rank"])]
    assert got == list(range(1, 11))
    assert neighbours.nearest(frame(spark, []), "id % 100 = 0").collect() == []


@pytest.mark.parametrize("block", [4_096, 50])
def test_near_duplicates_equal_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(covertree, "BLOCK", block)
    monkeypatch.setattr(covertree, "CHUNK", 16)
    rows = awkward(300, 2)
    held = valid(rows)
    ids = sorted(held)
    links = {i: set() for i in ids}
    for i in ids:
        for j in ids:
            if i < j and len(held[i]) == len(held[j]):
                a, b = held[i], held[j]
                if a @ b / (np.sqrt((a**2).sum()) * np.sqrt((b**2).sum())) >= 0.95:
                    links[i].add(j)
                    links[j].add(i)
    root = {i: i for i in ids}
    for _ in ids:
        for i in ids:
            root[i] = min([root[i], *(root[j] for j in links[i])])
    got = {r["vec_id"]: r for r in covertree.near_duplicates(frame(spark, rows)).collect()}
    assert set(got) == {i for i, _ in rows}
    for i, r in got.items():
        if i in held:
            assert (r["n_links"], r["component_id"], r["kept"]) == (len(links[i]), root[i], root[i] == i)
        else:
            assert (r["n_links"], r["component_id"], r["kept"]) == (0, i, True)
    assert sum(map(len, links.values())) > 100
    assert covertree.near_duplicates(frame(spark, [])).collect() == []


def test_trees_nest_cover_and_own_spans():
    rng = np.random.default_rng(3)
    x = np.concatenate([rng.normal(size=(40, 6)), rng.normal(size=(1, 6)) + rng.normal(size=(60, 6)) * 0.01])
    tree = covertree.CoverTree(np.arange(100), x)
    tree = covertree.CoverTree.unpack(tree.pack())
    for level, radius in enumerate(covertree.RADII):
        spans = tree.spans[level]
        assert spans[0, 0] == 0 and spans[-1, 1] == 100 and (spans[1:, 0] == spans[:-1, 1]).all()
        for (s, e), c, r in zip(spans, tree.centres[level], tree.radius[level], strict=True):
            away = np.sqrt(np.maximum(2 - 2 * tree.x[s:e] @ c, 0))
            assert away.max() <= r + 1e-3
            if level == len(covertree.RADII) - 1:
                assert r <= radius + 1e-3
        if level:
            assert {tuple(c) for c in tree.centres[level - 1]} <= {tuple(c) for c in tree.centres[level]}


def test_a_large_group_returns_a_row_for_each_member_only():
    x = np.ones((500, 4)) + np.random.default_rng(0).normal(size=(500, 4)) * 1e-3
    tree = covertree.CoverTree(np.arange(500), x)
    found = covertree.links(tree, tree, True, 0.95)
    assert sorted(i for i, _, _ in found) == list(range(500))
    assert {(n, r) for _, n, r in found} == {(499, 0)}


def test_a_walk_holds_few_node_pairs_where_all_are_near(monkeypatch):
    rng = np.random.default_rng(5)
    x = np.ones(64) + rng.normal(size=(1_200, 64)) * 0.25
    a, b = (covertree.CoverTree(np.arange(600) + s, x[s : s + 600]) for s in (0, 600))
    found = covertree.links(a, b, False, 0.95)
    monkeypatch.setattr(covertree, "NODE_PAIRS", 1_000, raising=False)
    tracemalloc.start()
    nodes = sum(1 for _ in covertree.traverse(a, b, False, np.sqrt(2 - 2 * 0.95)))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert nodes > 50_000 and peak < 4_000_000
    assert covertree.links(a, b, False, 0.95) == found


def test_packed_trees_are_small_and_exact():
    rng = np.random.default_rng(6)
    floats = rng.normal(size=(300, 64)).astype(np.float32).astype(np.float64)
    for x, most in ((floats, 400), (floats * 1e160, 700), (floats + 1e-12, 700)):
        tree = covertree.CoverTree(np.arange(300), x)
        back = covertree.CoverTree.unpack(tree.pack())
        assert (back.vectors == tree.vectors).all() and len(tree.pack()) < most * 300
        assert all((s == t).all() and (c == d).all() for s, t, c, d in zip(tree.spans, back.spans, tree.centres, back.centres, strict=True))


def test_trees_are_not_shuffled_to_meet(spark):
    trees = [(2, i, covertree.CoverTree(np.arange(9) + 10 * i, np.ones((9, 2))).pack()) for i in range(4)]
    trees += [(3, 0, covertree.CoverTree(np.arange(9) + 90, np.ones((9, 3))).pack())]
    met = covertree.block_links(spark.createDataFrame(trees, "dim int, block int, tree binary"), 0.95)
    assert "Exchange" not in met._jdf.queryExecution().executedPlan().toString()
    total = {}
    for r in met.collect():
        total[r["id"]] = total.get(r["id"], 0) + r["n"]
    assert total == {i: 35 if i < 90 else 8 for i in [*range(9), *range(10, 19), *range(20, 29), *range(30, 39), *range(90, 99)]}


def test_components_of_paths_stars_and_rings(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, x) for x in range(101, 160)] + [(200 + i, 200 + (i + 1) % 9) for i in range(9)] + [(300, 300)]
    got = {r["id"]: r["component"] for r in components(spark.createDataFrame([e[::-1] if sum(e) % 3 else e for e in edges], "a long, b long")).collect()}
    expected = {**{i: 0 for i in range(41)}, **{i: 100 for i in range(100, 160)}, **{200 + i: 200 for i in range(9)}}
    assert got == expected
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
