import random
import tracemalloc

import numpy as np
import pytest

from lumbung.operators import community
from lumbung.operators.components import components


def planted(groups=3, size=40, seed=1):
    rng = random.Random(seed)
    edges = []
    for a in range(groups * size):
        for b in range(a + 1, groups * size):
            if rng.random() < (0.3 if a // size == b // size else 0.005):
                edges.append((a, b, 1.0))
    return groups * size, edges


def test_communities_find_the_planted_groups():
    n, edges = planted()
    labels = community.modularity_communities(n + 1, edges)
    truth = np.arange(n) // 40
    assert labels.max() == 3 and labels[n] == 3
    assert sum((labels[:n] == np.bincount(labels[:n][truth == t]).argmax())[truth == t].sum() for t in range(3)) >= n - 3
    assert community.quality(n + 1, edges, labels) > community.quality(n + 1, edges, np.arange(n + 1))
    assert (labels == community.modularity_communities(n + 1, edges)).all()


def test_both_ways_of_moving_find_the_planted_groups():
    n, edges = planted(6, 30, 4)
    for singly in (0, 10**9):
        labels = community.modularity_communities(n, edges, singly=singly)
        truth = np.arange(n) // 30
        assert sum((labels == np.bincount(labels[truth == t]).argmax())[truth == t].sum() for t in range(6)) >= n - 6
        for c in range(labels.max() + 1):  # communities are connected
            own = np.flatnonzero(labels == c)
            inside = np.array([(a, b) for a, b, _ in edges if labels[a] == c == labels[b]], np.int64).reshape(-1, 2)
            assert len(set(community._connected(n, inside[:, 0], inside[:, 1])[own])) == 1


def test_ward_by_chains_is_the_greedy_one():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(60, 3))
    groups = [[i] for i in range(60)]
    while len(groups) > 7:
        cost = {(i, j): len(a) * len(b) / (len(a) + len(b)) * ((x[a].mean(axis=0) - x[b].mean(axis=0)) ** 2).sum() for i, a in enumerate(groups) for j, b in enumerate(groups) if i < j}
        i, j = min(cost, key=cost.get)
        groups[i] += groups.pop(j)
    labels = community.ward(x, 7)
    assert {frozenset(np.flatnonzero(labels == k).tolist()) for k in range(7)} == {frozenset(g) for g in groups}


def test_communities_without_weight_are_single():
    assert sorted(community.modularity_communities(4, []).tolist()) == [0, 1, 2, 3]
    assert sorted(community.modularity_communities(3, [(0, 1, 0.0)]).tolist()) == [0, 1, 2]
    assert community.modularity_communities(0, []).tolist() == []


def test_target_range_changes_the_resolution():
    n, edges = planted()
    few, r1 = community.communities_in_range(n, edges, 2, 4)
    many, r2 = community.communities_in_range(n, edges, 6, 40)
    assert few.max() + 1 <= 4 and many.max() + 1 > few.max() + 1 and r2 > r1


def test_ward_and_density():
    rng = np.random.default_rng(0)
    x = np.concatenate([c + 0.05 * rng.normal(size=(30, 2)) for c in ([0, 0], [5, 0], [0, 5])] + [np.array([[20.0, 20.0]])])
    labels = community.ward(x[:90], 3)
    assert len(set(labels[:30])) == len(set(labels[30:60])) == 1 and labels.max() == 2
    assert community.ward(x[:4], 9).tolist() == [0, 1, 2, 3]
    found = community.density_clusters(x, 8, 4)
    assert found.max() == 2 and found[90] == -1 and all(len(set(found[i : i + 30]) - {-1}) == 1 for i in (0, 30, 60))
    assert (community.density_clusters(x[:1], 5) == -1).all()


@pytest.mark.parametrize("parts", [1, 6])
def test_components(spark, parts):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100 + i, 100) for i in range(1, 30)] + [(rng.randint(200, 260), rng.randint(200, 260)) for _ in range(40)] + [(5, 5), (None, 4), (7, None), (3, 4)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = sorted((find(a), find(b)))
            root[y] = x
    want = {(x, find(x)) for x in list(root) if find(x) != x}
    df = spark.createDataFrame(edges, "a long, b long").repartition(parts)
    assert {tuple(r) for r in components(df).collect()} == want
    assert components(df.where("a = 5 AND b = 5")).count() == 0


def test_large_graphs_take_little_memory(monkeypatch):
    rng = np.random.default_rng(3)
    n, edges = 30_000, 300_000
    a = rng.integers(0, n, edges)
    b = (a + rng.integers(1, 40, edges)) % n
    e = np.column_stack([a, b, rng.random(edges)])
    want = community.modularity_communities(n, e, seed=1)
    monkeypatch.setattr(community, "AT_ONCE", 30_000)
    tracemalloc.start()
    got = community.modularity_communities(n, community._graph(n, e), seed=1)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 32e6  # the edges in both directions are 7 MB
    assert got.max() == pytest.approx(want.max(), rel=0.2)


def test_graphs_of_any_piece_are_the_same(monkeypatch):
    n, edges = planted(4, 30, 2)
    whole = community._graph(n, [*edges, (3, 3, 1.0), (2, 1, 0.5), (1, 2, 0.5), (5, 6, 0.0)])
    monkeypatch.setattr(community, "AT_ONCE", 50)
    parts = community._graph(n, [*edges, (3, 3, 1.0), (2, 1, 0.5), (1, 2, 0.5), (5, 6, 0.0)])
    assert (whole.first == parts.first).all() and (whole.dst == parts.dst).all() and whole.w == pytest.approx(parts.w)
    assert parts.degrees() == pytest.approx(whole.degrees())
    for singly in (0, 10**9):
        assert (community.modularity_communities(n, whole, singly=singly) == community.modularity_communities(n, parts, singly=singly)).all()


def test_alike_vectors_need_not_be_listed():
    rng = np.random.default_rng(4)
    x = np.concatenate([c + 0.2 * rng.normal(size=(1_000, 8)) for c in np.eye(8)[:4]])
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    held, made = community.Alike.of(x, 0.25), community.Alike.of(x, 0.25, most=1_000)
    assert type(held) is community.Graph and type(made) is community.Alike
    assert made.degrees() == pytest.approx(held.degrees())
    tracemalloc.start()
    labels = community.modularity_communities(len(x), community.Alike.of(x, 0.25, most=1_000))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100e6  # listed with both ends, the 2 million pairs took more
    assert labels.max() == 3
    assert sum(np.bincount(labels[1_000 * c : 1_000 * c + 1_000]).max() for c in range(4)) >= 3_980


def test_graph_of_a_table_read_in_pieces(spark):
    from lumbung.plans import batch

    n, edges = planted(2, 20, 5)
    df = spark.createDataFrame([(10 * a + 7, 10 * b + 7, w) for a, b, w in edges], "src long, dst long, weight double")
    want = community._graph(n, edges)
    for piece in (2_000_000, 25):
        ids, graph = batch.graph_of(df, piece=piece)
        assert ids.tolist() == [10 * i + 7 for i in range(n)]
        assert (graph.first == want.first).all() and (graph.dst == want.dst).all() and (graph.w == want.w).all()
    assert batch.graph_of(df.where("false"))[1].n == 0


def test_components_of_more_vectors_than_were_allowed(spark, monkeypatch):
    import __spark_entry__ as entry

    want = sorted(tuple(r) for r in entry.queries()["connected_components"](spark, entry.SMOKE).collect())
    count = type(spark.range(1)).count
    monkeypatch.setattr(type(spark.range(1)), "count", lambda self: 300_001 if self.columns == ["id", "v"] else count(self))
    assert sorted(tuple(r) for r in entry.queries()["connected_components"](spark, entry.SMOKE).collect()) == want
