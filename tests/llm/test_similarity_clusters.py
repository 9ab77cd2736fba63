import random

import pytest

from lumbung.llm.similarity_clusters import clusters, describe, keyword_set, word_set


def brute(rows, like, least):
    by = {}
    for space, key, words in rows:
        if space is not None and key is not None and words is not None and len(words) >= least:
            by.setdefault(space, {}).setdefault(key, set(words))
    out = set()
    for space, own in by.items():
        keys = sorted(own)
        root = {k: k for k in keys}

        def find(k):
            while root[k] != k:
                k = root[k]
            return k

        for i, a in enumerate(keys):
            for b in keys[i + 1 :]:
                if len(own[a] & own[b]) >= like * len(own[a] | own[b]) - 1e-9:
                    x, y = sorted((find(a), find(b)))
                    root[y] = x
        groups = {}
        for k in keys:
            groups.setdefault(find(k), []).append(k)
        out |= {(space, f, k) for f, g in groups.items() if len(g) > 1 for k in g}
    return out


def made(seed, n, spaces):
    rng = random.Random(seed)
    vocabulary = [f"w{i}" for i in range(80)]
    rows = []
    for k in range(n):
        if rows and rng.random() < 0.6:
            words = set(rng.choice(rows)[2])
            for _ in range(rng.randint(0, 3)):
                words.symmetric_difference_update([rng.choice(vocabulary)])
        else:
            words = set(rng.sample(vocabulary, rng.randint(1, 14)))
        rows.append((rng.choice(spaces), k, sorted(words)))
    return rows


@pytest.mark.parametrize("like,least,capacity", [("0.6", 4, 20_000), ("0.5", 1, 20_000), ("0.6", 4, 12), ("0.8", 1, 6)])
def test_against_brute_force(spark, like, least, capacity):
    rows = made(3, 220, ["a", "b"])
    df = spark.createDataFrame(rows, "space string, key long, words array<string>")
    got = {tuple(r) for r in clusters(df, like, least, capacity=capacity).collect()}
    assert got == brute(rows, float(like), least)


@pytest.mark.parametrize("capacity", [20_000, 10])
def test_denser_clusters_against_brute_force(spark, capacity):
    rows = made(5, 160, ["a"])
    sets = {k: set(w) for _, k, w in rows}
    near = {a: {b for b in sets if len(sets[a] & sets[b]) >= 0.6 * len(sets[a] | sets[b]) - 1e-9} for a in sets}
    core = {a for a in sets if len(near[a]) >= 4}
    root = {}
    for a in sorted(core):
        if a not in root:
            todo = [a]
            while todo:
                x = todo.pop()
                if x not in root:
                    root[x] = a
                    todo += near[x] & core
    groups = {}
    for a in sets:
        if near[a] & core:
            groups.setdefault(root[a] if a in core else min(root[x] for x in near[a] & core), set()).add(a)
    df = spark.createDataFrame(rows, "space string, key long, words array<string>")
    got = {(r.first, r.key) for r in clusters(df, "0.6", 1, capacity, 4).collect()}
    assert got == {(min(g), k) for g in groups.values() for k in g}


def test_medoids_have_the_greatest_mean_similarity(spark):
    rows = made(3, 120, ["a"])
    df = spark.createDataFrame(rows, "space string, key long, words array<string>")
    found = clusters(df, "0.6", 4)
    groups = {}
    for r in found.collect():
        groups.setdefault(r.first, []).append(r.key)
    sets = {k: set(w) for _, k, w in rows}
    for r in describe(found, df, 1).collect():
        mean = {k: sum(len(sets[k] & sets[m]) / (len(sets[k]) * len(sets[m])) ** 0.5 for m in groups[r.first]) / len(groups[r.first]) for k in groups[r.first]}
        assert abs(mean[r.key] - r.typical) < 2e-6 and mean[r.key] >= max(mean.values()) - 2e-6


def test_edges(spark):
    rows = [("a", 1, ["x", "y", "z"]), ("a", 2, ["x", "y", "z"]), ("a", 2, ["x", "y", "z"]), ("b", 3, ["x", "y", "z"]), (None, 4, ["x", "y", "z"]), ("a", None, ["x", "y", "z"]), ("a", 5, None), ("a", 6, []), ("a", 7, [f"w{i}" for i in range(20_000)]), ("a", 8, [f"w{i}" for i in range(20_001)])]
    df = spark.createDataFrame([(*r, "n", 1) for r in rows], "space string, key long, words array<string>, first string, n int")
    got = clusters(df, "0.6")
    assert {tuple(r) for r in got.collect()} == {("a", 1, 1), ("a", 1, 2), ("a", 7, 7), ("a", 7, 8)}
    top = describe(got, df.where("key IS NOT NULL AND space IS NOT NULL")).collect()
    assert {(r.first, r.members, r["rank"], r.key) for r in top} == {(1, 2, 1, 1), (1, 2, 2, 2), (7, 2, 1, 8), (7, 2, 2, 7)} or {(r.first, r.members) for r in top} == {(1, 2), (7, 2)}
    none = df.where("false")
    assert clusters(none, "0.6").count() == 0 and describe(clusters(none, "0.6"), none).count() == 0


def test_word_sets(spark):
    df = spark.createDataFrame([("B a, a-b  A",), (None,), ("",), (" NaN ",), ("x y, X y,z,",)], "t string")
    got = df.select(word_set(df.t), keyword_set(df.t)).collect()
    assert [r[0] for r in got] == [["a", "b"], None, [], ["nan"], ["x", "y", "z"]]
    assert [r[1] for r in got] == [["a-b  a", "b a"], None, None, None, ["x y", "z"]]
