import numpy as np
import pytest
from pyspark.sql import functions as F

from lumbung.functions import models
from lumbung.operators import corpus, keywords, topics


def planted(n=120, dim=8, seed=1):
    rng = np.random.default_rng(seed)
    centre = np.eye(dim)[:3]
    rows = []
    for i in range(n):
        v = centre[i % 3] + 0.1 * rng.normal(size=dim)
        rows.append((i, None if i % 5 == 0 else i % 3, [float(x) for x in v * (1 + i % 2)]))
    return [*rows, (900, 0, None), (901, -1, [1.0] + [0.0] * (dim - 1)), (902, None, [-1.0] * dim), (903, None, [0.0] * dim)]


def test_centroids_and_assignment(spark):
    df = spark.createDataFrame(planted(), "id long, label int, vec array<float>").repartition(5)
    cents = topics.centroids(df, "label", "vec").orderBy("topic").collect()
    assert [c.topic for c in cents] == [0, 1, 2] and all(abs(sum(x * x for x in c.centroid) - 1) < 1e-9 for c in cents)
    got = {r.id: r.topic for r in topics.assign(df, "id", "label", "vec").collect()}
    assert sum(got[i] == i % 3 for i in range(120)) >= 110 and got[901] == -1 and got[902] == -1 and got[903] == -1 and got[900] == 0
    forced = {r.id: r.topic for r in topics.assign(df, "id", "label", "vec", force=True).collect()}
    assert forced[901] == 0 and all(forced[i] == i % 3 for i in range(120)) and forced[902] >= 0
    none = df.where("label = 77")
    assert topics.centroids(none, "label", "vec").count() == 0
    assert {r.topic for r in topics.assign(df.where("label IS NULL"), "id", "label", "vec").collect()} == {-1}


def test_result_does_not_depend_on_partitions(spark):
    df = spark.createDataFrame(planted(), "id long, label int, vec array<float>")
    seen = {tuple(sorted((r.id, r.topic) for r in topics.assign(df.repartition(n), "id", "label", "vec").collect())) for n in (1, 4, 32)}
    assert len(seen) == 1


def test_ties_go_to_the_lowest_topic(spark):
    cents = spark.createDataFrame([(4, [1.0, 0.0]), (2, [1.0, 0.0]), (9, [0.0, 1.0])], "topic int, centroid array<double>")
    df = spark.createDataFrame([(1, [3.0, 0.0]), (2, [1.0, 1.0])], "id long, v array<float>")
    assert {r.id: r.topic for r in topics.nearest(df, "id", "v", cents).collect()} == {1: 2, 2: 2}


def test_exact_neighbours(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(60, 6)).astype(np.float32)
    x[10] = x[11]
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(90, None), (91, [0.0] * 6)], "id long, v array<float>")
    edges = topics.exact_neighbours(df, "id", "v", k=4).collect()
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1, keepdims=True)
    s = np.round(u @ u.T, 9)
    np.fill_diagonal(s, -2)
    want = {}
    for i in range(60):
        for j in np.lexsort((np.arange(60), -s[i]))[:4]:
            if s[i, j] >= 0:
                want[(min(i, j), max(i, j))] = s[i, j]
    assert {(e.src, e.dst): e.weight for e in edges} == pytest.approx(want)
    assert (10, 11) in want
    with pytest.raises(ValueError):
        topics.exact_neighbours(df, "id", "v", most=10)
    assert topics.exact_neighbours(df.where("false"), "id", "v").count() == 0


def test_silhouette_needs_rows_and_labels(spark):
    df = spark.createDataFrame(planted(), "id long, label int, vec array<float>")
    assert topics.silhouette(df.where("label < 2"), "id", "label", "vec") is None
    more = spark.createDataFrame([(i, i % 2, [float(i % 2), 0.0]) for i in range(200)], "id long, label int, vec array<float>")
    assert topics.silhouette(more, "id", "label", "vec") == pytest.approx(1.0)


def test_embedder_and_cache(spark):
    df = spark.createDataFrame([(1, "harga naik"), (2, None), (3, "harga naik")], "id long, t string")
    got = {r.id: list(r.vec) for r in models.embed_texts(df, "id", "t").collect()}
    assert got[1] == got[3] and len(got[1]) == 384 and sum(x * x for x in got[1]) == pytest.approx(1, abs=1e-5)
    marker = spark.createDataFrame([(1, [9.0])], "id long, vec array<float>")
    again = {r.id: list(r.vec) for r in models.embed_texts(df, "id", "t", known=marker).collect()}
    assert again[1] == [9.0] and again[3] == got[3]


def test_language_backends(spark):
    df = spark.createDataFrame([("saya tidak bisa dan mau juga",), ("the river is not for you",), ("",), (None,), ("zzz",)], "t string")
    got = [tuple(r) for r in models.detect_distinct(df, "t").select("t", "lang", "lang_conf").collect()]
    by = {t: (x, c) for t, x, c in got}
    assert by["saya tidak bisa dan mau juga"][0] == "id" and by["the river is not for you"][0] == "en"
    assert by[""] == by[None] == by["zzz"] == ("und", 0.0)
    assert models.detector("unknown")(["a"]) == (["und"], [0.0])


def test_language_filter_needs_both(spark):
    rows = [("en", 0.4996, True), ("en", 0.4994, False), ("id", 0.9, False), (None, None, False), ("en", None, False)]
    df = spark.createDataFrame(rows, "l string, c double, want boolean")
    assert all(r[0] == r[1] for r in df.select(corpus.dropped(df.l, df.c), "want").collect())


def test_rake(spark):
    df = spark.createDataFrame([(1, 0, "harga bensin naik dan antrean panjang"), (2, 0, "antrean panjang, harga bensin naik"), (3, -1, "x y"), (4, 1, None)], "id long, topic int, t string")
    got = [(r.topic, r.term, r.score) for r in keywords.rake(df, "topic", "t", "id").orderBy("topic", "rank").collect()]
    assert got == [(0, "harga bensin naik", 9.0), (0, "antrean panjang", 4.0)]


def test_keyword_terms(spark):
    df = spark.createDataFrame([("Harga dan bensin a naik",), ("",), ("satu",), (None,)], "t string")
    assert [r[0] for r in df.select(keywords.words(df.t, ["dan"]).alias("w")).select(keywords.with_pairs(F.col("w"))).collect()] == [["harga", "bensin", "naik", "harga bensin", "bensin naik"], [], ["satu"], None]
    empty = spark.createDataFrame([], "topic int, t string")
    assert keywords.ctfidf(keywords.term_counts(empty, "topic", "t")).count() == 0


def test_more_topics_than_a_worker_holds(spark, monkeypatch):
    from lumbung.plans import batch

    df = spark.createDataFrame([(i, i % 7, [1.0, float(i), float(i % 3)]) for i in range(30)] + [(90, None, [0.0, 0.0, 0.0])], "id long, topic int, vec array<double>")
    cents = topics.centroids(df, "topic", "vec")
    want = sorted(tuple(r) for r in topics.nearest(df, "id", "vec", cents).collect())
    own = sorted(tuple(r) for r in topics.own_similarity(df, "id", "topic", "vec", cents).collect())
    monkeypatch.setattr(topics, "MOST_TOPICS", 2)
    assert sorted(tuple(r) for r in topics.nearest(df, "id", "vec", cents).collect()) == want
    assert sorted(tuple(r) for r in topics.own_similarity(df, "id", "topic", "vec", cents).collect()) == own
    with pytest.raises(ValueError):
        batch.meta_topics(cents, spark.createDataFrame([], "topic_a int, topic_b int, w double"), "w")


def test_neighbours_do_not_depend_on_the_blocks(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(v) for v in rng.normal(size=6)]) for i in range(150)] + [(200 + i, [1.0, 2.0, 0.0, 0.0, 1.0, 3.0]) for i in range(40)]
    df = spark.createDataFrame(rows, "id long, v array<float>")
    got = [{(r.src, r.dst, round(r.weight, 6)) for r in topics.exact_neighbours(df, "id", "v", 4, block=b).collect()} for b in (20_000, 60)]
    assert got[0] == got[1]
    assert {(s, d) for s, d, w in got[0] if s >= 200 and d < 204} == {(a, b) for a in range(200, 204) for b in range(a + 1, 204)}


def test_neighbours_have_no_bound_unless_one_is_given(spark, monkeypatch):
    df = spark.range(1, 41).select("id", F.array(F.cos("id").cast("float"), F.sin("id").cast("float")).alias("v"))
    want = sorted(tuple(r) for r in topics.exact_neighbours(df, "id", "v", 3).collect())
    count = type(df).count
    monkeypatch.setattr(type(df), "count", lambda self: 300_001 if self.columns == ["id", "v"] else count(self))
    assert sorted(tuple(r) for r in topics.exact_neighbours(df, "id", "v", 3).collect()) == want


def test_best_of_tiles_is_the_whole_search():
    rng = np.random.default_rng(5)
    raw = rng.normal(size=(300, 8)).astype(np.float32)
    raw[40:140] = raw[40]  # a crowd of equal vectors, more than a tile holds
    ids = np.sort(rng.choice(10_000, 300, replace=False))
    u = raw.astype(np.float64) / np.linalg.norm(raw.astype(np.float64), axis=1, keepdims=True)
    best = [np.full((300, 7), topics.NOBODY), np.full((300, 7), -2.0)]
    for part in (np.arange(0, 300, 2), np.arange(1, 300, 2)):
        topics._add_block(ids, u, best, ids[part], raw[part], rows=64, width=32)
    s = np.round(u @ u.T, 9)
    np.fill_diagonal(s, -2)
    want = np.array([np.lexsort((ids, -s[i]))[:7] for i in range(300)])
    assert (best[0] == ids[want]).all() and best[1] == pytest.approx(np.take_along_axis(s, want, 1), abs=2e-9)
