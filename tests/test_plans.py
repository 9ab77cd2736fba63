import random

import pytest

from lumbung import streaming
from lumbung.operators import topics
from lumbung.plans import batch, merge


def posts(n=150, seed=2):
    rng = random.Random(seed)
    themes = ["harga bensin antre solar pom naik".split(), "konser tiket panggung musik lagu penonton".split(), "banjir sungai hujan genangan perahu pompa".split()]
    rows = []
    for i in range(n):
        rows.append((i, " ".join(rng.choice(themes[i % 3]) for _ in range(9)) + (" yang dan" if i % 2 else ""), "x"))
    return [*rows, (1000, rows[0][1], "x"), (1001, "ok", "y"), (1002, None, "y")]


@pytest.mark.parametrize("engine", ["communities", "density"])
def test_batch(spark, engine):
    df = spark.createDataFrame(posts(), "id long, content string, topic string")
    done = batch.run(df.withColumnRenamed("topic", "extra"), "content", "id", batch.Settings(target=(2, 6), k=8, engine=engine, min_cluster_size=12, language_filter=False))
    rows = {r.id: r for r in done.assignments.collect()}
    assert len(rows) == 153 and rows[1001].topic == rows[1002].topic == -2 and rows[1000].topic == rows[0].topic
    assert rows[1001].topic_label == "FILTERED_NON_INFORMATIVE" and rows[1001].meta_topic == -2
    pure = 0
    by = {}
    for i in range(150):
        if rows[i].topic >= 0:
            by.setdefault(rows[i].topic, []).append(i % 3)
    pure = sum(max(v.count(k) for k in range(3)) for v in by.values())
    assert pure >= 0.9 * sum(map(len, by.values())) and sum(map(len, by.values())) > 75
    table = done.topics.collect()
    assert {t.topic for t in table} == set(by) and all(t.keywords is not None for t in table) and done.metrics.first().n_rows == 153
    assert done.languages.count() >= 1


def test_too_few_texts(spark):
    df = spark.createDataFrame(posts(10), "id long, content string, extra string")
    with pytest.raises(ValueError):
        batch.run(df, "content", "id")
    with pytest.raises(ValueError):
        batch.run(df, "missing", "id")


def chunk_centroids(spark, n=30, dim=6):
    import numpy as np

    rng = np.random.default_rng(1)
    rows = [(f"c{i % 5}", i // 5, [float(x) for x in np.eye(dim)[i % 3] + 0.05 * rng.normal(size=dim)]) for i in range(n)]
    return spark.createDataFrame(rows, "chunk string, topic int, centroid array<double>")


def test_global_topics(spark):
    cents = chunk_centroids(spark)
    few = {(r.chunk, r.topic): r.global_topic for r in merge.global_topics(cents, (40, 50)).collect()}
    assert sorted(few.values()) == list(range(30))
    got = merge.global_topics(cents, (2, 3)).collect()
    assert 2 <= len({r.global_topic for r in got}) <= 3 and len(got) == 30
    rows = spark.createDataFrame([("c0", 0), ("c0", -1), ("c0", -2), ("zz", 0), (None, 0)], "chunk string, topic int")
    mapped = merge.apply_mapping(rows, merge.global_topics(cents, (2, 3)))
    assert [r.global_topic >= 0 if r.chunk == "c0" and r.topic == 0 else r.global_topic for r in mapped.orderBy("chunk", "topic").collect()] == [-1, -2, -1, True, -1]
    local = spark.createDataFrame([(f"c{i % 5}", i // 5, i, f"k{i % 3}, x") for i in range(30)], "chunk string, topic int, n_rows long, keywords string")
    out = merge.global_summary(local, merge.global_topics(cents, (2, 3)), cents, 0.0).collect()
    assert sum(r.n_rows for r in out) == sum(range(30)) and all("x" in r.keywords for r in out) and all(r.meta_topic is not None for r in out)


def test_super_topics(spark):
    cents = chunk_centroids(spark)
    got = merge.super_topics(cents, ["chunk", "topic"], top=3).collect()
    assert len({r.super_topic for r in got}) == 3
    more = merge.super_topics(cents, ["chunk", "topic"], top=5).collect()
    assert len({r.super_topic for r in more}) == 5
    ranked = merge.ranked_super_topics(spark.createDataFrame([(0, "p", 5, "a, b"), (1, "q", None, "nan"), (1, "q", 9, "c"), (0, "r", 1, "b")], "super_topic int, project_id string, n_rows long, keywords string"), "project_id")
    assert [tuple(r) for r in ranked.collect()] == [(1, 1, 9, 1, "c"), (2, 0, 6, 2, "b, a")]
    assert sorted(merge.slices(ranked, (1, 2, 50))) == [1, 2]


def test_stream(spark, tmp_path):
    import datetime as dt

    at = dt.datetime(2026, 1, 1)
    rows = [(i, "harga bensin naik lagi" if i % 2 else "ok", f"o{i % 6}", at + dt.timedelta(minutes=10 * i)) for i in range(12)]
    df = spark.createDataFrame(rows, "id long, content string, object_id string, fetched_at timestamp")
    src = str(tmp_path / "in")
    df.repartition(3).write.parquet(src)
    from lumbung.functions.models import hashed_ngrams

    vec = hashed_ngrams()(["harga bensin naik lagi"])[0]
    cents = spark.createDataFrame([(3, [float(x) for x in vec])], "topic int, centroid array<double>")
    out = str(tmp_path / "out")
    streaming.assign_stream(streaming.stream_posts(spark, src, df.schema, 1), "id", "content", cents, 0.5, out, str(tmp_path / "ck")).awaitTermination(120)
    got = {r.id: r.topic for r in spark.read.parquet(out).collect()}
    assert got == {i: 3 if i % 2 else -2 for i in range(12)}
    q = streaming.without_refetched(streaming.stream_posts(spark, src, df.schema)).writeStream.format("memory").queryName("once").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("once").count() == 6
    q = streaming.counts_by_window(streaming.stream_posts(spark, src, df.schema), "object_id").writeStream.format("memory").queryName("counted").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert spark.table("counted").agg({"n": "sum"}).first()[0] == 12


def test_cooccurrence_counts_pairs(spark):
    cents = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.8, 0.6])], "topic int, centroid array<double>")
    df = spark.createDataFrame([(1, [1.0, 0.1]), (2, [0.0, 1.0]), (3, [0.0, 0.0]), (4, None)], "id long, v array<float>")
    assert [tuple(r) for r in topics.cooccurrence(df, "id", "v", cents, 0.4, 0.1).collect()] == [(0, 1, 1, 0.5, 0.8)]


def test_density_topics_of_all_vectors(spark):
    import numpy as np

    from lumbung.operators import community

    rng = np.random.default_rng(4)
    x = np.vstack([rng.normal(size=8) + 0.1 * rng.normal(size=(60, 8)) for _ in range(5)] + [rng.normal(size=(60, 8)), np.ones((30, 8))])
    for stored in (1, 3, 16):
        tree, want = community.spread_density_tree(spark, x, 3, stored), community.density_tree(x, 3)
        assert np.allclose(sorted(w for w, _, _ in tree), sorted(w for w, _, _ in want), atol=1e-7)
    df = spark.createDataFrame([(i, [float(v) for v in r]) for i, r in enumerate(x)] + [(900, None), (901, [0.0] * 8)], "id long, vec array<double>")
    for sample in (120, 1000):
        got = {r.id: r.topic for r in batch.density_topics(df, "id", "vec", 5, 2, batch.Settings(fit_sample=sample)).collect()}
        assert set(got) == set(range(len(x))) and None not in got.values()
        assert sum(got[i] >= 0 for i in range(300)) > 200
