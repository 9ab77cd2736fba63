import random

from lumbung import sources
from lumbung.engine import Engine


def test_chunks_merge_and_resume(spark, tmp_path):
    rng = random.Random(1)
    themes = ["harga bensin antre solar pom".split(), "konser tiket panggung musik lagu".split()]
    rows = [(i, " ".join(rng.choice(themes[i % 2]) for _ in range(8)), i // 80) for i in range(160)] + [(900, "sendiri di sini saja", 2)]
    df = spark.createDataFrame(rows, "id long, content string, chunk_no int")
    e, path = Engine(spark), str(tmp_path / "out")
    settings = {"target": (2, 4), "k": 6, "language_filter": False, "min_unique": 20}
    assert e.cluster_chunks(df, "content", "id", "chunk_no", path, **settings) == ["0", "1"]
    assert e.cluster_chunks(df, "content", "id", "chunk_no", path, **settings) == []
    assert [r.chunk for r in e.refused(path).collect()] == ["2"] and "fewer" in e.refused(path).first().reason
    summary, assigned = e.merge(path, (2, 3))
    assert assigned.count() == 160 and 2 <= summary.count() <= 3
    assert sum(r.n_rows for r in summary.collect()) == assigned.where("global_topic >= 0").count()
    names = e.report({"a": assigned, "b": spark.range(3)}).collect()
    assert [r.path for r in names] == ["a"] and names[0].n_docs_clustered == assigned.where("global_topic >= 0").count()
    assert e.report({}).count() == 0
    cents = spark.read.parquet(f"{path}/centroids").selectExpr("CAST(chunk AS STRING) AS project_id", "topic AS global_topic", "centroid")
    topics = cents.selectExpr("project_id", "global_topic", "10L AS n_rows", "'a, b' AS keywords")
    jobs = spark.createDataFrame([("j1", "done", 1, "0"), ("j2", "failed", 2, "1")], "job_id string, status string, created_at long, project_id string")
    ranked = e.super_topics(cents, topics, jobs, 2).collect()
    assert len(ranked) == 2 and all(r.n_sources == 1 and r.keywords == "a, b" for r in ranked)


def test_super_topics_of_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_text('topic,count,keywords,name,examples\n0,5,"harga, bensin, solar",bensin,x ||| y\n1,7,"konser, musik, tiket",musik,\n')
    (tmp_path / "b.csv").write_text('Topic,Count,Keywords,Name\n0,3,"harga, bensin, antre",bensin\n')
    got = Engine(spark).super_topics_of_tables([str(tmp_path / "a.csv"), str(tmp_path / "b.csv")], 2).collect()
    assert [(r["rank"], r["count"], r.n_sources, r.top_names) for r in got] == [(1, 8, 2, "bensin"), (2, 7, 1, "musik")]
    assert got[0].examples == "x ||| y" and got[0].keywords.startswith("bensin, harga")


def test_cursor(spark, tmp_path):
    path = str(tmp_path / "cursor")
    assert sources.read_cursor(spark, path) is None
    sources.write_cursor(spark, path, 0, ("2026-01-01", 5))
    sources.write_cursor(spark, path, 1, ("2026-01-02", 7))
    assert sources.read_cursor(spark, path) == (1, ("2026-01-02", 7))
    sources.write_cursor(spark, path, 1, (None, 9))
    assert sources.read_cursor(spark, path) == (1, (None, 9))
