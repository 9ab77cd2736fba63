import json
import zipfile

import pytest
from pyspark.sql import functions as F

from lumbung import sources
from lumbung.plans import report


def test_formats(spark, tmp_path):
    rows = [("a, \"b\"\nc", "1"), ("", "2")]
    (tmp_path / "x.csv").write_text('t,n\n"a, ""b""\nc",1\n,2\n')
    (tmp_path / "x.tsv").write_text("t\tn\nq\t1\n")
    (tmp_path / "x.jsonl").write_text('{"t": "q", "n": 1}\n{"t": "r"}\n')
    got = [tuple(r) for r in sources.read_table(spark, str(tmp_path / "x.csv")).collect()]
    assert got[0] == rows[0] and got[1][1] == "2"
    assert sources.read_table(spark, str(tmp_path / "x.tsv")).first().t == "q"
    assert sources.read_table(spark, str(tmp_path / "x.jsonl")).count() == 2
    for name, doc, n in (("a", [{"t": 1}, {"t": 2}], 2), ("b", {"meta": 1, "z": [{"t": 1}], "a": [{"t": 1}, {"t": 2}]}, 1), ("c", {"t": 1}, 1), ("d", {"e": [], "rows": [{"t": 5}, {"t": 6}, {"t": 7}]}, 3)):
        (tmp_path / f"{name}.json").write_text(json.dumps(doc))
        assert sources.read_table(spark, str(tmp_path / f"{name}.json")).count() == n
    spark.range(3).write.parquet(str(tmp_path / "x.parquet"))
    assert sources.read_table(spark, str(tmp_path / "x.parquet")).count() == 3
    with pytest.raises(ValueError):
        sources.read_table(spark, "x.xml")


def test_pages_cover_all_rows_once(spark):
    df = spark.createDataFrame([(i // 3 if i % 7 else None, i) for i in range(40)], "a long, b long")
    seen, after = [], None
    for _ in range(20):
        got = [tuple(r) for r in sources.page(df.where("a IS NOT NULL"), 7, after, ("a", "b")).collect()]
        if not got:
            break
        seen += got
        after = got[-1]
    assert seen == sorted(tuple(r) for r in df.where("a IS NOT NULL").collect())


def test_chunks_and_resume(spark, tmp_path):
    df = spark.createDataFrame([(i * 7 % 100, i) for i in range(100)], "ts long, id long").repartition(6)
    numbered = sources.chunk_numbers(df, 30, [F.col("ts"), F.col("id")])
    assert {(r.id, r.chunk_id) for r in numbered.collect()} == {(i, (i * 7 % 100) // 30) for i in range(100)}
    path = str(tmp_path / "chunks")
    assert sources.write_chunks(numbered.where("chunk_id < 2"), path) == [0, 1]
    assert sources.write_chunks(numbered, path) == [2, 3] and sources.write_chunks(numbered, path) == []
    assert sources.finished_rows(spark, path).count() == 100
    numbered.where("chunk_id = 3").withColumn("chunk_id", F.lit(9)).write.partitionBy("chunk_id").mode("append").parquet(f"{path}/rows")  # of a run that died
    assert sources.finished_rows(spark, path).count() == 100
    parts = sources.union_indices([df.withColumn("x", F.lit(1)), df], 130, ("id",))
    assert parts.count() == 130 and parts.where("index_no = 0").count() == 100


def test_text_of_mixed_columns(spark):
    df = spark.createDataFrame([(bytearray(b"a"), {"k": 1}, [1], None, 3)], "b binary, m map<string,int>, l array<int>, n string, i int")
    assert tuple(sources.as_text(df).first()) == ("a", '{"k":1}', "[1]", None, 3)


def test_latest_jobs(spark):
    rows = [("j1", "done", 1, "p"), ("j3", "Done", 5, "p"), ("j2", "done", 5, "p"), ("j9", "failed", 9, "p"), ("j4", "done", 1, None), ("j2", "done", 5, "p")]
    df = spark.createDataFrame(rows, "job_id string, status string, created_at long, project_id string")
    assert [tuple(r) for r in sources.latest_jobs(df).collect()] == [("p", "j2", 5)]


def test_topic_tables_and_zip(spark, tmp_path):
    a = tmp_path / "run one.csv"
    a.write_text("Topic,COUNT,Keywords,Examples,Name\n0,12,\"a, b\",x ||| y,n\n1,bad,c,,\n2,3,nan,,\n3,4,,,\n")
    got = sources.topic_tables(spark, [str(a)]).collect()
    assert [(r.count_, r.keywords, r.examples) if hasattr(r, "count_") else (r["count"], r.keywords, r.examples) for r in got] == [(12, "a, b", "x ||| y"), (0, "c", None)]
    assert got[0].source.replace("%20", " ") == "run one"
    (tmp_path / "bad.csv").write_text("a,b\n1,2\n")
    with pytest.raises(ValueError):
        sources.topic_tables(spark, [str(tmp_path / "bad.csv")])
    with zipfile.ZipFile(tmp_path / "z.zip", "w") as z:
        for name in ("d/a.csv", "e/a.csv", "__MACOSX/d/a.csv", "d/._a.csv", "readme.txt"):
            z.writestr(name, f"x\n{name}\n")
    got = {r.name: r.content for r in sources.zip_members(spark, str(tmp_path / "z.zip")).collect()}
    assert got == {"a.csv": "x\nd/a.csv\n", "a_2.csv": "x\ne/a.csv\n"}
    with pytest.raises(ValueError):
        sources.topic_tables(spark, [str(tmp_path / "z.zip")])
    with zipfile.ZipFile(tmp_path / "t.zip", "w") as z:
        z.writestr("p/one.csv", "Count,KEYWORDS,name\n4,\"a, b\",n\n2,nan,\nx,c,m\n")
        z.writestr("q/one.csv", "count,keywords,examples\n1,d,u ||| v\n")
    rows = sources.topic_tables(spark, [str(a), str(tmp_path / "t.zip")]).orderBy("place").collect()
    assert [(r.source.replace("%20", " "), r["count"], r.keywords, r.examples) for r in rows[2:]] == [("one", 4, "a, b", None), ("one", 0, "c", None), ("one_2", 1, "d", "u ||| v")]
    assert [r.keywords for r in rows[:2]] == ["a, b", "c"]
    (tmp_path / "cache").mkdir()
    (tmp_path / "cache" / "c.csv").write_text("a\n")
    (tmp_path / "topic_graph_edges.csv").write_text("a\n")
    names = {r.path.rsplit("/", 1)[1].replace("%20", " ") for r in sources.cluster_files(spark, str(tmp_path)).collect()}
    assert names == {"run one.csv", "bad.csv"}


def test_cluster_reports(spark):
    whole = spark.createDataFrame([("0", "5"), ("1", "x"), ("-1", "7"), ("bad", "9")], "Topic string, Count string")
    assert {tuple(r) for r in report.cluster_sizes(whole).collect()} == {(0, 5), (1, 0), (-1, 7)}
    rows = spark.createDataFrame([(0,), (0,), (1,), (-1,), (-2,), (None,)], "topic int")
    sizes = report.cluster_sizes(rows)
    assert tuple(report.summary(sizes).first()) == (2, 3, 1, 1, 2)
    assert [tuple(r) for r in report.largest(sizes, 5).collect()] == [(1, 0, 2), (2, 1, 1)]
    with pytest.raises(ValueError):
        report.cluster_sizes(spark.range(2))
    both = spark.createDataFrame([("b", 3), ("a", 3), ("c", 1)], "path string, n_docs_clustered long")
    assert report.headline(both).first().path == "a"


def test_pages_go_through_null_keys_to_the_end(spark):
    rows = [(i if i < 4 else None, i) for i in range(17)]
    df = spark.createDataFrame(rows, "a int, b int").repartition(3)
    got, after = [], None
    for _ in range(10):
        page = [tuple(r) for r in sources.page(df, 5, after, ("a", "b")).collect()]
        if not page:
            break
        got, after = got + page, page[-1]
    assert got == rows


def test_fetch_goes_on_where_it_stood(spark, tmp_path):
    a = spark.createDataFrame([(i // 4 if i % 5 else None, i, [i]) for i in range(23)], "ts long, id long, tags array<int>").repartition(3)
    b = spark.createDataFrame([(1, 100, [1]), (None, 101, None)], "ts long, id long, tags array<int>")
    path = str(tmp_path / "fetch")
    assert sources.fetch([a, b], path, 4, ("ts", "id"), most_chunks=2) == 2
    a.where("id < 2").withColumn("index_no", F.lit(0)).write.parquet(f"{path}/rows/chunk_id=3")  # of a run that died before its manifest
    assert sources.finished_rows(spark, path).count() == 8
    assert sources.fetch([a, b], path, 4, ("ts", "id")) == 5 and sources.fetch([a, b], path, 4, ("ts", "id")) == 0
    rows = sources.finished_rows(spark, path).orderBy("chunk_id", F.col("ts").asc_nulls_last(), "id").collect()
    assert [(r.ts, r.id) for r in rows] == [tuple(r) for d in (a, b) for r in d.orderBy(F.col("ts").asc_nulls_last(), "id").select("ts", "id").collect()]
    assert rows[0].tags == f"[{rows[0].id}]"
