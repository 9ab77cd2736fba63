from collections import Counter

from pyspark.sql import functions as F

from lumbung.operators.skew import eager_join_sums, eager_rollup, join_hot, join_text


def test_rollup_is_that_of_the_join(spark):
    left = spark.createDataFrame([("a", "x")] * 40 + [("a", "y")] * 3 + [("b", "x"), (None, "x"), ("c", None)], "k string, g string")
    right = spark.createDataFrame([("a", 2), ("a", 5), ("a", None), ("c", 7), ("d", 1), (None, 3)], "k string, v long")
    got = {r.g: (int(r.joined_rows), int(r.joined_sum)) for r in eager_rollup(left, right, "k", "g", "v").collect()}
    want = {r.g: (r.n, r.s) for r in left.join(right, "k").groupBy("g").agg(F.count("*").alias("n"), F.sum("v").alias("s")).collect()}
    assert got == want


def test_hot_texts_are_joined(spark):
    df = spark.createDataFrame([("viral", i) for i in range(50)] + [(None, 90), ("x", 91), ("y", 92)], "t string, i int")
    known = spark.createDataFrame([("viral", 1), ("x", 2)], "_text string, n int")
    for most in (1000, 2):
        assert {(r.i, r.n) for r in join_text(df, "t", known, most).collect()} == {(i, 1) for i in range(50)} | {(90, None), (91, 2), (92, None)}


def test_eager_sums_match_the_joined_rows(spark):
    left = [("a", 1, 5), ("a", 2, None), ("b", 3, 1), ("d", None, None), (None, 9, 9)]
    right = [("a", 10), ("a", 20), ("a", None), ("c", 7), (None, 1)]
    a, b = spark.createDataFrame(left, "k string, x long, y long"), spark.createDataFrame(right, "k string, z long")
    got = {r.key: r for r in eager_join_sums({"l": (a, ["x", "y"]), "r": (b, ["z"])}, "k").collect()}
    full = a.where("k IS NOT NULL").join(b.where("k IS NOT NULL"), "k", "full").groupBy("k").agg({"x": "sum", "y": "sum", "z": "sum", "*": "count"}).collect()
    assert set(got) == {r.k for r in full} == {"a", "b", "c", "d"}
    for r in full:
        g = got[r.k]
        assert int(g.joined_rows) == r["count(1)"]
        for side, m in (("l", "x"), ("l", "y"), ("r", "z")):
            want, have = r[f"sum({m})"], g[f"joined_{side}_{m}_sum"]
            assert (None if have is None else int(have)) == want
    assert eager_join_sums({"l": (a.where("false"), ["x"]), "r": (b.where("false"), ["z"])}, "k").count() == 0


def test_join_with_hot_keys(spark):
    rows = [(i, "hot" if i % 3 else f"k{i % 50}") for i in range(900)] + [(1000, None), (1001, "none")]
    classes = [(k, k.upper(), n) for k, n in Counter(k for _, k in rows if k).items() if k != "none"]
    df, cl = spark.createDataFrame(rows, "id long, k string"), spark.createDataFrame(classes, "k string, c string, n long")
    for most in (1000, 10, 1):
        got = {(r.id, r.c) for r in join_hot(df, cl, ["k"], "n", most).collect()}
        assert got == {(i, k.upper()) for i, k in rows if k and k != "none"}
    assert join_hot(df, cl.where("false"), ["k"], "n").count() == 0


def test_staged_tables_are_dropped(spark):
    import os

    from lumbung.session import drop_staged, stage

    path = stage(spark.range(5), "five").inputFiles()[0].removeprefix("file://")
    assert os.path.exists(path) and drop_staged(spark) >= 1
    assert not os.path.exists(path) and drop_staged(spark) == 0
