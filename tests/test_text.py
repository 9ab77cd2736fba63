import pytest
from pyspark.sql import functions as F

from lumbung.functions import text

CASES = [
    ("RT @budi: harga BBM naik https://t.co/x", "harga bbm naik"),
    ("mantaaap bangettt", "mantap banget"),
    ("wkwkwkwk lucu", "wkwk lucu"),
    ("awkwkwk hahahaha xixixi hihi hehehe", "wkwk wkwk wkwk wkwk wkwk"),
    ("jalan2 yuk", "jalan jalan yuk"),
    ("#BBMNaik &amp; rugi", "bbmnaik rugi"),
    ("harga 1000", "harga 10"),
    ("rtx mahal", "x mahal"),
    (None, ""),
    ("", ""),
    ("www.toko.example dan\xa0www x", "dan wkwk x"),
    ("ＡＢＣ １２ ﬁ", "abc 12 fi"),
    ("emoji 😂❤️ hilang", "emoji hilang"),
    ("a-b_c! (d)", "a b_c d"),
    ("haha", "wkwk"),
    ("hahax", "hahax"),
]


def test_clean_text(spark):
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(CASES)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(text.clean_text(F.col("t"))).collect()]
    assert got == [w for _, w in CASES]


def test_options(spark):
    df = spark.createDataFrame([("rtx mahal 😂😂 bgt gak",)], "t string")
    lex = {"bgt": "banget", "gak": "tidak jelas"}
    one = lambda **k: df.select(text.clean_text(F.col("t"), **k)).first()[0]
    assert one(strict_repost=True) == "rtx mahal bgt gak"
    assert one(keep_emoji=True) == "x mahal 😂😂 bgt gak"
    assert one(lexicon=lex) == "x mahal banget tidak jelas" and one(lexicon={}) == "x mahal bgt gak"


def test_cleaning_twice_changes_nothing(spark):
    df = spark.createDataFrame([(t,) for t, _ in CASES if t and "1000" not in t and "rt" not in t.lower()], "t string")
    once = df.select(text.clean_text(F.col("t")).alias("a")).select("a", text.clean_text(F.col("a")).alias("b")).collect()
    assert all(r.a == r.b for r in once)


def test_informative(spark):
    rows = [("ok", False), ("wkwk yg", False), ("harga bbm naik", True), (None, False), ("", False), ("a b c d e f", False), ("yang dan itu", False), ("macet parah", True)]
    df = spark.createDataFrame([(i, t) for i, (t, _) in enumerate(rows)], "i int, t string")
    got = [r[0] for r in df.orderBy("i").select(text.informative(F.col("t"), [*text.STOPWORDS, "yg"])).collect()]
    assert got == [w for _, w in rows]


def test_lexicon_last_line_wins(spark):
    df = spark.createDataFrame([(1, " Bgt ", "sangat"), (2, "bgt", "Banget"), (3, "", "x"), (4, "ok", "OK"), (5, None, "y"), (6, "z", None)], "line_no long, slang string, formal string")
    assert text.lexicon_map(df) == {"bgt": "banget"}
    with pytest.raises(ValueError):
        text.lexicon_map(df, most=0)


def test_names_labels_stopwords(spark):
    df = spark.createDataFrame([("id-ID", 0, "harga, naik"), ("ceb-X", 3, ""), (None, -1, "x"), ("EN", -2, None)], "c string, t int, k string")
    got = df.select(text.language_name(F.col("c")).alias("n"), text.topic_label(F.col("t"), F.col("k")).alias("l")).collect()
    assert [r.n for r in got] == ["Indonesian", "Cebuano", "Undetermined", "English"]
    assert [r.l for r in got] == ["harga", "topic_3", "OUTLIER_NO_TOPIC", "FILTERED_NON_INFORMATIVE"]
    assert text.load_stopwords(spark.createDataFrame([("b ",), ("a",), ("",), ("a",)], "value string")) == ["a", "b"]


def test_fingerprint(spark):
    df = spark.createDataFrame([("a",), ("b",)], "t string")
    mark = lambda d, m="x", p=False: text.fingerprint(d, "t", m, p).first()["fingerprint"]
    assert mark(df) == mark(df.repartition(3)) and len(mark(df)) == 16
    assert len({mark(df), mark(df, "y"), mark(df, "x", True), mark(df.union(df)), mark(df.limit(1))}) == 5
