import os

import pytest

from lumbung.llm import source_mixture as mix
from lumbung.llm.queries import VOCABULARY

pytestmark = pytest.mark.skipif(not os.path.exists(VOCABULARY), reason="no vocabulary")


def test_counts_match_the_tokenizer(spark):
    import base64

    import tiktoken

    with open(VOCABULARY, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    enc = tiktoken.Encoding("t", pat_str=mix.PATTERN, mergeable_ranks=ranks, special_tokens={})
    texts = ["Halo dunia!  Apa kabar?\n\n3.500 it's", "", None, "😭 naïve ujung " * 2000, "<|endoftext|>"]
    df = spark.createDataFrame([(i, t, " Forum-Warga ") for i, t in enumerate(texts)], "id long, text string, source string")
    got = {r.id: r for r in mix.token_counts(df, "id", "text", "source", VOCABULARY).collect()}
    assert [got[i].tokens for i in range(len(texts))] == [len(enc.encode_ordinary(t or "")) for t in texts]
    assert got[0].source == "forum_warga"


def test_shares(spark):
    docs = [(i, "a b c d", "Big") for i in range(900)] + [(1000 + i, "a b c d", "small one") for i in range(60)] + [(2000 + i, "a b", "other") for i in range(50)] + [(3000, None, "Big"), (3001, "x", None)]
    df = spark.createDataFrame([(*d, 1.0, 2) for d in docs], "id long, text string, source string, rate double, copies int")
    targets = spark.createDataFrame([("big", 0.5, 2), ("Small-One", 0.4, 3), ("none", 0.1, 5), (None, 0.5, 1), ("null", None, 1)], "source string, target_share double, max_repeats int")
    counts = mix.token_counts(df, "id", "text", "source", VOCABULARY)
    rate = mix.rates(counts, targets)
    by = {r.source: r for r in rate.collect()}
    assert set(by) == {"big", "Small-One", "none"}
    total = 960 * 4
    assert by["big"].rate == pytest.approx(0.5 * total / 3600) and not by["big"].short
    assert by["Small-One"].rate == 3 and by["Small-One"].short and by["none"].rate == 0 and by["none"].short
    rows = mix.mixture(counts, rate).collect()
    copies = {}
    for r in rows:
        copies.setdefault(r.source, {}).setdefault(r.id, []).append(r.copy)
    assert all(sorted(c) == [1, 2, 3] for c in copies["Small-One"].values()) and len(copies["Small-One"]) == 60
    assert abs(len(copies["big"]) - by["big"].rate * 901) < 60
    assert sorted(map(tuple, rows)) == sorted(map(tuple, mix.mixture(counts.repartition(7), rate).collect()))
    report = {r.source: r for r in mix.shares(mix.mixture(counts, rate), rate).collect()}
    assert report["none"].actual_share == 0 and abs(sum(r.actual_share for r in report.values()) - 1) < 1e-5


def test_empty(spark):
    df = spark.createDataFrame([], "id long, text string, source string")
    targets = spark.createDataFrame([("a", 1.0, 2)], "source string, target_share double, max_repeats int")
    rate = mix.rates(mix.token_counts(df, "id", "text", "source", VOCABULARY), targets)
    assert [(r.source, r.short) for r in rate.collect()] == [("a", False)]
    assert mix.mixture(mix.token_counts(df, "id", "text", "source", VOCABULARY), rate).count() == 0
    assert mix.rates(mix.token_counts(df, "id", "text", "source", VOCABULARY), targets.where("false")).count() == 0
