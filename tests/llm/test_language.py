import random

from lumbung.llm import language

ID = "saya tidak bisa pergi ke pasar karena hujan turun sejak pagi tadi dan jalan banjir".split()
EN = "the river was high and we could not walk home because they closed every road again".split()


def model():
    rng = random.Random(2)
    texts = {"id": [" ".join(ID)] * 9, "en": [" ".join(EN)] * 9}
    for _ in range(50):
        for k in texts:
            texts[k].append("".join(rng.choice("bdkmnr") + rng.choice("aiu") for _ in range(3)))
    return language.Model(texts)


def test_automaton_finds_longest_matches():
    a = language.Automaton("abcabdx")
    assert a.phrases("abca") == 1 and a.phrases("abdabc") == 2 and a.phrases("zz") == 2 and a.phrases("") == 0


def test_side_by_side_parsing_finds_the_same_phrases():
    rng = random.Random(8)
    a = language.Automaton("".join(rng.choice("abc ") for _ in range(300)))
    letters = {c: i + 1 for i, c in enumerate("abc ")}
    texts = ["".join(rng.choice("abc x") for _ in range(rng.randint(1, 60))) for _ in range(40)]
    import numpy as np

    flat, size = np.array([letters.get(c, 0) for c in "".join(texts)], np.int32), np.array([len(t) for t in texts])
    lengths = language.phrase_lengths(a.dense(letters), flat, np.cumsum(size) - size, np.cumsum(size))
    for t, e, n in zip(texts, np.cumsum(size), size, strict=True):
        assert round((1 / lengths[e - n : e]).sum(), 6) == a.phrases(t)


def test_segments():
    m = model()
    texts = [" ".join(ID[:10]), " ".join(EN[:10]), " ".join(ID[:8]) + ". " + " ".join(EN[:8]), " ".join(ID[:6]) + " again " + " ".join(ID[6:12]), None, "", "wkwkwk haha https://a.example/x @b", " ".join(ID * 3000)]
    out = m.segments(texts)
    name = lambda k: [(m.languages[x], e - s) for s, e, x, _ in out[k][1]]
    assert name(0) == [("id", 10)] and name(1) == [("en", 10)] and name(2) == [("id", 8), ("en", 8)] and name(3) == [("id", 13)]
    assert out[4] == (0, []) and out[5] == (0, []) and out[6][0] == 2
    assert name(7) == [("id", len(ID) * 3000)]
    assert all(0 <= c <= 1 for _, segs in out for *_, c in segs)


def test_tables(spark):
    rng = random.Random(5)
    sample = [(k, " ".join(rng.sample(v, 10))) for k, v in (("id", ID), ("en", EN)) for _ in range(30)]
    samples = spark.createDataFrame([*sample, (None, "x"), ("id", None)], "lang string, text string")
    posts = [(i, k, " ".join(rng.sample(v, 9))) for i, (k, v) in enumerate([("id", ID), ("in", ID), ("ID-id", ID), ("en", EN), ("en-GB", EN)] * 6)]
    held = [(100, None, " ".join(ID[:8])), (101, "und", " ".join(EN[:8])), (102, "en", " ".join(ID[:8])), (103, "id", " ".join(ID[:7] + EN[:7])), (104, "", " ".join(ID[:5])), (105, "id", None), (106, None, ""), (107, "es", " ".join(ID[:9])), (107, "es", " ".join(ID[:9]))]
    df = spark.createDataFrame([(*r, 1) for r in posts + held], "id long, label string, text string, words int")
    m = language.fit(samples, "lang", "text", df, "label", "text")
    segs = language.label_segments(df, "id", "text", "label", m)
    found = {tuple(r) for r in language.mislabelled(segs).collect()}
    assert found == {(100, "id"), (101, "en"), (102, "id"), (103, "id"), (103, "en"), (107, "id")}
    und = {r.id: r for r in segs.where("id IN (105, 106)").collect()}
    assert und[105].lang == "und" and und[105].confidence == 0 and und[106].words == 0
    none = df.where("false")
    assert language.label_segments(none, "id", "text", "label", m).count() == 0


def test_held_out_accuracy(spark):
    import os

    import pytest

    root = "/root/testdata/sf0.01"
    if not os.path.exists(root):
        pytest.skip("no test data")
    rows = [(r.lang, r.text) for r in spark.read.parquet(f"{root}/lang_samples.parquet").orderBy("sample_id").collect()]
    texts = {}
    for i, (k, t) in enumerate(rows):
        if i % 5:
            texts.setdefault(k, []).append(t)
    m = language.Model(texts)
    held = [r for i, r in enumerate(rows) if not i % 5]
    right = sum(segs[0][2] == m.languages.index(k) and len(segs) == 1 for (k, _), (_, segs) in zip(held, m.segments([t for _, t in held]), strict=True))
    assert right >= 0.9 * len(held)
