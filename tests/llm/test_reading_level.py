import random

import pytest

from lumbung.llm import reading_level as rl


@pytest.mark.parametrize(
    "text,words,sentences",
    [
        ("Satu dua. Tiga!! Empat?! lima… Enam", 6, 5),
        ("harga 3.500 dan 2.12 naik.", 3, 1),
        ("beli di Jl. Mawar No. 5 dll. lalu pulang.", 8, 1),
        ("lihat https://s.kabar.example/a.b/22. Lalu pergi.", 9, 2),
        ("<p>Satu dua.</p><p>Tiga</p>", 3, 2),
        ("baris satu\nbaris dua", 4, 1),
        ("...", 0, 0),
    ],
)
def test_measures(text, words, sentences):
    n, s, _, _ = rl.measures(text)
    assert (n, s) == (words, sentences)


def test_bands():
    assert rl.band(9, 1, 47) == "easy" and rl.band(10, 1, 47) == "medium" and rl.band(9, 1, 48) == "medium"
    assert rl.band(20, 1, 116) == "hard" and rl.band(19, 1, 116) == "medium" and rl.band(20, 1, 115) == "medium" and rl.band(0, 0, 0) == "easy"


def made(n, seed):
    rng = random.Random(seed)
    words = [[f"kata{chr(97 + k)}{chr(97 + i)}" for i in range(26)] for k in range(5)]
    out = []
    for i in range(n):
        level = rng.randint(1, 5)
        out.append((i, level, " ".join(rng.choice(words[min(4, max(0, rng.randint(0, level - 1)))]) for _ in range(60)) + "."))
    return out


def test_levels_follow_held_out_judgements(spark):
    rows = made(400, 1)
    docs = spark.createDataFrame([(i, t, "x", 1) for i, _, t in rows], "id long, text string, words string, level int")
    labels = spark.createDataFrame([(i, lv) for i, lv, _ in rows if i < 300] + [(1, None), (2, 9), (None, 3)], "doc long, level int")
    got = {r.id: r.level for r in rl.reading_levels(docs, "id", "text", rl.fit(docs, "id", "text", labels, "doc", "level")).collect()}
    error = [abs(got[i] - lv) for i, lv, _ in rows if i >= 300]
    assert sum(error) / len(error) < 0.6


def test_edges(spark):
    docs = spark.createDataFrame([(1, None), (2, ""), (3, " \n "), (4, "!!!"), (5, "kata " * 50_000), (6, "a b."), (6, "a b.")], "id long, text string")
    labels = spark.createDataFrame([], "id long, level int")
    model = rl.fit(docs, "id", "text", labels, "id", "level")
    got = rl.reading_levels(docs, "id", "text", model).collect()
    assert sorted(r.id for r in got) == [4, 5, 6, 6]
    assert {r.id: (r.level, r.known, r.words) for r in got}[5] == (3.0, 0.0, 50_000)
    assert rl.reading_levels(docs.where("false"), "id", "text", model).count() == 0
