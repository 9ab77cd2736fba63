import random

import pytest

from lumbung.llm.leaked_items import leaked, load, weighed, words_of


def brute(docs, items, run):
    grams = {}
    for i, t in items:
        w = words_of(t or "")
        for j in range(len(w) - run + 1):
            grams.setdefault(tuple(w[j : j + run]), set()).add(i)
    out = set()
    for d, t in docs:
        w = words_of(t or "")
        for j in range(len(w) - run + 1):
            out |= {(d, i) for i in grams.get(tuple(w[j : j + run]), ())}
    return out


@pytest.mark.parametrize("postings,cells", [(8_000_000, 16_000_000), (150, 16_000_000), (8_000_000, 0)])
def test_against_brute_force(spark, monkeypatch, postings, cells):
    monkeypatch.setattr("lumbung.llm.leaked_items.CELLS", cells)
    rng = random.Random(4)
    words = [f"k{i}" for i in range(40)]
    text = lambda n: " ".join(rng.choice(words) for _ in range(n))
    items = [(i, text(rng.randint(5, 40))) for i in range(30)]
    docs = []
    for d in range(150):
        parts = [text(rng.randint(0, 30))]
        if rng.random() < 0.5:
            w = rng.choice(items)[1].split()
            n = rng.randint(5, 12)
            s = rng.randint(0, max(0, len(w) - n))
            parts += ["<p>" + ",\n".join(w[s : s + n]).upper() + "</p>", text(rng.randint(0, 30))]
        docs.append((d, " ".join(parts)))
    df, it = spark.createDataFrame(docs, "id long, text string"), spark.createDataFrame(items, "item long, t string")
    got = leaked(df, "id", "text", it, "item", "t", most_postings=postings).collect()
    assert {(r.id, r.item_id) for r in got} == brute(docs, items, 8)
    assert all(r.score >= 0.999 and r.runs >= 1 for r in got)


def test_edges(spark):
    item = "satu dua tiga empat lima enam tujuh delapan sembilan"
    docs = [(1, None), (2, ""), (3, "satu dua tiga"), (4, "kata " * 50_000 + item), (5, "x " + item), (5, "x " + item), (None, item)]
    df = spark.createDataFrame([(*d, "x", 1) for d in docs], "id long, text string, item_id string, runs int")
    it = spark.createDataFrame([(9, item), (9, item), (10, None), (11, "pendek"), (None, item)], "item_id long, text string")
    got = leaked(df, "id", "text", it, "item_id", "text").collect()
    assert {(r.id, r.item_id, r.runs) for r in got} == {(4, 9, 2), (5, 9, 2)}
    assert leaked(df.where("false"), "id", "text", it, "item_id", "text").count() == 0
    assert leaked(df, "id", "text", it.where("false"), "item_id", "text").count() == 0


def test_blocks_are_skipped_and_parts_told_apart(spark):
    rng = random.Random(5)
    common, rare = [f"u{i}" for i in range(30)], [f"r{i}" for i in range(3000)]
    text = lambda n: " ".join(rng.choice(common if rng.random() < 0.6 else rare) for _ in range(n))
    items = [(i, text(rng.randint(20, 60))) for i in range(2000)] + [(5000, "apa warna langit pada siang hari yang cerah? langit tampak biru karena cahaya pendek paling banyak dihamburkan udara")]
    index = load(weighed(spark.createDataFrame(items, "item long, t string"), "item", "t", 8).orderBy("least").toArrow(), 8)
    docs = [text(80) + " " + " ".join(items[k][1].split()[4:14]) for k in range(0, 300, 3)]
    docs += ["dia tahu langit tampak biru karena cahaya pendek paling banyak dihamburkan udara kata guru", "apa warna langit pada siang hari yang cerah"]
    got = index.leaks(docs)
    assert {(r[0], r[1]) for r in got} == brute(list(enumerate(docs)), items, 8)
    assert index.skipped > 0 and index.opened > 0
    parts = {r[0]: r[4:] for r in got if r[1] == 5000}
    assert parts[100] == (10 / 18, 0.0, 1.0) and parts[101] == (8 / 18, 1.0, 0.0)
