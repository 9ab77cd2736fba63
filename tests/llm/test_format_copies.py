import random

from lumbung.llm.format_copies import Trie, bucket_name, copies, messages, radix_splits

LONG = "x " * 60_000
ROWS = [
    (10, "Harga  BBM naik lagi, warga kecewa sekali!"),
    (11, "harga bbm naik lagi warga KECEWA sekali 😡"),
    (12, "harga bbm naik lagi warga kecewa sekalian"),
    (20, "barang: tas kulit | harga: 12000 | kota: Solo jaya"),
    (21, "KOTA = solo jaya; barang=TAS kulit;harga = 12000;"),
    (22, "barang tas kulit harga 12000 kota solo jaya"),
    (23, "kota solo jaya barang tas kulit harga 12000"),
    (24, "kota: solo jaya dekat pasar barang harga tas; kulit 12000"),
    (30, "pendek saja"),
    (31, "pendek saja"),
    (40, None),
    (41, ""),
    (42, " \n;|"),
    (50, LONG),
    (51, LONG.upper()),
    (60, "Ini pesan yang berulang persis di tabel"),
    (60, "Ini pesan yang berulang persis di tabel"),
    (None, "Harga BBM naik lagi, warga kecewa sekali!"),
]
FOUND = {(10, 11), (20, 21), (20, 22), (20, 23), (50, 51)}


def rows(df):
    return {tuple(r) for r in df.collect()}


def test_copies(spark):
    df = spark.createDataFrame(ROWS, "id long, text string")
    assert rows(copies(df, "id", "text")) == FOUND
    assert rows(messages(df, "id", "text")) == {(10, 2), (12, 1), (20, 4), (24, 1), (30, 2), (50, 2), (60, 2)}
    assert rows(messages(df, "id", "text", 25)) == {(10, 2), (12, 1), (20, 4), (24, 1), (50, 2), (60, 2)}


def test_clashing_columns_and_names(spark):
    df = spark.createDataFrame([(t, i, "x", 1) for i, t in ROWS], "id string, text long, first string, canon int")
    assert rows(copies(df, "text", "id")) == FOUND


def test_empty(spark):
    df = spark.createDataFrame([], "id long, text string")
    assert copies(df, "id", "text").columns == ["first_id", "id"]
    assert rows(copies(df, "id", "text")) == set()


def test_small_buckets_and_hot_group(spark):
    rng = random.Random(1)
    base = [f"pesan nomor {k} tentang jalan rusak di kampung {k % 7}" for k in range(60)]
    data = [(i, rng.choice([base[0], rng.choice(base)]).replace(" ", rng.choice([" ", "  ", ", "]))) for i in range(600)]
    first = {}
    want = set()
    for i, t in data:
        key = "".join(c for c in t if c.isalnum())
        if key in first:
            want.add((first[key], i))
        first.setdefault(key, i)
    df = spark.createDataFrame(data, "id long, text string").repartition(5)
    for capacity, split in ((20_000, 200_000), (3, 7)):
        assert rows(copies(df, "id", "text", capacity=capacity, split_rows=split)) == want
        got = {r.first_id: r.copies for r in messages(df, "id", "text", capacity=capacity, split_rows=split).collect()}
        assert got == {i: 1 + sum(a == i for a, _ in want) for i in first.values()}


def test_a_long_template_is_skipped_at_once(spark):
    head = b"iklan" * 100
    keys = [head + str(i).encode() for i in range(300)] + [head, b"lain", b""]
    splits = radix_splits(spark.createDataFrame([(bytearray(k),) for k in keys], "canon binary"), 40)
    assert len({len(k) for k in splits}) <= 3 and max(splits.values()) <= len(head) + 4
    names = [bucket_name(splits, k) for k in keys]
    assert max(names.count(n) for n in set(names)) <= 40 and all(k.startswith(n) for k, n in zip(keys, names, strict=True))
    data = [(i, k.decode()) for i, k in enumerate(keys + keys[5:9])]
    assert rows(copies(spark.createDataFrame(data, "id long, text string"), "id", "text", capacity=10)) == {(5 + j, len(keys) + j) for j in range(4)}


def test_trie_keeps_every_key():
    t = Trie()
    keys = [b"", b"a", b"abcd", b"abcde", b"abcdefgh", b"abcdefgi", b"abc", b"abcd"]
    for k in keys:
        t.terminal(k)[1] += 1
    assert {k: e[1] for k, e in t} == {k: keys.count(k) for k in keys} and t.size == 7
