"""Copies hidden by spacing, case, punctuation or the order of labelled fields.

Canonical bytes of every record go through recursive radix partitioning: records that are equal inside one input split
are first folded by a trie with terminal counters, the folded entries are spread over buckets named by their leading
bytes, a bucket above its capacity is split by further bytes until each fits, and a trie per bucket then counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.operators.components import components
from lumbung.session import stage

BREAK = r"[;|\n\r\x{0B}\x{0C}\x{85}\x{2028}\x{2029}]"
INK = r"[^\s\p{Z}\p{Cc}\p{Cf}]"
LABEL = r"^[^\p{L}\p{N}:=]*[\p{L}\p{N}_]+(?:[^\p{L}\p{N}:=]+[\p{L}\p{N}_]+)?[^\p{L}\p{N}:=]*[:=]"
STEP = 2  # bytes a level


def folded(c: Column) -> Column:
    """Letters and digits only, without case."""
    return F.regexp_replace(F.translate(F.lower(F.upper(c)), "ς", "σ"), r"[^\p{L}\p{N}]+", "")


def listing_key(c: Column) -> Column:
    """A digest of the sorted folded pieces of a listing; null for any other text."""
    pieces = F.filter(F.split(c, BREAK), lambda p: p.rlike(INK))
    listing = (F.size(pieces) >= 2) & F.forall(pieces, lambda p: p.rlike(LABEL))
    key = F.sha2(F.array_join(F.array_sort(F.transform(pieces, folded)), "\u0001"), 256)
    return F.when(c.rlike(BREAK) & c.rlike("[:=]"), F.when(listing, F.substring(key, 1, 32)))


class Trie:
    """Byte strings with a terminal [first id, count, ids or None, listing keys] each; a tail is split only when another key shares its start."""

    __slots__ = ("root", "size")
    STRIDE = 4

    def __init__(self) -> None:
        self.root: dict = {}
        self.size = 0

    def terminal(self, key: bytes) -> list:
        node, at, step = self.root, 0, self.STRIDE
        while True:
            part = key[at : at + step]
            at += step
            held = node.get(part)
            if held is None:
                end = [None, 0, None, None]
                node[part] = (key[at:], end)
                self.size += 1
                return end
            if type(held) is dict:
                node = held
                continue
            tail, end = held
            if tail == key[at:]:
                return end
            node[part] = node = {tail[:step]: (tail[step:], end)}

    def __iter__(self) -> Iterator[tuple[bytes, list]]:
        work = [(b"", self.root)]
        while work:
            head, node = work.pop()
            for part, held in node.items():
                if type(held) is dict:
                    work.append((head + part, held))
                else:
                    yield head + part + held[0], held[1]


LOCAL = pa.schema([("canon", pa.binary()), ("local", pa.int64()), ("n", pa.int64()), ("ids", pa.list_(pa.int64())), ("keys", pa.list_(pa.string()))])
GLOBAL = pa.schema([("local", pa.int64()), ("first", pa.int64()), ("n", pa.int64()), ("keys", pa.list_(pa.string()))])


def _fold_split(batches, most: int):
    """Fold the records of one input split; the trie is emptied whenever it holds `most` keys or ids."""
    trie, held = Trie(), 0

    def out():
        rows = list(trie)
        return pa.RecordBatch.from_arrays(
            [pa.array([k for k, _ in rows], pa.binary()), *(pa.array([e[i] for _, e in rows], t) for i, t in ((0, pa.int64()), (1, pa.int64()))), pa.array([sorted(e[2]) for _, e in rows], LOCAL.field("ids").type), pa.array([sorted(e[3]) if e[3] else None for _, e in rows], LOCAL.field("keys").type)],
            schema=LOCAL,
        )

    for b in batches:
        for canon, key, i in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist(), strict=True):
            e = trie.terminal(canon)
            if e[2] is None:
                e[0], e[2] = i, []
            elif i < e[0]:
                e[0] = i
            e[1] += 1
            e[2].append(i)
            if key is not None:
                e[3] = (e[3] or set()) | {key}
            held += 1
        if held >= most:
            yield out()
            trie, held = Trie(), 0
    if held:
        yield out()


def _count_buckets(capacity: int, every: bool):
    """Entries ordered by bucket and bytes: tries with terminal counters give each entry its first id.

    A trie is emptied at the end of its bucket, and as soon as it holds `capacity` keys: in the order of the bytes no key
    comes again, so a bucket of any size is counted in parts that fit. The entry with the first id carries the count of
    all records, the others 0. Entries that stand alone come out only with `every`.
    """

    def run(batches):
        trie, bucket, held, last, rows = Trie(), None, [], None, []

        def settle():
            rows.extend((local, e[0], e[1] if local == e[0] else 0, keys) for local, e, keys in held if every or keys or e[1] > 1)

        def out():
            return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], GLOBAL.field(i).type) for i in range(4)], schema=GLOBAL)

        for b in batches:
            for name, canon, local, n, keys in zip(*(b.column(i).to_pylist() for i in range(5)), strict=True):
                if name != bucket or (canon != last and max(trie.size, len(held) // 4) >= capacity):
                    settle()
                    trie, bucket, held = Trie(), name, []
                    if len(rows) >= 20_000:
                        yield out()
                        rows = []
                last = canon
                e = trie.terminal(canon)
                e[0] = local if e[0] is None else min(e[0], local)
                e[1] += n
                held.append((local, e, keys))
        settle()
        if rows:
            yield out()

    return run


def _shared(a: bytes, b: bytes) -> int:
    return next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), min(len(a), len(b)))


def radix_splits(entries: DataFrame, capacity: int, most_splits: int = 10_000) -> dict[bytes, int]:
    """The buckets that hold more than `capacity` entries, by name, with the length of the names they are split into.

    Buckets are named by leading bytes. One that is too large is split two bytes beyond what all its entries share, so a
    long common template costs one round. At most `most_splits` buckets, the largest first, are split in a round: their
    names are all that reaches the driver, and a bucket left large is still counted in tries that fit. A key that is used
    up is not split: its entries are equal, one for each fold of an input split.
    """
    splits: dict[bytes, int] = {}
    left = entries.select("canon", F.lit(STEP).alias("d"))
    while True:
        named = left.select("canon", F.expr("substring(canon, 1, d)").alias("b"))
        sizes = named.groupBy("b").agg(F.count("*").alias("n"), F.min("canon").alias("low"), F.max("canon").alias("high"))
        over = sizes.where((F.col("n") > capacity) & (F.col("low") < F.col("high"))).orderBy(F.desc("n"), "b").limit(most_splits).collect()
        if not over:
            return splits
        new = {bytes(r["b"]): _shared(bytes(r["low"]), bytes(r["high"])) + STEP for r in over}
        splits |= new
        made = entries.sparkSession.createDataFrame([(bytearray(k), d) for k, d in new.items()], "b binary, d int")
        left = named.join(F.broadcast(made), "b").where(F.octet_length("canon") > F.octet_length("b")).select("canon", "d")


def bucket_name(splits: dict[bytes, int], canon: bytes) -> bytes:
    name = canon[:STEP]
    while (to := splits.get(name)) is not None:
        longer = canon[:to]
        if longer == name:
            break
        name = longer
    return name


def _bucketed(splits: dict[bytes, int]):
    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([bucket_name(splits, c) for c in b.column(0).to_pylist()], pa.binary()), *b.columns], names=["bucket", *b.schema.names])

    return run


def _classes(df: DataFrame, id_col: str, text_col: str, min_chars: int, capacity: int, split_rows: int, every: bool) -> tuple[DataFrame, DataFrame]:
    """The folded entries of all input splits, and (local, first_id, n) for those whose class has several, or for all."""
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text IS NOT NULL")
    rows = rows.select("id", folded(F.col("text")).alias("plain"), listing_key(F.col("text")).alias("key")).where(F.char_length("plain") >= min_chars)
    rows = rows.select(F.encode("plain", "utf-8").alias("canon"), "key", "id")
    local = stage(rows.mapInArrow(lambda it: _fold_split(it, split_rows), "canon binary, local long, n long, ids array<long>, keys array<string>"), "local")

    entries = local.select("canon", "local", "n", "keys")
    splits = radix_splits(entries, capacity)
    shape = "canon binary, local long, n long, keys array<string>"
    bucketed = entries.mapInArrow(_bucketed(splits), f"bucket binary, {shape}")
    bucketed = bucketed.repartition("bucket").sortWithinPartitions("bucket", "canon")
    found = stage(bucketed.mapInArrow(_count_buckets(capacity, every), "local long, first long, n long, keys array<string>"), "found")

    listed = found.select(F.explode("keys").alias("key"), "first").distinct()
    heads = listed.groupBy("key").agg(F.min("first").alias("head"), F.max("first").alias("last")).where("head < last")
    roots = components(listed.join(heads, "key").select("first", "head"), "first", "head")
    return local, found.join(roots.withColumnRenamed("node", "first"), "first", "left").select("local", F.coalesce("root", "first").alias("first_id"), "n")


def copies(df: DataFrame, id_col: str, text_col: str, min_chars: int = 25, capacity: int = 20_000, split_rows: int = 200_000) -> DataFrame:
    """(first_id, id) for every copy but the first of its group, which has the smallest id.

    Two records are copies if their texts have the same letters and digits in the same order, or if both are listings
    of the same labelled pieces in any order; chains of copies are one group. Null ids, null texts and texts with fewer
    than `min_chars` letters and digits have no copies. A repeated row counts once. Other columns are ignored, whatever
    their names; an empty table gives an empty table.
    """
    local, classes = _classes(df, id_col, text_col, min_chars, capacity, split_rows, False)
    members = local.select("local", F.explode("ids").alias("id")).join(classes.select("local", "first_id"), "local").select("first_id", "id")
    return members.where("id <> first_id").distinct()


def messages(df: DataFrame, id_col: str, text_col: str, min_chars: int = 1, capacity: int = 20_000, split_rows: int = 200_000) -> DataFrame:
    """One row for each message: (first_id, copies), copies being all its records, the first included, 1 without any other.

    The numbers are the sums of the terminal counters: no id is listed. Records without letters and digits are no
    messages, nor are null ids and texts; a repeated row is a further record; an empty table has no messages.
    """
    classes = _classes(df, id_col, text_col, min_chars, capacity, split_rows, True)[1]
    return classes.groupBy("first_id").agg(F.sum("n").alias("copies"))
