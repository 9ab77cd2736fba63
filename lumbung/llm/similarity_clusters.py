"""Clusters of mutually similar records and their most typical members.

Density clustering with a neighbourhood given by the Jaccard similarity of word sets: a record with enough neighbours
is a core point, and chains of core points are one cluster. A record's vector of words is reduced to the coordinates of
its rarest words; the space of these is cut into regions, and a record lies in every region that its reduced vector
touches, so that regions overlap by the margin that each pair of neighbours needs to meet in one at least. Crowded
regions are cut again by a further word. Regions are clustered on their own, hashed bit vectors ruling out most pairs
before the exact similarity, and local clusters are merged through the core points that they share. The
representatives of a cluster are its medoids, the members with the greatest mean similarity to all members.
"""

from __future__ import annotations

import zlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from lumbung.operators.components import components
from lumbung.operators.skew import join_hot
from lumbung.session import stage

GAP = "\u0001"
BITS = 256
WORDS_AT_ONCE = 2_000_000  # words of pairs that a task compares at once


def word_set(text: Column) -> Column:
    """The distinct words of a text, runs of letters and digits without case."""
    return F.array_sort(F.array_distinct(F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda w: w != "")))


def keyword_set(text: Column) -> Column:
    """The distinct entries of a list joined by commas, trimmed and without case; null for null, blank and `nan` lists."""
    low = F.lower(F.trim(text))
    parts = F.array_sort(F.array_distinct(F.filter(F.transform(F.split(low, ","), lambda w: F.trim(w)), lambda w: w != "")))
    return F.when((low != "") & (low != "nan"), parts)


def _merge(roots: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union of the sets of a[i] and b[i]; a root is the smallest index of its set."""
    while True:
        ra, rb = roots[a], roots[b]
        apart = ra != rb
        if not apart.any():
            return roots
        a, b = a[apart], b[apart]
        np.minimum.at(roots, np.maximum(ra, rb)[apart], np.minimum(ra, rb)[apart])
        while True:
            up = roots[roots]
            if (up == roots).all():
                break
            roots = up


def local_clusters(first: np.ndarray, codes: np.ndarray, start: np.ndarray, like: Fraction, keep: np.ndarray | None = None, pairs_at_once: int = 1_000_000, every: list | None = None) -> np.ndarray:
    """Root index of each record of a region. codes[start[i]:start[i + 1]] are its words, rarest first where `keep` is given.

    `keep` marks the words that span this region; without it the region is a whole space and words are ordered here.
    Pairs that are linked already are not compared, unless all pairs of neighbours are asked for, into `every`.
    """
    m, num, den = len(first), like.numerator, like.denominator
    size = np.diff(start)
    owner = np.repeat(np.arange(m), size)
    if keep is None:
        df = np.bincount(codes)
        codes = codes[np.lexsort((codes, df[codes], owner))]
    bit = (codes.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(56)
    bits = np.zeros((m, BITS // 64), np.uint64)
    np.bitwise_or.at(bits, (owner, (bit >> np.uint64(6)).astype(np.int64)), np.uint64(1) << (bit & np.uint64(63)))
    ordered = np.sort(owner * (np.int64(codes.max(initial=0)) + 1) + codes) % (np.int64(codes.max(initial=0)) + 1)

    span = size - (num * size + den - 1) // den + 1
    at = np.arange(len(codes)) - start[:-1][owner]
    use = at < span[owner]
    if keep is not None:
        use &= keep[codes]
    cell, rec = codes[use], owner[use]
    order = np.lexsort((rec, cell))
    cell, rec = cell[order], rec[order]
    edge = np.flatnonzero(np.r_[True, cell[1:] != cell[:-1]]) if len(cell) else np.zeros(0, np.int64)
    count = np.diff(np.r_[edge, len(cell)])
    late = np.repeat(edge + count, count) - np.arange(len(cell)) - 1  # partners after each entry in its cell
    by = np.argsort(np.repeat(count, count), kind="stable")  # small cells first
    by = by[late[by] > 0]
    roots, done = np.arange(m), 0
    ends = np.cumsum(late[by])
    while done < len(by):
        base = ends[done - 1] if done else 0
        to = max(done + 1, int(np.searchsorted(ends, base + pairs_at_once, "right")))
        entry, n = by[done:to], late[by[done:to]]
        done = to
        i = np.repeat(entry, n)
        j = i + 1 + np.arange(len(i)) - np.repeat(np.cumsum(n) - n, n)
        a, b = rec[i], rec[j]
        both = size[a] + size[b]
        ok = ((roots[a] != roots[b]) | (every is not None)) & (num * np.maximum(size[a], size[b]) <= den * np.minimum(size[a], size[b]))
        a, b, both = a[ok], b[ok], both[ok]
        need = (num * both + den + num - 1) // (den + num)
        ok = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1) <= both - 2 * need
        pairs = np.unique(a[ok] * np.int64(m) + b[ok])
        a, b = pairs // m, pairs % m
        words = np.cumsum(size[a] + size[b])
        cuts = np.unique(np.r_[0, np.searchsorted(words, np.arange(WORDS_AT_ONCE, words[-1] if len(a) else 0, WORDS_AT_ONCE)), len(a)])
        for s, e in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
            x, y = a[s:e], b[s:e]
            shared = _overlap(ordered, start, x, y)
            yes = shared * (den + num) >= num * (size[x] + size[y])
            if every is not None:
                every.append((first[x[yes]], first[y[yes]]))
            roots = _merge(roots, x[yes], y[yes])
    return roots


def _overlap(ordered: np.ndarray, start: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Number of codes that the records a[i] and b[i] share."""
    n = np.r_[np.diff(start)[a], np.diff(start)[b]]
    at = np.repeat(np.r_[start[a], start[b]] - (np.cumsum(n) - n), n) + np.arange(n.sum())
    pair = np.repeat(np.r_[np.arange(len(a)), np.arange(len(b))], n)
    key = np.sort(pair * (np.int64(ordered.max(initial=0)) + 1) + ordered[at])
    twice = key[1:][key[1:] == key[:-1]] // (np.int64(ordered.max(initial=0)) + 1)
    return np.bincount(twice, minlength=len(a))


OFTEN = 50_000  # frequent words whose order is known to all tasks; any one order of words is right


def _placed(like: Fraction, often: dict[str, int]):
    """Each set once for every region that one of its rarest words falls into, its words in the common order."""

    def run(batches):
        for b in batches:
            spaces, sets, firsts, counts = (c.to_pylist() for c in b.columns)
            rows = []
            for space, text, first, regions in zip(spaces, sets, firsts, counts, strict=True):
                ranked = sorted(text.split(GAP), key=lambda w: (often.get(w, 0), w))
                reach = len(ranked) - -(-len(ranked) * like.numerator // like.denominator) + 1
                words = GAP.join(ranked)
                rows += ((space, words, first, regions, r) for r in sorted({zlib.crc32(w.encode()) % regions for w in ranked[:reach]}))
            if rows:
                kinds = (b.schema.field(0).type, pa.string(), pa.int64(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["space", "words", "first", "regions", "region"])

    return run


def _deeper(like: Fraction):
    """Each set of a crowded region once for every part that a further one of its rarest words falls into.

    Neighbours share two words among their rarest, one more of them taken, unless one word is all that they need to
    share: sets so short meet in a part of their own.
    """

    def run(batches):
        for b in batches:
            cols = [c.to_pylist() for c in b.columns]
            rows = []
            for row in zip(*cols, strict=True):
                words, regions, region, parts = row[1].split(GAP), row[3], row[4], row[5]
                reach = len(words) - -(-len(words) * like.numerator // like.denominator) + 2
                near = words[:reach]
                here = [w for w in near if zlib.crc32(w.encode()) % regions == region]
                more = {zlib.adler32(w.encode()) % parts for w in near if len(here) > 1 or w not in here}
                if len(words) * like.numerator <= like.denominator:
                    more.add(-1)
                rows += ((*row[:5], part) for part in sorted(more))
            if rows:
                kinds = (b.schema.field(0).type, pa.string(), pa.int64(), pa.int32(), pa.int32(), pa.int32())
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["space", "words", "first", "regions", "region", "part"])

    return run


LINKS = pa.schema([("first", pa.int64()), ("root", pa.int64())])


def _region(like: Fraction, every: bool):
    """(first, root) for each set that has a smaller neighbour in the region, or, with `every`, all pairs of neighbours."""

    def run(t: pa.Table) -> pa.Table:
        t = t.sort_by("first").combine_chunks()
        regions, region = t["regions"][0].as_py(), t["region"][0].as_py()
        lists = pc.split_pattern(t["words"], GAP).combine_chunks()
        lists = lists.chunk(0) if isinstance(lists, pa.ChunkedArray) else lists
        words = lists.flatten().dictionary_encode()
        start = lists.offsets.to_numpy().astype(np.int64)
        start = start - start[0]
        keep = None
        if regions > 1:
            keep = np.array([zlib.crc32(w.encode()) % regions == region for w in words.dictionary.to_pylist()])
        first = t["first"].to_numpy()
        pairs = [] if every else None
        roots = local_clusters(first, words.indices.to_numpy().astype(np.int64), start, like, keep, every=pairs)
        if every:
            a, b = (np.concatenate([np.zeros(0, np.int64), *x]) for x in (zip(*pairs, strict=True) if pairs else ((), ())))
            return pa.table([np.maximum(a, b), np.minimum(a, b)], schema=LINKS)
        moved = roots != np.arange(len(first))
        return pa.table([first[moved], first[roots[moved]]], schema=LINKS)

    return run


def _links(sets: DataFrame, share: Fraction, capacity: int, every: bool) -> DataFrame:
    """Links of neighbouring sets: (first, root) with the root of all that hang together, or all pairs with `every`."""
    large = sets.groupBy("space").agg(F.count("*").alias("sets")).where(F.col("sets") > capacity)
    large = stage(large.withColumn("regions", F.ceil(F.col("sets") / (capacity / 4)).cast("int")).drop("sets"), "large")
    run, shape = _region(share, every), "first long, root long"
    known = sets.join(large.select("space", "regions"), "space", "left").withColumn("regions", F.coalesce("regions", F.lit(1)))
    links = known.where("regions = 1").select("space", "words", "first", "regions", F.lit(0).alias("region")).groupBy("space").applyInArrow(run, shape)
    if large.isEmpty():
        return links
    split = known.where("regions > 1").select("space", "words", "first", "regions")
    words = split.select(F.explode(F.split("words", GAP)).alias("w")).groupBy("w").agg(F.count("*").alias("df"))
    often = {r["w"]: r["df"] for r in words.orderBy(F.desc("df"), "w").limit(OFTEN).collect()}
    kind = f"space {dict(sets.dtypes)['space']}, words string, first long, regions int, region int"
    split = stage(split.mapInArrow(_placed(share, often), kind), "placed")
    by = ["space", "region"]
    crowd = split.groupBy(*by).agg(F.ceil(F.count("*") / (capacity / 4)).cast("int").alias("parts")).where("parts > 8")
    local = split.join(crowd, by, "left_anti").groupBy(*by).applyInArrow(run, shape)
    if not crowd.isEmpty():
        again = split.join(crowd, by).select("space", "words", "first", "regions", "region", "parts").mapInArrow(_deeper(share), kind + ", part int")
        again = stage(again, "again")
        # A part that one word still crowds is cut into tiles by a hash, any two of which meet.
        tiles = again.groupBy(*by, "part").agg(F.ceil(F.count("*") / capacity).cast("int").alias("tiles"))
        again = again.join(tiles, [*by, "part"]).withColumn("tile", F.pmod(F.xxhash64("first"), "tiles").cast("int"))
        again = again.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1)))
        again = again.withColumns({"i": F.least("tile", "other"), "j": F.greatest("tile", "other")}).drop("tile", "other", "tiles")
        local = local.unionByName(again.groupBy(*by, "part", "i", "j").applyInArrow(run, shape))
    if not every:
        local = components(local, "first", "root").select(F.col("node").alias("first"), "root")
    return links.unionByName(local)


def clusters(records: DataFrame, like: str, least: int = 1, capacity: int = 20_000, min_points: int = 2) -> DataFrame:
    """(space, first, key) for every member of a cluster, its first member, which has the smallest key, included.

    `records` has space, key and words (an array of distinct words). Two records of a space are neighbours if they
    share at least `like` (a decimal) of all distinct words of the two; those with fewer than `least` words, with null
    words or a null key or space have no neighbours. A record with `min_points` neighbours, itself counted, is a core
    point; core points that are neighbours are in one cluster, and so is any neighbour of theirs, in the one with the
    smallest first core point. With 2 points a cluster is a chain of neighbours. A repeated row counts once.

    Spaces of more than `capacity` distinct word sets are cut into regions of about a quarter as many; regions with
    over twice as many into parts by a further word. Equal sets are folded before anything else, whatever their number.
    """
    share = Fraction(like)
    recs = records.where("space IS NOT NULL AND key IS NOT NULL").where(F.size("words") >= max(1, least))
    recs = recs.select("space", "key", F.array_join("words", GAP).alias("words"))
    sets = stage(recs.groupBy("space", "words").agg(F.min("key").alias("first"), F.count("key").alias("n")), "sets")
    if min_points > 2:
        return _dense(recs, sets, share, capacity, min_points)
    links = stage(_links(sets, share, capacity, False), "links")
    # A set is in a cluster if another set is linked to it, or if it has several records.
    classes = sets.join(links, "first", "left").select("space", "words", "n", "first", F.coalesce("root", "first").alias("root"))
    chosen = classes.where("n > 1 OR root <> first").drop("first")
    members = join_hot(recs, chosen, ["space", "words"], "n").select("space", F.col("root").alias("first"), "key")
    heads = links.select(F.col("root").alias("first")).distinct().join(sets.where("n = 1").select("first", "space"), "first").select("space", "first", F.col("first").alias("key"))
    return members.unionByName(heads).distinct()


def _dense(recs: DataFrame, sets: DataFrame, share: Fraction, capacity: int, min_points: int) -> DataFrame:
    pairs = stage(_links(sets, share, capacity, True).distinct(), "pairs")
    both = pairs.select(F.col("first").alias("a"), F.col("root").alias("b")).unionByName(pairs.select(F.col("root").alias("a"), F.col("first").alias("b")))
    near = both.join(sets.select(F.col("first").alias("b"), "n"), "b").groupBy("a").agg(F.sum("n").alias("near"))
    core = stage(sets.join(near, sets["first"] == near["a"], "left").where(F.col("n") + F.coalesce("near", F.lit(0)) >= min_points).select("first"), "core")
    inner = both.join(core.withColumnRenamed("first", "a"), "a")
    roots = components(inner.join(core.withColumnRenamed("first", "b"), "b").where("a > b"), "a", "b")
    rooted = core.join(roots.withColumnRenamed("node", "first"), "first", "left").select("first", F.coalesce("root", "first").alias("root"))
    border = inner.join(core.withColumnRenamed("first", "b"), "b", "left_anti").join(rooted.withColumnRenamed("first", "a"), "a").groupBy(F.col("b").alias("first")).agg(F.min("root").alias("root"))
    chosen = sets.join(rooted.unionByName(border), "first").select("space", "words", "n", "root")
    members = stage(join_hot(recs, chosen, ["space", "words"], "n").select("space", "root", "key").distinct(), "members")
    return members.join(members.groupBy("root").agg(F.min("key").alias("first")), "root").select("space", "first", "key")


def describe(members: DataFrame, records: DataFrame, top: int = 3) -> DataFrame:
    """(space, first, members, rank, key, typical): size of each cluster and its `top` medoids.

    A member is typical by its mean cosine similarity to all members, itself included. That is the product of its own
    unit vector with the mean of theirs, so it is exact and linear in the data. Ties go to the smaller key. Word sums
    are combined before the shuffle and the best members are picked per task first, so a huge cluster stays spread.
    """
    members = stage(members, "members")
    rows = stage(records.select("space", "key", "words").join(members, ["space", "key"]).select("space", "first", "key", "words").dropDuplicates(["space", "key"]), "rows")
    words = rows.select("space", "first", "key", F.size("words").alias("n"), F.explode("words").alias("w"))
    common = stage(words.groupBy("space", "first", "w").agg(F.sum(1 / F.sqrt("n")).alias("c"), F.count("*").alias("weight")), "common")
    weighed = join_hot(words, common, ["space", "first", "w"], "weight")
    typical = weighed.groupBy("space", "first", "key").agg((F.sum("c") / F.sqrt(F.first("n"))).alias("dot"))
    size = members.groupBy("space", "first").agg(F.count("*").alias("members"))
    w = Window.partitionBy("space", "first").orderBy(F.desc("typical"), "key")
    scored = typical.join(size, ["space", "first"]).select("space", "first", "members", "key", F.round(F.col("dot") / F.col("members"), 6).alias("typical"))
    return scored.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select("space", "first", "members", "rank", "key", "typical")
