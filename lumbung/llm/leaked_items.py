"""Evaluation items that leaked into a corpus.

The items are turned into a table of BM25 weights by Spark; shards of it of a bounded size become inverted indexes whose
postings lie in blocks of items of like thresholds with the greatest weight of each. Every passage of every document is a query. An item's threshold
is the least score of any passage that holds a run of its words of the asked length, so nothing that holds one is lost:
terms whose greatest weights together stay below it open no list, a block of items for which the greatest weights of
all terms stay below it is skipped, and a score is given up as soon as the terms left cannot lift it. What reaches the
threshold is verified word by word, apart for the question and the answer of an item that has both.
"""

from __future__ import annotations

import re
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.session import stage

TAG = re.compile(r"</?[a-zA-Z][^<>]*>")
WORD = re.compile(r"[^\W_]+")
ASKED = re.compile(r"[?？](?=.*[^\W_])", re.S)
K1, B = 1.2, 0.75
EDGE = 1 - 1e-5
SPANS = (512, 64, 16, 4, 1)  # neighbouring entries whose postings of a term are a block, from the coarsest level to single entries
CELLS = 16_000_000  # greatest weights that are held as a plain table
AT_ONCE = 500_000  # pairs of a passage and a span that are looked up at once
PASSAGES = 4096  # passages that are looked up at once


def words_of(text: str) -> list[str]:
    return WORD.findall(TAG.sub(" ", text).casefold() if "<" in text else text.casefold())


def code(word: str) -> int:
    return int.from_bytes(blake2b(word.encode(), digest_size=8).digest(), "little", signed=True)


def _ranges(start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All numbers from start[i] to stop[i], and the i of each."""
    n = stop - start
    owner = np.repeat(np.arange(len(n)), n)
    return np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n) + start[owner], owner


class Index:
    """Inverted index of a shard: for each term the greatest weight in each span of entries, down to single entries.

    items, words, asked: of each entry its item, its words as codes and how many of them are the question (0: none).
    owner, term, weight: the postings, weights relative to the entry's threshold.
    """

    def __init__(self, run: int, items: np.ndarray, words: list[np.ndarray], asked: np.ndarray, owner: np.ndarray, term: np.ndarray, weight: np.ndarray) -> None:
        self.run, self.width, self.items, self.asked = run, run + run // 2, items, asked
        order = np.lexsort((owner, term))
        owner, term, weight = owner[order].astype(np.int64), term[order], weight[order].astype(np.float32)
        self.terms, which = np.unique(term, return_inverse=True)
        self.levels = []  # of each span size: number of spans, keys of the blocks by term and span, their greatest weights
        for span in SPANS:
            n = -(-max(1, len(items)) // span)
            keys, first = np.unique(which * np.int64(n) + owner // span, return_index=True)
            self.levels.append((n, keys, np.maximum.reduceat(weight, first) if len(weight) else weight))
        # The finest level of blocks whose greatest weights fit a plain table of terms and spans is summed up as one.
        self.plain, self.table = None, None
        for level in range(len(SPANS) - 2, -1, -1):
            n, keys, greatest = self.levels[level]
            if n <= 512 and (len(self.terms) + 1) * n <= CELLS:
                self.plain, self.table = level, np.zeros((len(self.terms) + 1, n), np.float32)
                self.table.ravel()[keys] = greatest
                break
        last = SPANS[-2]
        n, keys, greatest = self.levels[-1]
        self.single = None  # weights by term, block of the finest level and entry in it
        if (len(self.terms) + 1) * (self.levels[-2][0] * last) <= CELLS:
            self.single = np.zeros((len(self.terms) + 1, self.levels[-2][0], last), np.float32)
            self.single[keys // n, keys % n // last, keys % n % last] = greatest
        n, keys, greatest = self.levels[0]
        self.first = np.searchsorted(keys, np.arange(len(self.terms) + 1) * np.int64(n))
        self.bound = np.r_[np.maximum.reduceat(greatest, self.first[:-1]) if len(weight) else weight, 0.0].astype(np.float64)
        self.size = np.array([len(w) for w in words], np.int64)
        self.begin = np.cumsum(self.size) - self.size
        self.words = np.searchsorted(self.terms, np.concatenate(words)).astype(np.int32) if words else np.zeros(0, np.int32)
        place, entry = _ranges(self.begin, self.begin + self.size - run + 1)
        runs = self._run_keys(self.words[place[:, None] + np.arange(run)], entry) if len(place) else np.zeros(0, np.uint64)
        order = np.argsort(runs, kind="stable")
        self.runs, self.places = runs[order], place[order].astype(np.int32)  # where each run of words stands
        self.memo: dict[str, int] = {}
        self.opened = self.skipped = 0  # blocks

    def __getstate__(self):
        return self.__dict__ | {"memo": {}}

    @staticmethod
    def _run_keys(words: np.ndarray, entry: np.ndarray) -> np.ndarray:
        key = entry.astype(np.uint64)
        for j in range(words.shape[1]):
            key = (key ^ words[:, j].astype(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
            key ^= key >> np.uint64(29)
        return key

    def numbers(self, words: list[str]) -> list[int]:
        """The place of each word among the terms, len(terms) for a word of no item."""
        out = list(map(self.memo.get, words))
        if None not in out:
            return out
        memo, none = self.memo, len(self.terms)
        new = [w for w in dict.fromkeys(words) if w not in memo]
        if len(memo) > 500_000:
            memo.clear()
            new = list(dict.fromkeys(words))
        codes = np.array([code(w) for w in new], np.int64)
        at = np.minimum(np.searchsorted(self.terms, codes), max(0, none - 1))
        memo.update(zip(new, np.where(self.terms[at] == codes, at, none).tolist() if none else [none] * len(new), strict=True))
        return [memo[w] for w in words]

    def candidates(self, passages: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(passage, entry, score) of all pairs that reach the threshold; passages are rows of term numbers."""
        none = len(self.terms)
        terms = np.sort(passages, axis=1)
        terms[:, 1:][terms[:, 1:] == terms[:, :-1]] = none
        rows = np.flatnonzero(self.bound[terms].sum(axis=1) >= EDGE)
        terms = terms[rows]
        bound = self.bound[terms]
        order = np.argsort(bound, axis=1, kind="stable")
        terms, bound = np.take_along_axis(terms, order, 1), np.take_along_axis(bound, order, 1)
        found = []
        if self.plain is not None:
            sums = self.table[terms[:, 0]]
            for j in range(1, terms.shape[1]):
                sums += self.table[terms[:, j]]
            p, at = np.nonzero(sums >= EDGE - 1e-5)
            self.opened += len(p)
            self.skipped += sums.size - len(p)
            self._parts(self.plain, terms, bound, p, at, found)
        else:
            self._by_lists(terms, bound, found)
        p, e, score = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))
        both, at = np.unique(p * np.int64(max(1, len(self.items))) + e, return_index=True)  # a passage whose terms were cut apart meets twice
        return rows[p[at]], e[at], score[at]

    def _by_lists(self, terms, bound, found: list) -> None:
        """Start from the lists of the terms without which the threshold cannot be reached."""
        p, j = np.nonzero((np.cumsum(bound, axis=1) >= EDGE) & (terms < len(self.terms)))
        t = terms[p, j]
        size = np.cumsum(self.first[t + 1] - self.first[t])
        cuts = np.searchsorted(size, np.arange(AT_ONCE, size[-1], AT_ONCE)) if len(size) else []
        n, keys, _ = self.levels[0]
        for own, of in zip(np.split(t, cuts), np.split(p, cuts), strict=True):
            block, back = _ranges(self.first[own], self.first[own + 1])
            pairs = np.unique(of[back] * np.int64(n) + keys[block] % n)
            self._descend(0, terms, bound, pairs // n, pairs % n, found)

    def _descend(self, level, terms, bound, p, at, found: list) -> None:
        """Keep the pairs of a passage and a span whose greatest weights reach the threshold, and go on with the span's parts.

        Terms are added from the greatest bound down; a pair is given up when the terms left cannot lift it any more.
        """
        n, keys, values = self.levels[level]
        none, sums, left, met = len(self.terms), np.zeros(len(p)), bound[p].sum(axis=1), len(p)
        for j in range(terms.shape[1] - 1, -1, -1):
            t = terms[p, j]
            want = t.astype(np.int64) * n + at
            place = np.minimum(np.searchsorted(keys, want), len(keys) - 1)
            sums = sums + np.where((t < none) & (keys[place] == want), values[place], 0.0)
            left = left - bound[p, j]
            alive = sums + left >= EDGE
            p, at, sums, left = p[alive], at[alive], sums[alive], left[alive]
        self.opened += len(p)
        self.skipped += met - len(p)
        if level == len(SPANS) - 1:
            found.append((p, at, sums))
        else:
            self._parts(level, terms, bound, p, at, found)

    def _parts(self, level, terms, bound, p, at, found: list) -> None:
        if level == len(SPANS) - 2 and self.single is not None:
            for s in range(0, len(p), AT_ONCE // 8):
                q, b = p[s : s + AT_ONCE // 8], at[s : s + AT_ONCE // 8]
                sums = self.single[terms[q, 0], b]
                for j in range(1, terms.shape[1]):
                    sums += self.single[terms[q, j], b]
                row, e = np.nonzero(sums >= EDGE - 1e-5)
                found.append((q[row], b[row] * SPANS[level] + e, sums[row, e].astype(np.float64)))
            return
        parts, below = SPANS[level] // SPANS[level + 1], self.levels[level + 1][0]
        for s in range(0, len(p), max(1, AT_ONCE // parts)):
            some = slice(s, s + max(1, AT_ONCE // parts))
            e = (at[some, None] * parts + np.arange(parts)).ravel()
            ok = e < below
            self._descend(level + 1, terms, bound, np.repeat(p[some], parts)[ok], e[ok], found)

    def verified(self, passages: np.ndarray, p: np.ndarray, e: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each pair of a passage and an entry the runs of words that both have: the pair's number and the place in `words`."""
        pair, place = [], []
        for i in range(self.width - self.run + 1):
            words = passages[p, i : i + self.run]
            key = self._run_keys(words, e)
            hit, of = _ranges(np.searchsorted(self.runs, key), np.searchsorted(self.runs, key, "right"))
            at = self.places[hit].astype(np.int64)
            same = (self.words[at[:, None] + np.arange(self.run)] == words[of]).all(axis=1) & (at >= self.begin[e[of]]) & (at < self.begin[e[of]] + self.size[e[of]])
            pair.append((of[same] * (self.width + 1) + i))
            place.append(at[same])
        return np.concatenate(pair), np.concatenate(place)

    def leaks(self, texts: list[str | None]) -> list[tuple]:
        """(text, item, runs, score, covered, question, answer) for each text and item that share a run of words."""
        run, width, none = self.run, self.width, len(self.terms)
        flat: list[int] = []
        owner, start = [], []
        for t, text in enumerate(texts):
            words = self.numbers(words_of(text)) if text else []
            if len(words) < run:
                continue
            base = len(flat)
            flat += words
            at = range(base, base + len(words) - run + 1, width - run + 1)
            start += at
            owner += [t] * len(at)
            flat += [none] * width
        if not start or not none:
            return []
        flat_a, start_a = np.array(flat, np.int32), np.array(start)
        inside = np.r_[0, np.cumsum(flat_a != none)]
        known = np.flatnonzero(inside[start_a + width] - inside[start_a] >= run)
        found: dict[tuple[int, int], list] = {}
        for k in range(0, len(known), PASSAGES):
            rows = known[k : k + PASSAGES]
            passages = flat_a[start_a[rows][:, None] + np.arange(width)]
            p, entry, score = self.candidates(passages)
            pair, place = self.verified(passages, p, entry)
            for q, at in zip(pair.tolist(), place.tolist(), strict=True):
                k_, i = divmod(q, width + 1)
                e = found.setdefault((owner[rows[p[k_]]], int(entry[k_])), [set(), 0.0, set()])
                e[0].add((int(rows[p[k_]]), i))
                e[1] = max(e[1], float(score[k_]))
                e[2].add(at)
        out = []
        for (t, entry), (n, s, places) in found.items():
            size, asked = int(self.size[entry]), int(self.asked[entry])
            held = np.zeros(size, bool)
            for i in places:
                held[i - self.begin[entry] : i - self.begin[entry] + run] = True
            parts = (float(held[:asked].mean()), float(held[asked:].mean())) if 0 < asked < size else (None, None)
            out.append((t, int(self.items[entry]), len(n), s, float(held.mean()), *parts))
        return out


INDEXED = "entry long, item long, asked int, words array<long>, least double, terms array<long>, weights array<float>"


def _tokenised(run: int):
    def go(batches):
        for b in batches:
            rows = []
            for item, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                words = words_of(text)
                if len(words) >= run:
                    m = ASKED.search(text)
                    rows.append((item, len(words_of(text[: m.end()])) if m else 0, [code(w) for w in words]))
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate((pa.int64(), pa.int32(), pa.list_(pa.int64())))], names=["item", "asked", "words"])

    return go


def _relative(run: int):
    """Weights divided by the entry's threshold, the least sum of distinct terms' weights in any run of its words."""

    def go(batches):
        for b in batches:
            words, pairs = b.column("words").to_pylist(), b.column("pairs").to_pylist()
            terms, weights, leasts = [], [], []
            for ws, ps in zip(words, pairs, strict=True):
                of = {p["w"]: p["weight"] for p in ps}
                least = min(sum(of[w] for w in set(ws[i : i + run])) for i in range(len(ws) - run + 1))
                leasts.append(least)
                terms.append(list(of))
                weights.append([x / least for x in of.values()])
            yield pa.RecordBatch.from_arrays([*(b.column(c) for c in ("entry", "item", "asked", "words")), pa.array(leasts, pa.float64()), pa.array(terms, pa.list_(pa.int64())), pa.array(weights, pa.list_(pa.float32()))], names=["entry", "item", "asked", "words", "least", "terms", "weights"])

    return go


def weighed(items: DataFrame, item_col: str, item_text_col: str, run: int) -> DataFrame:
    """The items of at least `run` words with the BM25 weight of each of their terms, as a written table."""
    rows = items.select(F.col(item_col).cast("long").alias("item"), F.col(item_text_col).alias("text")).where("item IS NOT NULL AND text <> ''")
    rows = rows.mapInArrow(_tokenised(run), "item long, asked int, words array<long>").distinct().withColumn("entry", F.monotonically_increasing_id())
    known = stage(rows, "items")
    of = known.agg(F.count("*").alias("n"), F.avg(F.size("words")).alias("mean"))
    df = known.select(F.explode(F.array_distinct("words")).alias("w")).groupBy("w").agg(F.count("*").alias("df"))
    tf = known.select("entry", F.size("words").alias("length"), F.explode("words").alias("w")).groupBy("entry", "length", "w").agg(F.count("*").alias("tf"))
    idf = F.log(1 + (F.col("n") - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weight = idf * F.col("tf") * (K1 + 1) / (F.col("tf") + K1 * (1 - B + B * F.col("length") / F.col("mean")))
    pairs = tf.join(df, "w").crossJoin(F.broadcast(of)).groupBy("entry").agg(F.collect_list(F.struct("w", weight.alias("weight"))).alias("pairs"))
    return stage(known.join(pairs, "entry").mapInArrow(_relative(run), INDEXED), "index")


def load(rows: pa.Table, run: int) -> Index:
    terms, words = rows["terms"].combine_chunks(), rows["words"].combine_chunks()
    size = terms.value_lengths().to_numpy(zero_copy_only=False) if len(rows) else np.zeros(0, np.int64)
    cut = np.cumsum(words.value_lengths().to_numpy(zero_copy_only=False))[:-1] if len(rows) else []
    flat = words.flatten().to_numpy(zero_copy_only=False)
    return Index(run, rows["item"].to_numpy(), np.split(flat, cut) if len(rows) else [], rows["asked"].to_numpy(), np.repeat(np.arange(len(size)), size), terms.flatten().to_numpy(zero_copy_only=False), rows["weights"].combine_chunks().flatten().to_numpy(zero_copy_only=False))


FOUND = "id long, item_id long, runs long, score double, covered double, question double, answer double"


def _query(index):
    def run(batches):
        for b in batches:
            keys = b.column(0).to_pylist()
            rows = [(keys[r[0]], *r[1:]) for r in index.value.leaks(b.column(1).to_pylist())]
            names, kinds = zip(*(x.split() for x in FOUND.split(", ")), strict=True)
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], pa.int64() if k == "long" else pa.float64()) for c, k in enumerate(kinds)], names=names)

    return run


def leaked(corpus: DataFrame, id_col: str, text_col: str, items: DataFrame, item_col: str, item_text_col: str, run: int = 8, most_postings: int = 4_000_000) -> DataFrame:
    """(id, item_id, runs, score, covered, question, answer): documents that hold at least `run` consecutive words of an item.

    runs is the number of places where such a run of `run` words starts, score the greatest BM25 score of a passage of
    the document relative to the item's threshold, covered the share of the item's words that its runs hold; question
    and answer are that share of the words up to and after the first question mark, null for items without both. Words
    are runs of letters and digits without case; markup tags are ignored. Null and short texts hold and are nothing. A
    repeated document or item counts once. The index of at most `most_postings` postings (some 60,000 items of 80
    words) is a broadcast of a checked size, for one pass over the corpus; more items are served in further passes.
    """
    index = weighed(items, item_col, item_text_col, run)
    sc = corpus.sparkSession.sparkContext
    postings = index.agg(F.sum(F.size("terms"))).first()[0] or 0
    shards = -(-postings // most_postings) or 1
    docs = corpus.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("id IS NOT NULL AND text <> ''")
    out = None
    for k in range(shards):
        rows = index.where(F.pmod(F.xxhash64("entry"), F.lit(shards)) == k).orderBy("least", "entry").toArrow()
        part = docs.mapInArrow(_query(sc.broadcast(load(rows, run))), FOUND)
        out = part if out is None else out.unionByName(part)
    most = [F.max(c).alias(c) for c in ("runs", "covered", "question", "answer")]
    return out.groupBy("id", "item_id").agg(F.max(F.round("score", 4)).alias("score"), *most)
