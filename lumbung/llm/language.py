"""Language of each text and of its segments by cross-parsing.

For each language a suffix automaton of running labelled text yields the longest matches into which a text falls when it
is read from left to right; every word costs the phrases it takes part in. A text is cut into segments by the cheapest
path through languages; the language that needs the fewest normalised phrases wins a segment. A segment that even it
explains worse than any labelled text is of none of the languages (`und`). The confidence is the share of labelled
passages with a like lead that were right.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

NOISE = re.compile(r"https?://\S+|www\.\S+|\S+ (?:at|[\[({]at[\])}]) \S+ (?:dot|[\[({]dot[\])}]) \S+|[\w.+-]*(?:\s?[@＠]\s?|[\[({]at[\])}])[\w.-]+|&#?\w+;|\bRT\b")
PIECE = re.compile(r"[^\W\d_]+|[\n/.!?;|–—]|\s-\s")
LAUGH = re.compile(r"(?:w+k+){2,}w?|(?:[hkx][aeiou]){2,}h?|w{3,}|lo+l")
SWITCH, AT_BREAK = 1.5, 0.9  # cost of another language after a word, and after a mark that may end a sentence
UNKNOWN = 0.2  # weight of a word that no language explains as one phrase
KNOWN = 1.3  # phrases up to which a word is explained
PIECE_CHARS = 400  # a text is parsed in pieces of about so many characters


class Automaton:
    """Suffix automaton of a text: every state's transitions, by character."""

    def __init__(self, text: str) -> None:
        self.next: list[dict[str, int]] = [{}]
        link, length, last = [-1], [0], 0
        for c in text:
            new = len(self.next)
            self.next.append({})
            length.append(length[last] + 1)
            link.append(0)
            p = last
            while p >= 0 and c not in self.next[p]:
                self.next[p][c] = new
                p = link[p]
            if p >= 0:
                q = self.next[p][c]
                if length[p] + 1 == length[q]:
                    link[new] = q
                else:
                    twin = len(self.next)
                    self.next.append(dict(self.next[q]))
                    length.append(length[p] + 1)
                    link.append(link[q])
                    while p >= 0 and self.next[p].get(c) == q:
                        self.next[p][c] = twin
                        p = link[p]
                    link[q] = link[new] = twin
            last = new

    def dense(self, letters: dict[str, int]) -> np.ndarray:
        """The transitions as a table of states and letters; -1 for none, and always for letter 0, which is any other."""
        out = np.full((len(self.next), len(letters) + 1), -1, np.int32)
        for state, to in enumerate(self.next):
            for c, new in to.items():
                out[state, letters[c]] = new
        return out

    def phrases(self, text: str) -> int:
        """Longest matches that the text falls into; a character that the automaton lacks is one by itself."""
        n, at, end, nxt = 0, 0, len(text), self.next
        while at < end:
            state, start = 0, at
            while at < end and (to := nxt[state].get(text[at])) is not None:
                state = to
                at += 1
            at += at == start
            n += 1
        return n


def phrase_lengths(table: np.ndarray, flat: np.ndarray, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
    """For each character the length of the phrase it is in, all pieces flat[start[i]:stop[i]] being read side by side."""
    begins = np.zeros(len(flat) + 1, bool)
    begins[start] = True
    at, state, live = start.copy(), np.zeros(len(start), np.int64), np.flatnonzero(start < stop)
    while len(live):
        here = at[live]
        to = table[state[live], flat[here]]
        on = to >= 0
        lone = ~on & (state[live] == 0)  # a letter that no phrase begins with
        state[live] = np.where(on, to, 0)
        here = here + (on | lone)
        at[live] = here
        begins[here[~on]] = True
        live = live[here < stop[live]]
    begins = begins[:-1]
    phrase = np.cumsum(begins) - 1
    return np.bincount(phrase)[phrase] if len(flat) else phrase


class Model:
    """Languages, each with the automaton of its running text.

    Words that stand in less than `least` of a language's words, names mostly, are cut out of its text. `parsed` is the
    number of texts of each language that the automaton is made of; all texts count for what is rare.
    """

    def __init__(self, texts: dict[str, list[str]], least: float = 4e-4, parsed: int = 400) -> None:
        self.languages = sorted(texts)
        running = []
        for lang in self.languages:
            split = [words_of(t) for t in texts[lang]]
            counts = Counter(w for ws in split for w in ws)
            need = max(2, least * counts.total())
            kept = {w for w, n in counts.items() if n >= need} or set(counts)
            rest = " ".join(sorted(kept - {w for ws in split[:parsed] for w in ws}))
            running.append(" | ".join([rest, *(" ".join(w if w in kept else "|" for w in ws) for ws in split[:parsed])]).join("  "))
        self.letters = {c: i + 1 for i, c in enumerate(sorted(set("".join(running))))}
        self.tables = [Automaton(t).dense(self.letters) for t in running]
        self.limit, self.leads, self.right = np.inf, np.zeros(0), np.zeros(0)

    def parse(self, words: list[list[str]]) -> np.ndarray:
        """The phrases that each word of each text takes part in, for each language: a phrase counts once, spread over its letters."""
        pieces, ends = [], []
        for ws in words:
            size, begun = 0, 0
            for i, w in enumerate(ws):
                size += len(w) + 1
                if size > PIECE_CHARS or i == len(ws) - 1:
                    pieces.append(" " + " ".join(ws[begun : i + 1]) + " ")
                    begun, size = i + 1, 0
        text = "".join(pieces)
        n = sum(map(len, words))
        if not n:
            return np.zeros((0, len(self.languages)))
        get = self.letters.get
        codes = {c: get(c, 0) for c in set(text)}
        flat = np.array([codes[c] for c in text], np.int32)
        size = np.array([len(p) for p in pieces])
        stop = np.cumsum(size)
        space = np.frombuffer(text.encode("utf-32-le"), np.uint32) == 32
        first = np.flatnonzero(space[:-1] & ~space[1:]) + 1
        out = np.empty((n, len(self.tables)))
        for j, table in enumerate(self.tables):
            cost = np.where(space, 0.0, 1.0 / phrase_lengths(table, flat, stop - size, stop))
            out[:, j] = np.add.reduceat(cost, first)
        return out

    def segments(self, texts: list[str | None]) -> list[tuple[int, list[tuple[int, int, int, float]]]]:
        """For each text its number of words, and its segments (first word, end, language or -1, confidence)."""
        words, cut, lengths = [], [], []
        for text in texts:
            own = []
            mark = small = 0
            for w in PIECE.findall(NOISE.sub(" ", text) if text else ""):
                if w[0].isalpha():
                    low = w.lower()
                    own.append(low)
                    cut.append(mark or (small and low != w))  # a capital after a small letter may start a sentence
                    mark, small = 0, low == w
                else:
                    mark = 1
            words.append(own)
            lengths.append(len(own))
        flat = [w for ws in words for w in ws]
        phrases = self.parse(words)
        costs = self.relative(flat, phrases)
        k = len(self.languages)
        n = np.array(lengths, np.int64)
        start = np.cumsum(n) - n
        order = np.argsort(-n, kind="stable")
        breaks = np.where(np.array(cut, bool), AT_BREAK, SWITCH)
        back = np.zeros((len(flat), k), np.int8)
        total = np.zeros((len(texts), k))
        alive = np.searchsorted(-n[order], -np.arange(n.max(initial=0)), "left")  # texts with more than `step` words
        for step, many in enumerate(alive):
            rows = order[:many]
            at = start[rows] + step
            if step:
                prev = total[rows]
                best = prev.argmin(axis=1)
                jump = prev.min(axis=1) + breaks[at]
                stay = prev <= jump[:, None]
                back[at] = np.where(stay, np.arange(k), best[:, None])
                total[rows] = np.where(stay, prev, jump[:, None]) + costs[at]
            else:
                total[rows] = costs[at]
        path = np.zeros(len(flat), np.int8)
        state = total.argmin(axis=1)
        for step in range(len(alive) - 1, -1, -1):
            rows = order[: alive[step]]
            at = start[rows] + step
            path[at] = state[rows]
            state[rows] = back[at, state[rows]]
        out = []
        sums = np.vstack([np.zeros((1, k)), costs.cumsum(axis=0)])
        parsed = np.vstack([np.zeros((1, k)), phrases.cumsum(axis=0)])
        chars = np.r_[0, np.cumsum([len(w) for w in flat])]
        for s, size in zip(start.tolist(), lengths, strict=True):
            own = path[s : s + size]
            ends = [*(np.flatnonzero(own[1:] != own[:-1]) + 1).tolist(), size] if size else []
            a, segs = 0, []
            for e in ends:
                lang = int(own[a])
                c = sums[s + e] - sums[s + a]
                rest = np.delete(c, lang).min() if k > 1 else 0.0
                rate = (parsed[s + e, lang] - parsed[s + a, lang]) / (chars[s + e] - chars[s + a])
                conf = self.confidence(max(0.0, float(rest - c[lang])), e - a)
                segs.append((a, e, -1, 0.0) if rate > self.limit else (a, e, lang, conf))
                a = e
            out.append((size, segs))
        return out

    def relative(self, words: list[str], phrases: np.ndarray) -> np.ndarray:
        """Phrases beyond the best language's, relative to the worst parse; words that none explains weigh less."""
        if not len(phrases):
            return phrases
        least, most = phrases.min(axis=1, keepdims=True), phrases.max(axis=1, keepdims=True)
        out = (phrases - least) / np.maximum(most - 0.5, 1.0) * np.where(least <= KNOWN, 1.0, UNKNOWN)
        empty: dict[str, bool] = {}
        for w in set(words):
            empty[w] = len(w) < 2 or LAUGH.fullmatch(w) is not None
        out[np.array([empty[w] for w in words])] = 0.0
        return out

    def confidence(self, lead: float, words: int) -> float:
        """The calibrated share of right passages with such a lead; without calibration the lead a word."""
        if not len(self.leads):
            return round(min(1.0, lead / words), 4)
        return round(float(np.interp(lead, self.leads, self.right)), 4)

    def calibrate(self, held: list[tuple[str, str]], bins: int = 12) -> list[tuple[float, float, int]]:
        """Fit confidence and limit on held-out labelled texts, cut into passages of 1 to 8 words: (lead, share right, passages) a bin."""
        words = [words_of(t) for _, t in held]
        phrases = self.parse(words)
        costs = self.relative([w for ws in words for w in ws], phrases)
        leads, right, rates, at = [], [], [], 0
        for (lang, _), ws in zip(held, words, strict=True):
            own = self.languages.index(lang)
            if len(ws) >= 5:
                rates.append(phrases[at : at + len(ws), own].sum() / sum(map(len, ws)))
            for size in (1, 2, 3, 5, 8):
                for i in range(0, len(ws) - size + 1, size):
                    c = costs[at + i : at + i + size].sum(axis=0)
                    order = np.argsort(c, kind="stable")
                    leads.append(c[order[1]] - c[order[0]] if len(c) > 1 else 0.0)
                    right.append(order[0] == own)
            at += len(ws)
        if len(leads) < 10 * bins:
            return []
        order = np.argsort(leads, kind="stable")
        parts = np.array_split(order, bins)
        leads, right = np.array(leads), np.array(right, float)
        self.leads = np.array([leads[p].mean() for p in parts])
        self.right = np.maximum.accumulate([(right[p].sum() + 0.5) / (len(p) + 1) for p in parts])
        self.limit = 1.15 * float(np.quantile(rates, 0.995)) if len(rates) > 20 else np.inf
        return [(float(leads[p].mean()), float(right[p].mean()), len(p)) for p in parts]


def base_code(lang: Column) -> Column:
    """A language code without region and case, `in` and `ind` as id; null for null, blank and `und`."""
    code = F.lower(F.trim(F.split(lang, "-")[0]))
    return F.when(code.isin("in", "ind"), "id").when((code != "") & (code != "und"), code)


def words_of(text: str) -> list[str]:
    return [w for w in PIECE.findall(NOISE.sub(" ", text).lower()) if w[0].isalpha() and len(w) > 1 and not LAUGH.fullmatch(w)]


def fit(samples: DataFrame, lang_col: str, text_col: str, posts: DataFrame, post_lang_col: str, post_text_col: str, most_samples: int = 20_000, most_posts: int = 1_000) -> Model:
    """A model from labelled samples, then widened by labelled posts that it agrees with.

    The fit is bounded: at most `most_samples` samples, and at most `most_posts` posts for each language of the samples,
    taken in the order of a hash of the text (1,000 is the most for which Spark cuts each task's rows before the shuffle). A post
    widens the model if its only segment has its label's language; a fifth of them is held out for the calibration.
    """
    rows = samples.select(base_code(F.col(lang_col)).alias("lang"), F.col(text_col).alias("text")).where("lang IS NOT NULL AND text IS NOT NULL")
    clean = rows.orderBy(F.xxhash64("text"), "text").limit(most_samples).collect()
    texts: dict[str, list[str]] = {}
    for lang, text in sorted(clean):
        texts.setdefault(lang, []).append(text)
    first = Model(texts)
    labelled = posts.select(base_code(F.col(post_lang_col)).alias("lang"), F.col(post_text_col).alias("text")).where("text IS NOT NULL")
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.xxhash64("text"), "text"))
    chosen = labelled.where(F.col("lang").isin(first.languages)).withColumn("place", place).where(F.col("place") <= most_posts).orderBy("lang", "place").collect()
    held = []
    for lang in first.languages:
        some = [r["text"] for r in chosen if r["lang"] == lang]
        for i, (text, (size, segs)) in enumerate(zip(some, first.segments(some), strict=True)):
            if size >= 6 and len(segs) == 1 and first.languages[segs[0][2]] == lang and segs[0][3] > 0.1:
                if i % 5:
                    texts[lang].append(text)
                else:
                    held.append((lang, text))
    model = Model(texts)
    model.calibrate(held)
    return model


SHAPE = "id long, label string, words int, segment int, first_word int, end_word int, lang string, confidence double, passages array<string>"


def _run(model: Model, passage: int):
    def run(batches):
        for b in batches:
            ids, labels = b.column(0).to_pylist(), b.column(1).to_pylist()
            rows = []
            for i, label, (size, segs) in zip(ids, labels, model.segments(b.column(2).to_pylist()), strict=True):
                if not segs:
                    rows.append((i, label, size, 0, 0, 0, "und", 0.0, []))
                long = sorted({model.languages[x] for s, e, x, _ in segs if e - s >= passage and x >= 0})
                rows += ((i, label, size, j, s, e, model.languages[x] if x >= 0 else "und", conf, long) for j, (s, e, x, conf) in enumerate(segs))
            kinds = (pa.int64(), pa.string(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.string(), pa.float64(), pa.list_(pa.string()))
            names = [x.split()[0] for x in SHAPE.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)] if rows else [pa.array([], t) for t in kinds], names=names)

    return run


def label_segments(df: DataFrame, id_col: str, text_col: str, lang_col: str, model: Model, passage: int = 5) -> DataFrame:
    """One row for each segment of each text: id, label (as normal code), words, segment, first_word, end_word, lang, confidence,
    and the languages of all the text's segments of at least `passage` words.

    Links, mentions, addresses and entities are no words; laughter and single letters carry no evidence. A null, empty or
    wordless text has one row with language `und` and confidence 0, and so has a segment in none of the languages. A repeated row is labelled as often as it stands.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), base_code(F.col(lang_col)).alias("label"), F.col(text_col).alias("text"))
    return rows.mapInArrow(_run(model, passage), SHAPE)


def mislabelled(segments: DataFrame, least_words: int = 6) -> DataFrame:
    """(id, true_lang): each language with a passage, for the texts whose label does not name exactly their one language."""
    texts = segments.where((F.col("segment") == 0) & (F.col("words") >= least_words))
    wrong = texts.where((F.size("passages") > 1) | ~F.get("passages", F.lit(0)).eqNullSafe(F.col("label")))
    return wrong.select("id", F.explode("passages").alias("true_lang")).distinct()
