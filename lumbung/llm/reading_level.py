"""Reading level of documents.

The acquisition grade of a word is the level by which a given share of its occurrences over graded texts has been met,
levels weighing alike; a document's level is predicted from a quantile of the grades of its known words, calibrated on
the graded documents. Sentence and word lengths give the band by which a corpus is filtered.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LETTERS = re.compile(r"[^\W\d_]+")
TAG = re.compile(r"</?[a-zA-Z][^<>]*>|&#?\w+;")
# Abbreviations after whose dot a sentence goes on (fixed values).
SHORT = "a.n al bpk cf dk dkk dll dr drs dsb dst eg etc gg hal hlm ibid ie ir jl jln jr kab kec kel km mr mrs ms no nomor pkl prof rp rt rw sdr sr st tel telp tgl tlp ttd vs yth".split()
STILL = re.compile(r"https?://\S+|www\.\S+|(?<=\d)[.](?=\d)|(?<![^\W_])(?:" + "|".join(map(re.escape, sorted(SHORT, key=len, reverse=True))) + r")\.(?!\.)", re.I)
LINK_END = re.compile(r"[.!?…]+$")
END = re.compile(r"[.!?…]+")
LEVELS = 5
QUANTILES = (0.5, 0.6, 0.7, 0.8, 0.9)


def _calm(m: re.Match) -> str:
    s = m.group()
    tail = LINK_END.search(s) if len(s) > 8 and ("/" in s) else None
    return " x " + (tail.group() if tail else "")


def measures(text: str) -> tuple[int, int, int, set[str]]:
    """Words, sentences, letters and the distinct words without case. A sentence has a word and ends at a mark or the text's end."""
    if "<" in text or "&" in text:
        text = TAG.sub(" ", text)
    words = LETTERS.findall(text)
    parts = END.split(STILL.sub(_calm, text))
    sentences = sum(1 for p in parts if LETTERS.search(p))
    return len(words), sentences, sum(map(len, words)), set(map(str.lower, words))


def band(words: int, sentences: int, letters: int) -> str:
    if not words:
        return "easy"
    if words < 10 * sentences and letters < 5.3 * words:
        return "easy"
    return "hard" if words >= 20 * sentences and letters >= 5.8 * words else "medium"


class Grades:
    """Acquisition grades of words and the calibration of a quantile of them to levels."""

    def __init__(self, grades: dict[str, float], quantile: float, slope: float, offset: float, mean: float) -> None:
        self.grades, self.quantile, self.slope, self.offset, self.mean = grades, quantile, slope, offset, mean

    def known(self, words: set[str]) -> np.ndarray:
        get = self.grades.get
        return np.sort(np.array([g for g in map(get, words) if g is not None]))

    def level(self, words: set[str]) -> tuple[float, float]:
        """Predicted level, 1 easiest to 5 hardest, and the share of words with a grade; the mean level without any."""
        g = self.known(words)
        if not len(g):
            return round(self.mean, 3), 0.0
        q = g[min(len(g) - 1, int(self.quantile * len(g)))]
        return round(float(np.clip(self.offset + self.slope * q, 1, LEVELS)), 3), round(len(g) / len(words), 4)


def fit(docs: DataFrame, id_col: str, text_col: str, labels: DataFrame, label_id: str, level_col: str, most_docs: int = 5_000, most_words: int = 100_000, least_docs: int = 3, share: float = 0.5) -> Grades:
    """Word grades and their calibration from judged documents.

    The fit is bounded: at most `most_docs` judged documents, in the order of a hash of the id, and the `most_words`
    words of most of them that at least `least_docs` have. A document's level is the median of its judgements; null
    judgements are none. Without any judgement every word is unknown and every level 3.
    """
    judged = labels.where(F.col(level_col).between(1, LEVELS)).groupBy(F.col(label_id).cast("long").alias("id")).agg(F.percentile(level_col, 0.5).alias("level"))
    chosen = judged.orderBy(F.xxhash64("id"), "id").limit(most_docs)
    texts = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text <> ''").join(F.broadcast(chosen), "id")
    rows = texts.select("id", "text", "level").toArrow()
    seen: dict[str, list[float]] = {}
    levels, sets = [], []
    for text, level in zip(rows["text"].to_pylist(), rows["level"].to_pylist(), strict=True):
        own = measures(text)[3]
        levels.append(level)
        sets.append(own)
    per = np.bincount(np.rint(levels).astype(int), minlength=LEVELS + 1)[1:] if levels else np.zeros(LEVELS)
    for own, level in zip(sets, levels, strict=True):
        at = round(level) - 1
        for w in own:
            seen.setdefault(w, [0] * LEVELS)[at] += 1
    often = sorted((w for w, c in seen.items() if sum(c) >= least_docs), key=lambda w: (-sum(seen[w]), w))[:most_words]
    grades = {}
    for w in often:
        rate = np.array(seen[w]) / np.maximum(per, 1)
        cum = np.cumsum(rate) / rate.sum()
        at = int(np.searchsorted(cum, share))
        before = cum[at - 1] if at else 0.0
        grades[w] = float(at + 0.5 + (share - before) / (cum[at] - before))
    if not levels:
        return Grades({}, 0.5, 1.0, 0.0, 3.0)
    y, best, plain = np.array(levels), None, Grades(grades, 0.5, 1.0, 0.0, float(np.mean(levels)))
    known = [plain.known(s) for s in sets]
    for q in QUANTILES:
        x = np.array([g[min(len(g) - 1, int(q * len(g)))] if len(g) else np.nan for g in known])
        ok = ~np.isnan(x)
        if ok.sum() < 2 or np.ptp(x[ok]) == 0:
            continue
        slope, offset = np.polyfit(x[ok], y[ok], 1)
        error = float(np.mean((offset + slope * x[ok] - y[ok]) ** 2))
        if best is None or error < best[0]:
            best = (error, Grades(grades, q, float(slope), float(offset), plain.mean))
    return best[1] if best else plain


def _score(model: Grades):
    def run(batches):
        for b in batches:
            rows = []
            for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
                n, sentences, letters, words = measures(text)
                rows.append((i, n, sentences, letters, *model.level(words), band(n, sentences, letters)))
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.float64(), pa.string())
            yield pa.RecordBatch.from_arrays([pa.array([r[c] for r in rows], k) for c, k in enumerate(kinds)], names=["id", "words", "sentences", "letters", "level", "known", "band"])

    return run


def reading_levels(docs: DataFrame, id_col: str, text_col: str, model: Grades) -> DataFrame:
    """(id, words, sentences, letters, level, known, band) for every document with text.

    Null and blank texts are left out; a text without words is easy and has the mean level. Words are runs of letters,
    sentences end at a row of `.`, `!`, `?` or `…` but not within numbers and links or after abbreviations; markup is
    ignored. band: easy with under 10 words a sentence and 5.3 letters a word, hard from 20 and 5.8, else medium. A
    repeated row is scored as often as it stands.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where(F.col("text").rlike(r"[^\s\p{Z}\p{Cc}\p{Cf}]"))
    return rows.mapInArrow(_score(model), "id long, words long, sentences long, letters long, level double, known double, band string")
