"""Model-backed columns: an embedder and a language detector behind small protocols, run over Arrow batches."""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf

from lumbung.operators.skew import join_text
from lumbung.session import stage

Embedder = Callable[[list[str]], np.ndarray]
Detector = Callable[[list[str]], tuple[list[str], list[float]]]


def hashed_ngrams(dim: int = 384, low: int = 3, high: int = 5) -> Embedder:
    """The default embedder: counts of character n-grams hashed to signed places, scaled to length 1. It has no state."""

    def embed(texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), dim), np.float32)
        for at in range(0, len(texts), 256):
            coded = [f" {t} ".encode() for t in texts[at : at + 256]]
            flat = np.frombuffer(b"".join(coded), np.uint8).astype(np.uint64)
            size = np.array([len(b) for b in coded])
            owner, end = np.repeat(np.arange(len(coded)), size), np.repeat(np.cumsum(size), size)
            h = np.zeros(len(flat), np.uint64)
            for n in range(1, high + 1):  # h is the hash of the n bytes that start at each place
                live = len(flat) - n + 1
                if live < 1:
                    break
                h = (h[:live] ^ flat[n - 1 :]) * np.uint64(0x9E3779B97F4A7C15)
                h ^= h >> np.uint64(29)
                if n >= low:
                    ok = np.flatnonzero(np.arange(live) + n <= end[:live])
                    place = (h[ok] % np.uint64(dim)).astype(np.int64) + owner[ok] * dim
                    sign = np.where(h[ok] >> np.uint64(63), 1.0, -1.0)
                    out[at : at + 256] += np.bincount(place, sign, minlength=len(coded) * dim).reshape(len(coded), dim).astype(np.float32)
        size = np.linalg.norm(out, axis=1, keepdims=True)
        return out / np.where(size > 0, size, 1)

    return embed


def embed_texts(texts: DataFrame, id_col: str, text_col: str, embedder: Embedder | None = None, prefix: str = "", known: DataFrame | None = None) -> DataFrame:
    """(id, vec): the embedding of each text, `prefix` before it; a null text is an empty one.

    With `known`, an earlier result over the same ids, only the others are embedded and both are returned: the written
    table is the cache, so a broken run goes on where it stood.
    """
    embed = embedder or hashed_ngrams()
    rows = texts.select(F.col(id_col).alias("id"), F.concat(F.lit(prefix), F.coalesce(text_col, F.lit(""))).alias("t"))
    if known is not None:
        rows = rows.join(known.select("id"), "id", "left_anti")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                v = embed(b.column(1).to_pylist()).astype(np.float32)
                flat, step = pa.array(v.ravel()), v.shape[1]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.ListArray.from_arrays(pa.array(np.arange(len(v) + 1, dtype=np.int32) * step), flat)], names=["id", "vec"])

    kind = dict(rows.dtypes)["id"]
    new = rows.mapInArrow(run, f"id {kind}, vec array<float>")
    return new if known is None else known.select("id", "vec").unionByName(new)


# Frequent words that tell languages of the region apart (a small profile of our own).
PROFILE = {
    "id": "yang dan di itu dengan untuk tidak ini dari karena sudah belum bisa kalau juga saya mau tapi oleh".split(),
    "ms": "yang dan di itu dengan untuk tak ini daripada kerana sudah belum boleh kalau juga saya nak tetapi oleh kat".split(),
    "jv": "sing lan ing kuwi karo kanggo ora iki saka amarga wis durung iso yen uga aku arep nanging dening".split(),
    "su": "anu jeung di eta sareng pikeun henteu ieu ti sabab geus acan tiasa lamun oge kuring rek tapi ku mah".split(),
    "en": "the and in that with for not this from because already can if also i want but by of is are".split(),
}


def profile_detector(profile: dict[str, list[str]] = PROFILE) -> Detector:
    """The default detector: the language with most profile words, its share of all profile hits as confidence."""
    sets = {k: set(v) for k, v in sorted(profile.items())}
    word = re.compile(r"[^\W\d_]+")

    def detect(texts: list[str]) -> tuple[list[str], list[float]]:
        codes, confs = [], []
        for t in texts:
            words = word.findall(t.lower())
            hits = {k: sum(w in s for w in words) for k, s in sets.items()}
            best = max(hits, key=lambda k: hits[k])
            total = len({i for i, w in enumerate(words) if any(w in s for s in sets.values())})
            codes.append(best if hits[best] else "und")
            confs.append(round(hits[best] / total, 3) if total else 0.0)
        return codes, confs

    return detect


def no_detector(texts: list[str]) -> tuple[list[str], list[float]]:
    """Knows no language, so a filter that asks for a confidence keeps every row."""
    return ["und"] * len(texts), [0.0] * len(texts)


def ngram_detector(samples: dict[str, list[str]], least: int = 1, high: int = 3) -> Detector:
    """A detector fitted on labelled texts: naive Bayes over character n-grams of words, `und` for texts without any known.

    The confidence is the posterior of the best language among all. The samples are a bounded list that the caller holds.
    """
    grams = lambda t: [f" {w} "[i : i + n] for w in re.findall(r"[^\W\d_]+", t.lower()) for n in range(1, high + 1) for i in range(len(w) + 3 - n)]
    counts = {k: Counter(g for t in texts for g in grams(t)) for k, texts in sorted(samples.items())}
    known = sorted({g for c in counts.values() for g, n in c.items() if n >= least})
    place = {g: i for i, g in enumerate(known)}
    table = np.array([[c[g] for g in known] for c in counts.values()], np.float64).reshape(len(counts), -1) + 0.5
    logs = np.log(table / table.sum(axis=1, keepdims=True))
    names = list(counts)

    def detect(texts: list[str]) -> tuple[list[str], list[float]]:
        codes, confs = [], []
        for t in texts:
            own = [place[g] for g in grams(t) if g in place]
            if not own or len(own) * 2 < len(grams(t)):
                codes.append("und")
                confs.append(0.0)
                continue
            score = logs[:, own].sum(axis=1) / high  # the n-grams of one place depend on each other
            p = np.exp(score - score.max())
            codes.append(names[int(p.argmax())])
            confs.append(round(float(p.max() / p.sum()), 3))
        return codes, confs

    return detect


def detector(*backends: Callable[[], Detector] | str) -> Detector:
    """The first backend that can be made, by name or as a factory; without any that can, none: every text is `und`.

    Names are `profile` and `none`. A factory that raises ImportError, OSError or ValueError, because its package or its
    model file is missing, is passed over, as is an unknown name.
    """
    for make in backends or ("profile",):
        if make == "profile":
            return profile_detector()
        if callable(make):
            try:
                return make()
            except (ImportError, OSError, ValueError):
                continue
    return no_detector


def fasttext_detector(path: str) -> Detector:
    """A detector of a fastText model file, if the package is there (ImportError) and the file too (ValueError)."""
    import fasttext

    model = fasttext.load_model(path)

    def detect(texts: list[str]) -> tuple[list[str], list[float]]:
        labels, probs = model.predict([t.replace("\n", " ") for t in texts])
        return [x[0].removeprefix("__label__") for x in labels], [float(p[0]) for p in probs]

    return detect


def detect_language(text: Column, detect: Detector | None = None) -> Column:
    """struct<lang, lang_conf> of a text; blank and null are und with 0. Line breaks count as spaces."""
    run = detect or profile_detector()

    @pandas_udf("lang string, lang_conf double")
    def column(s: pd.Series) -> pd.DataFrame:
        texts = [(t or "").replace("\n", " ") for t in s]
        codes, confs = run(texts)
        blank = [not t.strip() for t in texts]
        return pd.DataFrame({"lang": ["und" if e else c for c, e in zip(codes, blank, strict=True)], "lang_conf": [0.0 if e else float(c) for c, e in zip(confs, blank, strict=True)]})

    return column(text)


def detect_distinct(df: DataFrame, text_col: str, detect: Detector | None = None) -> DataFrame:
    """All rows with lang and lang_conf, each distinct text judged once and joined back."""
    found = df.where(F.col(text_col).isNotNull()).select(F.col(text_col).alias("_t")).distinct().withColumn("_l", detect_language(F.col("_t"), detect))
    found = stage(found.select(F.col("_t").alias("_text"), "_l"), "languages")
    out = join_text(df, text_col, found)
    return out.withColumns({"lang": F.coalesce("_l.lang", F.lit("und")), "lang_conf": F.coalesce("_l.lang_conf", F.lit(0.0))}).drop("_l")
