"""Cleaning and judging of short informal texts, as column expressions."""

from __future__ import annotations

import html
import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.functions import pandas_udf
from pyspark.sql.types import StringType

W = r"[\p{L}\p{N}_]"
S = r"[\s\x{1C}-\x{1F}\x{85}\p{Z}]"
NOT_S = r"[^\s\x{1C}-\x{1F}\x{85}\p{Z}]"

# What counts as a link, a mention, a repost mark, laughter and an emoji.
LINK = rf"https?://{NOT_S}+|www\.{NOT_S}+"
MENTION = f"@{W}+"
REPOST = f"^{S}*rt{S}*:?{S}*(?=@|{W})"
STRICT_REPOST = f"^{S}*rt(?:{S}*:{S}*|{S}+)(?=@|{W})"
TAG = f"#({W}+)"
LAUGH = rf"(?<!{W})(?:a*(?:wk|kw){{2,}}a*|(?:ha){{2,}}h?|(?:he){{2,}}h?|(?:hi){{2,}}h?|(?:xi){{2,}}x?|(?:wa){{2,}}k*|w{{3,}})(?!{W})"
EMOJI = r"[\x{1F300}-\x{1FAFF}\x{2600}-\x{27BF}\x{1F1E6}-\x{1F1FF}\x{FE0F}]"
STRETCHED = rf"({W})\1{{2,}}"
TWICE = rf"(?<!{W})([a-z]{{3,}})2(?!{W})"

#: Frequent function words of Indonesian and its informal spelling; another list can be read with load_stopwords().
STOPWORDS = (
    "ada adalah adanya agar aja akan akhirnya aku anda antara apa apakah apalagi atas atau bagaimana bagi bahkan bahwa baik banyak banget baru bagian begini begitu "
    "belum beberapa berada berikut bila bisa boleh buat bukan bukankah cuma cukup dalam dan dapat dari daripada dengan demi demikian dia di dong dulu gak ga gitu guna hal hanya "
    "harus hingga ia ialah ini itu iya jadi jangan jika juga kalau kalian kami kamu kan karena kata ke kenapa kepada ketika kini kita kok lagi lah lain lalu lebih "
    "maka malah mana masih masing mau maupun melalui memang mereka merupakan meski meskipun misalnya mungkin nah namun nanti nih nya oleh pada padahal para pasti pernah "
    "pula pun punya saat saja salah sama sambil sampai sana sangat saya seakan sebab sebagai sebelum sebuah sedang sehingga sejak sekali sekarang selain selalu selama "
    "semua seorang seperti sering serta sesuatu setelah setiap si siapa sih sini situ suatu sudah supaya tanpa tapi telah tentang terhadap terlalu tersebut tetap tetapi "
    "tiap tidak untuk waktu walau wkwk ya yaitu yakni yang"
).split()

# Names of language codes.
LANGUAGE_NAMES = {
    "id": "Indonesian", "ms": "Malay", "jv": "Javanese", "su": "Sundanese", "min": "Minangkabau", "ban": "Balinese",
    "ace": "Acehnese", "en": "English", "hi": "Hindi", "es": "Spanish", "ar": "Arabic", "zh": "Chinese", "ja": "Japanese",
    "ko": "Korean", "th": "Thai", "vi": "Vietnamese", "tl": "Tagalog", "ceb": "Cebuano", "fr": "French", "de": "German",
    "pt": "Portuguese", "ru": "Russian", "nl": "Dutch", "it": "Italian", "tr": "Turkish", "fa": "Persian", "ur": "Urdu",
    "bn": "Bengali", "ta": "Tamil", "te": "Telugu", "mr": "Marathi", "pa": "Punjabi", "gu": "Gujarati", "kn": "Kannada",
    "ml": "Malayalam", "pl": "Polish", "uk": "Ukrainian", "ro": "Romanian", "el": "Greek", "he": "Hebrew", "sw": "Swahili",
    "und": "Undetermined",
}


@pandas_udf(StringType())
def _entities_and_forms(s: pd.Series) -> pd.Series:
    return s.map(lambda t: unicodedata.normalize("NFKC", html.unescape(t)), na_action="ignore")


def plain_forms(c: Column) -> Column:
    """Entities decoded and compatibility forms composed; only texts with `&` or beyond ASCII go through Python."""
    special = c.rlike(r"&|[^\x00-\x7F]")
    return F.when(special, _entities_and_forms(F.when(special, c))).otherwise(c)


def squeeze(c: Column) -> Column:
    return F.trim(F.regexp_replace(c, S + "+", " "))


def strip_links(c: Column) -> Column:
    """The part of cleaning that needs no Python: case, links, mentions, tags, punctuation and spaces."""
    t = F.lower(F.coalesce(c, F.lit("")))
    for pattern, new in ((LINK, " "), (MENTION, " "), (TAG, "$1"), (rf"[^\p{{L}}\p{{N}}_\s\x{{1C}}-\x{{1F}}\x{{85}}\p{{Z}}]", " ")):
        t = F.regexp_replace(t, pattern, new)
    return squeeze(t)


def clean_text(c: Column, lexicon: dict[str, str] | Column | None = None, keep_emoji: bool = False, strict_repost: bool = False) -> Column:
    """A text ready for embedding; null becomes an empty string.

    Digits that repeat three times are shortened like letters (`1000` to `10`), and a repost mark is taken from the
    start of a word (`rtx` to `x`) unless `strict_repost`. With `keep_emoji` emoji stay as tokens.
    """
    t = F.lower(plain_forms(F.coalesce(c, F.lit(""))))
    t = F.regexp_replace(t, STRICT_REPOST if strict_repost else REPOST, "")
    for pattern, new in ((LINK, " "), (MENTION, " "), (TAG, "$1")):
        t = F.regexp_replace(t, pattern, new)
    t = F.regexp_replace(t, EMOJI + "+", " $0 " if keep_emoji else " ")
    t = F.regexp_replace(t, LAUGH, " wkwk ")
    t = F.regexp_replace(t, STRETCHED, "$1")
    kept = EMOJI[1:-1] if keep_emoji else ""
    t = F.regexp_replace(t, rf"[^\p{{L}}\p{{N}}_\s\x{{1C}}-\x{{1F}}\x{{85}}\p{{Z}}{kept}]", " ")
    t = squeeze(F.regexp_replace(t, TWICE, "$1 $1"))
    return t if lexicon is None else normalize_slang(t, lexicon)


MOST_LITERALS = 500


def normalize_slang(c: Column, lexicon: dict[str, str] | Column) -> Column:
    """Each token replaced once by its formal word, which may be several.

    A lexicon of more than MOST_LITERALS words is looked up in Arrow batches: a map in the plan is searched word by word.
    """
    if isinstance(lexicon, dict):
        if not lexicon:
            return c
        if len(lexicon) > MOST_LITERALS:
            return pandas_udf(lambda s: s.map(lambda t: " ".join([lexicon.get(w, w) for w in t.split(" ")]), na_action="ignore"), StringType())(c)
        lexicon = F.create_map(*(F.lit(x) for pair in sorted(lexicon.items()) for x in pair))
    return F.array_join(F.transform(F.split(c, " "), lambda w: F.coalesce(F.try_element_at(lexicon, w), w)), " ")


def slang_lexicon(df: DataFrame, line: str = "line_no", slang: str = "slang", formal: str = "formal") -> DataFrame:
    """(slang, formal), trimmed and in lower case; lines with an empty side or equal sides are out, the last of a word wins."""
    rows = df.select(line, F.lower(F.trim(slang)).alias("slang"), F.lower(F.trim(formal)).alias("formal"))
    rows = rows.where("slang <> '' AND formal <> '' AND slang <> formal")
    return rows.groupBy("slang").agg(F.max_by("formal", line).alias("formal"))


def lexicon_map(df: DataFrame, most: int = 100_000) -> dict[str, str]:
    """A lexicon of at most `most` words as a dictionary for normalize_slang()."""
    rows = slang_lexicon(df).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} words")
    return {r["slang"]: r["formal"] for r in rows}


def informative(clean: Column, stopwords: list[str] = STOPWORDS, min_content: int = 2, min_chars: int = 5) -> Column:
    """At least `min_chars` characters and `min_content` tokens that are longer than one and no stopwords."""
    content = F.filter(F.split(clean, " "), lambda w: (F.char_length(w) > 1) & ~w.isin(*stopwords))
    return F.coalesce((F.char_length(clean) >= min_chars) & (F.size(content) >= min_content), F.lit(False))


def load_stopwords(df: DataFrame, column: str = "value", most: int = 100_000) -> list[str]:
    """Distinct trimmed lines of a stopword text, as spark.read.text gives them."""
    words = [r[0] for r in df.select(F.trim(column)).distinct().where(F.length(F.trim(column)) > 0).limit(most + 1).collect()]
    if len(words) > most:
        raise ValueError(f"more than {most} words")
    return sorted(words)


def language_name(code: Column) -> Column:
    """A readable name for a code, by its part before `-`; an unknown code stays as it is, null is Undetermined."""
    names = F.create_map(*(F.lit(x) for pair in LANGUAGE_NAMES.items() for x in pair))
    code = F.when(code == "", "und").otherwise(F.coalesce(code, F.lit("und")))
    return F.coalesce(F.try_element_at(names, F.lower(F.split(code, "-")[0])), code)


def topic_label(topic: Column, keywords: Column) -> Column:
    """The first keyword of a topic, `topic_<id>` without any, and fixed labels for outliers and filtered rows."""
    first = F.split(keywords, ", ")[0]
    named = F.when(first != "", first).otherwise(F.concat(F.lit("topic_"), topic.cast("string")))
    return F.when(topic == -1, "OUTLIER_NO_TOPIC").when(topic < -1, "FILTERED_NON_INFORMATIVE").otherwise(named)


def fingerprint(df: DataFrame, text_col: str, model: str, prefixed: bool = False) -> DataFrame:
    """One row: 16 hex digits that change with the model, the prefix, the number of texts or any text, in any order."""
    part = lambda at: F.sum(F.conv(F.substring(F.md5(text_col), at, 15), 16, 10).cast("decimal(38,0)"))
    parts = df.agg(F.count(text_col).alias("n"), F.coalesce(part(1), F.lit(0)).alias("a"), F.coalesce(part(16), F.lit(0)).alias("b"))
    text = F.concat_ws("|", F.lit(model), F.lit(str(prefixed)), "n", "a", "b")
    return parts.select("n", F.substring(F.sha1(text), 1, 16).alias("fingerprint"))
