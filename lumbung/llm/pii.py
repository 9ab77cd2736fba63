"""Personal information in free text: detection and keyed, type-consistent surrogates.

Every detected entity has a normal form, so that the spellings of one entity get one surrogate everywhere. A surrogate is
the normal form's image under a keyed permutation of all texts of its shape, poured into the format in which it stands:
type, script, case, separators and, for names and identity numbers, the marking of gender are kept. A permutation gives
distinct entities distinct surrogates without ever comparing them; names are replaced word by word, so that a person
who is named in full and by the given name alone stays one. clashes() checks a table of entities for it.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

W = r"[^\W_]"
DOT = r"(?:\.|\s?[\[({]\s?dot\s?[\])}]\s?)"
LABEL = rf"{W}+(?:-{W}+)*"
LOCAL = rf"{W}(?:[\w.+%-]*{W})?"
EMAIL = re.compile(
    rf"(?<![\w.+%-])(?:{LOCAL}(?:[@＠]|\s[@＠]\s|\s?[\[({{]\s?at\s?[\])}}]\s?){LABEL}(?:{DOT}{LABEL})*{DOT}[^\W\d_]{{2,}}|{LOCAL}\sat\s{LABEL}(?:\sdot\s{LABEL})*\sdot\s[^\W\d_]{{2,}})(?![\w@])",
    re.I,
)
EMAIL_HINT = re.compile(r"[@＠]|\bat\b", re.I)
ID_NUMBER = re.compile(r"(?<![\w+])(?<!\d[.\-/])(?:\d{6}([ .-]?)\d{6}\1\d{4}|\d{4}([ .-]?)\d{4}\2\d{4}\2\d{4}|\d{2}\.?\d{3}\.?\d{3}\.?\d[-.]?\d{3}\.?\d{3})(?![\w])(?![.\-/]\d)")
PHONE = re.compile(r"(?<![\w+])(?<!\d[.\-/])(?:(?:\(\+?62\)[ .-]?|\+?62[ .-]?|0)8\d{1,2}[ ./-]?\d{3,4}[ .-]?\d{3,5}|(?:\(0\d{2,3}\)[ .-]?|0\d{2,3}[ .-])\d{3,4}[ .-]?\d{3,4})(?!\w)(?![.\-/]\d)")
ABROAD = re.compile(r"(?<![\w+])\+(?!62)\d{1,3}(?:[ .-]?\(?\d{1,4}\)?){2,5}(?!\w)(?![.\-/]\d)|(?<=(?:epon|hone|Telp|telp|all:|WA :) )\+?\d{2,3}(?:[ .-]\d{3,4}){2,3}(?!\w)(?![.\-/]\d)|(?<!\w)\([2-9]\d{2}\) \d{3}-\d{4}(?!\w)")
SECURITY = re.compile(r"(?:\bSSN|social security(?: number)?|\bjaminan sosial)\D{0,5}(\d{3}-\d{2}-\d{4})(?!\w)", re.I)
STREET = re.compile(
    r"(?<![\w@#])\d{1,5}[a-z]?\s+(?:[A-Z][a-z]+\s+){1,3}(?:Street|St|Road|Rd|Avenue|Ave|Lane|Ln|Drive|Boulevard|Blvd|Court|Square)(?!\w)"
    r"|(?<![\w@#])[Jj]alan(?:\s+[A-Z][a-z]+){1,3}\s+\d+(?:[a-z](?!\w))?(?!\w)(?!\s*(?:menit|jam|km|meter|m|hari|orang|kali|kg|ribu|juta|persen|%|x)(?!\w))"
)
NUMBER = r"\d+(?:[a-z](?!\w))?"
WORDS = r"(?:\s+[^\W\d_]+){1,3}?"
NO = rf"(?:no|nomor|nomer)(?:\s*\.\s*|\s+){NUMBER}"
BLOCK = rf"blok\s+[a-z]{{1,2}}(?:\s?\d+(?:\s?/\s?{NUMBER})?|\s?-\s?{NUMBER}|\s+{NO})"
NEIGHBOURS = r"rt\.?\s?\d+(?:\s?/\s?(?:rw\.?\s?)?\d+)?"
ADDRESS = re.compile(
    rf"(?<![\w@#])(?:(?:jl|jln|gg|gang)\b\.?{WORDS}(?:\s+(?:km|gg|gang)\.?\s?\d+)*\s+(?:{NO}|{NEIGHBOURS}|{BLOCK}|{NUMBER})"
    rf"|jalan{WORDS}(?:\s+(?:km|gg|gang)\.?\s?\d+)*\s+(?:{NO}|{NEIGHBOURS})"
    rf"|(?:dusun|dsn|kampung|kp)\b\.?{WORDS}\s+(?:{NEIGHBOURS}|{NO})"
    rf"|(?:perumahan|perum|kompleks|komplek|griya)\b\.?{WORDS}\s+(?:{BLOCK}|{NO}))(?:,?\s+(?:{BLOCK}|{NEIGHBOURS}|{NO}))*(?!\w)",
    re.I,
)
TITLES = r"mbak|mas|bapak|pak|ibu|bu|mrs|mr|ms|sdr|sdri|kak|bang|bpk"
STRONG = re.compile(r"(?<!\w)(?:(?:sdri?|bpk)\.?|a\.n\.|atas nama:?|nama:|name:|cp:?|mrs?\.?|(?:ny|tn)\.|nyonya|tuan|bernama|my (?:friend|brother|sister|colleague|neighbou?r)|teman saya)\s+(?:(?i:" + TITLES + r")\b\.?\s+)?", re.I)
CUES = ("sdr", "bpk", "a.n.", "nama", "name", "cp", "mr", "ny.", "tn.", "nyonya", "tuan", "my ", "teman")
WORD = re.compile(r"(?<!\w)[^\W\d_]{3,}(?!\w)")
FAMILY = re.compile(r"[ \t]+([A-Z][a-z]{2,})(?!\w)")  # a capital after a given name
GIVEN = re.compile(r"[A-Z][a-z]{2,}(?:[ \t]+[A-Z][a-z]{2,})?(?!\w)")


class Names:
    """Knows a given list of names and names composed of the same beginnings and endings."""

    def __init__(self, names: list[str]) -> None:
        self.names = {n.strip().casefold() for n in names if n and n.strip()}
        heads, tails = defaultdict(set), defaultdict(set)
        for n in self.names:
            for cut in range(3, len(n) - 2):
                heads[n[:cut]].add(n[cut:])
                tails[n[cut:]].add(n[:cut])
        self.tails = {t for t, h in tails.items() if len(h) > 1}
        self.heads = {h for h, t in heads.items() if len(t & self.tails) > 1}
        # A beginning is one that many endings follow: the shortest kept one of each family.
        self.stems = sorted(h for h in self.heads if not any(h[:k] in self.heads for k in range(3, len(h))))
        self.starts = {n[:3] for n in self.names}
        self.known: dict[str, bool] = {}
        self.new: dict[str, str] = {}  # names replaced so far
        self.endings: dict[str, list[str]] = defaultdict(list)  # names without such parts, by their last letter
        for n in sorted(n for n in self.names if self.split(n) is None):
            self.endings[n[-1]].append(n)

    def split(self, word: str) -> tuple[str, str] | None:
        for stem in self.stems:
            if word.startswith(stem) and word[len(stem) :] in self.tails:
                return stem, word[len(stem) :]
        return None

    def is_name(self, word: str) -> bool:
        known = self.known.get(word)
        if known is None:
            if len(self.known) > 200_000:
                self.known.clear()
            known = self.known[word] = word in self.names or self.split(word) is not None
        return known

    def find(self, text: str) -> Iterator[tuple[int, int]]:
        last = None  # start, end, whether a family name is in it
        starts, low = self.starts, text.casefold()
        some = any(w[:3] in starts and self.is_name(w) for w in WORD.findall(low))
        for m in WORD.finditer(text) if some else ():
            s, e = m.span()
            if not self.is_name(m.group().casefold()) or text[s - 1 : s] == "@":
                continue
            if last and text[last[1] : s].isspace() and not last[2]:
                last = (last[0], e, True)
                continue
            if last:
                yield last[:2]
            last = (s, e, False)
            if text[s].isupper() and not text[s:e].isupper() and (g := FAMILY.match(text, e)) and not self.is_name(g.group(1).casefold()):
                last = (s, g.end(), True)
        if last:
            yield last[:2]
        for m in STRONG.finditer(text) if any(map(low.__contains__, CUES)) else ():
            if g := GIVEN.match(text, m.end()):
                yield g.span()


def detect(text: str, names: Names) -> list[tuple[int, int, str]]:
    """Non-overlapping (start, end, type), in order."""
    found: list[tuple[int, int, str]] = []
    digits = any(map(text.__contains__, "0123456789"))
    if EMAIL_HINT.search(text):
        found += ((*m.span(), "email") for m in EMAIL.finditer(text))
    if digits:
        found += ((*m.span(), "id_number") for m in ID_NUMBER.finditer(text))
        found += ((*m.span(), "phone") for m in PHONE.finditer(text))
        found += ((*m.span(), "address") for m in ADDRESS.finditer(text))
        found += ((*m.span(1), "id_number") for m in SECURITY.finditer(text))
        found += ((*m.span(), "phone") for m in ABROAD.finditer(text) if 8 <= sum(c.isdigit() for c in m.group()) <= 15)
        found += ((*m.span(), "address") for m in STREET.finditer(text))
    found += ((s, e, "person_name") for s, e in names.find(text))
    kept: list[tuple[int, int, str]] = []
    for s, e, kind in found:
        if all(e <= a or s >= b for a, b, _ in kept):
            kept.append((s, e, kind))
    return sorted(kept)


def normal(kind: str, text: str) -> str:
    """One form for all spellings of an entity."""
    t = " ".join(text.casefold().split())
    if kind in ("phone", "id_number"):
        d = "".join(c for c in t if c.isdigit())
        return "62" + d[1:] if kind == "phone" and d[:1] == "0" else d
    if kind == "email":
        t = re.sub(r"\s?[\[({]\s?at\s?[\])}]\s?|\sat\s|\s?＠\s?|\s@\s", "@", t)
        return re.sub(r"\s?[\[({]\s?dot\s?[\])}]\s?|\sdot\s", ".", t)
    return t


VOWELS, CONSONANTS, DIGITS = "aeiou", "bcdfghjklmnpqrstvwxyz", "0123456789"


def _pool(c: str) -> str:
    """The characters that may stand for c: vowels, consonants, digits, or the letters of its case in its script's block."""
    for pool in (VOWELS, CONSONANTS, DIGITS):
        if c in pool:
            return pool
    if not c.isalnum():
        return c
    base = ord(c) // 32 * 32
    return "".join(x for x in map(chr, range(base, base + 32)) if x.isalnum() and x.isdecimal() == c.isdecimal() and x == x.casefold()) if c == c.casefold() else c


def _shuffled(x: int, n: int, key: bytes, tweak: str) -> int:
    """The image of x under a keyed permutation of 0 .. n - 1: an unbalanced Feistel network with cycle walking."""
    if n < 2:
        return x
    a = math.isqrt(n - 1) + 1
    size = (a.bit_length() + 71) // 8
    while True:
        left, right = divmod(x, a)
        for r in range(6):
            mixed = int.from_bytes(blake2b(f"{tweak}\0{n}\0{r}\0{right}".encode(), key=key, digest_size=min(64, size)).digest(), "little")
            left, right = right, (left + mixed) % a
        x = left * a + right
        if x < n:
            return x


def _permuted(text: str, kept: list[bool], key: bytes, tweak: str) -> str:
    """A text of the same shape: characters from the same pools, the kept ones as they are. Distinct texts stay distinct."""
    pools = [c if k else _pool(c) for c, k in zip(text, kept, strict=True)]
    x, n = 0, 1
    for c, pool in zip(text, pools, strict=True):
        x, n = x * len(pool) + pool.index(c), n * len(pool)
    shape = tweak + "\0" + "".join(pool if len(pool) == 1 else pool[0] * 2 for pool in pools)
    y, out = _shuffled(x, n, key, shape), []
    for pool in reversed(pools):
        y, at = divmod(y, len(pool))
        out.append(pool[at])
    return "".join(reversed(out))


def _poured(text: str, plain: str, new: str) -> str:
    """The letters and digits of `new` in the format of `text`, if those of `text` are the ones of `plain`; else `new`."""
    signs = [c for c in text if c.isalnum()]
    if [c.casefold() for c in signs] != [c for c in plain if c.isalnum()] or len(signs) != sum(map(str.isalnum, new)):
        return new
    it = iter(c for c in new if c.isalnum())
    return "".join((x.upper() if c.isupper() else x) if c.isalnum() and (x := next(it)) else c for c in text)


SPELLED = re.compile(r"(\s?[\[({]\s?(?:at|dot)\s?[\])}]\s?|\s(?:at|dot)\s|\s?[@＠]\s?|[.])", re.I)
KEPT = re.compile(r"(?<!\w)(?:jalan|jln|jl|gang|gg|dusun|dsn|kampung|kp|perumahan|perum|kompleks|komplek|griya|blok|nomor|nomer|no|km|rt|rw|street|st|road|rd|avenue|ave|lane|ln|drive|boulevard|blvd|court|square)(?!\w)", re.I)


def _name(word: str, names: Names, key: bytes) -> str:
    """A name's word: another beginning with the same ending, another listed name, or letters that are no known name."""
    if cut := names.split(word):
        stem, tail = cut
        order = sorted(names.stems, key=lambda s: blake2b(f"{tail}\0{s}".encode(), key=key).digest())
        return order[(order.index(stem) + 1) % len(order)] + tail
    same = names.endings.get(word[-1:], ())
    if word in names.names and len(same) > 1:
        order = sorted(same, key=lambda s: blake2b(s.encode(), key=key).digest())
        return order[(order.index(word) + 1) % len(order)]
    kept = [False] * (len(word) - 1) + [True]  # the ending often tells the gender
    new = word
    while True:
        new = _permuted(new, kept, key, "name")
        if new == word or not names.is_name(new):
            return new


def surrogate(kind: str, text: str, names: Names, key: bytes) -> str:
    """The replacement of an entity, in the format in which it stands."""
    plain = normal(kind, text)
    if kind == "person_name":
        out = []
        for w in re.split(r"(\s+)", text):
            low = w.casefold()
            if low.strip() and low not in names.new:
                if len(names.new) > 100_000:
                    names.new.clear()
                names.new[low] = _name(low, names, key)
            out.append(_poured(w, low, names.new[low]) if low.strip() else w)
        return "".join(out)
    kept = [not c.isalnum() for c in plain]
    if kind == "phone":
        keep = 5 if plain[:3] == "628" else 4
        kept[:keep] = [True] * min(keep, len(kept))
        new = _permuted(plain, kept, key, kind)
        own = "".join(c for c in text if c.isdigit())
        return _poured(text, own, "0" + new[2:]) if own[:1] == "0" else _poured(text, plain, new)
    if kind == "id_number":
        if len(plain) != 16:
            return _poured(text, plain, _permuted(plain, kept, key, kind))
        kept[6] = True  # the day of birth is 41 to 71 for women
        new = _permuted(plain, kept, key, kind)
        turn = blake2b((new[:6] + new[7:]).encode(), key=key).digest()[0] % 4
        day = int(plain[6])
        return _poured(text, plain, new[:6] + (str(day // 4 * 4 + (day + turn) % 4) if day < 8 else plain[6]) + new[7:])
    if kind == "email":
        last = plain.rfind(".")
        kept[last:] = [True] * (len(plain) - last)
        new = _permuted(plain, kept, key, kind)
        parts, pieces = SPELLED.split(text), re.split(r"[@.]", new)
        if [len(p) for p in parts[::2]] != [len(p) for p in pieces]:
            return new
        return "".join(p if i % 2 else _poured(p, p.casefold(), pieces[i // 2]) for i, p in enumerate(parts))
    for m in KEPT.finditer(plain):
        kept[m.start() : m.end()] = [True] * (m.end() - m.start())
    return _poured(text, plain, _permuted(plain, kept, key, kind))


HIT = pa.struct([("start", pa.int32()), ("stop", pa.int32()), *((c, pa.string()) for c in ("pii_type", "pii_text", "normal", "surrogate", "surrogate_normal"))])
HITS = "array<struct<start:int,stop:int,pii_type:string,pii_text:string,normal:string,surrogate:string,surrogate_normal:string>>"


def _scan(batches, names: list[str], key: bytes, keep_text: bool):
    """id, text (null unless kept) and hits of each text; without `keep_text` only of those with any."""
    known = Names(names)
    for b in batches:
        ids, texts, hits = [], [], []
        for i, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            own = []
            for s, e, kind in detect(text, known) if text else ():
                t = text[s:e]
                new = surrogate(kind, t, known, key)
                own.append({"start": s, "stop": e, "pii_type": kind, "pii_text": t, "normal": normal(kind, t), "surrogate": new, "surrogate_normal": normal(kind, new)})
            if own or keep_text:
                ids.append(i)
                texts.append(text if keep_text else None)
                hits.append(own)
        yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(texts, pa.string()), pa.array(hits, pa.list_(HIT))], names=["id", "text", "hits"])


def _known(names: DataFrame, name_col: str, most: int) -> list[str]:
    known = [r[0] for r in names.select(F.col(name_col)).where(F.col(name_col).isNotNull()).distinct().limit(most + 1).collect()]
    if len(known) > most:
        raise ValueError(f"more than {most} names")
    return sorted(known)


def entities(df: DataFrame, id_col: str, text_col: str, names: DataFrame, key: bytes, name_col: str = "name", most_names: int = 100_000) -> DataFrame:
    """Each entity with its place (start, stop in code points), type, text, normal form and surrogate under the secret `key`.

    `names` is a list of known given names of at most `most_names` entries, else ValueError. Null and empty texts have
    no entities; a repeated row has them once. Entities that overlap are resolved in the order email, id_number, phone,
    address, person_name. Surrogates of distinct entities are distinct in the whole table, those of one entity equal.
    """
    known = _known(names, name_col, most_names)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text")).where("text <> ''")
    found = rows.mapInArrow(lambda it: _scan(it, known, key, False), f"id long, text string, hits {HITS}").select("id", F.inline("hits"))
    return found.distinct()


def clashes(found: DataFrame) -> DataFrame:
    """(pii_type, surrogate_normal, owners): surrogates of a table of entities that stand for several; there are none."""
    owners = found.groupBy("pii_type", "surrogate_normal").agg(F.count_distinct("normal").alias("owners"))
    return owners.where("owners > 1")


def redact(df: DataFrame, id_col: str, text_col: str, names: DataFrame, key: bytes, name_col: str = "name", most_names: int = 100_000) -> DataFrame:
    """(id, redacted, entities): each entity stands as [TYPE surrogate] in the text; texts without any stay as they are.

    Every row comes out, null ids and texts as well and repeated rows as often as they stand. Nothing is shuffled:
    surrogates are permutations, which need no look at other entities.
    """
    known = _known(names, name_col, most_names)
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"))
    texts = rows.mapInArrow(lambda it: _scan(it, known, key, True), f"id long, text string, hits {HITS}")
    step = lambda a, s: F.struct(
        F.concat(a["out"], F.substr(F.col("text"), a["at"] + 1, s["start"] - a["at"]), F.lit("["), F.upper(s["pii_type"]), F.lit(" "), s["surrogate"], F.lit("]")).alias("out"), s["stop"].alias("at")
    )
    made = F.aggregate("hits", F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), step, lambda a: F.concat(a["out"], F.substr(F.col("text"), a["at"] + 1)))
    return texts.select("id", F.when(F.size("hits") > 0, made).otherwise(F.col("text")).alias("redacted"), F.size("hits").alias("entities"))
