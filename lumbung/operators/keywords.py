"""Keywords of topics: class-based TF-IDF, merged keyword lists and rapid keyword phrases."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.functions.text import STOPWORDS


def words(text: Column, stopwords: list[str] = STOPWORDS) -> Column:
    """Words of two or more characters without stopwords."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda w: (F.char_length(w) >= 2) & ~w.isin(*stopwords))


def with_pairs(words: Column) -> Column:
    """The words and the pairs of words that follow each other."""
    pairs = F.transform(words, lambda w, i: F.concat(w, F.lit(" "), F.get(words, i + 1)))
    return F.concat(words, F.filter(pairs, lambda p: p.isNotNull()))


def term_counts(df: DataFrame, topic: str, text: str, min_topics: int = 2, most_terms: int = 20_000, min_docs: int = 1, **of) -> DataFrame:
    """(topic, term, n, df, f): counts of the `most_terms` most frequent terms that `min_topics` topics and `min_docs` texts or more have.

    Ties at the limit go to the smaller term. Counts are combined per task; the vocabulary has a fixed bound.
    """
    rows = df.where(F.col(topic) >= 0).select(F.col(topic).alias("topic"), words(F.col(text), **of).alias("words"))
    terms = with_pairs(F.col("words"))
    if min_docs > 1:
        once = F.transform(terms, lambda t, i: F.struct(t.alias("term"), (F.array_position(terms, t) == i + 1).cast("long").alias("first")))
        rows = rows.select("topic", F.inline(once))
    else:
        rows = rows.select("topic", F.explode(terms).alias("term"), F.lit(1).cast("long").alias("first"))
    counts = rows.groupBy("topic", "term").agg(F.count("*").alias("n"), F.sum("first").alias("docs"))
    vocabulary = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("n").alias("f"), F.sum("docs").alias("docs"))
    vocabulary = vocabulary.where((F.col("df") >= min_topics) & (F.col("docs") >= min_docs)).drop("docs")
    kept = vocabulary.orderBy(F.desc("f"), "term").limit(most_terms)
    return counts.join(kept, "term").select("topic", "term", "n", "df", "f")


def _top(scored: DataFrame, top: int) -> DataFrame:
    w = Window.partitionBy("topic").orderBy(F.desc("score"), "term")
    return scored.where("score > 0").withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= top).select("topic", "rank", "term", "score")


def ctfidf(counts: DataFrame, top: int = 10) -> DataFrame:
    """(topic, rank, term, score): share of the topic's terms times ln(topics / (topics with it + 1)) + 1."""
    topics = counts.agg(F.count_distinct("topic").alias("k"))
    total = counts.groupBy("topic").agg(F.sum("n").alias("total"))
    score = F.col("n") / (F.col("total") + 1e-9) * (F.log(F.col("k") / (F.col("df") + 1.0)) + 1.0)
    return _top(counts.join(total, "topic").crossJoin(F.broadcast(topics)).withColumn("score", F.round(score, 9)), top)


def ctfidf_by_class_size(counts: DataFrame, top: int = 10) -> DataFrame:
    """(topic, rank, term, score): share of the topic's terms times ln(1 + mean terms of a topic / frequency)."""
    total = counts.groupBy("topic").agg(F.sum("n").alias("total"))
    mean = total.agg(F.avg("total").alias("mean"))
    score = F.col("n") / F.col("total") * F.log(1 + F.col("mean") / F.col("f"))
    return _top(counts.join(total, "topic").crossJoin(F.broadcast(mean)).withColumn("score", F.round(score, 9)), top)


def joined(ranked: DataFrame) -> DataFrame:
    """(topic, keywords): ranked terms of each topic joined by commas."""
    parts = F.array_sort(F.collect_list(F.struct("rank", "term")))
    return ranked.groupBy("topic").agg(F.array_join(F.transform(parts, lambda s: s["term"]), ", ").alias("keywords"))


def merged_keywords(df: DataFrame, group: str, keywords: str, count: str | None = None, top: int = 10, split: str = ", ") -> DataFrame:
    """(topic, rank, term, score): the keywords of a group's topics, each weighing its topic's count, at least 1, or 1.

    Lists that are null, blank or `nan` have no keywords; ties go to the smaller term.
    """
    weight = F.greatest(F.lit(1), F.coalesce(F.col(count), F.lit(1))).cast("long") if count else F.lit(1).cast("long")
    text = F.trim(keywords)
    rows = df.where((text != "") & (F.lower(text) != "nan")).select(F.col(group).alias("topic"), weight.alias("w"), F.explode(F.split(text, split)).alias("term")).where("term <> ''")
    return _top(rows.groupBy("topic", "term").agg(F.sum("w").alias("score")), top)


def rake(df: DataFrame, topic: str, text: str, id_col: str, stopwords: list[str] = STOPWORDS, top: int = 10, most_docs: int = 200, most_words: int = 4) -> DataFrame:
    """(topic, rank, term, score): phrases between stopwords and marks, scored by the degree over frequency of their words.

    From at most `most_docs` texts a topic, by a hash of the id (the sample that this report is defined on); a phrase
    counts once a topic; phrases have at most `most_words` words.
    """
    pick = Window.partitionBy(topic).orderBy(F.md5(F.col(id_col).cast("string")), id_col)
    rows = df.where((F.col(topic) >= 0) & F.col(text).isNotNull()).withColumn("_n", F.row_number().over(pick)).where(F.col("_n") <= most_docs)
    stop = "|".join(sorted(stopwords))
    cut = F.regexp_replace(F.lower(text), rf"(?<![\p{{L}}\p{{N}}_])(?:{stop})(?![\p{{L}}\p{{N}}_])|[^\p{{L}}\p{{N}}_\s]", "\n")
    phrases = F.array_distinct(F.transform(F.split(cut, "\n"), lambda p: F.trim(F.regexp_replace(p, r"\s+", " "))))
    one = rows.select(F.col(topic).alias("topic"), F.explode(phrases).alias("term")).where("term <> ''").distinct()
    one = one.withColumn("words", F.split("term", " ")).where(F.size("words") <= most_words)
    word = one.select("topic", "term", F.size("words").alias("size"), F.explode("words").alias("word"))
    scores = word.groupBy("topic", "word").agg((F.sum("size") / F.count("*")).alias("s"))
    scored = word.join(scores, ["topic", "word"]).groupBy("topic", "term").agg(F.round(F.sum("s"), 6).alias("score"))
    return _top(scored, top)
