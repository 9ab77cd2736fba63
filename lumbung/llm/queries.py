"""The queries of this subpackage over a folder of tables, and the SQL of those that SQL can express on whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.llm import distinctive_terms, format_copies, language, leaked_items, pii, reading_level, similar_vectors, similarity_clusters, source_mixture
from lumbung.llm.sql import oracle_sql  # noqa: F401
from lumbung.session import spread, stage
from lumbung.session import table as read

COLUMNS = {"fetched_posts": ["post_id", "content", "lang"], "documents": ["doc_id", "text", "source"]}


KEY = b"for tests only"  # of the surrogates; in use it is a secret
VOCABULARY = "/opt/tokenizers/byte_bpe_50k.tiktoken"
REGION = 2_000  # distinct word sets from which a space is cut into regions: the spaces here have some thousands


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    """A table, the texts on all cores and without columns that no query here reads."""
    df = read(spark, sf, name)
    return spread(df.select(*COLUMNS[name])) if name in COLUMNS else df


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    found = format_copies.copies(table(spark, sf, "fetched_posts"), "post_id", "content")
    return found.select(F.col("first_id").alias("first_post_id"), F.col("id").alias("post_id"))


def p1_messages(spark: SparkSession, sf: str) -> DataFrame:
    found = format_copies.messages(table(spark, sf, "fetched_posts"), "post_id", "content")
    return found.select(F.col("first_id").alias("first_post_id"), "copies")


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    found = pii.entities(table(spark, sf, "fetched_posts"), "post_id", "content", table(spark, sf, "given_names"), KEY)
    return found.select(F.col("id").alias("post_id"), "pii_type", "pii_text").distinct()


def p2_redacted(spark: SparkSession, sf: str) -> DataFrame:
    done = pii.redact(table(spark, sf, "fetched_posts"), "post_id", "content", table(spark, sf, "given_names"), KEY)
    return done.withColumnRenamed("id", "post_id")


def _posts(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "assignments").select(F.col("chunk").alias("space"), F.col("post_id").alias("key"), similarity_clusters.word_set(F.col("clean_text")).alias("words"))


def _topics(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "global_topics").select(F.lit("all").alias("space"), F.col("topic_key").alias("key"), similarity_clusters.keyword_set(F.col("keywords")).alias("words"))


def _clusters(spark: SparkSession, sf: str) -> dict[str, tuple[DataFrame, DataFrame]]:
    posts, topics = _posts(spark, sf), _topics(spark, sf)
    return {"post": (similarity_clusters.clusters(posts, "0.6", 8, REGION), posts), "topic": (similarity_clusters.clusters(topics, "0.5", 1, REGION), topics)}


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    kinds = [m.where("key <> first").select(F.lit(kind).alias("record_kind"), F.col("first").alias("first_key"), F.col("key").alias("member_key")) for kind, (m, _) in _clusters(spark, sf).items()]
    return kinds[0].unionByName(kinds[1])


def p3_clusters(spark: SparkSession, sf: str) -> DataFrame:
    kinds = [similarity_clusters.describe(m, r).withColumn("record_kind", F.lit(kind)) for kind, (m, r) in _clusters(spark, sf).items()]
    return kinds[0].unionByName(kinds[1])


def _segments(spark: SparkSession, sf: str) -> DataFrame:
    posts = table(spark, sf, "fetched_posts")
    model = language.fit(table(spark, sf, "lang_samples"), "lang", "text", posts, "lang", "content")
    return language.label_segments(posts, "post_id", "content", "lang", model)


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return language.mislabelled(_segments(spark, sf)).select(F.col("id").alias("post_id"), "true_lang")


def p4_segments(spark: SparkSession, sf: str) -> DataFrame:
    return _segments(spark, sf).withColumnRenamed("id", "post_id").drop("passages")


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    vectors = table(spark, sf, "post_vectors")
    found = similar_vectors.similar_pairs(vectors, "vec_id", "vec", similar_vectors.most_similar(vectors, "vec_id", "vec"), 0.9)
    return found.select(F.col("a").alias("vec_a"), F.col("b").alias("vec_b"))


def p5_neighbours(spark: SparkSession, sf: str) -> DataFrame:
    found = similar_vectors.most_similar(table(spark, sf, "post_vectors"), "vec_id", "vec").where("rank <= 5")
    return found.select(F.col("id").alias("vec_id"), "rank", F.col("to").alias("neighbour"), F.round("cosine", 3).alias("cosine"))


def _terms(spark: SparkSession, sf: str, kind: str, **kept) -> DataFrame:
    name, key, text = {"post": ("fetched_posts", "post_id", "content"), "topic": ("global_topics", "topic_key", "keywords")}[kind]
    found = distinctive_terms.distinctive(table(spark, sf, name), key, text, **kept)
    return found.select(F.lit(kind).alias("record_kind"), F.col("key").alias("record_key"), "term", "tf", "df", "score")


def p7_found(spark: SparkSession, sf: str) -> DataFrame:
    posts, topics = (_terms(spark, sf, kind, least_tf=3, df_range=(2, 12)) for kind in ("post", "topic"))
    scored = stage(posts.unionByName(topics), "scored")  # else no weight is ever computed: the rows follow from the counts alone
    return scored.select("record_kind", "record_key", "term").distinct()


def p7_scores(spark: SparkSession, sf: str) -> DataFrame:
    return _terms(spark, sf, "post").unionByName(_terms(spark, sf, "topic"))


def _leaks(spark: SparkSession, sf: str) -> DataFrame:
    return leaked_items.leaked(table(spark, sf, "documents"), "doc_id", "text", table(spark, sf, "eval_items"), "item_id", "text")


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return _leaks(spark, sf).select(F.col("id").alias("doc_id"), "item_id")


def p8_leaks(spark: SparkSession, sf: str) -> DataFrame:
    return _leaks(spark, sf).select(F.col("id").alias("doc_id"), "item_id", "runs", F.round("covered", 6).alias("covered"))


def p8_items(spark: SparkSession, sf: str) -> DataFrame:
    items = table(spark, sf, "eval_items").select("item_id", "task").dropDuplicates(["item_id"])
    per = _leaks(spark, sf).groupBy("item_id").agg(F.count("*").alias("documents"), F.max("runs").alias("most_runs"))
    return items.join(per, "item_id", "left").fillna(0, ["documents", "most_runs"])


def _mixture(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    counts = source_mixture.staged_counts(table(spark, sf, "documents"), "doc_id", "text", "source", VOCABULARY)
    return counts, source_mixture.rates(counts, table(spark, sf, "mix_targets"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return _mixture(spark, sf)[1].where("short").select("source")


def p9_mixture(spark: SparkSession, sf: str) -> DataFrame:
    return source_mixture.mixture(*_mixture(spark, sf)).withColumnRenamed("id", "doc_id")


def p9_shares(spark: SparkSession, sf: str) -> DataFrame:
    counts, rate = _mixture(spark, sf)
    return source_mixture.shares(source_mixture.mixture(counts, rate), rate)


def _levels(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents")
    model = reading_level.fit(docs, "doc_id", "text", table(spark, sf, "reading_labels"), "doc_id", "level")
    return reading_level.reading_levels(docs, "doc_id", "text", model)


def p10_found(spark: SparkSession, sf: str) -> DataFrame:
    return _levels(spark, sf).select(F.col("id").alias("doc_id"), "band").distinct()


def p10_levels(spark: SparkSession, sf: str) -> DataFrame:
    return _levels(spark, sf).withColumnRenamed("id", "doc_id")


def p10_profile(spark: SparkSession, sf: str) -> DataFrame:
    by = _levels(spark, sf).groupBy("band", F.round("level").cast("int").alias("level"))
    return by.agg(F.count("*").alias("documents"), F.sum("words").alias("words"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {name: f for name, f in globals().items() if name[0] == "p" and name[1].isdigit()}

