"""Topics of chunks to global topics, and topics of projects to ranked super topics."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lumbung.operators import community, topics
from lumbung.operators.keywords import joined, merged_keywords
from lumbung.plans.batch import meta_topics

MOST = 20_000  # local topics that the driver clusters at once


def _vectors(cents: DataFrame, keys: list[str]) -> tuple[list[tuple], np.ndarray]:
    t = cents.select(*keys, F.col("centroid").cast("array<double>").alias("centroid")).orderBy(*keys).limit(MOST + 1).toArrow()
    n = t.num_rows
    if n > MOST:
        raise ValueError(f"more than {MOST} topics")
    x = np.asarray(t["centroid"].combine_chunks().flatten(), np.float64).reshape(n, -1 if n else 0)
    return list(zip(*(t[k].to_pylist() for k in keys), strict=True)), x / np.maximum(np.linalg.norm(x, axis=1, keepdims=True), 1e-12)


def _nearest_group(x: np.ndarray, labels: np.ndarray) -> np.ndarray:
    """Each row's nearest group centre, so that noise finds a group too; groups are numbered anew by first use."""
    k = int(labels.max(initial=-1)) + 1
    if not k:
        return np.arange(len(x))
    c = np.array([x[labels == i].mean(axis=0) for i in range(k)])
    c /= np.maximum(np.linalg.norm(c, axis=1, keepdims=True), 1e-12)
    return np.concatenate([(x[s : s + 1000] @ c.T).argmax(axis=1) for s in range(0, len(x), 1000)])


def global_topics(cents: DataFrame, target: tuple[int, int] = (20, 50), seed: int = 42) -> DataFrame:
    """(chunk, topic, global_topic) for all chunks' centroids.

    With fewer centroids than the target's lower end each is its own global topic. Else they are clustered by density,
    cut or merged to the target by least squared error, and every centroid goes to the nearest global centre.
    """
    keys, x = _vectors(cents, ["chunk", "topic"])
    n, (least, most) = len(keys), target
    if n < max(2, least):
        labels = np.arange(n)
    else:
        size = min(max(2, n // (4 * most)), max(2, n // least))
        labels = community.density_clusters(x, size, max(1, size // 4))
        k = int(labels.max(initial=-1)) + 1
        if not least <= k <= most:
            labels = community.ward(x, min(n, most if k > most else least))
        labels = _nearest_group(x, labels)
    return cents.sparkSession.createDataFrame([(*k, int(g)) for k, g in zip(keys, labels, strict=True)], "chunk string, topic int, global_topic int")


def apply_mapping(assignments: DataFrame, mapping: DataFrame, chunk: str = "chunk", topic: str = "topic") -> DataFrame:
    """Assignments with their global topic; -1 where the mapping misses, -2 rows stay -2."""
    m = mapping.select(F.col("chunk").alias("_c"), F.col("topic").alias("_t"), "global_topic")
    out = assignments.drop("global_topic").join(m, (F.col(chunk) == F.col("_c")) & (F.col(topic) == F.col("_t")), "left").drop("_c", "_t")
    return out.withColumn("global_topic", F.when(F.col(topic) == -2, -2).otherwise(F.coalesce("global_topic", F.lit(-1))))


def global_summary(local: DataFrame, mapping: DataFrame, cents: DataFrame | None = None, graph_similarity: float = 0.3, top: int = 10) -> DataFrame:
    """(global_topic, n_rows, n_local_topics, keywords[, meta_topic]) from the chunks' topic tables.

    `local` has chunk, topic, n_rows and keywords; of repeated topics the first by keywords counts. With centroids,
    meta topics come from the graph of global centres, weighted by their similarity.
    """
    one = local.groupBy("chunk", "topic").agg(F.max("n_rows").alias("n_rows"), F.min("keywords").alias("keywords"))
    rows = mapping.join(one, ["chunk", "topic"], "left")
    sizes = rows.groupBy("global_topic").agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_rows"), F.count("*").alias("n_local_topics"))
    words = joined(merged_keywords(rows, "global_topic", "keywords", "n_rows", top)).withColumnRenamed("topic", "global_topic")
    out = sizes.join(words, "global_topic", "left").withColumn("keywords", F.coalesce("keywords", F.lit("")))
    if cents is not None:
        centres = topics.centroids(cents.join(mapping, ["chunk", "topic"]).withColumn("g", F.col("global_topic")), "g", "centroid")
        edges = topics.centroid_pairs(centres, graph_similarity)
        meta = meta_topics(centres, edges, "similarity").withColumnRenamed("topic", "global_topic")
        out = out.join(meta, "global_topic", "left")
    return out


def super_topics(cents: DataFrame, keys: list[str], top: int = 10, similarity: float = 0.25, seed: int = 42) -> DataFrame:
    """(*keys, super_topic): communities of similar centroids, or `top` clusters by squared error if there are fewer."""
    ids, x = _vectors(cents, keys)
    n = len(ids)
    labels = community.modularity_communities(n, community.Alike.of(x, similarity), seed=seed)
    if labels.max(initial=-1) + 1 < top <= n:
        labels = community.ward(x, top)
    labels = _nearest_group(x, labels) if n else labels
    kinds = dict(cents.dtypes)
    return cents.sparkSession.createDataFrame([(*k, int(g)) for k, g in zip(ids, labels, strict=True)], ", ".join(f"{k} {kinds[k]}" for k in keys) + ", super_topic int")


def ranked_super_topics(members: DataFrame, source: str, count: str = "n_rows", keywords: str = "keywords", split: str = ", ", top_words: int = 10) -> DataFrame:
    """(rank, super_topic, count, n_sources, keywords): super topics by their rows, largest first, ties by number.

    Each keyword counts once a member that has it; `split` is a pattern (white space gives the older form).
    """
    sizes = members.groupBy("super_topic").agg(F.coalesce(F.sum(count), F.lit(0)).alias("count"), F.count_distinct(source).alias("n_sources"))
    words = joined(merged_keywords(members, "super_topic", keywords, None, top_words, split)).withColumnRenamed("topic", "super_topic")
    out = sizes.join(words, "super_topic", "left").withColumn("keywords", F.coalesce("keywords", F.lit("")))
    return out.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("count"), "super_topic"))).select("rank", "super_topic", "count", "n_sources", "keywords")


def totals(ranked: DataFrame) -> DataFrame:
    """(total_documents, total_super_clusters) over all super topics of a ranking, not only the first ones."""
    return ranked.agg(F.coalesce(F.sum("count"), F.lit(0)).alias("total_documents"), F.count("*").alias("total_super_clusters"))


def top_names(members: DataFrame, name: str, n: int = 3) -> DataFrame:
    """(super_topic, top_names): the n most frequent names of each, joined by bars; blanks and `nan` are none."""
    rows = members.where((F.trim(name) != "") & (F.lower(F.trim(name)) != "nan")).groupBy("super_topic", F.trim(name).alias("name")).agg(F.count("*").alias("n"))
    w = Window.partitionBy("super_topic").orderBy(F.desc("n"), "name")
    best = rows.withColumn("r", F.row_number().over(w)).where(F.col("r") <= n)
    return best.groupBy("super_topic").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "name"))), lambda s: s["name"]), " | ").alias("top_names"))


def first_examples(members: DataFrame, order: str, examples: str, n: int = 5) -> DataFrame:
    """(super_topic, examples): the first n distinct examples in the members' order."""
    parts = members.where(F.col(examples).isNotNull()).select("super_topic", F.col(order).alias("o"), F.posexplode(F.split(examples, r" \|\|\| ")).alias("p", "e")).where("trim(e) <> '' AND lower(trim(e)) <> 'nan'")
    first = parts.groupBy("super_topic", F.trim("e").alias("e")).agg(F.min(F.struct("o", "p")).alias("at"))
    best = first.withColumn("r", F.row_number().over(Window.partitionBy("super_topic").orderBy("at", "e"))).where(F.col("r") <= n)
    return best.groupBy("super_topic").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("r", "e"))), lambda s: s["e"]), " ||| ").alias("examples"))


def slices(ranked: DataFrame, sizes: tuple[int, ...]) -> dict[int, DataFrame]:
    """The first rows of a ranking for each asked size that it reaches."""
    n = ranked.count()
    return {k: ranked.where(F.col("rank") <= k) for k in sorted(set(sizes)) if k <= n}
