"""The unique corpus of a batch: language filter, distinct texts, label propagation and batch metrics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lumbung.functions.text import language_name
from lumbung.operators.skew import join_text

KEPT = ("id", "ms", "jv", "su", "min", "ban", "ace")


def dropped(lang: Column, conf: Column, keep: tuple[str, ...] = KEPT, least: float = 0.5) -> Column:
    """Whether the language filter drops a row: another language, with a confidence of `least` after rounding to 3 places."""
    code = F.coalesce(lang, F.lit("und"))
    return ~code.isin(*keep) & (F.round(F.coalesce(conf, F.lit(0.0)), 3) >= least)


def language_report(df: DataFrame, lang: str = "lang", conf: str = "lang_conf", **filter_by) -> DataFrame:
    """(lang, language, rows, rows_dropped, pct_of_input) for every language of the input, also without drops."""
    code = F.coalesce(F.col(lang), F.lit("und"))
    gone = dropped(F.col(lang), F.col(conf), **filter_by)
    counts = df.groupBy(code.alias("lang")).agg(F.count("*").alias("rows"), F.count_if(gone).alias("rows_dropped"))
    total = counts.agg(F.sum("rows").alias("total"))
    return counts.crossJoin(F.broadcast(total)).select("lang", language_name(F.col("lang")).alias("language"), "rows", "rows_dropped", F.round(100.0 * F.col("rows_dropped") / F.col("total"), 2).alias("pct_of_input"))


def kept_shares(df: DataFrame, lang: str = "lang", conf: str = "lang_conf", top: int = 10, **filter_by) -> DataFrame:
    """(rank, lang, rows, pct): the most frequent languages of the rows that the filter keeps, with their share of them."""
    kept = df.where(~dropped(F.col(lang), F.col(conf), **filter_by)).groupBy(F.coalesce(F.col(lang), F.lit("und")).alias("lang")).agg(F.count("*").alias("rows"))
    total = kept.agg(F.sum("rows").alias("total"))
    first = kept.orderBy(F.desc("rows"), "lang").limit(top).withColumn("rank", F.row_number().over(Window.orderBy(F.desc("rows"), "lang")))
    return first.crossJoin(F.broadcast(total)).select("rank", "lang", "rows", F.round(100.0 * F.col("rows") / F.col("total"), 2).alias("pct"))


def distinct_texts(df: DataFrame, text_col: str, id_col: str) -> DataFrame:
    """(text, first_id, n_rows): each text once, with its first row and its number of rows; null and empty texts are out."""
    rows = df.where(F.col(text_col) != "")
    return rows.groupBy(F.col(text_col).alias("text")).agg(F.min(id_col).alias("first_id"), F.count("*").alias("n_rows"))


def propagate(df: DataFrame, text_col: str, labels: DataFrame, label: str = "topic", missing: int = -2) -> DataFrame:
    """All rows with the label of their text, by `labels` with one row a text; rows whose text has none get `missing`."""
    known = labels.select(F.col("text").alias("_text"), label)
    return join_text(df.drop(label), text_col, known).withColumn(label, F.coalesce(label, F.lit(missing)))


def batch_metrics(df: DataFrame, text_col: str = "clean_text", topic: str = "topic") -> DataFrame:
    """One row: rows, filtered, outlier and clustered rows, topics, unique texts, largest share and outlier share in percent."""
    t = F.col(topic)
    sizes = df.where(t >= 0).groupBy(topic).agg(F.count("*").alias("n")).agg(F.count("*").alias("n_topics"), F.max("n").alias("largest"), F.sum("n").alias("clustered"))
    rows = df.agg(F.count("*").alias("n_rows"), F.count_if(t == -2).alias("n_filtered"), F.count_if(t == -1).alias("n_outlier"), F.count_distinct(F.when(F.col(text_col) != "", F.col(text_col))).alias("n_unique"))
    pct = lambda a, b: F.round(100.0 * F.coalesce(a, F.lit(0)) / F.greatest(b, F.lit(1)), 2)
    return rows.crossJoin(sizes).select("n_rows", "n_filtered", "n_outlier", "n_unique", "n_topics", F.coalesce("clustered", F.lit(0)).alias("n_clustered"), pct(F.col("largest"), F.col("clustered")).alias("largest_pct"), pct(F.col("n_outlier"), F.col("n_rows")).alias("outlier_pct"))


def hash_sample(df: DataFrame, id_col: str, n: int, seed: int = 42) -> DataFrame:
    """Exactly n rows (or all) without replacement, the same in any run: the first by a seeded hash of the id."""
    return df.orderBy(F.md5(F.concat_ws(" ", F.lit(seed), F.col(id_col).cast("string"))), id_col).limit(n)
