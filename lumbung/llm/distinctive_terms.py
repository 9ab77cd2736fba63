"""How distinctive a term is for a record: divergence from randomness.

The weight of a term is its information content under a geometric model of the collection, times the Laplace
after-effect gain, both with the term frequency normalised for the record's length.
"""

from __future__ import annotations

import re
from collections import Counter

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.operators.skew import join_hot
from lumbung.session import stage

LETTERS = re.compile(r"[^\W\d_]+")
COUNTS = pa.schema([("key", pa.int64()), ("term", pa.string()), ("tf", pa.int64()), ("length", pa.int64())])


def _count(batches):
    for b in batches:
        keys, terms, tfs, lengths = [], [], [], []
        for key, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            counts = Counter(LETTERS.findall(text.lower()))
            keys += [key] * len(counts)
            lengths += [counts.total()] * len(counts)
            terms += counts.keys()
            tfs += counts.values()
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(terms, pa.string()), pa.array(tfs, pa.int64()), pa.array(lengths, pa.int64())], schema=COUNTS)


def term_counts(df: DataFrame, key_col: str, text_col: str) -> DataFrame:
    """(key, term, tf, length): how often each run of letters, in lower case, stands in a record of `length` runs."""
    rows = df.select(F.col(key_col).cast("long").alias("key"), F.col(text_col).alias("text")).where("key IS NOT NULL AND text <> ''")
    return rows.mapInArrow(_count, "key long, term string, tf long, length long")


def weight(tf: Column, length: Column, total: Column, records: Column, mean: Column, c: float = 1.0) -> Column:
    """The weight of a term of which the collection of `records` has `total`, in a record of `length` where `mean` is usual."""
    tfn = tf * F.log2(1 + c * mean / length)
    rate = total / records
    return (F.log2(1 + rate) + tfn * F.log2((1 + rate) / rate)) / (tfn + 1)


def distinctive(df: DataFrame, key_col: str, text_col: str, least_tf: int = 1, df_range: tuple[int, int] | None = None) -> DataFrame:
    """(key, term, tf, df, score) for every term of every record, statistics being those of all records.

    A record is a row with a key and a term at least; null keys, null, empty and letterless texts have no terms. Keys
    should be unique: a repeated row counts as a further record and its rows are repeated. `least_tf` and `df_range`
    keep only such terms in the result. Terms of most records are joined where their rows are, others by a shuffle.
    """
    counts = stage(term_counts(df, key_col, text_col), "terms")
    stats = counts.groupBy("term").agg(F.count("*").alias("df"), F.sum("tf").alias("total"))
    stats = stage(stats if df_range is None else stats.where(F.col("df").between(*df_range)), "stats")
    whole = counts.agg(F.round(F.sum(F.col("tf") / F.col("length"))).alias("records"), F.sum("tf").alias("length")).first()  # a record's tf / length sum to 1
    records = whole["records"] or 1.0
    rows = counts.where(F.col("tf") >= least_tf)
    joined = join_hot(rows, stats.withColumn("n", F.col("df")), ["term"], "n")
    score = weight(F.col("tf"), F.col("length"), F.col("total"), F.lit(records), F.lit((whole["length"] or 1) / records))
    return joined.select("key", "term", "tf", "df", F.round(score, 6).alias("score"))
