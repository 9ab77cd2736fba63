"""A mixture of sources with target shares of all tokens.

Tokens are summed per source, a source's repetition rate is what its share needs, at most its cap, and each document is
emitted floor(rate) times and once more with the rest as probability, drawn from a keyed hash of its id.
"""

from __future__ import annotations

import base64

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lumbung.session import stage

# The published pattern by which the byte-level vocabulary's words are cut (a fixed value).
PATTERN = r"""'(?:[sdmt]|ll|ve|re)| ?\p{L}++| ?\p{N}++| ?[^\s\p{L}\p{N}]++|\s++$|\s+(?!\S)|\s"""


def _tokens(path: str):
    def run(batches):
        import regex
        import tiktoken

        with open(path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in (line.split() for line in f)}
        encode = tiktoken.Encoding("words", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        cut, memo = regex.compile(PATTERN).findall, {}
        for b in batches:
            sizes = []
            for text in b.column(1).to_pylist():
                n = 0
                for w in cut(text or ""):
                    k = memo.get(w)
                    if k is None:
                        if len(memo) > 500_000:
                            memo.clear()
                        k = memo[w] = len(encode(w))
                    n += k
                sizes.append(n)
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(sizes, pa.int64())], names=["id", "source", "tokens"])

    return run


def plain_source(c: Column) -> Column:
    """A source's name without outer blanks and case, with `-` and blank as `_`."""
    return F.translate(F.lower(F.trim(c)), "- ", "__")


def token_counts(df: DataFrame, id_col: str, text_col: str, source_col: str, vocabulary: str) -> DataFrame:
    """(id, source, tokens): each document's number of tokens of the byte-level vocabulary in the file `vocabulary`; 0 for null text.

    The file has a base64 token and its rank on each line and is read by the tasks, so all executors need it.
    """
    rows = df.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("text"), plain_source(F.col(source_col)).alias("source"))
    return rows.mapInArrow(_tokens(vocabulary), "id long, source string, tokens long")


def rates(counts: DataFrame, targets: DataFrame, most_targets: int = 10_000) -> DataFrame:
    """For each target: source as spelled, plain, target_share, max_repeats, documents, tokens, needed, rate and short.

    needed is target_share of all tokens of documents whose source has a target, each taken once; rate is what reaches
    it, at most max_repeats; short says that even max_repeats does not. A source without tokens has rate 0 and is short
    if it has a share. Null sources, shares and caps are no targets; of a
    source that is spelled in several ways the first by spelling, share and cap is the target; more than `most_targets` are refused.
    """
    wanted = targets.select("source", plain_source(F.col("source")).alias("plain"), "target_share", "max_repeats").dropna()
    wanted = wanted.groupBy("plain").agg(*(F.min_by(c, F.struct("source", "target_share", "max_repeats")).alias(c) for c in ("source", "target_share", "max_repeats"))).select("source", "plain", "target_share", "max_repeats")
    if wanted.select("plain").limit(most_targets + 1).count() > most_targets:
        raise ValueError(f"more than {most_targets} targets")
    sums = counts.groupBy(F.col("source").alias("plain")).agg(F.count("*").alias("documents"), F.sum("tokens").alias("tokens"))
    each = wanted.join(sums, "plain", "left").fillna(0, ["documents", "tokens"])
    total = each.agg(F.sum("tokens").alias("total"))
    each = each.crossJoin(F.broadcast(total)).withColumn("needed", F.col("target_share") * F.col("total"))
    rate = F.when(F.col("tokens") > 0, F.least(F.col("max_repeats").cast("double"), F.col("needed") / F.col("tokens"))).otherwise(0.0)
    return each.select("source", "plain", "target_share", "max_repeats", "documents", "tokens", "needed", rate.alias("rate"), (F.col("tokens") * F.col("max_repeats") < F.col("needed")).alias("short"))


def mixture(counts: DataFrame, rate: DataFrame, seed: int = 42) -> DataFrame:
    """(id, source, copy, tokens): the copies of each document in the mixture, numbered from 1.

    `rate` comes from rates() and has at most as many rows as there are targets, so it is broadcast. Documents of a
    source without target are not in it. The extra copy is drawn from a hash of id and seed: the same in any run.
    """
    draw = F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 53)) / F.lit(float(1 << 53))
    known = rate.select(F.col("plain"), F.col("source").alias("target"), "rate")
    rows = counts.join(F.broadcast(known), counts["source"] == known["plain"])
    copies = F.floor("rate") + F.when(draw < F.col("rate") - F.floor("rate"), 1).otherwise(0)
    rows = rows.withColumn("copies", copies.cast("int")).where("copies > 0")
    return rows.select("id", F.col("target").alias("source"), F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"), "tokens")


def shares(mixed: DataFrame, rate: DataFrame) -> DataFrame:
    """The report: each target's share, its rate, the tokens and documents that the mixture has of it and their share."""
    got = mixed.groupBy("source").agg(F.sum("tokens").alias("mixed_tokens"), F.count("*").alias("mixed_documents"))
    each = rate.join(got, "source", "left").fillna(0, ["mixed_tokens", "mixed_documents"])
    total = each.agg(F.sum("mixed_tokens").alias("all"))
    share = F.when(F.col("all") > 0, F.round(F.col("mixed_tokens") / F.col("all"), 6)).otherwise(0.0)
    return each.crossJoin(F.broadcast(total)).select("source", "target_share", "max_repeats", "tokens", F.round("rate", 6).alias("rate"), "mixed_documents", "mixed_tokens", share.alias("actual_share"), "short")


def staged_counts(df: DataFrame, id_col: str, text_col: str, source_col: str, vocabulary: str) -> DataFrame:
    """token_counts() written once, for a mixture that reads them twice."""
    return stage(token_counts(df, id_col, text_col, source_col, vocabulary), "tokens")
