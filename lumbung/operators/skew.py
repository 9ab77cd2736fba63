"""Per-key results when a few keys hold most rows: eager aggregation through joins, and joins with hot keys."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lumbung.session import stage


def join_hot(rows: DataFrame, classes: DataFrame, on: list[str], weight: str, most_hot: int = 1000) -> DataFrame:
    """Inner join of many rows with one row for each key in `classes`, whose `weight` is the number of rows of the key.

    The at most `most_hot` keys with more than 1 / most_hot of all weight are broadcast, so their rows stay where they
    are; all other keys are joined by a shuffle in which none holds more than that share. `weight` is dropped.
    """
    total = classes.agg(F.sum(weight)).first()[0] or 0
    limit = total / most_hot
    hot = classes.where(F.col(weight) > limit).drop(weight)
    cold = classes.where(F.col(weight) <= limit).drop(weight)
    return rows.join(F.broadcast(hot), on).unionByName(rows.join(cold, on))


def join_text(df: DataFrame, text_col: str, known: DataFrame, most_hot: int = 1000) -> DataFrame:
    """Left join of rows with `known`, which has one row for each distinct text in its column _text; other columns are kept.

    The at most `most_hot` texts with more than 1 / most_hot of all rows, reposts that went viral say, are broadcast with
    what is known of them, so that their rows stay where they are; all other rows are joined by a shuffle. A null text
    knows nothing.
    """
    counts = df.where(F.col(text_col).isNotNull()).groupBy(F.col(text_col).alias("_text")).agg(F.count("*").alias("_n"))
    total = counts.agg(F.sum("_n")).first()[0] or 0
    hot = stage(counts.where(F.col("_n") * most_hot > total).select("_text").join(known, "_text", "left"), "hot")
    new = [c for c in known.columns if c != "_text"]
    row = F.struct(F.lit(True).alias("_is"), *new).alias("_hot")
    marked = df.join(F.broadcast(hot.select("_text", row)), F.col(text_col) == F.col("_text"), "left").drop("_text")
    near = marked.where("_hot IS NOT NULL").select(*df.columns, *(F.col("_hot")[c].alias(c) for c in new))
    far = marked.where("_hot IS NULL").drop("_hot")
    far = far.join(known, far[text_col] == known["_text"], "left").drop("_text")
    return near.unionByName(far)


def eager_join_sums(sides: dict[str, tuple[DataFrame, list[str]]], key: str) -> DataFrame:
    """What a full join of the sides on `key` would give per key, without ever forming the joined rows.

    Each side is folded to one compact row a key: its count and the sums of its measures (nulls ignored). The folded
    rows are joined; the joined row count of a key is the product of the counts, and the sum of a side's measure over
    the joined rows is its own sum times the counts of the other sides. A key that a side lacks counts there as one
    null row, as in an outer join. Null keys are no keys. Columns: key, <side>_rows, joined_rows, and for each measure
    <side>_<measure>_sum and joined_<side>_<measure>_sum.
    """
    folded = None
    for name, (df, measures) in sides.items():
        one = df.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("key"))
        one = one.agg(F.count("*").alias(f"{name}_rows"), *(F.sum(m).alias(f"{name}_{m}_sum") for m in measures))
        folded = one if folded is None else folded.join(one, "key", "full")
    counts = {name: F.greatest(F.coalesce(F.col(f"{name}_rows"), F.lit(0)), F.lit(1)).cast("decimal(38,0)") for name in sides}

    def product(skip: str = ""):
        out = F.lit(1).cast("decimal(18,0)")
        for name, c in counts.items():
            if name != skip:
                out = (out * c.cast("decimal(18,0)")).cast("decimal(38,0)")
        return out

    own = [F.coalesce(F.col(f"{n}_rows"), F.lit(0)).alias(f"{n}_rows") for n in sides]
    sums = [c for n, (_, ms) in sides.items() for m in ms for c in (F.col(f"{n}_{m}_sum"), (F.col(f"{n}_{m}_sum") * product(n)).cast("decimal(38,0)").alias(f"joined_{n}_{m}_sum"))]
    return folded.select("key", *own, product().alias("joined_rows"), *sums)


def eager_rollup(left: DataFrame, right: DataFrame, key: str, group: str, measure: str) -> DataFrame:
    """(group, joined_rows, joined_sum): the inner join on `key` rolled up to a column of the left side, never forming it.

    The left side is folded by key and group, the right one to a count and the sum of `measure` by key; joined rows are
    the product of the counts, sums are multiplied by the left count, and both are summed by group. Null keys join
    nothing; a null group is one; null measures count 0.
    """
    one = left.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k"), F.col(group).alias("_g")).agg(F.count("*").cast("decimal(18,0)").alias("_n"))
    two = right.where(F.col(key).isNotNull()).groupBy(F.col(key).alias("_k")).agg(F.count("*").cast("decimal(18,0)").alias("_m"), F.coalesce(F.sum(measure), F.lit(0)).cast("decimal(18,0)").alias("_s"))
    both = one.join(two, "_k").groupBy(F.col("_g").alias(group))
    return both.agg(F.sum(F.col("_n") * F.col("_m")).alias("joined_rows"), F.sum(F.col("_n") * F.col("_s")).alias("joined_sum"))
