"""Reports over finished cluster tables and jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

CLUSTER = ("global_topic", "topic", "super_topic", "cluster")
COUNT = ("count", "n_rows", "size")


def first_column(df: DataFrame, names: tuple[str, ...]) -> str | None:
    """The first of the names that the table has, in any case."""
    have = {c.lower(): c for c in df.columns}
    return next((have[n] for n in names if n in have), None)


def cluster_sizes(df: DataFrame) -> DataFrame:
    """(cluster, size): summed counts if the table has one row a cluster and a count, else the rows of each cluster.

    Ids that are no numbers are out, counts that are none are 0. A table without a cluster column raises ValueError.
    """
    cluster, count = first_column(df, CLUSTER), first_column(df, COUNT)
    if cluster is None:
        raise ValueError("no cluster column")
    whole = lambda c: F.expr(f"CAST(try_cast(`{c}` AS DOUBLE) AS BIGINT)")
    if count is not None:
        n, distinct = df.agg(F.count(F.coalesce(F.col(cluster).cast("string"), F.lit("?"))), F.count_distinct(F.coalesce(F.col(cluster).cast("string"), F.lit("?")))).first()
        if n == distinct:
            return df.select(whole(cluster).alias("cluster"), F.coalesce(whole(count), F.lit(0)).alias("n")).where("cluster IS NOT NULL").groupBy("cluster").agg(F.sum("n").alias("size"))
    return df.select(whole(cluster).alias("cluster")).where("cluster IS NOT NULL").groupBy("cluster").agg(F.count("*").alias("size"))


def summary(sizes: DataFrame) -> DataFrame:
    """One row: clusters, clustered, outlier and filtered rows and the largest cluster."""
    ok = F.col("cluster") >= 0
    s = lambda c: F.coalesce(F.sum(F.when(c, F.col("size"))), F.lit(0))
    return sizes.agg(F.count_if(ok).alias("n_clusters"), s(ok).alias("n_docs_clustered"), s(F.col("cluster") == -1).alias("n_outlier"), s(F.col("cluster") == -2).alias("n_filtered"), F.coalesce(F.max(F.when(ok, F.col("size"))), F.lit(0)).alias("largest"))


def largest(sizes: DataFrame, n: int) -> DataFrame:
    """(rank, cluster, size): the n largest clusters; ties by id."""
    top = sizes.where("cluster >= 0").orderBy(F.desc("size"), "cluster").limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(F.desc("size"), "cluster"))).select("rank", "cluster", "size")


def headline(reports: DataFrame, path: str = "path") -> DataFrame:
    """The report with most clustered rows; ties by path."""
    return reports.orderBy(F.desc("n_docs_clustered"), path).limit(1)


def job_counts(jobs: DataFrame) -> DataFrame:
    """(status, jobs): distinct jobs by status, whatever its case."""
    return jobs.groupBy(F.lower(F.trim("status")).alias("status")).agg(F.count_distinct("job_id").alias("jobs"))


def progress(chunks: DataFrame, chunk: str = "chunk_id") -> DataFrame:
    """(chunk, n, done, pct): rows of each chunk and the running share of all rows, for a table of chunks."""
    per = chunks.groupBy(chunk).agg(F.count("*").alias("n"))
    w = Window.orderBy(chunk).rowsBetween(Window.unboundedPreceding, 0)
    total = per.agg(F.sum("n").alias("total"))
    return per.withColumn("done", F.sum("n").over(w)).crossJoin(F.broadcast(total)).select(chunk, "n", "done", F.round(100.0 * F.col("done") / F.col("total"), 2).alias("pct"))
