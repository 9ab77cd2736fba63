"""One object for the jobs of the engine: cluster a batch, merge chunks, rank super topics, report, and write results."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung import sources
from lumbung.functions.models import Detector, Embedder, embed_texts
from lumbung.plans import batch, merge, report
from lumbung.session import stage


class Engine:
    """The jobs over one session, with an embedder and a language detector of one's own where given."""

    def __init__(self, spark: SparkSession, embedder: Embedder | None = None, detect: Detector | None = None) -> None:
        self.spark, self.embedder, self.detect = spark, embedder, detect

    def read(self, path: str) -> DataFrame:
        return sources.read_table(self.spark, path)

    def cluster(self, posts: DataFrame, text_col: str, id_col: str, **settings) -> batch.Batch:
        """Topics of a batch; the settings are those of batch.Settings."""
        return batch.run(posts, text_col, id_col, batch.Settings(**settings), self.embedder, self.detect)

    def cluster_chunks(self, posts: DataFrame, text_col: str, id_col: str, chunk_col: str, path: str, **settings) -> list[str]:
        """Cluster and write every chunk that has no result below `path` yet; the chunks done now.

        Rows without a chunk number are one chunk, `none`. A chunk with too few texts is recorded with the reason in
        `path`/refused and looked at again next time; any other error ends the run. Chunks are a fixed size each, so
        their number is what the loop grows with; each is a distributed job.
        """
        known = {r[0] for r in self._rows(f"{path}/done", "chunk string").select("chunk").distinct().collect()}
        done, name = [], F.coalesce(F.col(chunk_col).cast("string"), F.lit("none"))
        for chunk in sorted(r[0] for r in posts.select(name).distinct().collect()):
            if chunk in known:
                continue
            try:
                result = self.cluster(posts.where(name == chunk), text_col, id_col, **settings)
            except batch.TooFewTexts as e:
                self.spark.range(1).select(F.lit(chunk).alias("chunk"), F.lit(str(e)).alias("reason")).coalesce(1).write.mode("append").json(f"{path}/refused")
                continue
            self.write(result, path, chunk)
            done.append(chunk)
        return done

    def refused(self, path: str) -> DataFrame:
        """(chunk, reason): the chunks below `path` that were refused and have no result."""
        return self._rows(f"{path}/refused", "chunk string, reason string").distinct().join(self._rows(f"{path}/done", "chunk string"), "chunk", "left_anti")

    def _rows(self, path: str, shape: str) -> DataFrame:
        try:
            return self.spark.read.schema(shape).json(path)
        except Exception as e:
            if "PATH_NOT_FOUND" not in str(e):
                raise
            return self.spark.createDataFrame([], shape)

    def write(self, result: batch.Batch, path: str, chunk: str) -> None:
        """Assignments and centroids as Parquet, topics and edges as CSV, metrics as JSON; the manifest comes last."""
        name = F.lit(chunk).alias("chunk")
        result.assignments.drop("chunk").write.mode("overwrite").parquet(f"{path}/assignments/chunk={chunk}")
        result.centroids.select("topic", "n", "centroid").write.mode("overwrite").parquet(f"{path}/centroids/chunk={chunk}")
        for part, df in (("topics", result.topics), ("edges", result.edges), ("languages", result.languages)):
            df.coalesce(1).write.mode("overwrite").csv(f"{path}/{part}/chunk={chunk}", header=True, escape='"')
        result.metrics.withColumn("resolution", F.lit(result.resolution)).coalesce(1).write.mode("overwrite").json(f"{path}/metrics/chunk={chunk}")
        self.spark.range(1).select(name).coalesce(1).write.mode("append").json(f"{path}/done")

    def merge(self, path: str, target: tuple[int, int] = (20, 50)) -> tuple[DataFrame, DataFrame]:
        """Global topics of all finished chunks below `path`: their summary, and all assignments with global_topic."""
        cents = self.spark.read.parquet(f"{path}/centroids").withColumn("chunk", F.col("chunk").cast("string"))
        cents = sources.finished_chunks(cents, self.spark.read.json(f"{path}/done").select(F.col("chunk").cast("string").alias("chunk")))
        mapping = stage(merge.global_topics(cents, target), "mapping")
        topics = self.spark.read.csv(f"{path}/topics", header=True, escape='"', multiLine=True)
        local = topics.select(F.col("chunk").cast("string").alias("chunk"), F.col("topic").cast("int").alias("topic"), F.col("n_rows").cast("long").alias("n_rows"), F.coalesce("keywords", F.lit("")).alias("keywords"))
        rows = self.spark.read.parquet(f"{path}/assignments").withColumn("chunk", F.col("chunk").cast("string"))
        return merge.global_summary(local, mapping, cents), merge.apply_mapping(rows, mapping)

    def super_topics(self, centroids: DataFrame, topics: DataFrame, jobs: DataFrame, top: int = 10) -> DataFrame:
        """Ranked super topics of the newest done job of each project.

        `centroids` has project_id, global_topic and centroid, `topics` project_id, global_topic, n_rows and keywords.
        """
        newest = sources.latest_jobs(jobs).select("project_id")
        cents = centroids.join(newest, "project_id", "left_semi").select("project_id", "global_topic", "centroid")
        members = merge.super_topics(cents, ["project_id", "global_topic"], top)
        one = topics.groupBy("project_id", "global_topic").agg(F.max("n_rows").alias("n_rows"), F.min("keywords").alias("keywords"))
        return merge.ranked_super_topics(members.join(one, ["project_id", "global_topic"], "left"), "project_id")

    def super_topics_of_tables(self, paths: list[str], top: int = 10) -> DataFrame:
        """Ranked super topics of topic CSV files, or of those in zip files, by the embedded keyword lists.

        With usual names, and first examples in the order of the files and their rows. Equal rows all count.
        """
        rows = stage(sources.topic_tables(self.spark, paths).withColumnRenamed("place", "id"), "tables")
        vecs = embed_texts(rows, "id", "keywords", self.embedder)
        members = stage(rows.join(merge.super_topics(vecs.select("id", F.col("vec").alias("centroid")), ["id"], top), "id"), "members")
        out = merge.ranked_super_topics(members, "source", "count")
        names, docs = merge.top_names(members, "name"), merge.first_examples(members, "id", "examples")
        return out.join(names, "super_topic", "left").join(docs, "super_topic", "left").orderBy("rank")

    def report(self, tables: dict[str, DataFrame]) -> DataFrame:
        """(path, n_clusters, n_docs_clustered, n_outlier, n_filtered, largest) for each table with a cluster column."""
        out = None
        for path, df in tables.items():
            if report.first_column(df, report.CLUSTER) is not None:
                one = report.summary(report.cluster_sizes(df)).select(F.lit(path).alias("path"), "*")
                out = one if out is None else out.unionByName(one)
        return out if out is not None else self.spark.createDataFrame([], "path string, n_clusters long, n_docs_clustered long, n_outlier long, n_filtered long, largest long")
