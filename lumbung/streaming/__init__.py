"""New posts as they arrive: cleaned, embedded and given known topics, and posts that arrive again left out."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from lumbung.functions.models import Embedder, embed_texts
from lumbung.functions.text import clean_text, informative
from lumbung.operators.topics import nearest


def stream_posts(spark: SparkSession, path: str, schema: T.StructType, files: int = 16) -> DataFrame:
    """A stream of the Parquet files of a folder, `files` at a time."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def without_refetched(posts: DataFrame, key: str = "object_id", seen_at: str = "fetched_at", late: str = "2 days") -> DataFrame:
    """Each key once within the watermark; rows that arrive later than `late` are dropped with the state."""
    return posts.withWatermark(seen_at, late).dropDuplicatesWithinWatermark([key])


def counts_by_window(posts: DataFrame, by: str, at: str = "fetched_at", width: str = "1 hour", late: str = "1 hour") -> DataFrame:
    """(window_start, by, n): posts of each key in each window, final once the watermark has passed."""
    return posts.withWatermark(at, late).groupBy(F.window(at, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").alias("window_start"), by, "n")


def assign_stream(posts: DataFrame, id_col: str, text_col: str, cents: DataFrame, cut: float, out: str, checkpoint: str, embedder: Embedder | None = None) -> StreamingQuery:
    """Write each micro-batch with clean_text and topic: nearest centroid, -1 below `cut`, -2 if not informative.

    The batch number is part of the path, so a batch that is run again after a failure replaces its own rows.
    """

    def batch(df: DataFrame, number: int) -> None:
        rows = df.withColumn("clean_text", clean_text(F.col(text_col))).withColumn("ok", informative(F.col("clean_text")))
        near = nearest(embed_texts(rows.where("ok"), id_col, "clean_text", embedder), "id", "vec", cents)
        near = near.select(F.col("id").alias("_id"), F.when(F.col("sim") < cut, -1).otherwise(F.col("topic")).alias("topic"), "sim")
        done = rows.join(near, rows[id_col] == near["_id"], "left").drop("_id", "ok").withColumn("topic", F.coalesce("topic", F.lit(-2)))
        done.write.mode("overwrite").parquet(f"{out}/batch={number}")

    return posts.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
