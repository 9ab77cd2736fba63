"""Readers of posts, topic tables and job states."""

from __future__ import annotations

import csv
import io
import json
import zipfile
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from lumbung.session import stage


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """CSV, TSV, JSON lines, a JSON document or Parquet, by the suffix; ValueError for any other.

    A JSON document is a list of rows, or an object whose first key with a non-empty list of objects has the rows, or
    else one row itself. A path of several documents is read by what the first of them has.
    """
    suffix = PurePosixPath(path.rstrip("/")).suffix.lower()
    if suffix in (".csv", ".tsv"):
        return spark.read.csv(path, header=True, sep="," if suffix == ".csv" else "\t", multiLine=True, escape='"')
    if suffix == ".parquet":
        return spark.read.parquet(path)
    if suffix in (".jsonl", ".ndjson"):
        return spark.read.json(path)
    if suffix == ".json":
        return _json_document(spark, path)
    raise ValueError(f"no reader for {suffix or path}")


def _json_document(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.json(path, multiLine=True)
    lists = {f.name for f in rows.schema if f.dataType.typeName() == "array" and f.dataType.elementType.typeName() == "struct"}
    if not lists:
        return rows
    # The keys in their order, of an object; a task reads the text, the driver only sees the keys.
    keys = spark.read.text(path, wholetext=True).select(F.expr("CASE WHEN ltrim(value) LIKE '{%' THEN json_object_keys(value) END").alias("k")).first()["k"]
    if keys is None:
        return rows
    known = [k for k in keys if k in lists]
    sizes = rows.select(*(F.size(f"`{k}`") for k in known)).first()
    full = [k for k, n in zip(known, sizes, strict=True) if n > 0]
    return rows.select(F.inline(f"`{full[0]}`")) if full else rows


def text_source(posts: DataFrame, project: str, fields: list[str], project_col: str = "project_id") -> DataFrame:
    """The rows of a project with the asked fields; filter and columns reach the scan."""
    return posts.where(F.col(project_col) == project).select(*fields)


def page(rows: DataFrame, size: int, after: tuple | None, order: tuple[str, str]) -> DataFrame:
    """The next `size` rows beyond the keys `after`, by the two order columns, nulls last: no offset is ever counted."""
    a, b = (F.col(c) for c in order)
    if after is not None:
        x, y = (F.lit(v) for v in after)
        rows = rows.where(a.isNull() & (b > y) if after[0] is None else (a > x) | ((a == x) & (b > y)) | a.isNull())
    return rows.orderBy(a.asc_nulls_last(), b.asc_nulls_last()).limit(size)


def union_indices(indices: list[DataFrame], most: int = 0, order: tuple[str, ...] = ()) -> DataFrame:
    """All rows of the indices in the listed order, columns by name; at most `most` of them, the first ones, if not 0."""
    out = None
    for i, df in enumerate(indices):
        df = df.withColumn("index_no", F.lit(i))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    return out.orderBy("index_no", *order).limit(most) if most else out


def chunk_numbers(rows: DataFrame, size: int, order: list[Column | str]) -> DataFrame:
    """`chunk_id` for rows in a total order, `size` rows a chunk, without a single-task sort.

    Rows are range-partitioned by the order; the sizes of the partitions give each its first number.
    """
    ordered = stage(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id()), "ordered")
    before = ordered.groupBy("part").agg(F.count("*").alias("n")).withColumn("before", F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    place = F.row_number().over(Window.partitionBy("part").orderBy(*order)) - 1
    numbered = ordered.withColumn("place", place).join(F.broadcast(before.select("part", "before")), "part")  # a row for each partition
    return numbered.withColumn("chunk_id", F.floor((F.col("place") + F.col("before")) / size)).drop("part", "place", "before")


def _lines(spark: SparkSession, path: str, shape: str) -> DataFrame:
    try:
        return spark.read.schema(shape).json(path)
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], shape)


def write_chunks(chunks: DataFrame, path: str) -> list[int]:
    """Write the chunks that are not finished yet, each in its folder below `path`/rows; the chunk numbers written.

    A chunk is finished once the manifest in `path`/done lists it, which is written last: what a run that died left
    behind is overwritten by the next. finished_rows() reads the finished chunks only.
    """
    spark = chunks.sparkSession
    todo = stage(chunks.join(_lines(spark, f"{path}/done", "chunk_id long").select("chunk_id").distinct(), "chunk_id", "left_anti"), "chunks")
    new = sorted(int(r[0]) for r in todo.select("chunk_id").distinct().collect())
    if new:
        todo.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("chunk_id").parquet(f"{path}/rows")
        todo.groupBy(F.col("chunk_id").cast("long").alias("chunk_id")).agg(F.count("*").alias("n")).coalesce(1).write.mode("append").json(f"{path}/done")
    return new


def finished_rows(spark: SparkSession, path: str) -> DataFrame:
    """The rows of the finished chunks that write_chunks() or fetch() left below `path`."""
    return spark.read.parquet(f"{path}/rows").join(F.broadcast(_lines(spark, f"{path}/done", "chunk_id long").select("chunk_id").distinct()), "chunk_id")


def fetch(indices: list[DataFrame], path: str, size: int, order: tuple[str, str], most_chunks: int = 0) -> int:
    """Fetch the indices in turn, page by page beyond the last cursor, each page a finished chunk; the chunks fetched now.

    The cursor is written after its page, so a fetch that was broken, or stopped after `most_chunks`, goes on where it
    stood and repeats no row. Columns of no plain type are stored as text. Pages of an archive that is a table are
    better numbered at once: chunk_numbers() and write_chunks().
    """
    spark, fetched = indices[0].sparkSession, 0
    at = read_cursor(spark, f"{path}/cursor")
    number, after = at or (0, None)
    chunk = (_lines(spark, f"{path}/done", "chunk_id long").agg(F.max("chunk_id")).first()[0] or 0) + 1
    while number < len(indices) and not (most_chunks and fetched >= most_chunks):
        rows = stage(page(as_text(indices[number]), size, after, order), "page")
        last = rows.orderBy(F.col(order[0]).desc_nulls_first(), F.col(order[1]).desc()).select(*order).first()
        if last is None:
            number, after = number + 1, None
            continue
        rows.withColumn("index_no", F.lit(number)).write.mode("overwrite").parquet(f"{path}/rows/chunk_id={chunk}")
        after = tuple(last)
        spark.range(1).select(F.lit(chunk).cast("long").alias("chunk_id"), F.lit(rows.count()).alias("n")).coalesce(1).write.mode("append").json(f"{path}/done")
        write_cursor(spark, f"{path}/cursor", number, after)
        chunk, fetched = chunk + 1, fetched + 1
    return fetched


def as_text(df: DataFrame) -> DataFrame:
    """Columns without one plain type as strings: binary decoded as UTF-8, nested ones as JSON; null stays."""
    out = []
    for f in df.schema:
        kind, c = f.dataType.typeName(), F.col(f"`{f.name}`")
        out.append((F.decode(c, "UTF-8") if kind == "binary" else F.to_json(c) if kind in ("struct", "map", "array") else c).alias(f.name))
    return df.select(*out)


def latest_jobs(jobs: DataFrame) -> DataFrame:
    """(project_id, job_id, created_at): the newest done job of each project; ties go to the smaller job_id."""
    w = Window.partitionBy("project_id").orderBy(F.desc("created_at"), "job_id")
    done = jobs.where((F.lower(F.trim("status")) == "done") & F.col("project_id").isNotNull())
    return done.withColumn("rn", F.row_number().over(w)).where("rn = 1").select("project_id", "job_id", "created_at")


def topic_tables(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(place, source, count, keywords, name, examples) of topic CSV files, and of those inside zip files.

    Column names are taken in any case. A file without count or keywords is refused; rows with blank or `nan` keywords
    are left out; a bad count is 0. place grows with the files in the given order and the rows in each.
    """
    out = None
    for i, path in enumerate(paths):
        if path.lower().endswith(".zip"):
            df = _zip_topics(spark, path)
            if df.where("keywords IS NULL AND count IS NULL").limit(1).count():
                raise ValueError(f"a member of {path} has no count or keywords")
        else:
            df = spark.read.csv(path, header=True, multiLine=True, escape='"')
            df = df.toDF(*(c.strip().lower() for c in df.columns))
            if not {"count", "keywords"} <= set(df.columns):
                raise ValueError(f"{path} has no count or keywords")
            examples = next((c for c in EXAMPLES if c in df.columns), None)
            one = lambda c, df=df: F.col(c) if c in df.columns else F.lit(None).cast("string")
            df = df.select(F.regexp_extract("_metadata.file_name", r"^(.*?)(?:\.[^.]*)?$", 1).alias("source"), "count", "keywords", one("name").alias("name"), one(examples).alias("examples"))
        df = df.select(
            (F.lit(i << 44) + F.monotonically_increasing_id()).alias("place"),
            "source",
            F.coalesce(F.expr("try_cast(count AS DOUBLE)"), F.lit(0.0)).cast("long").alias("count"),
            F.trim("keywords").alias("keywords"),
            "name",
            "examples",
        ).where("keywords <> '' AND lower(keywords) <> 'nan'")
        out = df if out is None else out.unionByName(df)
    return out


EXAMPLES = ("top5centroiddocs", "examples")  # names that the column of examples may have, in this order


def _members(blob: bytes):
    """Name and text of the CSV members of a zip file, without the folders and files that archivers add; equal names get a number."""
    seen: dict[str, int] = {}
    with zipfile.ZipFile(io.BytesIO(blob)) as z:
        for m in sorted(z.namelist()):
            name = PurePosixPath(m).name
            if not name.lower().endswith(".csv") or name.startswith("._") or "__MACOSX" in m:
                continue
            k = seen[name] = seen.get(name, 0) + 1
            yield name if k == 1 else f"{name[:-4]}_{k}.csv", z.read(m).decode("utf-8", "replace")


def zip_members(spark: SparkSession, path: str) -> DataFrame:
    """(name, content) of the CSV members of zip files. Archives are read whole, one row each, where they are."""

    def members(batches):
        import pandas as pd

        for pdf in batches:
            for blob in pdf["content"]:
                for row in _members(blob):
                    yield pd.DataFrame([row], columns=["name", "content"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(members, "name string, content string")


def _zip_topics(spark: SparkSession, path: str) -> DataFrame:
    """The topic rows of all members, as text; a member without count or keywords has one row without both."""

    def rows(batches):
        import pandas as pd

        for pdf in batches:
            for blob in pdf["content"]:
                for name, text in _members(blob):
                    reader = csv.DictReader(io.StringIO(text.removeprefix("\ufeff")))
                    reader.fieldnames = [c.strip().lower() for c in reader.fieldnames or []]
                    good = {"count", "keywords"} <= set(reader.fieldnames)
                    found = [(name[:-4], r["count"] or "", r["keywords"] or "", r.get("name"), next((r[c] for c in EXAMPLES if c in r), None)) for r in reader] if good else [(name[:-4], None, None, None, None)]
                    yield pd.DataFrame(found, columns=["source", "count", "keywords", "name", "examples"])

    return spark.read.format("binaryFile").load(path).select("content").mapInPandas(rows, "source string, count string, keywords string, name string, examples string")


def cluster_files(spark: SparkSession, root: str, skip: tuple[str, ...] = ("topic_graph_edges.csv", "dropped_languages.csv")) -> DataFrame:
    """(path): the CSV files below a folder, but for the skipped names and anything in a `cache` folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.csv").load(root).select("path")
    name = F.element_at(F.split("path", "/"), -1)
    return files.where(~name.isin(*skip) & ~F.col("path").contains("/cache/"))


def finished_chunks(centroids: DataFrame, manifest: DataFrame) -> DataFrame:
    """The centroids of chunks that a manifest lists as finished, whatever else lies there."""
    return centroids.join(manifest.select("chunk").distinct(), "chunk", "left_semi")


def write_cursor(spark: SparkSession, path: str, index_no: int, after: tuple) -> None:
    """Where a fetch stands: the index and the order keys of its last written row, as one more numbered row of a table.

    Keys are stored as JSON: numbers stay numbers, null stays null, times become text, which compares as their columns do.
    """
    n = _lines(spark, path, CURSOR).agg(F.max("n")).first()[0] or 0
    keys = json.dumps([k if k is None or isinstance(k, (int, float, str, bool)) else str(k) for k in after])
    spark.createDataFrame([(n + 1, index_no, keys)], CURSOR).coalesce(1).write.mode("append").json(path)


CURSOR = "n long, index_no int, after string"


def read_cursor(spark: SparkSession, path: str) -> tuple[int, tuple] | None:
    """The last cursor of a fetch, or None before the first."""
    last = _lines(spark, path, CURSOR).orderBy(F.desc("n")).first()
    return (last["index_no"], tuple(json.loads(last["after"]))) if last else None
