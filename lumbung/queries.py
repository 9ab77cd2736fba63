"""The queries of the core over a folder of tables, and SQL that gives the same rows."""

from __future__ import annotations

import uuid
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lumbung.functions import models, text
from lumbung.operators import community, components, corpus, keywords, skew, topics
from lumbung.plans import batch, merge, report
from lumbung.session import shared_dir, spread, stage, table
from lumbung import sources

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return add


SPACE = r"\s\x{1c}-\x{1f}\x{85}\p{Z}"
STOP = "[" + ", ".join(f"'{w}'" for w in text.STOPWORDS) + "]"
KEEP = ", ".join(f"'{x}'" for x in corpus.KEPT)

# ---- cleaning and judging texts


@query(
    rf"""SELECT post_id, trim(regexp_replace(regexp_replace(regexp_replace(regexp_replace(regexp_replace(lower(coalesce(content, '')),
    'https?://[^{SPACE}]+|www\.[^{SPACE}]+', ' ', 'g'), '@[\p{{L}}\p{{N}}_]+', ' ', 'g'), '#([\p{{L}}\p{{N}}_]+)', '\1', 'g'),
    '[^\p{{L}}\p{{N}}_{SPACE}]', ' ', 'g'), '[{SPACE}]+', ' ', 'g')) AS stripped FROM fetched_posts"""
)
def strip_links(spark, sf):
    return spread(table(spark, sf, "fetched_posts").select("post_id", "content")).select("post_id", text.strip_links(F.col("content")).alias("stripped"))


@query()
def clean_text(spark, sf):
    lexicon = text.lexicon_map(table(spark, sf, "slang_lexicon"))
    return spread(table(spark, sf, "fetched_posts").select("post_id", "content")).select("post_id", text.clean_text(F.col("content"), lexicon).alias("clean_text"))


@query("SELECT slang, arg_max(formal, line_no) AS formal FROM (SELECT line_no, lower(trim(slang)) AS slang, lower(trim(formal)) AS formal FROM slang_lexicon) WHERE slang <> '' AND formal <> '' AND slang <> formal GROUP BY slang")
def slang_lexicon(spark, sf):
    return text.slang_lexicon(table(spark, sf, "slang_lexicon"))


@query(
    """WITH lex AS (SELECT slang, arg_max(formal, line_no) AS formal FROM (SELECT line_no, lower(trim(slang)) AS slang, lower(trim(formal)) AS formal FROM slang_lexicon)
    WHERE slang <> '' AND formal <> '' AND slang <> formal GROUP BY slang),
    tok AS (SELECT post_id, unnest(string_split(clean_text, ' ')) AS w, generate_subscripts(string_split(clean_text, ' '), 1) AS i FROM assignments WHERE clean_text IS NOT NULL)
    SELECT post_id, string_agg(coalesce(formal, w), ' ' ORDER BY i) AS formal_text FROM tok LEFT JOIN lex ON w = slang GROUP BY post_id"""
)
def slang_normalized(spark, sf):
    lexicon = text.lexicon_map(table(spark, sf, "slang_lexicon"))
    return table(spark, sf, "assignments").where("clean_text IS NOT NULL").select("post_id", text.normalize_slang(F.col("clean_text"), lexicon).alias("formal_text"))


@query(f"SELECT post_id, coalesce(length(clean_text) >= 5 AND len([w for w in string_split(clean_text, ' ') if length(w) > 1 AND NOT list_contains({STOP}, w)]) >= 2, false) AS informative FROM assignments")
def informative_posts(spark, sf):
    return table(spark, sf, "assignments").select("post_id", text.informative(F.col("clean_text")).alias("informative"))


NAMES = "MAP {" + ", ".join(f"'{k}': '{v}'" for k, v in text.LANGUAGE_NAMES.items()) + "}"


@query(f"SELECT lang, count(*) AS n, any_value(coalesce(({NAMES})[lower(split_part(CASE WHEN coalesce(lang, '') = '' THEN 'und' ELSE lang END, '-', 1))], CASE WHEN coalesce(lang, '') = '' THEN 'und' ELSE lang END)) AS language FROM fetched_posts GROUP BY lang")
def language_names(spark, sf):
    rows = table(spark, sf, "fetched_posts").groupBy("lang").agg(F.count("*").alias("n"))
    return rows.select("lang", "n", text.language_name(F.col("lang")).alias("language"))


@query(
    f"""SELECT lang, any_value(coalesce(({NAMES})[lower(split_part(lang, '-', 1))], lang)) AS language, count(*) AS rows,
    count(*) FILTER (lang NOT IN ({KEEP}) AND round(coalesce(conf, 0), 3) >= 0.5) AS rows_dropped,
    round(100.0 * count(*) FILTER (lang NOT IN ({KEEP}) AND round(coalesce(conf, 0), 3) >= 0.5) / (SELECT count(*) FROM assignments), 2) AS pct_of_input
    FROM (SELECT coalesce(lang, 'und') AS lang, lang_conf AS conf FROM assignments) GROUP BY lang"""
)
def language_report(spark, sf):
    return corpus.language_report(table(spark, sf, "assignments"))


@query(
    f"""WITH kept AS (SELECT coalesce(lang, 'und') AS lang FROM assignments WHERE NOT (coalesce(lang, 'und') NOT IN ({KEEP}) AND round(coalesce(lang_conf, 0), 3) >= 0.5)), c AS (SELECT lang, count(*) AS rows FROM kept GROUP BY lang)
    SELECT row_number() OVER (ORDER BY rows DESC, lang) AS rank, lang, rows, round(100.0 * rows / (SELECT count(*) FROM kept), 2) AS pct FROM c QUALIFY rank <= 10"""
)
def kept_languages(spark, sf):
    return corpus.kept_shares(table(spark, sf, "assignments"))


@query()
def detected_languages(spark, sf):
    return models.detect_distinct(table(spark, sf, "assignments").select("post_id", "clean_text"), "clean_text").select("post_id", "lang", "lang_conf")


# ---- the unique corpus


@query("SELECT clean_text AS text, min(post_id) AS first_id, count(*) AS n_rows FROM assignments WHERE clean_text <> '' GROUP BY clean_text")
def distinct_texts(spark, sf):
    return corpus.distinct_texts(table(spark, sf, "assignments"), "clean_text", "post_id")


@query(
    """WITH first AS (SELECT clean_text, arg_min(topic, post_id) AS own FROM assignments WHERE clean_text <> '' GROUP BY clean_text)
    SELECT post_id, coalesce(own, -2) AS topic FROM assignments LEFT JOIN first USING (clean_text)"""
)
def propagated_labels(spark, sf):
    rows = table(spark, sf, "assignments").select("post_id", "clean_text", F.col("topic").alias("own"))
    labels = rows.where("clean_text <> ''").groupBy(F.col("clean_text").alias("text")).agg(F.min_by("own", "post_id").alias("topic"))
    return corpus.propagate(rows, "clean_text", labels).select("post_id", "topic")


@query(
    """WITH s AS (SELECT topic, count(*) AS n FROM assignments WHERE topic >= 0 GROUP BY topic)
    SELECT count(*) AS n_rows, count(*) FILTER (topic = -2) AS n_filtered, count(*) FILTER (topic = -1) AS n_outlier,
    count(DISTINCT clean_text) FILTER (clean_text <> '') AS n_unique, (SELECT count(*) FROM s) AS n_topics, (SELECT CAST(sum(n) AS BIGINT) FROM s) AS n_clustered,
    (SELECT round(100.0 * max(n) / sum(n), 2) FROM s) AS largest_pct, round(100.0 * count(*) FILTER (topic = -1) / count(*), 2) AS outlier_pct FROM assignments"""
)
def batch_metrics(spark, sf):
    return corpus.batch_metrics(table(spark, sf, "assignments"))


@query("SELECT post_id, project_id FROM fetched_posts ORDER BY md5('42 ' || post_id), post_id LIMIT 1000")
def sampled_rows(spark, sf):
    return corpus.hash_sample(table(spark, sf, "fetched_posts").select("post_id", "project_id"), "post_id", 1000)


@query(
    """WITH h AS (SELECT md5(clean_text) AS h FROM assignments WHERE clean_text IS NOT NULL)
    SELECT count(*) AS n, substr(sha1('hashed-ngrams|False|' || count(*) || '|' || coalesce(sum(CAST('0x' || h[1:15] AS HUGEINT)), 0) || '|' || coalesce(sum(CAST('0x' || h[16:30] AS HUGEINT)), 0)), 1, 16) AS fingerprint FROM h"""
)
def corpus_fingerprint(spark, sf):
    return text.fingerprint(table(spark, sf, "assignments"), "clean_text", "hashed-ngrams")


# ---- sources

BIGGEST = "(SELECT project_id FROM fetched_posts WHERE project_id IS NOT NULL GROUP BY project_id ORDER BY count(*) DESC, project_id LIMIT 1)"


def _biggest(posts: DataFrame) -> str:
    return posts.where("project_id IS NOT NULL").groupBy("project_id").count().orderBy(F.desc("count"), "project_id").first()[0]


@query(f"SELECT post_ts, post_id, from_username, engagement FROM fetched_posts WHERE project_id = {BIGGEST} AND (post_ts > TIMESTAMP '2026-01-01 12:00:00' OR (post_ts = TIMESTAMP '2026-01-01 12:00:00' AND post_id > 100) OR post_ts IS NULL) ORDER BY post_ts NULLS LAST, post_id LIMIT 50")
def keyset_page(spark, sf):
    posts = table(spark, sf, "fetched_posts")
    rows = sources.text_source(posts, _biggest(posts), ["post_ts", "post_id", "from_username", "engagement"])
    return sources.page(rows, 50, ("2026-01-01 12:00:00", 100), ("post_ts", "post_id"))


@query(f"SELECT count(*) AS n FROM fetched_posts WHERE project_id = {BIGGEST}")
def project_count(spark, sf):
    posts = table(spark, sf, "fetched_posts")
    return posts.where(F.col("project_id") == _biggest(posts)).agg(F.count("*").alias("n"))


BOTH = "(SELECT post_id, project_id, 0 AS index_no FROM fetched_posts WHERE chunk_no = 0 UNION ALL SELECT post_id, project_id, 1 FROM fetched_posts WHERE chunk_no <> 0)"


def _indices(spark, sf):
    posts = table(spark, sf, "fetched_posts").select("post_id", "project_id", "chunk_no")
    return [posts.where("chunk_no = 0"), posts.where("chunk_no <> 0")]


@query(f"SELECT post_id, project_id, index_no, row_number() OVER (ORDER BY index_no, post_id) - 1 AS place FROM {BOTH}")
def indices_in_order(spark, sf):
    rows = sources.union_indices(_indices(spark, sf))
    numbered = sources.chunk_numbers(rows, 1, [F.col("index_no"), F.col("post_id")])
    return numbered.select("post_id", "project_id", "index_no", F.col("chunk_id").alias("place"))


@query(f"SELECT post_id, project_id FROM {BOTH} ORDER BY index_no, post_id LIMIT 5000")
def first_of_indices(spark, sf):
    return sources.union_indices(_indices(spark, sf), 5000, ("post_id",)).select("post_id", "project_id")


@query(f"SELECT post_id FROM fetched_posts WHERE project_id = {BIGGEST} AND post_ts IS NULL")
def pages_of_null_keys(spark, sf):
    """Pages through the rows of the largest project without a time, to the end."""
    posts = table(spark, sf, "fetched_posts")
    rows = stage(sources.text_source(posts, _biggest(posts), ["post_ts", "post_id"]), "rows")
    out, after = None, (None, -1)
    while True:
        one = stage(sources.page(rows, 500, after, ("post_ts", "post_id")), "page")
        last = one.agg(F.max("post_id")).first()[0]
        if last is None:
            return out if out is not None else one.select("post_id")
        out = one.select("post_id") if out is None else out.unionByName(one.select("post_id"))
        after = (None, last)


def _new_folder(spark, name):
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


@query(
    f"""WITH r AS (SELECT index_no, row_number() OVER (PARTITION BY index_no ORDER BY post_ts NULLS LAST, post_id) AS n FROM (SELECT post_id, post_ts, project_id, CASE WHEN chunk_no = 0 THEN 0 ELSE 1 END AS index_no FROM fetched_posts) WHERE project_id = {BIGGEST}),
    c AS (SELECT index_no, (n - 1) // 1000 AS k, count(*) AS n FROM r GROUP BY ALL) SELECT row_number() OVER (ORDER BY index_no, k) AS chunk_id, index_no, n FROM c"""
)
def fetched_chunks(spark, sf):
    """A fetch of the largest project's posts from two indices in chunks, stopped after the first and taken up again."""
    posts = table(spark, sf, "fetched_posts")
    rows = stage(posts.where(F.col("project_id") == _biggest(posts)).select("post_ts", "post_id", "chunk_no", "content"), "rows")
    both, path = [rows.where("chunk_no = 0"), rows.where("chunk_no <> 0")], _new_folder(spark, "fetch")
    sources.fetch(both, path, 1000, ("post_ts", "post_id"), most_chunks=1)
    sources.fetch(both, path, 1000, ("post_ts", "post_id"))
    return sources.finished_rows(spark, path).groupBy("chunk_id", "index_no").agg(F.count("*").alias("n"))


@query("SELECT chunk_id, count(*) AS n, CAST(sum(post_id) AS BIGINT) AS ids FROM (SELECT (row_number() OVER (ORDER BY post_ts NULLS LAST, post_id) - 1) // 500 AS chunk_id, post_id FROM fetched_posts) GROUP BY chunk_id")
def written_chunks(spark, sf):
    """Numbered chunks written twice, of which the second run finds all finished."""
    chunks, path = _chunks(spark, sf), _new_folder(spark, "chunks")
    sources.write_chunks(chunks.where("chunk_id < 3"), path)
    sources.write_chunks(chunks, path)
    return sources.finished_rows(spark, path).groupBy("chunk_id").agg(F.count("*").alias("n"), F.sum("post_id").alias("ids"))


@query("SELECT f AS format, count(*) AS n, count(DISTINCT job_id) AS jobs, count(project_id) AS projects FROM cluster_jobs, (SELECT unnest(['csv', 'tsv', 'jsonl', 'parquet', 'json']) AS f) GROUP BY f")
def formats_read(spark, sf):
    """The same table written in every format and read back by its suffix."""
    jobs, path, out = table(spark, sf, "cluster_jobs").select("job_id", "project_id"), _new_folder(spark, "formats"), None
    jobs.write.csv(f"{path}/a.csv", header=True, escape='"')
    jobs.write.csv(f"{path}/a.tsv", header=True, sep="\t", escape='"')
    jobs.write.json(f"{path}/a.jsonl")
    jobs.write.parquet(f"{path}/a.parquet")
    jobs.agg(F.collect_list(F.struct("job_id", "project_id")).alias("rows")).select(F.lit(1).alias("meta"), "rows").coalesce(1).write.json(f"{path}/a.json")
    for kind in ("csv", "tsv", "jsonl", "parquet", "json"):
        one = sources.read_table(spark, f"{path}/a.{kind}").agg(F.count("*").alias("n"), F.count_distinct("job_id").alias("jobs"), F.count("project_id").alias("projects")).select(F.lit(kind).alias("format"), "*")
        out = one if out is None else out.unionByName(one)
    return out


CHUNKS = "SELECT (row_number() OVER (ORDER BY post_ts NULLS LAST, post_id) - 1) // 500 AS chunk_id, post_id FROM fetched_posts"


def _chunks(spark, sf):
    return sources.chunk_numbers(table(spark, sf, "fetched_posts").select("post_ts", "post_id"), 500, [F.col("post_ts").asc_nulls_last(), F.col("post_id")])


@query(f"SELECT chunk_id, post_id FROM ({CHUNKS})")
def chunk_assignment(spark, sf):
    return _chunks(spark, sf).select("chunk_id", "post_id")


@query(f"SELECT chunk_id, n, CAST(sum(n) OVER (ORDER BY chunk_id) AS BIGINT) AS done, round(100.0 * sum(n) OVER (ORDER BY chunk_id) / sum(n) OVER (), 2) AS pct FROM (SELECT chunk_id, count(*) AS n FROM ({CHUNKS}) GROUP BY chunk_id)")
def chunk_progress(spark, sf):
    return report.progress(_chunks(spark, sf))


@query("SELECT project_id, job_id, created_at FROM cluster_jobs WHERE lower(trim(status)) = 'done' AND project_id IS NOT NULL QUALIFY row_number() OVER (PARTITION BY project_id ORDER BY created_at DESC, job_id) = 1")
def latest_jobs(spark, sf):
    return sources.latest_jobs(table(spark, sf, "cluster_jobs"))


@query("SELECT lower(trim(status)) AS status, count(DISTINCT job_id) AS jobs FROM cluster_jobs GROUP BY 1")
def job_counts(spark, sf):
    return report.job_counts(table(spark, sf, "cluster_jobs"))


# ---- topics over vectors

UNITS = "u AS (SELECT vec_id, label, CAST(vec AS DOUBLE[]) AS v, sqrt(list_dot_product(CAST(vec AS DOUBLE[]), CAST(vec AS DOUBLE[]))) AS size FROM post_vectors WHERE vec IS NOT NULL)"
CENTRES = """means AS (SELECT label, p, avg(x) AS m FROM (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS p FROM u WHERE label >= 0) GROUP BY label, p),
    raw AS (SELECT label, list(m ORDER BY p) AS c FROM means GROUP BY label),
    cents AS (SELECT label, [x / sqrt(list_dot_product(c, c)) for x in c] AS c FROM raw),
    own AS (SELECT vec_id, u.label, list_dot_product(v, c) / size AS sim FROM u JOIN cents ON u.label = cents.label WHERE size > 0),
    near AS (SELECT vec_id, label, sim FROM (SELECT vec_id, cents.label, round(list_dot_product(v, c) / size, 12) AS sim FROM u, cents WHERE size > 0) QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY sim DESC, label) = 1)"""


def _vectors(spark, sf):
    return table(spark, sf, "post_vectors")


def _centroids(spark, sf):
    return stage(topics.centroids(_vectors(spark, sf), "label", "vec"), "centroids")


@query(f"WITH {UNITS}, {CENTRES} SELECT label AS topic, (SELECT count(*) FROM u WHERE u.label = cents.label) AS n, generate_subscripts(c, 1) - 1 AS place, round(unnest(c), 6) AS x FROM cents")
def topic_centroids(spark, sf):
    return _centroids(spark, sf).select("topic", "n", F.posexplode("centroid").alias("place", "x")).withColumn("x", F.round("x", 6)).withColumn("place", F.col("place").cast("long"))


@query(f"WITH {UNITS}, {CENTRES} SELECT vec_id, label AS topic, round(sim, 6) AS sim FROM own")
def own_similarity(spark, sf):
    sims = topics.own_similarity(_vectors(spark, sf), "vec_id", "label", "vec", _centroids(spark, sf))
    return sims.select(F.col("id").alias("vec_id"), "topic", F.round("sim", 6).alias("sim"))


@query(f"WITH {UNITS}, {CENTRES} SELECT vec_id, label AS topic, round(sim, 6) AS sim FROM near")
def nearest_topics(spark, sf):
    near = topics.nearest(_vectors(spark, sf), "vec_id", "vec", _centroids(spark, sf)).where("topic IS NOT NULL")
    return near.select(F.col("id").alias("vec_id"), "topic", F.round("sim", 6).alias("sim"))


@query(
    f"""WITH {UNITS}, {CENTRES} SELECT p.vec_id, CASE WHEN p.label IS NOT NULL THEN p.label WHEN near.label IS NULL OR near.sim < (SELECT quantile_cont(sim, 0.05) FROM own) THEN -1 ELSE near.label END AS topic
    FROM post_vectors p LEFT JOIN near ON p.vec_id = near.vec_id"""
)
def assigned_topics(spark, sf):
    return topics.assign(_vectors(spark, sf), "vec_id", "label", "vec").select(F.col("id").alias("vec_id"), "topic")


@query(f"WITH {UNITS}, {CENTRES} SELECT topic, rank, vec_id, round(sim, 6) AS sim FROM (SELECT label AS topic, vec_id, sim, row_number() OVER (PARTITION BY label ORDER BY round(sim, 9) DESC, vec_id) AS rank FROM own) WHERE rank <= 5")
def representative_vectors(spark, sf):
    best = topics.representatives(topics.own_similarity(_vectors(spark, sf), "vec_id", "label", "vec", _centroids(spark, sf)))
    return best.select("topic", "rank", F.col("id").alias("vec_id"), F.round("sim", 6).alias("sim"))


@query(
    f"""WITH {UNITS}, {CENTRES}, hot AS (SELECT vec_id, cents.label FROM u, cents WHERE size > 0 AND round(list_dot_product(v, c) / size, 9) >= 0.25)
    SELECT a.label AS topic_a, b.label AS topic_b, count(*) AS cooccurrence_count, round(count(*) / (SELECT count(*) FROM u WHERE size > 0), 6) AS cooccurrence_rate,
    any_value((SELECT round(list_dot_product(x.c, y.c), 4) FROM cents x, cents y WHERE x.label = a.label AND y.label = b.label)) AS centroid_similarity
    FROM hot a JOIN hot b ON a.vec_id = b.vec_id AND a.label < b.label GROUP BY a.label, b.label HAVING count(*) / (SELECT count(*) FROM u WHERE size > 0) >= 0.002"""
)
def topic_cooccurrence(spark, sf):
    return topics.cooccurrence(_vectors(spark, sf), "vec_id", "vec", _centroids(spark, sf), soft=0.25, least=0.002)


@query(f"WITH {UNITS}, {CENTRES} SELECT a.label AS topic_a, b.label AS topic_b, round(list_dot_product(a.c, b.c), 6) AS similarity FROM cents a JOIN cents b ON a.label < b.label WHERE round(list_dot_product(a.c, b.c), 12) >= 0.1")
def centroid_graph(spark, sf):
    return topics.centroid_pairs(_centroids(spark, sf), 0.1).withColumn("similarity", F.round("similarity", 6))


KNN = """e AS (SELECT vec_id, v, size FROM (SELECT vec_id, CAST(vec AS DOUBLE[]) AS v, sqrt(list_dot_product(CAST(vec AS DOUBLE[]), CAST(vec AS DOUBLE[]))) AS size FROM post_vectors WHERE vec IS NOT NULL) WHERE size > 0),
    pairs AS (SELECT a.vec_id AS a, b.vec_id AS b, round(list_dot_product(a.v, b.v) / a.size / b.size, 9) AS w FROM e a JOIN e b ON a.vec_id <> b.vec_id),
    edges AS (SELECT least(a, b) AS src, greatest(a, b) AS dst, max(w) AS w FROM (SELECT *, row_number() OVER (PARTITION BY a ORDER BY w DESC, b) AS r FROM pairs) WHERE r <= 15 AND w >= 0 GROUP BY ALL)"""


def _edges(spark, sf):
    return stage(topics.exact_neighbours(_vectors(spark, sf), "vec_id", "vec"), "edges")


@query(f"WITH {KNN} SELECT src, dst, round(w, 6) AS weight FROM edges")
def neighbour_edges(spark, sf):
    return _edges(spark, sf).withColumn("weight", F.round("weight", 6))


@query(
    f"""WITH RECURSIVE {KNN}, bi AS MATERIALIZED (SELECT src AS x, dst AS y FROM edges WHERE w >= 0.9 UNION SELECT dst, src FROM edges WHERE w >= 0.9),
    walk(node, root) AS (SELECT x, x FROM bi UNION SELECT y, root FROM walk JOIN bi ON node = x) SELECT node, min(root) AS root FROM walk GROUP BY node HAVING min(root) <> node"""
)
def connected_components(spark, sf):
    return components.components(_edges(spark, sf).where("weight >= 0.9"), "src", "dst")


@query()
def graph_communities(spark, sf):
    ids, graph = batch.graph_of(_edges(spark, sf))
    labels, resolution = community.communities_in_range(len(ids), graph, 5, 20)
    rows = spark.createDataFrame(pa.table([ids, labels], names=["vec_id", "community"]))
    return rows.select("vec_id", F.col("community").cast("int").alias("community"), F.lit(resolution).alias("resolution"))


@query()
def density_topics(spark, sf):
    return batch.density_topics(_vectors(spark, sf), "vec_id", "vec", 5, 2).withColumnRenamed("id", "vec_id")


@query()
def meta_topics(spark, sf):
    cents = _centroids(spark, sf)
    return batch.meta_topics(cents, topics.centroid_pairs(cents, 0.1), "similarity")


@query(
    """WITH e AS (SELECT vec_id, label, CAST(vec AS DOUBLE[]) AS v FROM post_vectors WHERE label >= 0 AND vec IS NOT NULL), n AS (SELECT label, count(*) AS n FROM e GROUP BY label),
    d AS (SELECT a.vec_id, a.label AS own, b.label AS other, sum(list_distance(a.v, b.v)) AS s FROM e a JOIN e b ON a.vec_id <> b.vec_id GROUP BY ALL),
    ab AS (SELECT vec_id, max(CASE WHEN own = other THEN s / greatest(n - 1, 1) END) AS a, min(CASE WHEN own <> other THEN s / n END) AS b FROM d JOIN n ON other = n.label GROUP BY vec_id)
    SELECT round(avg(coalesce((b - a) / greatest(a, b), 0)), 6) AS silhouette FROM ab"""
)
def silhouette_score(spark, sf):
    s = topics.silhouette(_vectors(spark, sf), "vec_id", "label", "vec")
    return spark.createDataFrame([(s,)], "silhouette double").select(F.round("silhouette", 6).alias("silhouette"))


@query("SELECT min(post_id) AS first_id, 384 AS dim, CAST(1 AS DOUBLE) AS length FROM assignments WHERE clean_text <> '' GROUP BY clean_text")
def embedded_texts(spark, sf):
    unique = corpus.distinct_texts(table(spark, sf, "assignments"), "clean_text", "post_id")
    return models.embed_texts(unique, "first_id", "text").select(F.col("id").alias("first_id"), F.size("vec").alias("dim"), F.round(F.aggregate("vec", F.lit(0.0), lambda s, x: s + x * x), 4).alias("length"))


# ---- keywords

COUNTS = rf"""rows AS (SELECT topic, [w for w in string_split_regex(lower(clean_text), '[^\p{{L}}\p{{N}}_]+') if length(w) >= 2 AND NOT list_contains({STOP}, w)] AS ws FROM assignments WHERE topic >= 0 AND clean_text IS NOT NULL),
    tok AS (SELECT topic, unnest(list_concat(ws, [ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))])) AS term FROM rows),
    cnt AS (SELECT topic, term, count(*) AS n FROM tok GROUP BY ALL),
    voc AS (SELECT term, count(*) AS df, sum(n) AS f FROM cnt GROUP BY term HAVING count(*) >= 2 ORDER BY f DESC, term LIMIT 20000),
    c AS (SELECT topic, term, n, df, f FROM cnt JOIN voc USING (term)), tot AS (SELECT topic, sum(n) AS total FROM c GROUP BY topic)"""


def _counts(spark, sf):
    return stage(keywords.term_counts(spread(table(spark, sf, "assignments").select("topic", "clean_text")), "topic", "clean_text"), "counts")


@query(
    f"""WITH {COUNTS}, s AS (SELECT topic, term, round(n / (total + 1e-9) * (ln((SELECT count(DISTINCT topic) FROM c) / (df + 1.0)) + 1.0), 9) AS score FROM c JOIN tot USING (topic))
    SELECT topic, rank, term, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY score DESC, term) AS rank FROM s WHERE score > 0) WHERE rank <= 10"""
)
def topic_keywords(spark, sf):
    return keywords.ctfidf(_counts(spark, sf)).withColumn("score", F.round("score", 6))


@query(
    f"""WITH {COUNTS}, s AS (SELECT topic, term, round(n / total * ln(1 + (SELECT avg(total) FROM tot) / f), 9) AS score FROM c JOIN tot USING (topic))
    SELECT topic, rank, term, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY score DESC, term) AS rank FROM s WHERE score > 0) WHERE rank <= 10"""
)
def topic_keywords_by_size(spark, sf):
    return keywords.ctfidf_by_class_size(_counts(spark, sf)).withColumn("score", F.round("score", 6))


COMMON = COUNTS.replace("FROM cnt GROUP BY term HAVING count(*) >= 2", "FROM cnt JOIN docs USING (term) GROUP BY term HAVING count(*) >= 2 AND any_value(docs) >= 5").replace("    cnt AS", "    docs AS (SELECT term, count(DISTINCT post_id) AS docs FROM (SELECT post_id, unnest(list_concat(ws, [ws[i] || ' ' || ws[i + 1] for i in range(1, len(ws))])) AS term FROM rows) GROUP BY term),\n    cnt AS").replace("(SELECT topic, [w for", "(SELECT post_id, topic, [w for")


@query(
    f"""WITH {COMMON}, s AS (SELECT topic, term, round(n / total * ln(1 + (SELECT avg(total) FROM tot) / f), 9) AS score FROM c JOIN tot USING (topic))
    SELECT topic, rank, term, round(score, 6) AS score FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY score DESC, term) AS rank FROM s WHERE score > 0) WHERE rank <= 10"""
)
def topic_keywords_of_common_terms(spark, sf):
    """By class size, with only the terms that five texts or more have."""
    counts = keywords.term_counts(spread(table(spark, sf, "assignments").select("topic", "clean_text")), "topic", "clean_text", min_docs=5)
    return keywords.ctfidf_by_class_size(stage(counts, "counts")).withColumn("score", F.round("score", 6))


GOOD = "trim(keywords) <> '' AND lower(trim(keywords)) <> 'nan'"


@query(
    f"""WITH k AS (SELECT meta_topic, greatest(1, coalesce(n_rows, 1)) AS w, unnest(string_split(trim(keywords), ', ')) AS term FROM global_topics WHERE {GOOD}),
    s AS (SELECT meta_topic, term, CAST(sum(w) AS BIGINT) AS score FROM k WHERE term <> '' GROUP BY ALL)
    SELECT meta_topic AS topic, rank, term, score FROM (SELECT *, row_number() OVER (PARTITION BY meta_topic ORDER BY score DESC, term) AS rank FROM s) WHERE rank <= 10"""
)
def merged_keywords(spark, sf):
    return keywords.merged_keywords(table(spark, sf, "global_topics"), "meta_topic", "keywords", "n_rows")


@query(
    rf"""WITH picked AS (SELECT topic, clean_text FROM assignments WHERE topic >= 0 AND clean_text IS NOT NULL QUALIFY row_number() OVER (PARTITION BY topic ORDER BY md5(CAST(post_id AS VARCHAR)), post_id) <= 200),
    tok AS (SELECT topic, [CASE WHEN list_contains({STOP}, w) THEN '|' ELSE w END for w in string_split_regex(regexp_replace(lower(clean_text), '[^\p{{L}}\p{{N}}_\s]', ' | ', 'g'), '\s+') if w <> ''] AS ws FROM picked),
    one AS (SELECT DISTINCT topic, trim(unnest(string_split(array_to_string(ws, ' '), '|'))) AS term FROM tok),
    ph AS (SELECT topic, term, string_split(term, ' ') AS ws FROM one WHERE term <> '' AND len(string_split(term, ' ')) <= 4),
    word AS (SELECT topic, term, len(ws) AS size, unnest(ws) AS word FROM ph), s AS (SELECT topic, word, sum(size) / count(*) AS s FROM word GROUP BY ALL),
    scored AS (SELECT topic, term, round(sum(s), 6) AS score FROM word JOIN s USING (topic, word) GROUP BY ALL)
    SELECT topic, rank, term, score FROM (SELECT *, row_number() OVER (PARTITION BY topic ORDER BY score DESC, term) AS rank FROM scored) WHERE rank <= 10"""
)
def rake_phrases(spark, sf):
    return keywords.rake(table(spark, sf, "assignments"), "topic", "clean_text", "post_id")


# ---- merging topics


@query(
    f"""WITH k AS (SELECT meta_topic, unnest(string_split(trim(keywords), ', ')) AS term FROM global_topics WHERE {GOOD}),
    s AS (SELECT meta_topic, term, count(*) AS n FROM k WHERE term <> '' GROUP BY ALL),
    top AS (SELECT meta_topic, string_agg(term, ', ' ORDER BY n DESC, term) AS keywords FROM (SELECT *, row_number() OVER (PARTITION BY meta_topic ORDER BY n DESC, term) AS r FROM s) WHERE r <= 10 GROUP BY meta_topic),
    g AS (SELECT meta_topic, CAST(coalesce(sum(n_rows), 0) AS BIGINT) AS n, count(DISTINCT project_id) AS n_sources FROM global_topics GROUP BY meta_topic)
    SELECT row_number() OVER (ORDER BY n DESC, meta_topic) AS rank, meta_topic AS super_topic, n AS count, n_sources, coalesce(keywords, '') AS keywords FROM g LEFT JOIN top USING (meta_topic)"""
)
def ranked_super_topics(spark, sf):
    return merge.ranked_super_topics(table(spark, sf, "global_topics").withColumnRenamed("meta_topic", "super_topic"), "project_id")


@query("SELECT CAST(coalesce(sum(n_rows), 0) AS BIGINT) AS total_documents, count(DISTINCT meta_topic) + count(DISTINCT CASE WHEN meta_topic IS NULL THEN 1 END) AS total_super_clusters FROM global_topics")
def super_topic_totals(spark, sf):
    return merge.totals(ranked_super_topics(spark, sf))


@query(
    f"""WITH n AS (SELECT meta_topic, trim(string_split(trim(keywords), ', ')[1]) AS name, count(*) AS n FROM global_topics WHERE {GOOD} GROUP BY ALL)
    SELECT meta_topic AS super_topic, string_agg(name, ' | ' ORDER BY n DESC, name) AS top_names FROM (SELECT *, row_number() OVER (PARTITION BY meta_topic ORDER BY n DESC, name) AS r FROM n WHERE name <> '') WHERE r <= 3 GROUP BY meta_topic"""
)
def super_topic_names(spark, sf):
    rows = table(spark, sf, "global_topics").where(GOOD).select(F.col("meta_topic").alias("super_topic"), F.split(F.trim("keywords"), ", ")[0].alias("name"))
    return merge.top_names(rows, "name")


@query(
    f"""WITH p AS (SELECT meta_topic, topic_key AS o, unnest(string_split(keywords, ', ')) AS e, generate_subscripts(string_split(keywords, ', '), 1) AS p FROM global_topics WHERE {GOOD}),
    f AS (SELECT meta_topic, trim(e) AS e, min((o, p)) AS spot FROM p WHERE trim(e) <> '' GROUP BY ALL)
    SELECT meta_topic AS super_topic, string_agg(e, ' ||| ' ORDER BY spot, e) AS examples FROM (SELECT *, row_number() OVER (PARTITION BY meta_topic ORDER BY spot, e) AS r FROM f) WHERE r <= 5 GROUP BY meta_topic"""
)
def super_topic_examples(spark, sf):
    rows = table(spark, sf, "global_topics").where(GOOD).select(F.col("meta_topic").alias("super_topic"), "topic_key", F.replace("keywords", F.lit(", "), F.lit(" ||| ")).alias("examples"))
    return merge.first_examples(rows, "topic_key", "examples")


MAPPING = "m AS (SELECT DISTINCT chunk, topic, topic % 7 AS global_topic FROM assignments WHERE topic >= 0 AND topic % 5 <> 4)"


def _mapping(spark, sf):
    rows = table(spark, sf, "assignments")
    return rows, rows.where("topic >= 0 AND topic % 5 <> 4").select("chunk", "topic", (F.col("topic") % 7).alias("global_topic")).distinct()


@query(f"WITH {MAPPING} SELECT post_id, CASE WHEN a.topic = -2 THEN -2 ELSE coalesce(global_topic, -1) END AS global_topic FROM assignments a LEFT JOIN m ON a.chunk = m.chunk AND a.topic = m.topic")
def mapped_topics(spark, sf):
    return merge.apply_mapping(*_mapping(spark, sf)).select("post_id", "global_topic")


@query(
    f"""WITH {MAPPING}, l AS (SELECT chunk, topic, count(*) AS n_rows, min(topic_label) AS keywords FROM assignments WHERE topic >= 0 GROUP BY ALL),
    r AS (SELECT * FROM m LEFT JOIN l USING (chunk, topic)), k AS (SELECT global_topic, greatest(1, n_rows) AS w, unnest(string_split(trim(keywords), ', ')) AS term FROM r WHERE {GOOD}),
    s AS (SELECT global_topic, term, sum(w) AS n FROM k WHERE term <> '' GROUP BY ALL),
    top AS (SELECT global_topic, string_agg(term, ', ' ORDER BY n DESC, term) AS keywords FROM (SELECT *, row_number() OVER (PARTITION BY global_topic ORDER BY n DESC, term) AS r FROM s) WHERE r <= 10 GROUP BY global_topic)
    SELECT global_topic, CAST(sum(n_rows) AS BIGINT) AS n_rows, count(*) AS n_local_topics, any_value(coalesce(top.keywords, '')) AS keywords FROM r LEFT JOIN top USING (global_topic) GROUP BY global_topic"""
)
def global_summary(spark, sf):
    rows, mapping = _mapping(spark, sf)
    local = rows.where("topic >= 0").groupBy("chunk", "topic").agg(F.count("*").alias("n_rows"), F.min("topic_label").alias("keywords"))
    return merge.global_summary(local, mapping)


def _chunk_centroids(spark, sf):
    vecs = _vectors(spark, sf).join(table(spark, sf, "assignments").select("post_id", "chunk", "topic"), "post_id")
    rows = vecs.where("topic >= 0 AND exists(vec, x -> x <> 0)")
    parts = rows.select("chunk", "topic", F.posexplode("vec").alias("p", "x")).groupBy("chunk", "topic", "p").agg(F.avg(F.col("x").cast("double")).alias("m"))
    return stage(parts.groupBy("chunk", "topic").agg(F.transform(F.array_sort(F.collect_list(F.struct("p", "m"))), lambda s: s["m"]).alias("centroid")), "chunks")


@query()
def global_topic_mapping(spark, sf):
    return merge.global_topics(_chunk_centroids(spark, sf))


@query()
def super_topic_members(spark, sf):
    return merge.super_topics(_chunk_centroids(spark, sf), ["chunk", "topic"])


# ---- reports


@query("SELECT CAST(topic AS BIGINT) AS cluster, count(*) AS size FROM assignments WHERE topic IS NOT NULL GROUP BY topic")
def cluster_sizes(spark, sf):
    return report.cluster_sizes(table(spark, sf, "assignments").select("topic", "post_id"))


@query("SELECT count(DISTINCT topic) FILTER (topic >= 0) AS n_clusters, count(*) FILTER (topic >= 0) AS n_docs_clustered, count(*) FILTER (topic = -1) AS n_outlier, count(*) FILTER (topic = -2) AS n_filtered, (SELECT max(n) FROM (SELECT count(*) AS n FROM assignments WHERE topic >= 0 GROUP BY topic)) AS largest FROM assignments")
def cluster_summary(spark, sf):
    return report.summary(report.cluster_sizes(table(spark, sf, "assignments").select("topic")))


@query("SELECT row_number() OVER (ORDER BY n DESC, topic) AS rank, CAST(topic AS BIGINT) AS cluster, n AS size FROM (SELECT topic, count(*) AS n FROM assignments WHERE topic >= 0 GROUP BY topic) QUALIFY rank <= 10")
def largest_clusters(spark, sf):
    return report.largest(report.cluster_sizes(table(spark, sf, "assignments").select("topic")), 10)


@query("SELECT path, count(DISTINCT topic) FILTER (topic >= 0) AS n_clusters, count(*) FILTER (topic >= 0) AS n_docs_clustered FROM (SELECT chunk AS path, topic FROM assignments) GROUP BY path ORDER BY n_docs_clustered DESC, path LIMIT 1")
def headline_report(spark, sf):
    each = table(spark, sf, "assignments").groupBy(F.col("chunk").alias("path")).agg(F.count_distinct(F.when(F.col("topic") >= 0, F.col("topic"))).alias("n_clusters"), F.count_if(F.col("topic") >= 0).alias("n_docs_clustered"))
    return report.headline(each)


# ---- a few keys holding most records


def _sides(spark, sf):
    posts = table(spark, sf, "fetched_posts").select("project_id", "from_username", "engagement", "reach")
    return posts, {"posts": (posts, ["engagement", "reach"]), "rows": (table(spark, sf, "assignments").select("project_id"), []), "docs": (table(spark, sf, "documents").select("project_id", "n_chars"), ["n_chars"])}


HEAVY = " UNION ALL ".join(f"SELECT '{c}' AS key_field, {c} AS key_value FROM fetched_posts WHERE {c} IS NOT NULL GROUP BY {c} HAVING count(*) >= 0.02 * (SELECT count(*) FROM fetched_posts)" for c in ("project_id", "from_username"))


@query(HEAVY)
def p6_found(spark, sf):
    posts, sides = _sides(spark, sf)
    total = posts.agg(F.count("*").alias("total"))
    out = None
    for field, used in (("project_id", sides), ("from_username", {"posts": (posts, [])})):
        states = skew.eager_join_sums(used, field).crossJoin(F.broadcast(total))
        part = states.where("posts_rows > 0 AND posts_rows >= 0.02 * total").select(F.lit(field).alias("key_field"), F.col("key").alias("key_value"))
        out = part if out is None else out.unionByName(part)
    return out


@query(
    """SELECT coalesce(p.project_id, a.project_id, d.project_id) AS project_id, CAST(count(*) AS DOUBLE) AS joined_rows, CAST(sum(engagement) AS DOUBLE) AS joined_engagement, CAST(sum(n_chars) AS DOUBLE) AS joined_chars
    FROM (SELECT project_id, engagement FROM fetched_posts WHERE project_id IS NOT NULL) p
    FULL JOIN (SELECT project_id FROM assignments WHERE project_id IS NOT NULL) a ON p.project_id = a.project_id
    FULL JOIN (SELECT project_id, n_chars FROM documents WHERE project_id IS NOT NULL) d ON d.project_id = coalesce(p.project_id, a.project_id) GROUP BY 1"""
)
def p6_joined_projects(spark, sf):
    states = skew.eager_join_sums(_sides(spark, sf)[1], "project_id")
    return states.select(F.col("key").alias("project_id"), F.col("joined_rows").cast("double").alias("joined_rows"), F.col("joined_posts_engagement_sum").cast("double").alias("joined_engagement"), F.col("joined_docs_n_chars_sum").cast("double").alias("joined_chars"))


@query("SELECT from_username, count(*) AS posts, CAST(sum(engagement) AS BIGINT) AS engagement, CAST(coalesce(sum(reach), 0) AS BIGINT) AS reach, round(100.0 * count(*) / (SELECT count(*) FROM fetched_posts), 4) AS pct FROM fetched_posts WHERE from_username IS NOT NULL GROUP BY from_username")
def p6_users(spark, sf):
    posts = _sides(spark, sf)[0]
    total = posts.agg(F.count("*").alias("total"))
    states = skew.eager_join_sums({"posts": (posts, ["engagement", "reach"])}, "from_username").crossJoin(F.broadcast(total))
    return states.select(F.col("key").alias("from_username"), F.col("posts_rows").alias("posts"), F.col("posts_engagement_sum").alias("engagement"), F.coalesce("posts_reach_sum", F.lit(0)).alias("reach"), F.round(100.0 * F.col("posts_rows") / F.col("total"), 4).alias("pct"))


@query(
    """SELECT specific_resource_type, CAST(count(*) AS DOUBLE) AS joined_rows, CAST(sum(coalesce(n_chars, 0)) AS DOUBLE) AS joined_chars
    FROM fetched_posts p JOIN documents d ON p.project_id = d.project_id GROUP BY specific_resource_type"""
)
def p6_types(spark, sf):
    """Posts joined with the documents of their project, rolled up to the resource type of the posts."""
    rolled = skew.eager_rollup(table(spark, sf, "fetched_posts"), table(spark, sf, "documents"), "project_id", "specific_resource_type", "n_chars")
    return rolled.select("specific_resource_type", F.col("joined_rows").cast("double").alias("joined_rows"), F.col("joined_sum").cast("double").alias("joined_chars"))


# ---- the whole batch


@query()
def batch_topics(spark, sf):
    done = batch.run(spread(table(spark, sf, "fetched_posts").select("post_id", "content")), "content", "post_id")
    return done.topics.select("topic", "name", "n_rows", "n_unique", "keywords", "meta_topic")


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
