"""SQL that gives the rows of this subpackage's queries over whole tables, written apart from the operators.

Queries that count tokens of a vocabulary file, detect entities, predict languages and levels or give neighbours with a loss have none.
"""

from __future__ import annotations

# ---- copies hidden by formatting

FOLD = r"regexp_replace(replace(lower(upper({})), 'ς', 'σ'), '[^\p{{L}}\p{{N}}]+', '', 'g')"
COPIES = rf"""t AS MATERIALIZED (SELECT post_id, content, {FOLD.format("content")} AS plain FROM fetched_posts WHERE post_id IS NOT NULL AND content IS NOT NULL),
    ok AS MATERIALIZED (SELECT * FROM t WHERE length(plain) >= $least),
    cut AS (SELECT post_id, list_filter(string_split_regex(content, '[;|\n\r\x0B\x0C\x{{85}}\x{{2028}}\x{{2029}}]'), lambda x: regexp_matches(x, '[^\s\p{{Z}}\p{{Cc}}\p{{Cf}}]')) AS ps FROM ok),
    lists AS (SELECT post_id, ps FROM cut WHERE len(ps) >= 2 AND len(list_filter(ps, lambda x: NOT regexp_matches(x, '^[^\p{{L}}\p{{N}}:=]*[\p{{L}}\p{{N}}_]+([^\p{{L}}\p{{N}}:=]+[\p{{L}}\p{{N}}_]+)?[^\p{{L}}\p{{N}}:=]*[:=]'))) = 0),
    keyed AS (SELECT post_id, 'text ' || plain AS k FROM ok UNION ALL SELECT post_id, 'list ' || array_to_string(list_sort(list_transform(ps, lambda x: {FOLD.format("x")})), chr(1)) FROM lists),
    heads AS (SELECT post_id AS x, min(post_id) OVER (PARTITION BY k) AS y FROM keyed),
    bi AS MATERIALIZED (SELECT x, y FROM heads WHERE x <> y UNION SELECT y, x FROM heads WHERE x <> y),
    walk(node, root) AS (SELECT x, x FROM bi UNION SELECT y, root FROM walk JOIN bi ON node = x),
    roots AS (SELECT node, min(root) AS root FROM walk GROUP BY node)"""

P1_FOUND = f"WITH RECURSIVE {COPIES.replace('$least', '25')} SELECT root AS first_post_id, node AS post_id FROM roots WHERE node <> root"
P1_MESSAGES = f"WITH RECURSIVE {COPIES.replace('$least', '1')} SELECT coalesce(root, post_id) AS first_post_id, count(*) AS copies FROM ok LEFT JOIN roots ON post_id = node GROUP BY 1"

# ---- clusters of similar records


def _clusters(rows: str, num: int, den: int, least: int) -> str:
    """Clusters of records (space, key, ws) that share num / den of all their words; `members` has key and first."""
    return f"""recs AS MATERIALIZED (SELECT * FROM ({rows}) WHERE len(ws) >= {least}),
    sets AS MATERIALIZED (SELECT space, ws, min(key) AS k FROM recs GROUP BY space, ws),
    w AS (SELECT space, k, len(ws) AS n, unnest(ws) AS w FROM sets),
    near AS (SELECT a.k AS x, b.k AS y FROM w a JOIN w b ON a.space = b.space AND a.w = b.w AND a.k < b.k GROUP BY a.k, b.k, a.n, b.n HAVING {den} * count(*) >= {num} * (a.n + b.n - count(*))),
    same AS (SELECT key AS x, min(key) OVER (PARTITION BY space, ws) AS y FROM recs),
    bi AS MATERIALIZED (SELECT x, y FROM near UNION SELECT y, x FROM near UNION SELECT x, y FROM same WHERE x <> y UNION SELECT y, x FROM same WHERE x <> y),
    walk(node, root) AS (SELECT x, x FROM bi UNION SELECT y, root FROM walk JOIN bi ON node = x),
    members AS MATERIALIZED (SELECT node AS key, min(root) AS first FROM walk GROUP BY node)"""


POSTS = r"SELECT chunk AS space, post_id AS key, list_sort(list_distinct(list_filter(string_split_regex(lower(clean_text), '[^\p{L}\p{N}_]+'), lambda x: x <> ''))) AS ws FROM assignments WHERE clean_text IS NOT NULL AND chunk IS NOT NULL"
TOPICS = "SELECT 'all' AS space, topic_key AS key, list_sort(list_distinct(list_filter(list_transform(string_split(lower(trim(keywords)), ','), lambda x: trim(x)), lambda x: x <> ''))) AS ws FROM global_topics WHERE trim(keywords) <> '' AND lower(trim(keywords)) <> 'nan'"
KINDS = {"post": _clusters(POSTS, 6, 10, 8), "topic": _clusters(TOPICS, 5, 10, 1)}
P3_FOUND = " UNION ALL ".join(f"SELECT * FROM (WITH RECURSIVE {w} SELECT '{kind}' AS record_kind, first AS first_key, key AS member_key FROM members WHERE key <> first)" for kind, w in KINDS.items())

MEDOIDS = """own AS (SELECT space, first, key, ws FROM members JOIN recs USING (key)),
    spread AS (SELECT first, key, len(ws) AS n, unnest(ws) AS w FROM own),
    sums AS (SELECT first, w, sum(1 / sqrt(n)) AS c FROM spread GROUP BY first, w),
    size AS (SELECT first, count(*) AS members FROM own GROUP BY first),
    score AS (SELECT s.first, key, round(sum(c) / sqrt(any_value(n)) / any_value(members), 6) AS typical FROM spread s JOIN sums USING (first, w) JOIN size ON s.first = size.first GROUP BY s.first, key)
    SELECT space, first, members, rank, key, typical FROM (SELECT score.*, row_number() OVER (PARTITION BY first ORDER BY typical DESC, key) AS rank FROM score) JOIN size USING (first) JOIN (SELECT key AS first, space FROM own) USING (first) WHERE rank <= 3"""
P3_CLUSTERS = " UNION ALL ".join(f"SELECT *, '{kind}' AS record_kind FROM (WITH RECURSIVE {w}, {MEDOIDS})" for kind, w in KINDS.items())

# ---- similar vectors

PAIRS = """u AS MATERIALIZED (SELECT DISTINCT vec_id AS id, CAST(vec AS DOUBLE[]) AS v FROM post_vectors WHERE vec IS NOT NULL AND list_dot_product(CAST(vec AS DOUBLE[]), CAST(vec AS DOUBLE[])) > 0),
    pairs AS (SELECT a.id AS a, b.id AS b, round(list_dot_product(a.v, b.v) / sqrt(list_dot_product(a.v, a.v) * list_dot_product(b.v, b.v)), 12) AS c FROM u a JOIN u b ON a.id <> b.id),
    best AS (SELECT a, b, c, row_number() OVER (PARTITION BY a ORDER BY c DESC, b) AS r FROM pairs QUALIFY r <= 5)"""
P5_FOUND = f"WITH {PAIRS} SELECT DISTINCT least(a, b) AS vec_a, greatest(a, b) AS vec_b FROM best WHERE c >= 0.9"

# ---- distinctive terms


def _terms(table: str, key: str, text: str, kind: str, rest: str) -> str:
    return rf"""SELECT * FROM (WITH runs AS (SELECT {key} AS record_key, unnest(regexp_extract_all(lower({text}), '\p{{L}}+')) AS term FROM {table} WHERE {key} IS NOT NULL),
    tf AS (SELECT record_key, term, count(*) AS tf FROM runs GROUP BY ALL), lens AS (SELECT record_key, count(*) AS length FROM runs GROUP BY ALL),
    df AS (SELECT term, count(*) AS df, sum(tf) AS total FROM tf GROUP BY term), n AS (SELECT count(*) AS records, sum(length) / count(*) AS mean FROM lens)
    SELECT '{kind}' AS record_kind, record_key, term{rest})"""


FEW = " FROM tf JOIN df USING (term) WHERE tf >= 3 AND df BETWEEN 2 AND 12"
SCORED = """, tf, df, round((log2(1 + total / records) + tf * log2(1 + mean / length) * log2((1 + total / records) / (total / records))) / (tf * log2(1 + mean / length) + 1), 6) AS score
    FROM tf JOIN df USING (term) JOIN lens USING (record_key), n"""
KEYS = (("fetched_posts", "post_id", "content", "post"), ("global_topics", "topic_key", "keywords", "topic"))
P7_FOUND = " UNION ALL ".join(_terms(*k, FEW) for k in KEYS)
P7_SCORES = " UNION ALL ".join(_terms(*k, SCORED) for k in KEYS)

# ---- leaked items

WORDS = r"regexp_extract_all(lower(regexp_replace(text, '</?[a-zA-Z][^<>]*>', ' ', 'g')), '[\p{L}\p{N}]+')"
LEAKS = f"""docs AS (SELECT DISTINCT doc_id, {WORDS} AS ws FROM documents WHERE text <> ''), items AS (SELECT item_id, {WORDS} AS ws FROM eval_items WHERE text <> ''),
    d AS (SELECT doc_id, i, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM docs)),
    e AS (SELECT DISTINCT item_id, array_to_string(ws[i:i + 7], ' ') AS g FROM (SELECT item_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM items)),
    hits AS (SELECT doc_id, item_id, count(*) AS runs FROM d JOIN e USING (g) GROUP BY doc_id, item_id)"""
P8_FOUND = f"WITH {LEAKS} SELECT doc_id, item_id FROM hits"
P8_ITEMS = f"WITH {LEAKS} SELECT item_id, any_value(task) AS task, count(doc_id) AS documents, coalesce(max(runs), 0) AS most_runs FROM eval_items LEFT JOIN hits USING (item_id) GROUP BY item_id"
P8_LEAKS = f"""WITH {LEAKS}, places AS (SELECT item_id, i, array_to_string(ws[i:i + 7], ' ') AS g, len(ws) AS size FROM (SELECT item_id, ws, unnest(range(1, len(ws) - 6)) AS i FROM items)),
    held AS (SELECT DISTINCT doc_id, item_id, size, unnest(range(places.i, places.i + 8)) AS place FROM d JOIN places USING (g)), share AS (SELECT doc_id, item_id, round(count(*) / any_value(size), 6) AS covered FROM held GROUP BY doc_id, item_id)
    SELECT doc_id, item_id, runs, covered FROM hits JOIN share USING (doc_id, item_id)"""

# ---- source mixture: words and marks as tokens, as any common way to count them gives the same sources

PLAIN = "translate(lower(trim(source)), '- ', '__')"
P9_FOUND = rf"""WITH n AS (SELECT {PLAIN} AS plain, sum(len(regexp_extract_all(coalesce(text, ''), '\p{{L}}+|\p{{N}}+|[^\p{{L}}\p{{N}}\s]'))) AS tokens FROM documents GROUP BY 1),
    t AS (SELECT source, target_share, max_repeats, coalesce(tokens, 0) AS tokens FROM mix_targets LEFT JOIN n ON {PLAIN} = plain)
    SELECT source FROM t WHERE tokens * max_repeats < target_share * (SELECT sum(tokens) FROM t)"""

# ---- reading level: abbreviations whose dot ends no sentence

SHORT = "a.n|al|bpk|cf|dk|dkk|dll|dr|drs|dsb|dst|eg|etc|gg|hal|hlm|ibid|ie|ir|jl|jln|jr|kab|kec|kel|km|mr|mrs|ms|no|nomor|pkl|prof|rp|rt|rw|sdr|sr|st|tel|telp|tgl|tlp|ttd|vs|yth".replace(".", r"\.")
CALM = r"regexp_replace(regexp_replace(regexp_replace(text, '</?[a-zA-Z][^<>]*>|&#?[\p{L}\p{N}_]+;', ' ', 'g'), '(https?://|www\.)\S*?([.!?…]*)(\s|$)', ' x \2 ', 'g'), '([0-9])\.([0-9])', '\1\2', 'g')"
for _ in range(2):
    CALM = rf"regexp_replace({CALM}, '(^|[^\p{{L}}\p{{N}}])({SHORT})\.($|[^.])', '\1 x \3', 'gi')"
P10_FOUND = rf"""WITH d AS (SELECT doc_id, regexp_extract_all(regexp_replace(text, '</?[a-zA-Z][^<>]*>|&#?[\p{{L}}\p{{N}}_]+;', ' ', 'g'), '\p{{L}}+') AS ws,
    len(list_filter(string_split_regex({CALM}, '[.!?…]+'), lambda x: regexp_matches(x, '\p{{L}}'))) AS s FROM documents WHERE regexp_matches(text, '[^\s\p{{Z}}\p{{Cc}}\p{{Cf}}]')),
    m AS (SELECT doc_id, len(ws) AS w, s, coalesce(list_sum(list_transform(ws, lambda x: length(x))), 0) AS l FROM d)
    SELECT doc_id, CASE WHEN w = 0 OR (w < 10 * s AND l < 5.3 * w) THEN 'easy' WHEN w >= 20 * s AND l >= 5.8 * w THEN 'hard' ELSE 'medium' END AS band FROM m"""


def oracle_sql() -> dict[str, str]:
    return {
        "p1_found": P1_FOUND, "p1_messages": P1_MESSAGES, "p3_found": P3_FOUND, "p3_clusters": P3_CLUSTERS, "p5_found": P5_FOUND,
        "p7_found": P7_FOUND, "p7_scores": P7_SCORES, "p8_found": P8_FOUND, "p8_leaks": P8_LEAKS, "p8_items": P8_ITEMS, "p9_found": P9_FOUND, "p10_found": P10_FOUND,
    }
