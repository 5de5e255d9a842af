"""The registered queries of this subpackage and their SQL, where SQL can say it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import load
from . import (
    centroids, chat_format, decontaminate, licenses, line_dedup, mixing, negatives, neighbours, quality, search, simhash,
    suffix_dedup, token_store,
)

QUERIES = {}
SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op1_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    added = spark.createDataFrame(
        [(-7, 0, "user", said), (-7, 1, "assistant", said)], "conv_id long, turn long, role string, text string"
    )
    rows = load(spark, sf_dir, "conversations").select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), "role", "text"
    )
    return chat_format.format_and_read(rows.unionByName(added))


_CONTROL = (
    r"'(<)(s>|/s>|\|turn\|>|<SYS>>|</SYS>>|\|im_start\|>|\|im_end\|>|\|endoftext\|>|\|startoftext\|>|unk>|pad>)"
    r"|(\[)(INST\]|/INST\])', '\1\3\\\2\4', 'g'"
)

SQL["op1_chat_format"] = rf"""
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'
), written AS (
    SELECT *, 8 + length(replace(regexp_replace(replace(role, '\', '\\'), {_CONTROL}), chr(10), '\n'))
        + 1 + length(regexp_replace(replace(text, '\', '\\'), {_CONTROL})) + 4 AS size
    FROM turns
)
SELECT conv_id, count(*) AS n_turns,
    sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn)) AS turns_sha256,
    coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
    sha256(coalesce(string_agg(text, '' ORDER BY turn) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
    (3 + sum(size))::BIGINT AS formatted_chars
FROM written GROUP BY conv_id
"""


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = line_dedup.dedup_lines(load(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


_LOWER = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

SQL["op2_line_dedup"] = f"""
WITH split AS (
    SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents
), line AS (
    SELECT doc_id, unnest(range(len(lines))) AS pos, unnest(lines) AS line FROM split
), keyed AS (
    SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), {_LOWER}) AS key FROM line
), common AS (
    SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 20
    GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), marked AS (
    SELECT keyed.*, keeper IS NOT NULL AND keeper <> doc_id AS gone FROM keyed LEFT JOIN common USING (key)
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op3_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find(
        load(spark, sf_dir, "documents").select("doc_id", "text"), load(spark, sf_dir, "benchmark")
    )
    return found.select(
        "doc_id", "_found.n_words", "_found.n_hit", F.size("_found.items").cast("long").alias("n_items"),
        F.sha2(F.array_join("_found.items", ","), 256).alias("items_sha256"),
        decontaminate.contaminated().alias("contaminated"),
    )


_WORDS = r"'[0-9a-z\x{80}-\x{10FFFF}]+'"

SQL["op3_decontaminate"] = f"""
WITH doc AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_WORDS}) AS words FROM documents
), item AS (
    SELECT item_id::VARCHAR AS item_id, regexp_extract_all(translate(coalesce(text, ''), {_LOWER}), {_WORDS}) AS words
    FROM benchmark
), sized AS (
    SELECT item_id, words, least(13, len(words)) AS n FROM item WHERE len(words) > 0
), starts AS (
    SELECT item_id, words, n, unnest(range(1, (len(words) - n + 2)::BIGINT)) AS i FROM sized
), windows AS (
    SELECT DISTINCT item_id, n, array_to_string(words[i:i + n - 1], ' ') AS passage FROM starts
), lengths AS (
    SELECT DISTINCT n FROM windows
), places AS (
    SELECT doc_id, words, n, unnest(range(1, (len(words) - n + 2)::BIGINT)) AS i FROM doc, lengths WHERE len(words) >= n
), matched AS (
    SELECT p.doc_id, p.i, p.n, w.item_id
    FROM (SELECT doc_id, i, n, array_to_string(words[i:i + n - 1], ' ') AS passage FROM places) p
    JOIN windows w ON p.n = w.n AND p.passage = w.passage
), hit AS (
    SELECT doc_id, count(*) AS n_hit FROM (
        SELECT DISTINCT doc_id, unnest(range(i, i + n)) AS word FROM matched) GROUP BY doc_id
), items AS (
    SELECT doc_id, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS ids
    FROM (SELECT DISTINCT doc_id, item_id FROM matched) GROUP BY doc_id
)
SELECT doc_id, len(words)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
    sha256(coalesce(ids, '')) AS items_sha256,
    coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(words) AS contaminated
FROM doc LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
"""


@query
def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(load(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken", "rate", "copies")


@query
def op5_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(load(spark, sf_dir, "documents")).select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score",
    )


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(load(spark, sf_dir, "documents"), load(spark, sf_dir, "labels"))


@query
def op7_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = suffix_dedup.remove_repeats(load(spark, sf_dir, "documents"))
    return made.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query
def op8_token_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_store.store_and_read(load(spark, sf_dir, "documents"), tokenizer_path())


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_duplicates(load(spark, sf_dir, "documents"))
    return groups.select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


@query
def op10_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document whose id is divisible by 20 asks, all documents answer."""
    return search.top_k(load(spark, sf_dir, "documents"), F.col("doc_id") % 20 == 0)


@query
def op11_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whose id is divisible by 100 asks, all others answer."""
    return neighbours.search(load(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op12_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector whose id is divisible by 100 is an anchor; the label of every seventh is moved on first."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.mine(load(spark, sf_dir, "embeddings").withColumn("label", moved), F.col("vec_id") % 100 == 0)


@query
def op13_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = centroids.cluster(load(spark, sf_dir, "embeddings"))
    return made.select(
        "vec_id", "cluster", "distance", "cluster_inertia", "inertia",
        F.sha2(F.concat_ws(",", F.transform("centroid", lambda x: x.cast("string"))), 256).alias("centroid_sha256"),
    )


_FINITE = "coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), false)"
_WHOLE = "list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT)"

SQL["op12_negatives"] = f"""
WITH kept AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, {_WHOLE} AS v
    FROM embeddings WHERE label IS NOT NULL AND vec_id IS NOT NULL AND {_FINITE}
), scored AS (
    SELECT a.vec_id AS anchor_id, k.vec_id, k.label = a.label AS same,
        list_sum(list_transform(list_zip(a.v, k.v), lambda z: z[1] * z[2]))::BIGINT AS score
    FROM kept a JOIN kept k ON a.vec_id % 100 = 0 AND k.vec_id <> a.vec_id AND len(a.v) = len(k.v)
), positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT p.anchor_id, p.positive_id, (row_number() OVER one)::INTEGER AS rank, s.vec_id AS negative_id, positive_score,
    s.score AS negative_score
FROM positives p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score
WINDOW one AS (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)
QUALIFY row_number() OVER one <= 10
"""


def _centroid_sql(k: int, rounds: int) -> str:
    """Every round as two tables: who is nearest to what, and where the centroids go."""
    gap = "list_sum(list_transform(list_zip(v.v, c.v), lambda z: (z[1] - z[2]) * (z[1] - z[2])))"
    tables = [f"""
WITH kept AS (
    SELECT vec_id, {_WHOLE} AS v FROM embeddings WHERE len(embedding) = 64 AND {_FINITE}
), c0 AS (
    SELECT row_number() OVER (ORDER BY sha256('2:' || vec_id)) - 1 AS c, v FROM kept ORDER BY sha256('2:' || vec_id) LIMIT {k}
), {_nearest_sql(0, gap)}"""]
    for i in range(1, rounds + 1):
        tables.append(f"""c{i} AS (
    SELECT c.c, coalesce(m.v, c.v) AS v FROM c{i - 1} c LEFT JOIN (
        SELECT c, list((s - ((s % n) + n) % n) // n ORDER BY pos) AS v FROM (
            SELECT c, pos, sum(x)::BIGINT AS s, count(*) AS n FROM (
                SELECT c, unnest(v) AS x, unnest(range(64)) AS pos FROM a{i - 1}) GROUP BY c, pos) GROUP BY c) m USING (c)
), {_nearest_sql(i, gap)}""")
    return ", ".join(tables) + f"""
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia,
    (sum(d) OVER ())::BIGINT AS inertia, sha256(array_to_string(w, ',')) AS centroid_sha256
FROM (SELECT a.*, c{rounds}.v AS w FROM a{rounds} a JOIN c{rounds} USING (c))
"""


def _nearest_sql(i: int, gap: str) -> str:
    return f"""a{i} AS MATERIALIZED (
    SELECT vec_id, any_value(v.v) AS v, (min({gap}::BIGINT * 64 + c.c) // 64)::BIGINT AS d, min({gap}::BIGINT * 64 + c.c) % 64 AS c
    FROM kept v, c{i} c GROUP BY vec_id
)"""


SQL["op13_centroids"] = _centroid_sql(centroids.K, centroids.ROUNDS)
