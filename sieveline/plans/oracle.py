"""Comparison SQL of the registered queries, one statement per query."""

from __future__ import annotations

from .oracle_parts import BATCH, CLEAN, batched, confusion, statement

SQL: dict[str, str] = {}

#: The checkpoints that score row by row: every tenth one and the last.  The network and curves have all.
TESTED = "checkpoint > 0 AND (checkpoint % 10 = 0 OR checkpoint = (SELECT max(batch_no) FROM rows))"


def sql(name: str, select: str, *needs: str) -> None:
    SQL[name] = statement(select, *needs)


sql("concat_joint", "SELECT doc_id AS row_id, lang || ' ' || text AS joint FROM documents")
sql("label_encode", "SELECT row_id, CASE WHEN feature2 = 'spam' THEN 1 ELSE 0 END AS y FROM mail", "mail")
sql("clean_steps", r"""
SELECT doc_id AS row_id, md5(lower(text)) AS lowered, md5(replace(lower(text), '\r\n', ' ')) AS unescaped,
       md5(regexp_replace(replace(lower(text), '\r\n', ' '), '[^a-zA-Z]', ' ', 'g')) AS letters,
       md5(regexp_replace(regexp_replace(replace(lower(text), '\r\n', ' '), '[^a-zA-Z]', ' ', 'g'), '\s+', ' ', 'g')) AS collapsed
FROM documents""")
sql("text_clean", "SELECT row_id, cleaned FROM texts", "texts")
sql("page_clean", f"SELECT page_id, {CLEAN.format('html')} AS cleaned FROM pages")

for _name, _table, _count, _out in (
    ("tokenize", "doc_tokens", "n_tokens", "tokens"),
    ("stopword_filter", "doc_kept", "n_kept", "kept"),
):
    sql(_name, f"""
SELECT d.doc_id AS row_id, CAST(count(t.w) AS INTEGER) AS {_count}, coalesce(string_agg(t.w, ' ' ORDER BY t.pos), '') AS {_out}
FROM documents d LEFT JOIN {_table} t ON t.row_id = d.doc_id GROUP BY d.doc_id""", _table)

sql("porter_stem", "SELECT token, s AS stem FROM doc_stems", "doc_stems")
for _name, _out, _where in (("preprocess", "processed", ""), ("vectorizer_tokens", "tokens", "AND length(t.s) > 1")):
    sql(_name, f"""
SELECT d.doc_id AS row_id, coalesce(string_agg(t.s, ' ' ORDER BY k.pos), '') AS {_out}
FROM documents d LEFT JOIN (doc_kept k JOIN doc_stems t ON k.w = t.token {_where}) ON k.row_id = d.doc_id
GROUP BY d.doc_id""", "doc_kept", "doc_stems")
sql("truncate3", "SELECT event_id, CASE WHEN value < 0 THEN ceil(value * 1000) ELSE floor(value * 1000) END / 1000.0 AS truncated FROM events")

def _hash_of_words() -> str:
    """The hash of words as they are; the feature tables hash their stems."""
    text = statement("""
SELECT s AS token, h AS murmur3, CAST(abs(h) % 512 AS INTEGER) AS bucket,
       CAST(('0x' || substr(md5(s), 1, 8))::BIGINT % 512 AS INTEGER) AS md5_bucket FROM doc_hashes""", "doc_hashes")
    return text.replace("FROM (SELECT DISTINCT s FROM doc_stems)", "FROM (SELECT DISTINCT w AS s FROM doc_kept)")


SQL["hash_bucket"] = _hash_of_words()
sql("bucket_tf", "SELECT row_id, bucket, n AS tf FROM doc_tf", "doc_tf")
sql("l2_features", "SELECT row_id, bucket, round(x, 6) AS x FROM doc_x", "doc_x")
sql("feature_rows", """
SELECT m.row_id, CASE WHEN m.feature2 = 'spam' THEN 1 ELSE 0 END AS y, x.bucket, round(x.x, 6) AS x
FROM mail m JOIN mail_x x ON m.row_id = x.row_id""", "mail", "mail_x")
sql("dense_vector", """
SELECT r.row_id, CAST(b.bucket AS INTEGER) AS bucket, round(coalesce(f.x, 0.0), 6) AS x
FROM all_rows r JOIN (SELECT unnest(range(512)) AS bucket) b ON true
LEFT JOIN all_features f ON f.row_id = r.row_id AND f.bucket = b.bucket""", "all_rows", "all_features")

sql("batch_assign", f"SELECT row_id, row_no, batch_no, row_in_batch FROM ({batched('mail', 'row_id', BATCH, True)})", "mail")
sql("batch_assign_events", f"SELECT event_id, row_no, batch_no, row_in_batch FROM ({batched('events', 'ts, event_id', 1000, True)})")
sql("batch_assign_orders", f"SELECT o_orderkey, batch_no, row_in_batch FROM ({batched('orders', 'o_orderkey', 1024, True)})")
SQL["replay_files_in_order"] = """
WITH numbered AS (
  SELECT doc_id, CAST(regexp_extract(source, '([0-9]+)$', 1) AS INTEGER) AS file_no,
         row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS row_no, count(*) OVER (PARTITION BY source) AS n
  FROM documents),
cut AS (
  SELECT doc_id, file_no, CAST(row_no // 16 + 1 AS BIGINT) AS file_batch_no, CAST(row_no % 16 AS INTEGER) AS row_in_batch
  FROM numbered WHERE row_no < n - n % 16 OR n % 16 = 15)
SELECT doc_id, file_no, file_batch_no, CAST(file_batch_no + earlier AS BIGINT) AS batch_no, row_in_batch
FROM cut JOIN (
  SELECT file_no, sum(batches) OVER (ORDER BY file_no) - batches AS earlier
  FROM (SELECT file_no, max(file_batch_no) AS batches FROM cut GROUP BY file_no)) USING (file_no)"""
sql("replay_epochs_twice", f"""
SELECT doc_id, epoch, CAST(batch_no + epoch * max(batch_no) OVER () AS BIGINT) AS batch_no, row_in_batch
FROM ({batched('labels', 'doc_id', 50, True)}), (SELECT CAST(unnest([0, 1]) AS INTEGER) AS epoch)""")
sql("dataset_select", "SELECT row_id, CASE WHEN row_id % 5 = 0 THEN 'test' ELSE 'train' END AS split FROM mail", "mail")
sql("batch_sizes", "SELECT batch_no, count(*) AS n, string_agg(DISTINCT y, ',' ORDER BY y) AS labels FROM all_rows GROUP BY batch_no", "all_rows")

_messages = f"SELECT batch_no, row_in_batch, feature0, feature1, feature2 FROM ({batched('mail', 'row_id', BATCH)})"
sql("columnar_roundtrip", _messages, "mail")
sql("stream_decode", _messages, "mail")
for _name in ("record_map_roundtrip", "nested_map_roundtrip"):
    sql(_name, f"""
SELECT batch_no, row_in_batch, label, CAST(pos - 1 AS INTEGER) AS pos, CAST(floor(CAST(v AS DOUBLE) * 1000) AS INTEGER) AS pixel
FROM (SELECT batch_no, row_in_batch, label, unnest(embedding) AS v, generate_subscripts(embedding, 1) AS pos
      FROM ({batched('embeddings', 'vec_id', 64)}))""")
sql("lines_roundtrip", f"""
SELECT batch_no, row_in_batch AS pos, line || chr(10) AS line
FROM ({batched('''(SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
  generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM conversations)''', 'conv_id, turn, line_no', 100)})""")
_pixels = "CAST(floor(CAST(embedding[{}] AS DOUBLE) * 1000) AS INTEGER)"
_keyed = "string_agg('\"' || row_in_batch || '\":' || record, ',' ORDER BY row_in_batch)"
_cube = "list_transform(range(4), lambda i: list_transform(range(4), lambda j: list_transform(range(4), lambda k: " + _pixels.format("i * 16 + j * 4 + k + 1") + ")))"
_texts = {
    "columnar": f"""
SELECT batch_no, '{{"first_row":0,' || string_agg('"feature' || i || '":' || column_text, ',' ORDER BY i) || '}}' AS payload FROM (
  SELECT batch_no, 0 AS i, to_json(list(feature0 ORDER BY row_in_batch))::VARCHAR AS column_text FROM sent GROUP BY batch_no
  UNION ALL SELECT batch_no, 1, to_json(list(feature1 ORDER BY row_in_batch))::VARCHAR FROM sent GROUP BY batch_no
  UNION ALL SELECT batch_no, 2, to_json(list(feature2 ORDER BY row_in_batch))::VARCHAR FROM sent GROUP BY batch_no) GROUP BY batch_no""",
    "record map": f"""
SELECT batch_no, '{{' || {_keyed} || '}}' AS payload FROM (
  SELECT batch_no, row_in_batch, '{{' || array_to_string(list_transform(range(len(embedding)),
    lambda i: '"feature' || i || '":' || {_pixels.format('i + 1')}), ',') || ',"label":' || label || '}}' AS record FROM images) GROUP BY batch_no""",
    "nested record map": f"""
SELECT batch_no, '{{' || {_keyed} || '}}' AS payload FROM (
  SELECT batch_no, row_in_batch, '{{"img":' || to_json({_cube})::VARCHAR || ',"label":' || label || '}}' AS record FROM images) GROUP BY batch_no""",
    "lines": """
SELECT batch_no, to_json(list(line || chr(10) ORDER BY row_in_batch))::VARCHAR AS payload FROM said GROUP BY batch_no""",
}
_said = batched("""(SELECT conv_id, turn, unnest(string_split(text, chr(10))) AS line,
  generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM conversations)""", "conv_id, turn, line_no", 100)
sql("payload_texts", f"""
SELECT shape, batch_no, CAST(length(payload) AS INTEGER) AS n_chars, md5(payload) AS digest
FROM (WITH sent AS ({batched('mail', 'row_id', BATCH)}), images AS ({batched('embeddings', 'vec_id', 64)}), said AS ({_said})
      """ + " UNION ALL ".join(f"SELECT '{shape}' AS shape, * FROM ({text})" for shape, text in _texts.items()) + ")", "mail")
sql("text_scan_batches", f"""
SELECT batch_no, count(*) AS n_lines
FROM ({batched("(SELECT unnest(string_split(text, chr(10))) AS line FROM benchmark)", "line", 10)}) GROUP BY batch_no""")
sql("csv_scan_rows", "SELECT feature0, feature1, feature2 FROM mail", "mail")

sql("nb_batch_sums", """
SELECT batch_no, CAST(2 + y * 512 + bucket AS INTEGER) AS slot, round(s, 6) AS s FROM nb_sums
UNION ALL SELECT batch_no, y, CAST(count(*) AS DOUBLE) FROM rows GROUP BY batch_no, y""", "nb_sums", "rows")
sql("nb_model", """
SELECT batch_no, CAST(y AS INTEGER) AS y, CAST(bucket AS INTEGER) AS bucket,
       round(log_prior, 6) AS log_prior, round(log_likelihood, 6) AS log_likelihood FROM nb_models""", "nb_models")
sql("nb_predict", """
SELECT row_id, batch_no, truth, round(decision, 6) AS decision, prediction
FROM nb_predictions WHERE checkpoint = batch_no""", "nb_predictions")

_LOG = "SELECT model, batch_no, n, tp, fp, fn, tn, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall"
_TRAIN = "(SELECT * FROM predictions WHERE checkpoint = batch_no)"
sql("nb_train_metrics", f"""
{_LOG} FROM ({confusion("(SELECT 'Multinomial Naive Bayes' AS model, * FROM nb_predictions WHERE checkpoint = batch_no)", 'model', 'batch_no')})""", "nb_predictions")

_flags = "(SELECT *, toxic AS truth, quality AS prediction FROM (" + batched("labels", "doc_id", 50) + "))"
sql("accuracy_by_batch", f"SELECT batch_no, n, round(accuracy, 6) AS accuracy FROM ({confusion(_flags, 'batch_no')})")
sql("precision_recall", f"SELECT batch_no, round(precision, 6) AS precision, round(recall, 6) AS recall FROM ({confusion(_flags, 'batch_no')})")
sql("confusion_matrix", f"SELECT batch_no, truth, prediction, count(*) AS n FROM {_flags} GROUP BY ALL")


def dual(table: str, *keys: str) -> str:
    """Metrics as they are and with the truth flipped."""
    flipped = f"(SELECT * REPLACE (1 - truth AS truth) FROM {table})"
    using = ", ".join(keys)
    columns = ", ".join(
        f"round({t}.{m}, 6) AS {m}_spam_{s}" for t, s in (("a", 1), ("z", 0)) for m in ("accuracy", "precision", "recall")
    )
    return f"SELECT {using}, a.n, {columns} FROM ({confusion(table, *keys)}) a JOIN ({confusion(flipped, *keys)}) z USING ({using})"


sql("dual_polarity", f"SELECT * EXCLUDE (n) FROM ({dual(_flags, 'batch_no')})")
sql("error_rate", f"""
SELECT batch_no, round(avg(CASE WHEN prediction <> truth THEN 1.0 ELSE 0.0 END), 6) AS error_rate FROM {_flags} GROUP BY batch_no""")
sql("label_flip", f"""
SELECT batch_no, n, tp, fp, fn, tn, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall
FROM ({confusion(f'(SELECT * REPLACE (1 - prediction AS prediction) FROM {_flags})', 'batch_no')})""")

for _name, _batch in (("kmeans_init", 0), ("kmeans_step", 1)):
    sql(_name, f"""
SELECT CAST(k AS INTEGER) AS cluster, CAST(b AS INTEGER) AS bucket,
       round(CASE WHEN k = 0 THEN c0[b + 1] ELSE c1[b + 1] END, 6) AS value
FROM kmeans_run, (SELECT unnest([0, 1]) AS k), (SELECT unnest(range(512)) AS b) WHERE batch_no = {_batch}""", "kmeans_run")
sql("kmeans_seeded_init", """
SELECT CAST(k AS INTEGER) AS cluster, CAST(b AS INTEGER) AS bucket,
       round(CASE WHEN k = 0 THEN c0[b + 1] ELSE c1[b + 1] END, 6) AS value
FROM kmeans_drawn, (SELECT unnest([0, 1]) AS k), (SELECT unnest(range(512)) AS b)""", "kmeans_drawn")
sql("kmeans_centres", """
SELECT batch_no, CAST(k AS INTEGER) AS cluster, CASE WHEN k = 0 THEN n0 ELSE n1 END AS size, CAST(b AS INTEGER) AS bucket,
       round(CASE WHEN k = 0 THEN c0[b + 1] ELSE c1[b + 1] END, 6) AS value
FROM kmeans_run, (SELECT unnest([0, 1]) AS k), (SELECT unnest(range(512)) AS b) WHERE batch_no > 0""", "kmeans_run")
sql("kmeans_assign", """
SELECT row_id, prediction AS cluster FROM kmeans_predictions
WHERE checkpoint = (SELECT max(batch_no) FROM rows)""", "kmeans_predictions", "rows")
sql("kmeans_stream", dual("(SELECT * FROM kmeans_predictions WHERE checkpoint = batch_no)", "batch_no"), "kmeans_predictions")

for _name, _model in (("logreg", "logistic"), ("perceptron", "perceptron")):
    sql(f"{_name}_weights", f"""
SELECT batch_no, -1 AS bucket, round(b, 6) AS value FROM {_model}_models
UNION ALL SELECT batch_no, CAST(k AS INTEGER), round(w[k + 1], 6) FROM {_model}_models, (SELECT unnest(range(512)) AS k)""", f"{_model}_models")
    sql(f"{_name}_predict", f"SELECT row_id, checkpoint, truth, prediction FROM {_model}_test_predictions WHERE {TESTED}", f"{_model}_test_predictions", "rows")

sql("sharded_fit", " UNION ALL ".join(
    f"SELECT '{model}' AS model, CAST(n AS BIGINT) AS n, CAST(pos AS INTEGER) AS pos, round(value, 6) AS value FROM {name}_mean"
    for model, name in (("SGD Classifier", "logistic"), ("Perceptron", "perceptron"))
) + """
UNION ALL SELECT 'Multi Layer Perceptron', n_rows::BIGINT, CAST(k * 513 + j AS INTEGER), round(w1[k + 1][j + 1], 6)
FROM network_mean, (SELECT unnest(range(15)) AS k), (SELECT unnest(range(513)) AS j)
UNION ALL SELECT 'Multi Layer Perceptron', n_rows::BIGINT, CAST(15 * 513 + k AS INTEGER), round(w2[k + 1], 6)
FROM network_mean, (SELECT unnest(range(16)) AS k)""", "logistic_mean", "perceptron_mean", "network_mean")
sql("mlp_predict", "SELECT row_id, checkpoint, truth, prediction FROM network_test_predictions", "network_test_predictions")
sql("mlp_weights", """
SELECT batch_no, CAST(k * 513 + j AS INTEGER) AS pos, round(w1[k + 1][j + 1], 6) AS value
FROM network_run, (SELECT unnest(range(15)) AS k), (SELECT unnest(range(513)) AS j) WHERE batch_no > 0
UNION ALL SELECT batch_no, CAST(15 * 513 + k AS INTEGER), round(w2[k + 1], 6)
FROM network_run, (SELECT unnest(range(16)) AS k) WHERE batch_no > 0""", "network_run")
sql("stream_train_log", f"{_LOG} FROM ({confusion(_TRAIN, 'model', 'batch_no')})", "predictions")
sql("mlp_stream", f"{_LOG} FROM ({confusion('(SELECT * FROM network_predictions WHERE checkpoint = batch_no)', 'model', 'batch_no')})", "network_predictions")
_FINAL = "(SELECT * FROM {} WHERE checkpoint = (SELECT max(batch_no) FROM rows))"
sql("stream_test_log", f"""
SELECT p.model, p.batch_no, r.row_in_batch, p.prediction, p.truth
FROM {_FINAL.format('test_predictions')} p JOIN test_rows r ON p.row_id = r.row_id""", "test_predictions", "test_rows", "rows")
sql("cluster_test_log", f"""
SELECT p.model, p.batch_no, r.row_in_batch, p.prediction, p.truth
FROM {_FINAL.format('kmeans_test_predictions')} p JOIN test_rows r ON p.row_id = r.row_id""", "kmeans_test_predictions", "test_rows", "rows")
sql("model_latest", """
SELECT m.model, (SELECT max(batch_no) FROM rows) AS batch_no, CAST(m.n AS INTEGER) AS n_params
FROM (VALUES ('Multinomial Naive Bayes', 2 + 2 * 512), ('SGD Classifier', 1 + 512), ('Perceptron', 1 + 512),
             ('Multi Layer Perceptron', 512 * 15 + 15 + 15 + 1)) m(model, n)""", "rows")
sql("log_reset", """
SELECT 'models' AS log, max(batch_no) AS n FROM rows
UNION ALL SELECT 'train_log', 0 UNION ALL SELECT 'test_log', 0""", "rows")

_3 = "format('{{:.3f}}', {0}) AS {0}"
sql("batch_report", "SELECT model, batch_no, n AS batch_size, " + ", ".join(
    f"format('{{:.3f}}', {m}) AS {m}" for m in ("accuracy", "precision", "recall")
) + f", format('[[{{}} {{}}] [{{}} {{}}]]', tn, fp, fn, tp) AS confusion_matrix FROM ({confusion(_TRAIN, 'model', 'batch_no')})", "predictions")
_LONG = "UNPIVOT ({}) ON accuracy, precision, recall INTO NAME metric VALUE value"


def curve(table: str, *keys: str) -> str:
    counted = f"(SELECT * EXCLUDE (n, tp, fp, fn, tn) FROM ({confusion(table, *keys)}))"
    return f"SELECT {', '.join(keys)}, metric, round(value, 6) AS value FROM ({_LONG.format(f'FROM {counted}')})"


_clusters = "(SELECT * FROM kmeans_predictions WHERE checkpoint = batch_no)"
sql("cluster_report", f"""
SELECT 'Clustering' AS model, batch_no, c.n AS batch_size, {', '.join(
    f"format('{{:.3f}}', {m}_spam_{s}) AS {m}_spam_{s}" for s in (1, 0) for m in ('accuracy', 'precision', 'recall')
)}, format('[[{{}} {{}}] [{{}} {{}}]]', tn, fp, fn, tp) AS confusion_matrix_spam_1,
    format('[[{{}} {{}}] [{{}} {{}}]]', fn, tp, tn, fp) AS confusion_matrix_spam_0
FROM ({confusion(_clusters, 'batch_no')}) c JOIN ({dual(_clusters, 'batch_no')}) d USING (batch_no)""", "kmeans_predictions")
sql("train_curve_long", curve(_TRAIN, "model", "batch_no"), "predictions")
sql("train_curve_one_model", f"SELECT * EXCLUDE (model) FROM ({curve(_TRAIN, 'model', 'batch_no')}) WHERE model = 'Perceptron'", "predictions")
sql("train_curve_pivot", "SELECT metric, batch_no, " + ", ".join(
    f"""max(value) FILTER (model = '{m}') AS "{m}" """ for m in ("Multinomial Naive Bayes", "SGD Classifier", "Perceptron", "Multi Layer Perceptron")
) + f"FROM ({curve(_TRAIN, 'model', 'batch_no')}) GROUP BY metric, batch_no", "predictions")
sql("test_accuracy_bar", f"""
SELECT model, round(accuracy, 6) AS accuracy, floor(accuracy * 1000) / 1000.0 AS bar_label
FROM ({confusion(_FINAL.format('test_predictions'), 'model')})""", "test_predictions", "rows")
sql("test_curve", curve(
    f"(SELECT *, 1 AS polarity FROM test_predictions WHERE checkpoint < (SELECT max(batch_no) FROM rows))",
    "model", "polarity", "checkpoint"), "test_predictions", "rows")
sql("test_curve_clustering", curve(
    "(SELECT *, 1 AS polarity FROM kmeans_test_predictions WHERE checkpoint > 0 UNION ALL "
    "SELECT * REPLACE (1 - prediction AS prediction), 0 FROM kmeans_test_predictions WHERE checkpoint > 0)",
    "model", "polarity", "checkpoint"), "kmeans_test_predictions", "rows")
sql("mlp_test_curve", curve(
    "(SELECT *, 1 AS polarity FROM network_test_predictions WHERE checkpoint > 0)", "model", "polarity", "checkpoint"
), "network_test_predictions", "rows")
sql("preview5", f"""
SELECT model, batch_no, round(accuracy, 6) AS accuracy FROM ({confusion(_TRAIN, 'model', 'batch_no')})
WHERE model = 'Perceptron' ORDER BY batch_no LIMIT 5""", "predictions")
sql("csv_train_logs", f"""
SELECT model, batch_no, round(accuracy, 6) AS accuracy, round(precision, 6) AS precision, round(recall, 6) AS recall
FROM ({confusion(_TRAIN, 'model', 'batch_no')})""", "predictions")
sql("csv_cluster_log", f"SELECT * EXCLUDE (n) FROM ({dual('(SELECT * FROM kmeans_predictions WHERE checkpoint = batch_no)', 'batch_no')})", "kmeans_predictions")
sql("checkpoint_number", f"""
SELECT model, CAST(checkpoint AS INTEGER) AS checkpoint, checkpoint = (SELECT max(batch_no) FROM rows) AS is_final,
       count(*) AS n, count(*) FILTER (truth = prediction) AS hits
FROM (SELECT * FROM {_FINAL.format('test_predictions')} UNION ALL
      SELECT * FROM kmeans_test_predictions WHERE checkpoint > 0)
GROUP BY model, checkpoint""", "test_predictions", "kmeans_test_predictions", "rows")
sql("model_number", """
SELECT model, checkpoint, row_id, prediction, truth FROM test_predictions WHERE checkpoint IN (1, 2)""", "test_predictions")
sql("test_after_reset", """
SELECT 'Multinomial Naive Bayes' AS model, p.batch_no, r.row_in_batch, p.prediction, p.truth
FROM nb_test_predictions p JOIN test_rows r ON p.row_id = r.row_id
WHERE checkpoint = (SELECT max(batch_no) FROM rows)""", "nb_test_predictions", "test_rows", "rows")
SQL["report_metric_curves"] = SQL["train_curve_pivot"]
sql("test_curve_order", "SELECT *, CAST(row_number() OVER (PARTITION BY model, polarity, metric ORDER BY checkpoint) AS INTEGER) AS place FROM (" + curve(
    "(SELECT *, 1 AS polarity FROM kmeans_test_predictions WHERE checkpoint > 0 UNION ALL "
    "SELECT * REPLACE (1 - prediction AS prediction), 0 FROM kmeans_test_predictions WHERE checkpoint > 0)",
    "model", "polarity", "checkpoint") + ")", "kmeans_test_predictions")
SQL["preview_test_log"] = SQL["stream_test_log"] + " ORDER BY model, p.batch_no, row_in_batch LIMIT 5"
SQL["replay_epochs_stream"] = SQL["replay_epochs_twice"]
sql("stream_progress", """
SELECT 'rows' AS what, count(*) AS n FROM rows UNION ALL SELECT 'logged', max(batch_no) FROM rows
UNION ALL SELECT 'models', max(batch_no) FROM rows UNION ALL SELECT 'started', 1 UNION ALL SELECT 'terminated', 1""", "rows")
for _name in ("csv_to_log", "plain_stream_log", "nb_state_log"):
    SQL[_name] = SQL["nb_train_metrics"]
