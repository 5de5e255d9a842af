"""Common table expressions the comparison SQL is put together from.

The statements restate each operator in the SQL of an embedded database, long
tables and joins where the engine uses arrays, so that the two can be compared
by value on the same parquet tables.
"""

from __future__ import annotations

from ..functions import hashing as H
from ..functions import porter as P
from ..functions.text import STOP_WORDS
from ..operators.models import HIDDEN_UNITS, MLP
from ..operators.sharded import initial_state

BATCH = 100


def words(values) -> str:
    return ", ".join(f"'{v}'" for v in values)


# Stemming of a distinct vocabulary, one table per step.

def _stem(n: int) -> str:
    return f"left(w, length(w) - {n})"


def _match(text: str, pattern: str) -> str:
    return f"regexp_matches({text}, '{pattern}')"


def _rule(suffix: str, replacement: str, condition: str) -> str:
    n = len(suffix)
    return (
        f"WHEN ends_with(w, '{suffix}') THEN CASE WHEN {_match(_stem(n), condition)} "
        f"THEN {_stem(n)} || '{replacement}' ELSE w END"
    )


def _step(rules: list[str]) -> str:
    return "CASE " + " ".join(rules) + " ELSE w END"


_CUT = "CASE WHEN length(w) = 4 THEN left(w, 3) ELSE left(w, length(w) - 2) END"

_STEPS = [
    _step([
        "WHEN ends_with(w, 'sses') THEN " + _stem(2),
        f"WHEN ends_with(w, 'ies') THEN {_CUT}",
        "WHEN ends_with(w, 'ss') THEN w",
        "WHEN ends_with(w, 's') THEN " + _stem(1),
    ]),
    _step([
        f"WHEN ends_with(w, 'ied') THEN {_CUT}",
        _rule("eed", "ee", P.MEASURE_GT_0),
        _rule("ed", "|", P.HAS_VOWEL),
        _rule("ing", "|", P.HAS_VOWEL),
    ]),
    _step([
        "WHEN NOT ends_with(w, '|') THEN w",
        f"WHEN {_match(_stem(1), '(at|bl|iz)$')} THEN {_stem(1)} || 'e'",
        f"WHEN {_match(_stem(1), P.DOUBLE_CONSONANT)} THEN {_stem(2)}",
        f"WHEN {_match(_stem(1), P.DOUBLE_L_S_Z)} THEN {_stem(1)}",
        f"WHEN {_match(_stem(1), P.SHORT_STEM)} THEN {_stem(1)} || 'e'",
        f"WHEN true THEN {_stem(1)}",
    ]),
    _step([f"WHEN ends_with(w, 'y') AND length(w) > 2 AND {_match(_stem(1), P.ENDS_CONSONANT)} THEN {_stem(1)} || 'i'"]),
    _step([_rule("alli", "al", P.MEASURE_GT_0)]),
    _step(
        [_rule(s, r, P.MEASURE_GT_0) for s, r in P.STEP_2]
        + [f"WHEN ends_with(w, 'logi') THEN CASE WHEN {_match(_stem(3), P.MEASURE_GT_0)} THEN {_stem(1)} ELSE w END"]
    ),
    _step([_rule(s, r, P.MEASURE_GT_0) for s, r in P.STEP_3]),
    _step([
        _rule(s, "", P.MEASURE_GT_1) if s != "ion" else
        "WHEN ends_with(w, 'ion') THEN CASE WHEN regexp_matches(w, '[st]ion$') "
        f"AND {_match(_stem(3), P.MEASURE_GT_1)} THEN {_stem(3)} ELSE w END"
        for s in P.STEP_4
    ]),
    _step([
        f"WHEN ends_with(w, 'e') AND ({_match(_stem(1), P.MEASURE_GT_1)} OR ({_match(_stem(1), P.MEASURE_EQ_1)} "
        f"AND NOT {_match(_stem(1), P.SHORT_STEM)})) THEN {_stem(1)}"
    ]),
    _step([f"WHEN ends_with(w, 'll') AND {_match(_stem(1), P.MEASURE_GT_1)} THEN {_stem(1)}"]),
]


def _mul(a: str, c: int) -> str:
    return f"(({a}) * ({c - (1 << 32) if c >= 1 << 31 else c}) & {H.MASK})"


def _rot(a: str, bits: int) -> str:
    return f"(((({a}) << {bits}) & {H.MASK}) | (({a}) >> {32 - bits}))"


def _code(i: str, n: int) -> str:
    return " + ".join(
        f"(CASE WHEN {i} + {j} <= length(s) THEN ord(substr(s, CAST({i} + {j} AS BIGINT), 1)) ELSE 0 END)::BIGINT * {1 << (8 * (j - 1))}"
        for j in range(1, n + 1)
    )


PARTS: dict[str, tuple[str, tuple[str, ...]]] = {}


def part(name: str, sql: str, *needs: str) -> None:
    PARTS[name] = (sql, needs)


def statement(select: str, *needs: str) -> str:
    """A SELECT with the tables it needs in front, each defined once."""
    order: list[str] = []

    def visit(name: str) -> None:
        for n in PARTS[name][1]:
            visit(n)
        if name not in order:
            order.append(name)

    for n in needs:
        visit(n)
    if not order:
        return select
    tables = ",\n".join(f"{n} AS ({PARTS[n][0]})" for n in order)
    return f"WITH RECURSIVE {tables}\n{select}"


# Messages. ``mail`` has the labelled documents, ``texts`` every document.

part("mail", """
SELECT d.doc_id AS row_id, d.lang AS feature0, d.text AS feature1,
       CASE WHEN l.toxic = 1 THEN 'spam' ELSE 'ham' END AS feature2
FROM documents d JOIN labels l ON d.doc_id = l.doc_id""")

CLEAN = r"regexp_replace(regexp_replace(replace(lower({}), '\r\n', ' '), '[^a-zA-Z]', ' ', 'g'), '\s+', ' ', 'g')"

part("texts", f"SELECT doc_id AS row_id, {CLEAN.format('text')} AS cleaned FROM documents")
part("mail_texts", "SELECT row_id, " + CLEAN.format("feature0 || ' ' || feature1") + " AS cleaned FROM mail", "mail")


def add_tokens(prefix: str, texts: str) -> None:
    """Tokens, kept tokens, stems and feature entries of one set of texts."""
    part(f"{prefix}_tokens", f"""
SELECT row_id, pos, w FROM (
  SELECT row_id, unnest(string_split(cleaned, ' ')) AS w,
         generate_subscripts(string_split(cleaned, ' '), 1) AS pos FROM {texts})
WHERE w <> ''""", texts)
    part(f"{prefix}_kept", f"SELECT * FROM {prefix}_tokens WHERE w NOT IN ({words(STOP_WORDS)})", f"{prefix}_tokens")
    part(f"{prefix}_stem_0", f"SELECT DISTINCT w AS token, w FROM {prefix}_kept", f"{prefix}_kept")
    for i, step in enumerate(_STEPS):
        part(f"{prefix}_stem_{i + 1}", f"SELECT token, {step} AS w FROM {prefix}_stem_{i}", f"{prefix}_stem_{i}")
    last = f"{prefix}_stem_{len(_STEPS)}"
    irregular = " ".join(f"WHEN token = '{k}' THEN '{v}'" for k, v in P.IRREGULAR.items())
    part(f"{prefix}_stems", f"""
SELECT token, CASE WHEN length(token) <= 2 THEN token {irregular} ELSE w END AS s FROM {last}""", last)
    # Hash of each distinct stem.
    scrambled = _mul(_rot(_mul("k", H.C1), 15), H.C2)
    part(f"{prefix}_hash_1", f"""
SELECT s, length(s) AS n,
       list_transform(range(length(s) // 4), lambda i: {_code('i * 4', 4)}) AS ks,
       {_code('(length(s) // 4) * 4', 3)} AS rest
FROM (SELECT DISTINCT s FROM {prefix}_stems)""", f"{prefix}_stems")
    part(f"{prefix}_hash_2", f"""
SELECT s, xor(xor(list_reduce(list_prepend(0::BIGINT, list_transform(ks, lambda k: {scrambled})),
    lambda h, k: ({_rot('xor(h, k)', 13)} * 5 + {H.STEP_ADD}) & {H.MASK}),
    CASE WHEN n % 4 > 0 THEN {scrambled.replace('k)', 'rest)')} ELSE 0 END), n) AS h
FROM {prefix}_hash_1""", f"{prefix}_hash_1")
    part(f"{prefix}_hash_3", f"SELECT s, {_mul('xor(h, h >> 16)', H.FINAL_1)} AS h FROM {prefix}_hash_2", f"{prefix}_hash_2")
    part(f"{prefix}_hash_4", f"SELECT s, {_mul('xor(h, h >> 13)', H.FINAL_2)} AS h FROM {prefix}_hash_3", f"{prefix}_hash_3")
    part(f"{prefix}_hashes", f"""
SELECT s, CASE WHEN xor(h, h >> 16) >= 2147483648 THEN xor(h, h >> 16) - 4294967296 ELSE xor(h, h >> 16) END AS h
FROM {prefix}_hash_4""", f"{prefix}_hash_4")
    part(f"{prefix}_tf", f"""
SELECT k.row_id, CAST(abs(h.h) % 512 AS INTEGER) AS bucket, CAST(count(*) AS INTEGER) AS n
FROM {prefix}_kept k JOIN {prefix}_stems t ON k.w = t.token JOIN {prefix}_hashes h ON t.s = h.s
WHERE length(t.s) > 1 GROUP BY 1, 2""", f"{prefix}_kept", f"{prefix}_stems", f"{prefix}_hashes")
    part(f"{prefix}_x", f"""
SELECT row_id, bucket, n / sqrt(sum(n * n) OVER (PARTITION BY row_id)) AS x FROM {prefix}_tf""", f"{prefix}_tf")


add_tokens("doc", "texts")
add_tokens("mail", "mail_texts")


def batched(table: str, order: str, size: int, tail_rule: bool = False) -> str:
    """Batches of a table, the last one as short as it may be, or cut by the tail rule."""
    kept = f"row_no < n_rows - n_rows % {size} OR (n_rows % {size} = {size} - 1 AND {size} > 1)" if tail_rule else "true"
    return f"""
SELECT *, CAST(row_no // {size} + 1 AS BIGINT) AS batch_no, CAST(row_no % {size} AS INTEGER) AS row_in_batch
FROM (SELECT *, row_number() OVER (ORDER BY {order}) - 1 AS row_no, count(*) OVER () AS n_rows FROM {table})
WHERE {kept}"""


# All messages, those of the training file (no prefix) and the held-out ones.
for _prefix, _where in (("all_", "true"), ("", "row_id % 5 <> 0"), ("test_", "row_id % 5 = 0")):
    part(f"{_prefix}rows", f"""
SELECT row_id, batch_no, row_in_batch, CASE WHEN feature2 = 'spam' THEN 1 ELSE 0 END AS y
FROM ({batched(f'(SELECT * FROM mail WHERE {_where})', 'row_id', BATCH)})""", "mail")
    part(f"{_prefix}features", f"""
SELECT r.*, x.bucket, x.x FROM {_prefix}rows r JOIN mail_x x ON r.row_id = x.row_id""", f"{_prefix}rows", "mail_x")
part("batches", "SELECT DISTINCT batch_no FROM rows", "rows")

# Naive Bayes after every batch.

part("grid", """
SELECT batch_no, y, bucket FROM batches, (SELECT unnest([0, 1]) AS y), (SELECT unnest(range(512)) AS bucket)""", "batches")
part("nb_sums", "SELECT batch_no, y, bucket, sum(x) AS s FROM features GROUP BY ALL", "features")
part("nb_running", """
SELECT g.batch_no, g.y, g.bucket,
       sum(coalesce(n.s, 0)) OVER (PARTITION BY g.y, g.bucket ORDER BY g.batch_no) AS s
FROM grid g LEFT JOIN nb_sums n ON g.batch_no = n.batch_no AND g.y = n.y AND g.bucket = n.bucket""", "grid", "nb_sums")
part("nb_sizes", """
SELECT b.batch_no, c.y, (SELECT count(*) FROM rows r WHERE r.batch_no <= b.batch_no AND r.y = c.y) AS n
FROM batches b, (SELECT unnest([0, 1]) AS y) c""", "batches", "rows")
part("nb_models", """
SELECT r.batch_no, r.y, r.bucket,
       CASE WHEN z.n > 0 THEN ln(z.n) - ln(sum(z.n) OVER (PARTITION BY r.batch_no, r.bucket)) END AS log_prior,
       ln(r.s + 1) - ln(sum(r.s + 1) OVER (PARTITION BY r.batch_no, r.y)) AS log_likelihood
FROM nb_running r JOIN nb_sizes z ON r.batch_no = z.batch_no AND r.y = z.y""", "nb_running", "nb_sizes")
# Scores of every row under the model of every batch.
for _prefix in ("", "test_"):
    part(f"nb_{_prefix}scores", f"""
SELECT r.row_id, r.batch_no, r.y AS truth, p.batch_no AS checkpoint, p.y,
       p.log_prior + coalesce(sum(f.x * m.log_likelihood), 0) AS score
FROM {_prefix}rows r
JOIN (SELECT DISTINCT batch_no, y, log_prior FROM nb_models) p ON true
LEFT JOIN {_prefix}features f ON f.row_id = r.row_id
LEFT JOIN nb_models m ON m.batch_no = p.batch_no AND m.y = p.y AND m.bucket = f.bucket
GROUP BY r.row_id, r.batch_no, r.y, p.batch_no, p.y, p.log_prior""", f"{_prefix}rows", f"{_prefix}features", "nb_models")
    part(f"nb_{_prefix}predictions", f"""
SELECT row_id, batch_no, checkpoint, truth,
       max(score) FILTER (y = 1) - max(score) FILTER (y = 0) AS decision,
       CASE WHEN max(score) FILTER (y = 1) IS NULL THEN 0
            WHEN max(score) FILTER (y = 0) IS NULL THEN 1
            WHEN max(score) FILTER (y = 1) - max(score) FILTER (y = 0) > 1e-9 THEN 1 ELSE 0 END AS prediction
FROM nb_{_prefix}scores GROUP BY 1, 2, 3, 4""", f"nb_{_prefix}scores")

# Dense rows in training order, for the learners that go row by row.

for _prefix in ("", "test_"):
    part(f"{_prefix}dense", f"""
SELECT r.batch_no, r.row_in_batch, r.row_id, r.y, row_number() OVER (ORDER BY r.row_id) AS i,
       list(coalesce(f.x, 0.0) ORDER BY b.bucket) AS v
FROM {_prefix}rows r JOIN (SELECT unnest(range(512)) AS bucket) b ON true
LEFT JOIN {_prefix}features f ON f.row_id = r.row_id AND f.bucket = b.bucket
GROUP BY r.batch_no, r.row_in_batch, r.row_id, r.y""", f"{_prefix}rows", f"{_prefix}features")

ZEROS = "list_transform(range(512), lambda j: 0.0::DOUBLE)"

SHARDS = 4


def _each_shard(expression: str) -> str:
    return f"list_transform(range({SHARDS}), lambda k: {expression})"


def _by_shard(expression: str) -> str:
    """A list of what an aggregate gives for the rows of every shard."""
    return "[" + ", ".join(f"{expression} FILTER (row_in_batch % {SHARDS} = {k})" for k in range(SHARDS)) + "]"


# A batch's rows dealt into shards; a step has the next row of every shard, if it has one.
part("shard_steps", f"""
SELECT row_number() OVER (ORDER BY batch_no, p) AS i, *, p = max(p) OVER (PARTITION BY batch_no) AS last FROM (
  SELECT batch_no, row_in_batch // {SHARDS} AS p,
         {_by_shard('any_value(list_prepend(1.0::DOUBLE, v))')} AS vs, {_by_shard('any_value(y)')} AS ys
  FROM dense GROUP BY ALL)
JOIN (SELECT batch_no, count(*) AS n, {_by_shard('count(*)')} AS sizes FROM dense GROUP BY batch_no) USING (batch_no)""", "dense")
_Z, _Y = "list_dot_product(ws[k + 1], vs[k + 1])", "ys[k + 1]"
for _model, _error, _keep in (
    ("logistic", f"0.01 * (1 / (1 + exp(-{_Z})) - {_Y})", "CASE WHEN j = 0 THEN 1 ELSE 1 - 0.01 * 0.0001 END"),
    ("perceptron", f"CASE WHEN (2 * {_Y} - 1) * {_Z} <= 0 THEN 1 - 2 * {_Y} ELSE 0 END", "1"),
):
    _moved = f"list_transform(range(513), lambda j: ws[k + 1][j + 1] * ({_keep}) - steps[k + 1] * vs[k + 1][j + 1])"
    _mean = f"list_transform(range(513), lambda j: list_sum(list_transform(range({SHARDS}), lambda s: sizes[s + 1] * moved[s + 1][j + 1])) / n)"
    part(f"{_model}_run", f"""
SELECT 0::BIGINT AS i, 0::BIGINT AS batch_no, false AS last,
       {_each_shard('list_transform(range(513), lambda j: 0.0::DOUBLE)')} AS ws
UNION ALL
SELECT i, batch_no, last, CASE WHEN last THEN {_each_shard(_mean)} ELSE moved END
FROM (SELECT *, {_each_shard(f'CASE WHEN vs[k + 1] IS NULL THEN ws[k + 1] ELSE {_moved} END')} AS moved
FROM (SELECT *, {_each_shard(f'CASE WHEN vs[k + 1] IS NULL THEN 0 ELSE {_error} END')} AS steps
FROM (SELECT d.i, d.batch_no, d.last, d.vs, d.ys, d.n, d.sizes, r.ws FROM {_model}_run r JOIN shard_steps d ON d.i = r.i + 1)))""",
         "shard_steps")
for _model in ("logistic", "perceptron"):
    part(f"{_model}_models", f"SELECT batch_no, ws[1][2:] AS w, ws[1][1] AS b FROM {_model}_run WHERE last", f"{_model}_run")
    for _prefix in ("", "test_"):
        part(f"{_model}_{_prefix}predictions", f"""
SELECT d.row_id, d.batch_no, m.batch_no AS checkpoint, d.y AS truth,
       CASE WHEN list_dot_product(m.w, d.v) + m.b > 1e-9 THEN 1 ELSE 0 END AS prediction
FROM {_prefix}dense d JOIN {_model}_models m ON true""", f"{_prefix}dense", f"{_model}_models")

# The whole table as one batch, dealt into shards that each learn from zero.
part("mail_vectors", """
SELECT row_id, y, v, row_number() OVER (ORDER BY row_id) - 1 AS row_no, count(*) OVER () AS n FROM (
SELECT m.row_id, m.y, list(coalesce(x.x, 0.0) ORDER BY b.bucket) AS v
FROM (SELECT row_id, CASE WHEN feature2 = 'spam' THEN 1 ELSE 0 END AS y FROM mail) m
JOIN (SELECT unnest(range(512)) AS bucket) b ON true
LEFT JOIN mail_x x ON x.row_id = m.row_id AND x.bucket = b.bucket GROUP BY m.row_id, m.y)""", "mail", "mail_x")
part("shard_rows", """
SELECT shard, row_number() OVER (PARTITION BY shard ORDER BY row_no) AS i, y, v
FROM (SELECT *, row_no % 8 AS shard FROM mail_vectors)""", "mail_vectors")
for _model, _error, _keep in (
    ("logistic", "0.01 * (1 / (1 + exp(-z)) - y)", "1 - 0.01 * 0.0001"),
    ("perceptron", "CASE WHEN (2 * y - 1) * z <= 0 THEN 1 - 2 * y ELSE 0 END", "1"),
):
    part(f"{_model}_shards", f"""
SELECT DISTINCT shard, 0::BIGINT AS i, {ZEROS} AS w, 0.0::DOUBLE AS b FROM shard_rows
UNION ALL
SELECT shard, i, list_transform(range(512), lambda j: w[j + 1] * ({_keep}) - step * v[j + 1]), b - step
FROM (SELECT shard, i, v, w, b, {_error} AS step
      FROM (SELECT r.shard, d.i, d.y, d.v, r.w, r.b, list_dot_product(r.w, d.v) + r.b AS z
            FROM {_model}_shards r JOIN shard_rows d ON d.shard = r.shard AND d.i = r.i + 1))""", "shard_rows")
    part(f"{_model}_mean", f"""
SELECT pos, sum(size) AS n, sum(size * CASE WHEN pos = 0 THEN b ELSE w[pos] END) / sum(size) AS value
FROM {_model}_shards JOIN (SELECT shard, max(i) AS size FROM shard_rows GROUP BY shard) USING (shard),
     (SELECT unnest(range(513)) AS pos)
WHERE i = size GROUP BY pos""", f"{_model}_shards")

# Predictions of all four by row and checkpoint.
for _prefix in ("", "test_"):
    part(f"{_prefix}predictions", f"""
SELECT 'Multinomial Naive Bayes' AS model, row_id, batch_no, checkpoint, truth, prediction FROM nb_{_prefix}predictions
UNION ALL SELECT 'SGD Classifier', row_id, batch_no, checkpoint, truth, prediction FROM logistic_{_prefix}predictions
UNION ALL SELECT 'Perceptron', row_id, batch_no, checkpoint, truth, prediction FROM perceptron_{_prefix}predictions
UNION ALL SELECT model, row_id, batch_no, checkpoint, truth, prediction FROM network_{_prefix}predictions""",
         *[f"{m}_{_prefix}predictions" for m in ("nb", "logistic", "perceptron", "network")])

# The network with a hidden layer: one Adam step per batch and shard, since the 25
# rows of a shard are one mini-batch.  Its random start is written out as a literal.

_U = 1 + H.N_BUCKETS
_START = initial_state(MLP).params


def _literal(numbers) -> str:
    return "[" + ", ".join(repr(float(n)) for n in numbers) + "]"


_HIDDEN_START = "[" + ", ".join(_literal(_START[k * _U:(k + 1) * _U]) for k in range(HIDDEN_UNITS)) + "]"
_ZERO_UNIT = f"list_transform(range({_U}), lambda j: 0.0::DOUBLE)"
_ZERO_HIDDEN = f"list_transform(range({HIDDEN_UNITS}), lambda k: {_ZERO_UNIT})"
_ZERO_OUT = f"list_transform(range({HIDDEN_UNITS + 1}), lambda k: 0.0::DOUBLE)"


def _each_weight(expression: str) -> str:
    """An array like the hidden layer, from an expression over unit k and input j."""
    return f"list_transform(range({HIDDEN_UNITS}), lambda k: list_transform(range({_U}), lambda j: {expression}))"


def _each_out(expression: str) -> str:
    return f"list_transform(range({HIDDEN_UNITS + 1}), lambda k: {expression})"


_RATE = "0.001 * sqrt(1 - 0.999 ** t) / (1 - 0.9 ** t)"


def _network_step(keys: str, source: str) -> str:
    """States after one mini-batch each, from states joined with ``t, xs, ys, n``."""
    return f"""
SELECT {keys}, n, {_each_weight(f'w1[k + 1][j + 1] - {_RATE} * m1[k + 1][j + 1] / (sqrt(v1[k + 1][j + 1]) + 1e-8)')} AS w1,
       {_each_out(f'w2[k + 1] - {_RATE} * m2[k + 1] / (sqrt(v2[k + 1]) + 1e-8)')} AS w2, m1, v1, m2, v2
FROM (SELECT {keys}, step AS t, n, w1, w2,
             {_each_weight('0.9 * m1[k + 1][j + 1] + 0.1 * g1[k + 1][j + 1]')} AS m1,
             {_each_weight('0.999 * v1[k + 1][j + 1] + 0.001 * g1[k + 1][j + 1] ** 2')} AS v1,
             {_each_out('0.9 * m2[k + 1] + 0.1 * g2[k + 1]')} AS m2,
             {_each_out('0.999 * v2[k + 1] + 0.001 * g2[k + 1] ** 2')} AS v2
FROM (SELECT {keys}, step, n, w1, w2, m1, v1, m2, v2,
             {_each_weight('(list_dot_product(back[k + 1], columns[j + 1]) + CASE WHEN j = 0 THEN 0 ELSE 1e-4 * w1[k + 1][j + 1] END) / n')} AS g1,
             {_each_out('(list_dot_product(errors, outs[k + 1]) + CASE WHEN k = 0 THEN 0 ELSE 1e-4 * w2[k + 1] END) / n')} AS g2
FROM (SELECT *, list_transform(range({_U}), lambda j: list_transform(xs, lambda x: x[j + 1])) AS columns,
             {_each_out('list_transform(hs, lambda h: CASE WHEN k = 0 THEN 1.0 ELSE h[k] END)')} AS outs,
             list_transform(range({HIDDEN_UNITS}), lambda k: list_transform(range(n), lambda i:
               errors[i + 1] * w2[k + 2] * (1 - hs[i + 1][k + 1] ** 2))) AS back
FROM (SELECT *, list_transform(range(n), lambda i: 1 / (1 + exp(-(w2[1] + list_dot_product(w2[2:], hs[i + 1])))) - ys[i + 1]) AS errors
FROM (SELECT *, list_transform(xs, lambda x: list_transform(w1, lambda u: tanh(list_dot_product(u, x)))) AS hs FROM ({source}))))))"""


def _network_mean(key: str, source: str, names: tuple[str, ...]) -> str:
    """States averaged by rows over the shards of a key."""
    def mean(name: str) -> str:
        hidden = name.endswith("1")
        value = f"{name}s[s + 1][k + 1]" + "[j + 1]" * hidden
        over = f"list_sum(list_transform(range(len(ns)), lambda s: ns[s + 1] * {value})) / list_sum(ns)"
        return f"{_each_weight(over) if hidden else _each_out(over)} AS {name}"

    lists = ", ".join(f"list({c} ORDER BY shard) AS {c}s" for c in names)
    return f"""
SELECT {key}, {', '.join(map(mean, names))}
FROM (SELECT {key}, list(n ORDER BY shard) AS ns, {lists} FROM ({source}) GROUP BY {key})"""


_NETWORK = f"""{_HIDDEN_START} AS w1, {_literal(_START[HIDDEN_UNITS * _U:])} AS w2,
       {_ZERO_HIDDEN} AS m1, {_ZERO_HIDDEN} AS v1, {_ZERO_OUT} AS m2, {_ZERO_OUT} AS v2"""
_NEXT = """
SELECT b.{0} AS step, b.*, r.w1, r.w2, r.m1, r.v1, r.m2, r.v2 FROM {1} r JOIN {2} b ON b.{0} = r.{0} + 1"""

part("network_input", f"""
SELECT batch_no, row_in_batch % {SHARDS} AS shard, list(list_prepend(1.0::DOUBLE, v) ORDER BY row_in_batch) AS xs,
       list(y ORDER BY row_in_batch) AS ys, count(*) AS n
FROM dense GROUP BY ALL""", "dense")
_after = _network_step("batch_no, shard", _NEXT.format("batch_no", "network_run", "network_input"))
part("network_run", f"""
SELECT 0::BIGINT AS batch_no, {_NETWORK}
UNION ALL {_network_mean("batch_no", _after, ("w1", "w2", "m1", "v1", "m2", "v2"))}""", "network_input")
# The whole table in eight shards that each learn from the start, in mini-batches of 200.
part("network_pieces", """
SELECT shard, (i - 1) // 200 + 1 AS piece, list(list_prepend(1.0::DOUBLE, v) ORDER BY i) AS xs, list(y ORDER BY i) AS ys,
       count(*) AS n
FROM shard_rows GROUP BY ALL""", "shard_rows")
_after = _network_step("piece, shard", _NEXT.format("piece", "network_shards", "network_pieces") + " AND b.shard = r.shard")
part("network_shards", f"""
SELECT DISTINCT 0::BIGINT AS piece, shard, 0::BIGINT AS n, {_NETWORK} FROM network_pieces
UNION ALL {_after}""", "network_pieces")
part("network_mean", _network_mean("n_rows", """
SELECT r.shard, r.w1, r.w2, z.n, sum(z.n) OVER () AS n_rows
FROM network_shards r JOIN (SELECT shard, max(piece) AS piece, sum(n) AS n FROM network_pieces GROUP BY shard) z USING (shard, piece)""",
    ("w1", "w2")), "network_shards", "network_pieces")
for _prefix in ("", "test_"):
    part(f"network_{_prefix}predictions", f"""
SELECT 'Multi Layer Perceptron' AS model, d.row_id, d.batch_no, m.batch_no AS checkpoint, d.y AS truth,
       CASE WHEN m.w2[1] + list_dot_product(m.w2[2:], list_transform(m.w1,
         lambda u: tanh(list_dot_product(u, list_prepend(1.0::DOUBLE, d.v))))) > 1e-9 THEN 1 ELSE 0 END AS prediction
FROM {_prefix}dense d JOIN network_run m ON m.batch_no > 0""", f"{_prefix}dense", "network_run")

# Two-centre k-means, batch after batch.

part("kmeans_start", """
SELECT (SELECT v FROM dense WHERE batch_no = 1 ORDER BY row_in_batch LIMIT 1) AS c0,
       (SELECT d.v FROM dense d, (SELECT v FROM dense WHERE batch_no = 1 ORDER BY row_in_batch LIMIT 1) f
        WHERE d.batch_no = 1
        ORDER BY round(list_dot_product(d.v, d.v) - 2 * list_dot_product(d.v, f.v), 9) DESC, d.row_in_batch LIMIT 1) AS c1""", "dense")
_CHANCE = "(('0x' || substr(md5('0:{}:' || row_in_batch), 1, 8))::BIGINT + 1) / 4294967296.0"
part("kmeans_drawn", f"""
SELECT c0, arg_min(v, {{'key': -ln({_CHANCE.format(1)}) / gap, 'place': row_in_batch}}) FILTER (gap > 0) AS c1 FROM (
  SELECT d.v, d.row_in_batch, f.c0,
         round(list_dot_product(d.v, d.v) - 2 * list_dot_product(d.v, f.c0) + list_dot_product(f.c0, f.c0), 9) AS gap
  FROM dense d, (SELECT arg_min(v, {{'key': {_CHANCE.format(0)}, 'place': row_in_batch}}) AS c0 FROM dense WHERE batch_no = 1) f
  WHERE d.batch_no = 1) GROUP BY c0""", "dense")
part("batch_rows", "SELECT batch_no, list(v ORDER BY row_in_batch) AS vs FROM dense GROUP BY batch_no", "dense")


def nearest(v: str, c0: str = "c0", c1: str = "c1") -> str:
    return (
        f"list_dot_product({c0}, {c0}) - list_dot_product({c1}, {c1}) "
        f"+ 2 * (list_dot_product({v}, {c1}) - list_dot_product({v}, {c0})) > 1e-9"
    )


def _moved(c: str, n: str, vs: str) -> str:
    total = (
        f"list_reduce(list_prepend({ZEROS}, {vs}), "
        "lambda a, b: list_transform(range(512), lambda j: a[j + 1] + b[j + 1]))"
    )
    return (
        f"CASE WHEN {n} + len({vs}) = 0 THEN {c} ELSE list_transform(list_zip({c}, {total}), "
        f"lambda z: ({n} * z[1] + z[2]) / ({n} + len({vs}))) END"
    )


part("kmeans_run", f"""
SELECT 0::BIGINT AS batch_no, c0, c1, 0::BIGINT AS n0, 0::BIGINT AS n1 FROM kmeans_start
UNION ALL
SELECT batch_no, {_moved('c0', 'n0', 'v0')}, {_moved('c1', 'n1', 'v1')}, n0 + len(v0), n1 + len(v1)
FROM (SELECT b.batch_no, r.c0, r.c1, r.n0, r.n1,
             list_filter(b.vs, lambda v: NOT ({nearest('v', 'r.c0', 'r.c1')})) AS v0,
             list_filter(b.vs, lambda v: {nearest('v', 'r.c0', 'r.c1')}) AS v1
      FROM kmeans_run r JOIN batch_rows b ON b.batch_no = r.batch_no + 1)""", "kmeans_start", "batch_rows")
for _prefix in ("", "test_"):
    part(f"kmeans_{_prefix}predictions", f"""
SELECT 'Clustering' AS model, d.row_id, d.batch_no, m.batch_no AS checkpoint, d.y AS truth,
       CASE WHEN {nearest('d.v', 'm.c0', 'm.c1')} THEN 1 ELSE 0 END AS prediction
FROM {_prefix}dense d JOIN kmeans_run m ON true""", f"{_prefix}dense", "kmeans_run")


def confusion(table: str, *keys: str) -> str:
    """Counts and metrics of class 1 per key."""
    by = ", ".join(keys)
    return f"""
SELECT *, CAST(tp + tn AS DOUBLE) / n AS accuracy,
       CASE WHEN tp + fp = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fp) END AS precision,
       CASE WHEN tp + fn = 0 THEN 0.0 ELSE CAST(tp AS DOUBLE) / (tp + fn) END AS recall
FROM (SELECT {by}, count(*) AS n,
             count(*) FILTER (truth = 1 AND prediction = 1) AS tp, count(*) FILTER (truth = 0 AND prediction = 1) AS fp,
             count(*) FILTER (truth = 1 AND prediction = 0) AS fn, count(*) FILTER (truth = 0 AND prediction = 0) AS tn
      FROM {table} GROUP BY {by})"""
