"""The registered queries on whole small tables: against SQL, or a plain version."""

import glob
import hashlib
import os
import zlib

import duckdb
import numpy as np
import pytest
from tokenizers import Tokenizer

import __spark_entry__ as entry
from sieveline.llm.queries import QUERIES, SQL, tokenizer_path
from sieveline.sources.tables import load
from test_licenses import plain_base
from test_mixing import plain_targets
from test_search import plain as plain_search
from test_simhash import plain_fingerprint, plain_groups
from test_suffix_dedup import plain as plain_repeats

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def docs(spark):
    return sorted((r.doc_id, r.text, r.source) for r in load(spark, SMALL, "documents").collect())


def run(spark, name):
    return entry.queries()[name](spark, SMALL).collect()


def test_all_are_registered():
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql()) and "pipeline" in entry.queries()
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", SQL)
def test_against_sql(spark, name):
    sql = duckdb.connect()
    for path in glob.glob(f"{SMALL}/*.parquet"):
        sql.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    result = sql.execute(SQL[name])
    columns = [c[0] for c in result.description]
    made = entry.queries()[name](spark, SMALL)
    assert sorted(made.columns) == sorted(columns)
    assert sorted(made.select(*columns).collect()) == sorted(result.fetchall())


def test_mixing(spark, docs):
    made = run(spark, "op4_mixing")
    size = {d: len((t or "").split()) for d, t, _ in docs}
    of = {d: s for d, _, s in docs}
    sizes = {}
    for d, s in of.items():
        sizes[s] = sizes.get(s, 0) + size[d]
    targets = plain_targets(sizes)
    taken = dict.fromkeys(targets, 0)
    for r in made:
        assert (r.size, r.source_size) == (size[r.doc_id], sizes[of[r.doc_id]]) and r.taken <= 2 * r.size
        assert r.target == pytest.approx(targets[of[r.doc_id]])
        taken[of[r.doc_id]] += r.taken
    largest = max(size.values())
    assert len(made) == len(docs) and all(abs(taken[s] - targets[s]) <= min(largest, 0.1 * targets[s] + 30) for s in taken)


def test_licenses(spark, docs):
    made = sorted(str((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in run(spark, "op5_licenses"))
    expected = []
    for d, t, _ in docs:
        *counts, labels = plain_base(t)
        expected.append(str((d, *counts, ",".join(labels))))
    assert made == sorted(expected)


def test_quality(spark, docs):
    made = run(spark, "op6_quality")
    assert sorted(r.doc_id for r in made) == [d for d, _, _ in docs]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and 0 <= r.score <= 1 for r in made)


def test_repeats(spark, docs):
    made = sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in run(spark, "op7_suffix_dedup"))
    assert made == plain_repeats([(d, t) for d, t, _ in docs])


def test_tokens(spark, docs):
    tokenizer, start, expected = Tokenizer.from_file(tokenizer_path()), 0, []
    for d, t, _ in docs:
        ids = np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 2], dtype="<u4")
        expected.append((d, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in run(spark, "op8_token_store")) == expected


def test_groups(spark, docs):
    prints = [plain_fingerprint(t) for _, t, _ in docs]
    least = plain_groups(prints)
    expected = [(d, f"{p:016x}", docs[i][0]) for (d, _, _), p, i in zip(docs, prints, least)]
    assert sorted((r.doc_id, r.fingerprint, r.component_id) for r in run(spark, "op9_simhash")) == expected


def test_search(spark, docs):
    got = {}
    for r in sorted(run(spark, "op10_search"), key=lambda r: r.rank):
        got.setdefault(r.query_id, []).append((-round(r.score, 9), r.doc_id))
    assert got == {q: lists[0] for q, lists in plain_search([(d, t) for d, t, _ in docs], 10).items()}


def test_neighbours(spark):
    vectors = {r.vec_id: np.array(r.embedding, dtype=float) for r in load(spark, SMALL, "embeddings").collect()}
    got, hits = {}, 0
    for r in sorted(run(spark, "op11_neighbours"), key=lambda r: r.rank):
        assert r.score == pytest.approx(np.linalg.norm(vectors[r.query_id] - vectors[r.vec_id]), rel=1e-12)
        got.setdefault(r.query_id, []).append((r.score, r.vec_id))
    for q, near in got.items():
        assert near == sorted(near) and len(near) == 10
        true = sorted((np.linalg.norm(v - vectors[q]), i) for i, v in vectors.items() if i != q)[:10]
        hits += len({i for _, i in near} & {i for _, i in true})
    assert set(got) == {i for i in vectors if i % 100 == 0} and hits >= 0.9 * 10 * len(got)


def test_reruns_agree(spark):
    digest = lambda name: hashlib.sha256(repr(sorted(map(str, run(spark, name)))).encode()).hexdigest()
    for name in ("op4_mixing", "op6_quality", "op11_neighbours"):
        assert digest(name) == digest(name)
