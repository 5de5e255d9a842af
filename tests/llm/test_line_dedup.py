"""Line dedup against a plain count of all lines."""

import random
import re

import pytest

from corpus_rows import rows_of  # noqa: F401
from sieveline.llm import line_dedup as L


def key_of(line):
    line = re.sub(r"^[\x20\x09-\x0D]+|[\x20\x09-\x0D]+$", "", line)
    return re.sub("[A-Z]", lambda m: m[0].lower(), line)


def plain(rows):
    holders = {}
    for doc, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 20:
                holders.setdefault(key_of(line), set()).add(doc)
    largest = {k: max(h, key=lambda d: (d is not None, d)) for k, h in holders.items() if len(h) >= 3}
    out = []
    for doc, text in rows:
        lines = (text or "").split("\n")
        kept = [x for x in lines if largest.get(key_of(x), doc) == doc]
        out.append((str(doc), len(lines), len(lines) - len(kept), "\n".join(kept)))
    return sorted(out)


def made(docs, **options):
    return sorted((str(r.doc_id), r.n_lines, r.n_dropped, r.kept) for r in L.dedup_lines(docs, **options).collect())


LINES = [
    "a common line of some length", "  A Common LINE of some length\t", "Éclair É line with some words", "éclair é line with some words",
    "x" * 19, "x" * 20, "X" * 20 + "\r", "", " ", "another rather frequent line", "\x0b  padded by vertical tabs \x0c", "padded by vertical tabs",
]


@pytest.mark.parametrize("batches, fanout", [(1, 2), (4, 2), (5, 3), (9, 2)])
def test_random_documents(rows_of, batches, fanout):
    rng = random.Random(batches)
    rows = [(i * 7, "\n".join(rng.choice(LINES) for _ in range(rng.randrange(6)))) for i in range(40)]
    rows += [(500 + i, "\n".join([rng.choice(LINES), f"a line that only row {i} has, surely"])) for i in range(9)]
    rows += [(None, "a common line of some length\nmine"), (None, "a common line of some length"), (14, "x" * 20), (1000, None), (1001, "")]
    rows.append((3, "\n".join([f"numbered line number {i}" for i in range(3000)] + ["a common line of some length"])))
    assert made(rows_of(rows), batches=batches, fanout=fanout) == plain(rows)


def test_threshold_is_three_documents(rows_of):
    line = "exactly twenty chars"
    assert len(line) == 20
    rows = [(1, line + "\n" + line), (2, line), (3, "other")]
    assert made(rows_of(rows)) == plain(rows) and plain(rows)[0][2] == 0
    rows[2] = (3, f"{line}\nx\n{line}")
    assert made(rows_of(rows)) == plain(rows) == [("1", 2, 2, ""), ("2", 1, 1, ""), ("3", 3, 0, f"{line}\nx\n{line}")]


def test_empty_table_and_null_ids_only(rows_of):
    assert made(rows_of([])) == []
    rows = [(None, "the same line in null rows"), (None, "the same line in null rows")]
    assert made(rows_of(rows)) == plain(rows)


def test_runs_are_compacted(spark):
    runs = L.Runs(spark, 4, fanout=2)
    for i in range(5):
        batch = spark.range(i * 10, i * 10 + 15).selectExpr("id AS h1", "id AS h2", "id AS keeper")
        new = runs.new_of(batch)
        assert new.count() == (15 if i == 0 else 10)
        runs.add(new)
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert runs.close().select("h1").distinct().count() == 55
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("run_")]


@pytest.mark.parametrize("ids", [(1, 2**57, 2**58), (-(2**63), 5, 2**63 - 1)])
def test_ids_that_span_all_longs(rows_of, ids):
    made = L.dedup_lines(rows_of([(i, "a line that is long enough") for i in ids])).collect()
    assert {r.doc_id: r.n_dropped for r in made} == {ids[0]: 1, ids[1]: 1, ids[2]: 0}
