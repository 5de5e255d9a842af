"""Benchmark hits against a plain search for every window."""

import random
import re

import pytest

from corpus_rows import rows_of  # noqa: F401
from sieveline.llm import decontaminate as D

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words_of(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(text, items):
    words, hit, found = words_of(text), set(), set()
    for item, passage in items:
        own = words_of(passage)
        n = min(13, len(own))
        for i in range(len(own) - n + 1 if n else 0):
            for s in range(len(words) - n + 1):
                if words[s:s + n] == own[i:i + n]:
                    hit.update(range(s, s + n))
                    found.add(str(item) if item is not None else "")
    return len(words), len(hit), sorted(found)


def cases():
    rng = random.Random(2)
    vocabulary = ["alpha", "BETA", "gamma9", "délta", "9", "x", "ein", "Ö"]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.choice([1, 2, 4, 5, 12, 13, 14, 30])))) for i in range(12)]
    items += [(None, "a passage without any id but of more than thirteen words in all its length"), (77, None), (78, " .,; "), (5, items[6][1])]
    docs = [(i, ", ".join(rng.choice(vocabulary) for _ in range(rng.randrange(60)))) for i in range(30)]
    docs += [(100 + i, f"before {items[i % 13][1] or ''}; {items[(i * 5) % 13][1] or ''} after") for i in range(13)]
    docs += [(200, None), (201, ""), (202, "..."), (None, items[7][1]), (100, items[7][1]), (203, "filler " * 30_000 + items[7][1])]
    return docs, items


@pytest.mark.parametrize("limits", [{}, {"max_shingles": 0}, {"max_windows": 0}, {"max_shingles": 0, "max_windows": 0}])
def test_found(spark, rows_of, limits):
    docs, items = cases()
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "'x' AS words", "'y' AS hash")
    made = D.find(rows_of(docs), table, **limits)
    assert "label" in made.columns
    got = sorted((str(r.doc_id), r.text or "", r._found.n_words, r._found.n_hit, r._found["items"]) for r in made.collect())
    assert got == sorted((str(d), t or "", *plain(t, items)) for d, t in docs)
    assert any(g[3] for g in got) and any(not g[3] for g in got)


def test_keep_clean_uses_the_share(spark, rows_of):
    passage = " ".join(f"w{i}" for i in range(13))
    filler = " ".join(f"f{i}" for i in range(400))
    docs = [(1, passage), (2, f"{filler} {passage}"), (3, f"{' '.join(filler.split()[:240])} {passage}"), (4, filler), (5, "")]
    items = spark.createDataFrame([(1, passage)], "item_id long, text string")
    kept = D.keep_clean(rows_of(docs), items)
    assert kept.columns == rows_of(docs).columns
    assert sorted(r.doc_id for r in kept.collect()) == [2, 4, 5]


def test_empty_tables(spark, rows_of):
    none = spark.createDataFrame([], "item_id long, text string")
    assert [r._found.n_hit for r in D.find(rows_of([(1, "a b")]), none).collect()] == [0]
    assert D.find(rows_of([]), spark.createDataFrame([(1, "a")], "item_id long, text string")).count() == 0
