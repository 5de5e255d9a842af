"""Suffix order and repeated strings against plain sorting and counting."""

import hashlib
import random
from collections import Counter

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from corpus_rows import rows_of  # noqa: F401
from sieveline.llm import suffix_dedup as S
from sieveline.llm.suffix_array import lyndon_groups, suffix_array


@settings(max_examples=400, deadline=None)
@given(st.integers(1, 6).flatmap(lambda k: st.lists(st.integers(0, k), max_size=60)))
def test_suffix_array(values):
    assert suffix_array(values) == sorted(range(len(values)), key=lambda i: values[i:])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(0, 2), max_size=30))
def test_groups_are_lyndon_prefixes(values):
    taken, group, previous = lyndon_groups(values)
    suffixes = [values[i:] for i in range(len(values))]
    lyndon = []
    for i, s in enumerate(suffixes):
        assert previous[i] == max((j for j in range(i) if suffixes[j] < s), default=-1)
        end = next((j for j in range(i + 1, len(values)) if suffixes[j] < s), len(values))
        lyndon.append(tuple(values[i:end]))
    order = [{lyndon[i] for i in own} for own in taken]
    assert all(len(o) == 1 for o in order)
    contexts = [o.pop() for o in order]
    assert contexts == sorted(set(lyndon), reverse=True)


def plain(rows):
    raws = [(t or "").encode() for _, t in rows]
    count = Counter(r[i:i + 200] for r in raws for i in range(len(r) - 199))
    out = []
    for (doc, _), r in zip(rows, raws):
        gone = bytearray(len(r))
        for i in range(len(r) - 199):
            if count[r[i:i + 200]] > 1:
                gone[i:i + 200] = b"\1" * 200
        runs = sum(1 for i in range(len(r)) if gone[i] and not (i and gone[i - 1]))
        kept = bytes(c for c, g in zip(r, gone) if not g)
        out.append((str(doc), len(r), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def made(docs, **limits):
    return sorted((str(r.doc_id), r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in S.remove_repeats(docs, **limits).collect())


def cases():
    rng = random.Random(9)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randrange(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passages = [text(60) for _ in range(4)] + ["x" * 199, "y" * 200, "z" * 201, "ab" * 180]
    rows = []
    for i in range(60):
        parts = [text(rng.randrange(30)) for _ in range(3)]
        parts.insert(rng.randrange(3), rng.choice(passages))
        rows.append((i, " ".join(parts)))
    near = text(150)
    for i in range(25):
        words = near.split()
        words[rng.randrange(len(words))] = word()
        rows.append((100 + i, " ".join(words)))
    exact = passages[0][:200]
    rows += [(200, exact), (201, exact[:199]), (202, "q" + exact), (203, None), (204, ""), (205, "r" * 1000), (206, passages[1] + passages[1])]
    rows += [(None, text(80)), (None, "s" * 400), (207, near), (207, near), (208, near[:399] + "Ü" + near[400:])]
    return rows


@pytest.mark.parametrize("limits", [{}, {"full": 3}, {"full": 1, "max_anchors": 0}, {"max_anchors": 0}])
def test_repeats(rows_of, limits):
    rows = cases()
    assert made(rows_of(rows), **limits) == plain(rows)


def test_pieces_of_a_long_text_meet(rows_of, monkeypatch):
    monkeypatch.setattr(S, "PIECE", 300)
    S._TABLES.clear()
    rows = [(i, t) for i, t in cases() if t and len(t) > 500]
    raws = {i: S.anchors(t.encode()) for i, t in rows}
    for i, t in rows:
        _, place, lo, n = raws[i]
        assert [x for a, c in zip(lo, n) for x in range(a, a + c)] == list(range(len(t.encode()) - 199))
        assert all(a <= x for a, x in zip(lo, place))
    S._TABLES.clear()


def test_empty_and_unrepeated(rows_of):
    assert made(rows_of([])) == []
    rows = [(1, "short"), (2, "".join(chr(97 + (i * i + i // 7) % 26) for i in range(900)))]
    assert made(rows_of(rows)) == plain(rows)
