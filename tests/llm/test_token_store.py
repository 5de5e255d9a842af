"""Planes and stores against the tokenizer's own ids."""

import zlib

import numpy as np
import pytest
import zstandard
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from corpus_rows import rows_of  # noqa: F401
from sieveline.llm import token_store as T
from sieveline.llm.queries import tokenizer_path

PATH = tokenizer_path()
WHOLE = Tokenizer.from_file(PATH)
ODD = [
    "", " ", "\n\t", "Hello, World!", "it's they'll I'D 've 's", "ΑΣ ΣΑΣ Σ", "é ́e a b c d", "x\x0by\x0cz\x1ca\x85b",
    "<|endoftext|> a<|startoftext|>b <|ENDOFTEXT|>", "日本語 テキスト", "1234 5,6 ½ ①", "İstanbul ǅ ﬁ", "\U0001f600‍\U0001f525 ﻿", "'", "a'b 's's",
]


def ids_of(text):
    return WHOLE.encode(text or "", add_special_tokens=False).ids


@settings(max_examples=100, deadline=None)
@given(st.lists(st.integers(0, 2**32 - 1) | st.integers(0, 49_407), max_size=300), st.sampled_from([1, 8]))
def test_planes_round_trip(ids, plane_bits):
    ids = np.array(ids, dtype="<u4")
    assert (T.unpack(T.pack(ids, plane_bits), len(ids), plane_bits) == ids).all()


def test_planes_hold_the_bits_of_eight_ids_in_a_byte():
    ids = np.random.RandomState(0).randint(0, 49_408, 1003).astype("<u4")
    planes = [zstandard.ZstdDecompressor().decompress(p) for p in T.pack(ids)]
    assert planes == [np.packbits(ids >> bit & 1, bitorder="little").tobytes() for bit in range(16)]


def test_planes_are_as_many_as_bits():
    assert len(T.pack(np.array([5, 1], dtype="<u4"))) == 3 and len(T.pack(np.array([300], dtype="<u4"), 8)) == 2
    assert T.pack(np.zeros(4, dtype="<u4")) == [] and (T.unpack([], 4) == 0).all()


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(max_size=12) | st.sampled_from(ODD), max_size=6).map(" ".join))
def test_word_by_word_is_the_whole_text(text):
    encoder = T.WordEncoder(PATH)
    assert next(encoder.encode([text.encode()])).tolist() == ids_of(text)


def test_stops_between_a_letter_and_a_blank_stand_alone():
    assert T.plain_words(b"a. b, c.d e., 1. f.\tg,\nH. .i x,") == [
        b"a", b".", b"b", b",", b"c.d", b"e.,", b"1.", b"f", b".", b"g", b",", b"h", b".", b".i", b"x", b","
    ]


@pytest.mark.parametrize("pair", ["J\u030c", "H\u0331", "T\u0308", "W\u030a", "Y\u030a"])
def test_letters_that_compose_in_lower_case_alone(pair):
    encoder = T.WordEncoder(PATH)
    for text in (pair, f"x {pair}y z", f"Caf\u00c9 A{pair}, {pair.lower()} B.", f"W\u0331\u030a {pair}<|endoftext|>"):
        assert next(encoder.encode([text.encode()])).tolist() == ids_of(text)


def test_a_full_memory_is_forgotten(monkeypatch):
    monkeypatch.setattr(T, "MEMORY", 3)
    monkeypatch.setattr(T, "GROUP", 20)
    encoder = T.WordEncoder(PATH)
    texts = ["one two three four five", "five six one", "seven", "one two three four five"] * 3
    assert [list(i) for i in encoder.encode([t.encode() for t in texts])] == [ids_of(t) for t in texts]


@pytest.mark.parametrize("chunk_ids, plane_bits", [(1 << 17, 1), (7, 1), (64, 8), (1, 1)])
def test_store(rows_of, chunk_ids, plane_bits):
    rows = [(i * 3 % 41, t) for i, t in enumerate(ODD)] + [(60, "many words here " * (3000 if chunk_ids > 60 else 20)), (61, None), (5, "again"), (5, "again")]
    made = T.store_and_read(rows_of(rows), PATH, chunk_ids, plane_bits).collect()
    start, expected = 0, []
    for doc, text in sorted(rows, key=lambda r: (r[0], r[1] or "")):
        ids = np.array([*ids_of(text), 2], dtype="<u4")
        expected.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    assert sorted((r.start, r.doc_id, r.n_tokens, r.ids_crc32) for r in made) == sorted((s, d, n, c) for d, s, n, c in expected)


@pytest.mark.parametrize("first, second", [(b"", b""), (b"", b"ab"), (b"ab", b""), (b"one", b"two" * 999), (b"\0" * 70_000, b"\0" * 131_072)])
def test_joined_checksums(first, second):
    assert T.joined_crc32(zlib.crc32(first), zlib.crc32(second), len(second)) == zlib.crc32(first + second)


def test_planes_are_not_moved_when_read_back(rows_of):
    made = T.store_and_read(rows_of([(i, "some words here") for i in range(30)]), PATH, 16)
    plan = made._jdf.queryExecution().optimizedPlan().toString()
    moved = next(line for line in plan.splitlines() if "RepartitionByExpression [shard" in line)
    assert "MapInArrow parts" in plan[plan.index(moved):].splitlines()[1]


def test_null_ids_come_first_and_empty_table(rows_of):
    made = T.store_and_read(rows_of([(3, "b"), (None, "a")]), PATH).orderBy("start").collect()
    assert [(r.doc_id, r.start) for r in made] == [(None, 0), (3, 2)]
    assert T.store_and_read(rows_of([]), PATH).count() == 0
