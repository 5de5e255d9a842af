"""SimHash groups against all pairs, computed plainly."""

import random

import pytest
import xxhash

from corpus_rows import rows_of  # noqa: F401
from sieveline.llm import simhash


def plain_fingerprint(text):
    table = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    words = (text or "").translate(table)
    for c in "\t\n\x0b\x0c\r":
        words = words.replace(c, " ")
    words = [w for w in words.split(" ") if w]
    if not words:
        return 0
    n = min(3, len(words))
    hs = [xxhash.xxh64_intdigest(" ".join(words[i:i + n]).encode(), 42) for i in range(len(words) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def plain_groups(values):
    """Smallest index reachable over links of at most three bits."""
    least = list(range(len(values)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(values):
            for j, b in enumerate(values):
                if (a ^ b).bit_count() <= 3 and least[j] < least[i]:
                    least[i], changed = least[j], True
    return least


TEXTS = [
    "", None, " \t\n", "one", "One", "one two", "a b c", "a b c d", "É é A", "x\x0by\x0cz w", "a b c",
    "the same words over and over " * 400, "the same words over and over " * 401,
]


def test_fingerprints_and_groups(rows_of):
    rng = random.Random(3)
    base = [f"w{rng.randrange(500)}" for _ in range(300)]
    texts = list(TEXTS)
    for _ in range(40):
        words = list(base)
        for _ in range(rng.randrange(4)):
            words[rng.randrange(300)] = "changed"
        texts.append(" ".join(words))
    made = simhash.near_duplicates(rows_of(enumerate(texts))).collect()
    expected = [plain_fingerprint(t) for t in texts]
    assert {r.doc_id: r.fp % 2**64 for r in made} == dict(enumerate(expected))
    assert {r.doc_id: r.component_id for r in made} == dict(enumerate(plain_groups(expected)))


@pytest.mark.parametrize("full_entry", [0, 3, 64])
def test_links_do_not_depend_on_the_entry_limit(spark, full_entry):
    rng = random.Random(5)
    values = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            v = centre
            for _ in range(rng.randrange(4)):
                v ^= 1 << rng.randrange(64)
            values.add(v)
    values |= {0, 7, 2**64 - 1, 2**63, (7 << 61), 1 << 32}
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    made = simhash.links(spark.createDataFrame([(v,) for v in signed], "fp long"), full_entry).collect()
    found = {frozenset((r.u % 2**64, r.v % 2**64)) for r in made}
    assert found == {frozenset((a, b)) for a in values for b in values if 1 <= (a ^ b).bit_count() <= 3}


def test_chain_is_one_component(spark):
    from sieveline.llm.components import connected

    links = [(i + 1, i) for i in range(60)] + [(100, 101), (7, 7)]
    made = {r.u: r.v for r in connected(spark.createDataFrame(links, "u long, v long")).collect()}
    assert made == {**{i: 0 for i in range(1, 61)}, 101: 100}
    assert connected(spark.createDataFrame([], "u long, v long")).count() == 0


def test_ids_null_repeated_and_empty_table(rows_of):
    made = simhash.near_duplicates(rows_of([(None, "a b c"), (4, "a b c"), (4, "a b c"), (None, "lone words here")]))
    assert sorted((str(r.doc_id), str(r.component_id)) for r in made.collect()) == [
        ("4", "4"), ("4", "4"), ("None", "4"), ("None", "None")]
    kept = simhash.keep_one(rows_of([(None, "a b c"), (4, "a b c"), (4, "a b c"), (None, "lone words here"), (9, "q")]))
    assert sorted((str(r.doc_id), r.text) for r in kept.collect()) == [
        ("4", "a b c"), ("9", "q"), ("None", "lone words here")]
    assert simhash.near_duplicates(rows_of([])).count() == 0
    assert simhash.keep_one(rows_of([])).count() == 0
