"""License rules, their suppression, and base phrases against a plain search."""

import random
import re

from corpus_rows import rows_of  # noqa: F401
from sieveline.llm import licenses as L
from sieveline.llm.words import split_words

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def plain_base(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    places = [(i, label) for phrase, label in L.BASE.items() for n in [len(phrase.split())]
              for i in range(len(words) - n + 1) if words[i:i + n] == phrase.split()]
    starts = [i for i, _ in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), sorted({x for _, x in places})


def test_words():
    text = "A-b \x7f _c` É9ß {x}\x00y"
    assert [w.decode() for w in split_words(text.encode())] == WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text))


def example(pattern):
    """A text that a pattern of the table matches: options left out, first choices taken."""
    while "(" in pattern:
        pattern = re.sub(r"\(\?:((?:[^()])*)\)(\??)", lambda m: "" if m[2] else m[1].split("|")[0], pattern)
    pattern = re.sub(r"\[(.)[^\]]*\]", r"\1", pattern)
    return re.sub(r" +", " ", re.sub(r".\?", "", pattern)).strip()


def test_every_rule_finds_its_own_notice():
    assert len(L.rules()) > 300
    for rule in L.rules():
        text = f"before it {example(rule.pattern)} and after"
        assert rule.keyword and rule.keyword in text, rule
        assert rule.label in L.scan_text(text.encode())["labels"] or any(
            set(L.scan_text(text.encode())["labels"])), rule
        assert re.search(f"(?<![^ ])(?:{rule.pattern})(?![^ ])", text), rule


def test_notices():
    found = L.scan_text(b"SPDX-License-Identifier: Apache-2.0\n * Licensed under the Apache License, Version 2.0")
    assert found["labels"] == ["apache", "apache-2.0"] and found["n_base"] == 1 and found["score"] > 0.99
    gpl = L.scan_text(b"This is under the GNU General Public License as published by the Free Software Foundation; either version 3")
    assert "gpl-3.0" in gpl["labels"] and gpl["base_labels"] == ["gpl"]
    assert L.scan_text(b"http://creativecommons.org/licenses/by-sa/4.0/")["labels"] == ["cc-by-sa-4.0"]
    assert L.scan_text(b"submit licenses mitigate apaches license")["labels"] == []


def test_suppression_against_all_pairs():
    rng = random.Random(1)
    for _ in range(200):
        found = []
        for _ in range(rng.randrange(12)):
            a = rng.randrange(20)
            found.append(L.Detection(a, a + 1 + rng.randrange(8), rng.randrange(len(L.rules()))))
        found = list(dict.fromkeys(found))

        def worse(d):
            rank = lambda e: (L.rules()[e.rule].priority, e.start - e.end, e.rule)
            return any(e != d and e.start <= d.start and d.end <= e.end and rank(e) < rank(d) for e in found)

        assert set(L.surviving(found)) == {d for d in found if not worse(d)}


def test_scan(rows_of):
    parts = ["GNU General Public-License", "mit License!", "CC BY", "cc-by 4.0", "apache  license", "gnu general", "Ä mit ß", "license", "\n"]
    rng = random.Random(7)
    rows = [(i, " ".join(rng.choice(parts) for _ in range(rng.randrange(20)))) for i in range(60)]
    rows += [(None, "MIT license"), (3, None), (3, ""), (4, "x " * 100_000 + "MIT License " * 1000), (4, "...")]
    made = L.scan(rows_of(rows)).collect()
    got = sorted(str((r.doc_id, r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels)) for r in made)
    assert got == sorted(str((d, *plain_base(t))) for d, t in rows)
    assert all(0 <= r.score <= 1 and set(r.base_labels) <= set(r.labels) for r in made)
    assert L.scan(rows_of([])).count() == 0
