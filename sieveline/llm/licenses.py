"""License notices in texts, by ordered signature rules.

A rule is a regular expression over the words of a text (lower-case, one blank
between them) with a label, a priority and a confidence.  Rules come from a table of
licenses, each spelled out in several kinds of notice.  A rule runs only where its
keyword occurs; one automaton finds all keywords in one pass.  Of overlapping
detections, one that lies inside another of better or equal priority is suppressed.

Defined results.  A null, empty or wordless text has no detection and score 0.
Repeated rows and ids are handled row by row.  Columns other than ``doc_id`` and
``text`` are ignored and may have any name.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from functools import lru_cache

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from .words import raw_texts, spaced

#: Contract: phrases whose places are counted, and their labels.
BASE = {
    "gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit",
}
BASE_CONFIDENCE = 0.7

#: label: names a notice may use, identifiers, words of its address; all as words.
LICENSES = {
    "0bsd": (["zero clause bsd license", "bsd zero clause license"], ["0bsd"], ["opensource org licenses 0bsd"]),
    "afl-3.0": (["academic free license(?: v(?:ersion)?)?(?: ?3 0)?"], ["afl 3 0"], ["opensource org licenses afl 3 0"]),
    "agpl-3.0": (["gnu affero general public license(?: v(?:ersion)? ?3)?"], ["agpl 3 0(?: only| or later)?"], ["gnu org licenses agpl 3 0"]),
    "apache-1.1": (["apache software license(?: version)? 1 1"], ["apache 1 1"], ["apache org licenses license 1 1"]),
    "apache-2.0": (["apache license(?: version)? 2 0"], ["apache 2 0"], ["apache org licenses license 2 0"]),
    "artistic-2.0": (["(?:the )?artistic license 2 0"], ["artistic 2 0"], ["opensource org licenses artistic license 2 0"]),
    "blueoak-1.0.0": (["blue oak model license(?: 1 0 0)?"], ["blueoak 1 0 0"], ["blueoakcouncil org license 1 0 0"]),
    "bsd-2-clause": (["simplified bsd license", "bsd 2 clause license", "2 clause bsd license"], ["bsd 2 clause"], ["opensource org licenses bsd 2 clause"]),
    "bsd-3-clause": (["(?:modified|new|revised) bsd license", "bsd 3 clause license", "3 clause bsd license"], ["bsd 3 clause"], ["opensource org licenses bsd 3 clause"]),
    "bsd-4-clause": (["original bsd license", "bsd 4 clause license"], ["bsd 4 clause"], ["directory fsf org wiki license bsd 4clause"]),
    "bsl-1.0": (["boost software license(?: version)?(?: 1 0)?"], ["bsl 1 0"], ["boost org license 1 0"]),
    "busl-1.1": (["business source license(?: 1 1)?"], ["busl 1 1"], ["mariadb com bsl11"]),
    "cc-by-3.0": (["creative commons attribution 3 0(?: unported)?(?: license)?"], ["cc by 3 0"], ["creativecommons org licenses by 3 0"]),
    "cc-by-4.0": (["creative commons attribution 4 0(?: international)?(?: license)?"], ["cc by 4 0"], ["creativecommons org licenses by 4 0"]),
    "cc-by-nc-4.0": (["creative commons attribution non ?commercial(?: 4 0)?(?: international)?(?: license)?"], ["cc by nc 4 0"], ["creativecommons org licenses by nc 4 0"]),
    "cc-by-nc-nd-4.0": (["creative commons attribution non ?commercial no ?deriv(?:ative)?s?(?: 4 0)?"], ["cc by nc nd 4 0"], ["creativecommons org licenses by nc nd 4 0"]),
    "cc-by-nc-sa-4.0": (["creative commons attribution non ?commercial share ?alike(?: 4 0)?"], ["cc by nc sa 4 0"], ["creativecommons org licenses by nc sa 4 0"]),
    "cc-by-nd-4.0": (["creative commons attribution no ?deriv(?:ative)?s?(?: 4 0)?"], ["cc by nd 4 0"], ["creativecommons org licenses by nd 4 0"]),
    "cc-by-sa-3.0": (["creative commons attribution share ?alike 3 0(?: unported)?(?: license)?"], ["cc by sa 3 0"], ["creativecommons org licenses by sa 3 0"]),
    "cc-by-sa-4.0": (["creative commons attribution share ?alike 4 0(?: international)?(?: license)?"], ["cc by sa 4 0"], ["creativecommons org licenses by sa 4 0"]),
    "cc0-1.0": (["creative commons zero(?: v?1 0)?(?: universal)?", "cc0 1 0 universal"], ["cc0 1 0"], ["creativecommons org publicdomain zero 1 0"]),
    "cddl-1.0": (["common development and distribution license(?: version)? 1 0"], ["cddl 1 0"], ["opensource org licenses cddl 1 0"]),
    "cddl-1.1": (["common development and distribution license(?: version)? 1 1"], ["cddl 1 1"], ["javaee github io license"]),
    "cecill-2.1": (["cecill free software license agreement(?: version 2 1)?"], ["cecill 2 1"], ["cecill info licences licence cecill v2 1"]),
    "cpl-1.0": (["common public license(?: version)?(?: 1 0)?"], ["cpl 1 0"], ["opensource org licenses cpl 1 0"]),
    "ecl-2.0": (["educational community license(?: version)?(?: 2 0)?"], ["ecl 2 0"], ["opensource org licenses ecl 2 0"]),
    "epl-1.0": (["eclipse public license(?: version| v)? ?1 0"], ["epl 1 0"], ["eclipse org legal epl v10"]),
    "epl-2.0": (["eclipse public license(?: version| v)? ?2 0"], ["epl 2 0"], ["eclipse org legal epl 2 0"]),
    "eupl-1.2": (["european union public licen[cs]e(?: v(?:ersion)?)?(?: ?1 2)?"], ["eupl 1 2"], ["joinup ec europa eu collection eupl"]),
    "fdl-1.3": (["gnu free documentation license(?: version 1 [123])?"], ["gfdl 1 3(?: only| or later)?"], ["gnu org licenses fdl 1 3"]),
    "ftl": (["freetype (?:project )?license"], ["ftl"], ["freetype org license"]),
    "gpl-2.0": (["gnu general public license(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?2"], ["gpl 2 0(?: only| or later)?"], ["gnu org licenses(?: old licenses)? gpl 2 0"]),
    "gpl-3.0": (["gnu general public license(?: as published by the free software foundation)?(?: either)?(?: version| v)? ?3"], ["gpl 3 0(?: only| or later)?"], ["gnu org licenses gpl 3 0"]),
    "hpnd": (["historical permission notice and disclaimer"], ["hpnd"], ["opensource org licenses hpnd"]),
    "ijg": (["independent jpeg group (?:s )?license"], ["ijg"], ["ijg org files readme"]),
    "ipl-1.0": (["ibm public license(?: version)?(?: 1 0)?"], ["ipl 1 0"], ["opensource org licenses ipl 1 0"]),
    "isc": (["isc license", "internet systems consortium license"], ["isc"], ["opensource org licenses isc"]),
    "lgpl-2.1": (["gnu lesser general public license(?: version| v)? ?2 1"], ["lgpl 2 1(?: only| or later)?"], ["gnu org licenses(?: old licenses)? lgpl 2 1"]),
    "lgpl-3.0": (["gnu lesser general public license(?: version| v)? ?3"], ["lgpl 3 0(?: only| or later)?"], ["gnu org licenses lgpl 3 0"]),
    "lppl-1.3c": (["latex project public license(?: version 1 3c?)?"], ["lppl 1 3c"], ["latex project org lppl"]),
    "mit-0": (["mit no attribution license"], ["mit 0"], ["github com aws mit 0"]),
    "mit-x11": (["mit x11 license", "x11 license"], ["x11"], ["opensource org licenses mit"]),
    "mpl-1.1": (["mozilla public license(?: version| v)? ?1 1"], ["mpl 1 1"], ["mozilla org mpl 1 1"]),
    "mpl-2.0": (["mozilla public license(?: version| v)? ?2 0"], ["mpl 2 0"], ["mozilla org mpl 2 0"]),
    "ms-pl": (["microsoft public license"], ["ms pl"], ["opensource org licenses ms pl"]),
    "ms-rl": (["microsoft reciprocal license"], ["ms rl"], ["opensource org licenses ms rl"]),
    "mulanpsl-2.0": (["mulan permissive software license(?: version)?(?: 2)?"], ["mulanpsl 2 0"], ["license coscl org cn mulanpsl2"]),
    "ncsa": (["university of illinois ncsa open source license"], ["ncsa"], ["opensource org licenses ncsa"]),
    "odbl-1.0": (["open data(?: commons open)? database license", "open database license"], ["odbl 1 0"], ["opendatacommons org licenses odbl"]),
    "odc-by-1.0": (["open data commons attribution license"], ["odc by 1 0"], ["opendatacommons org licenses by"]),
    "ofl-1.1": (["sil open font license(?: version)?(?: 1 1)?"], ["ofl 1 1"], ["scripts sil org ofl"]),
    "openssl": (["openssl license"], ["openssl"], ["openssl org source license"]),
    "osl-3.0": (["open software license(?: version)?(?: v)?(?: ?3 0)?"], ["osl 3 0"], ["opensource org licenses osl 3 0"]),
    "pddl-1.0": (["public domain dedication and license"], ["pddl 1 0"], ["opendatacommons org licenses pddl"]),
    "php-3.01": (["php license(?: version)?(?: 3 01)?"], ["php 3 01"], ["php net license 3 01"]),
    "polyform-nc": (["polyform noncommercial license(?: 1 0 0)?"], ["polyform noncommercial 1 0 0"], ["polyformproject org licenses noncommercial"]),
    "postgresql": (["postgresql license"], ["postgresql"], ["postgresql org about licence"]),
    "psf-2.0": (["python software foundation license(?: version 2)?"], ["psf 2 0", "python 2 0"], ["docs python org license"]),
    "qpl-1.0": (["q public license(?: version 1 0)?"], ["qpl 1 0"], ["opensource org licenses qpl 1 0"]),
    "ruby": (["ruby license"], ["ruby"], ["ruby lang org license"]),
    "sspl-1.0": (["server side public license(?: version 1)?"], ["sspl 1 0"], ["mongodb com licensing server side public license"]),
    "unicode": (["unicode license agreement"], ["unicode dfs 2016", "unicode 3 0"], ["unicode org license"]),
    "unlicense": (["the unlicense"], ["unlicense"], ["unlicense org"]),
    "upl-1.0": (["universal permissive license(?: version)?(?: 1 0)?"], ["upl 1 0"], ["oss oracle com licenses upl"]),
    "vim": (["vim license"], ["vim"], ["vim org license"]),
    "w3c": (["w3c software notice and license"], ["w3c"], ["w3 org consortium legal copyright software"]),
    "wtfpl": (["do what the fuck you want to public license"], ["wtfpl"], ["wtfpl net"]),
    "zlib": (["zlib license", "zlib libpng license"], ["zlib"], ["zlib net zlib license"]),
    "zpl-2.1": (["zope public license(?: version)?(?: 2 1)?"], ["zpl 2 1"], ["opensource org licenses zpl 2 1"]),
}

#: Notices that name no license.
GENERIC = {
    "copyright-notice": (["all rights reserved"], 0.4),
    "public-domain": (["(?:released into|dedicated to|in) the public domain"], 0.6),
    "proprietary": (["proprietary and confidential", "unauthorized (?:copying|use) (?:is )?(?:strictly )?prohibited"], 0.6),
    "permission-grant": (["permission is hereby granted free of charge to any person obtaining a copy"], 0.8),
    "redistribution": (["redistribution and use in source and binary forms"], 0.8),
    "no-warranty": (["provided as is without warranty of any kind"], 0.5),
}

#: Kinds of notice, best first: pattern around a name, identifier or address, and confidence.
TAG, GRANT, ADDRESS, TITLE, MENTION = range(5)
CONFIDENCE = {TAG: 0.99, GRANT: 0.95, ADDRESS: 0.9, TITLE: 0.8, MENTION: 0.6}
_GRANTED = "(?:licen[cs]ed|released|distributed|available|published|made available) under (?:the )?(?:terms of (?:the )?)?"


@dataclass(frozen=True)
class Rule:
    label: str
    priority: int
    confidence: float
    keyword: str
    pattern: str


def _keyword(pattern: str) -> str:
    """The longest piece of a pattern that any match must contain."""
    plain = re.sub(r"\((?:[^()]|\([^()]*\))*\)\??|\[[^\]]*\]|.\?", "\0", pattern)
    return max(plain.split("\0"), key=len).strip()


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All rules in order: the kinds of notice of every license, then the rest."""
    made = []

    def add(label, priority, confidence, pattern, keyword):
        made.append(Rule(label, priority, confidence, keyword, pattern))

    for label, (names, ids, addresses) in LICENSES.items():
        for i in ids:
            add(label, TAG, CONFIDENCE[TAG], f"spdx license identifier {i}", "spdx license identifier")
            add(label, MENTION, CONFIDENCE[MENTION], f"(?:licen[cs]e {i}|{i} licen[cs]ed?)", _keyword(i))
        for name in names:
            add(label, GRANT, CONFIDENCE[GRANT], _GRANTED + f"(?:{name})", _keyword(name))
            add(label, TITLE, CONFIDENCE[TITLE], name, _keyword(name))
        for address in addresses:
            add(label, ADDRESS, CONFIDENCE[ADDRESS], address, _keyword(address))
    for label, (patterns, confidence) in GENERIC.items():
        for pattern in patterns:
            add(label, MENTION, confidence, pattern, _keyword(pattern))
    return tuple(made)


@lru_cache(maxsize=1)
def _machine():
    """Automaton of all keywords, rules by keyword, compiled patterns, base phrases."""
    by_keyword: dict[str, list[int]] = {}
    for i, rule in enumerate(rules()):
        by_keyword.setdefault(rule.keyword, []).append(i)
    for phrase in BASE:
        by_keyword.setdefault(phrase, [])
    automaton = ahocorasick.Automaton()
    for keyword in by_keyword:
        automaton.add_word(keyword, keyword)
    automaton.make_automaton()
    compiled = [re.compile(f"(?<![^ ])(?:{rule.pattern})(?![^ ])") for rule in rules()]
    base = re.compile(f"(?<![^ ])(?:{'|'.join(BASE)})(?![^ ])")
    return automaton, by_keyword, compiled, base


@dataclass(frozen=True)
class Detection:
    start: int
    end: int
    rule: int


def surviving(found: list[Detection]) -> list[Detection]:
    """Detections that lie inside no other of better priority, nor of the same
    priority and longer (or as long and earlier in the order of rules)."""
    table, reach, kept = rules(), [-1] * (MENTION + 1), []
    for d in sorted(found, key=lambda d: (d.start, -d.end, table[d.rule].priority, d.rule)):
        priority = table[d.rule].priority
        if max(reach[:priority + 1]) < d.end:
            kept.append(d)
        reach[priority] = max(reach[priority], d.end)
    return kept


def _word_places(text: str, spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """First word of each span and the word after it, in one pass over the text."""
    at, words, index = 0, 0, {}
    for place in sorted({p for span in spans for p in span}):
        words += text.count(" ", at, place)
        at, index[place] = place, words
    return [(index[a], index[b] + 1) for a, b in spans]


def scan_text(raw: bytes) -> dict:
    """Counts, places, labels and score of one text."""
    words = spaced(raw).split()
    text = b" ".join(words).decode()
    automaton, by_keyword, compiled, base = _machine()
    keywords = {keyword for _, keyword in automaton.iter(text)}
    result = {
        "n_words": len(words), "n_base": 0, "first_word": None, "last_word": None, "base_labels": [], "labels": [],
        "score": 0.0, "detections": [],
    }
    if not keywords:
        return result
    places = [m.span() for m in base.finditer(text)]
    if places:
        starts = [a for a, _ in _word_places(text, places)]
        result |= {"n_base": len(starts), "first_word": starts[0], "last_word": starts[-1]}
        result["base_labels"] = sorted({BASE[text[a:b]] for a, b in places})
    spans, owners = [], []
    for i in sorted(i for keyword in keywords for i in by_keyword[keyword]):
        for m in compiled[i].finditer(text):
            spans.append(m.span())
            owners.append(i)
    found = [Detection(a, b, i) for (a, b), i in zip(_word_places(text, spans), owners)]
    kept = surviving(found)
    best = dict.fromkeys(result["base_labels"], BASE_CONFIDENCE)
    for d in kept:
        rule = rules()[d.rule]
        best[rule.label] = max(best.get(rule.label, 0.0), rule.confidence)
    missed = 1.0
    for label in sorted(best):
        missed *= 1.0 - best[label]
    result["labels"] = sorted(best)
    result["score"] = round(1.0 - missed, 9)
    result["detections"] = [
        {"label": rules()[d.rule].label, "start": d.start, "end": d.end, "confidence": rules()[d.rule].confidence}
        for d in kept
    ]
    return result


_FIELDS = [
    ("n_words", pa.int64(), "long"), ("n_base", pa.int64(), "long"), ("first_word", pa.int64(), "long"),
    ("last_word", pa.int64(), "long"), ("base_labels", pa.list_(pa.string()), "array<string>"),
    ("labels", pa.list_(pa.string()), "array<string>"), ("score", pa.float64(), "double"),
    ("detections", pa.list_(pa.struct([
        ("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("confidence", pa.float64())])),
     "array<struct<label:string,start:bigint,end:bigint,confidence:double>>"),
]


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score,
    detections`` of every document row; ``start`` and ``end`` count words from 0."""
    def look(batches):
        for batch in batches:
            results = [scan_text(raw) for raw in raw_texts(batch.column(1))]
            columns = [pa.array([r[name] for r in results], type=kind) for name, kind, _ in _FIELDS]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["doc_id", *[f[0] for f in _FIELDS]])

    rows = docs.select("doc_id", "text")
    added = StructType.fromDDL(", ".join(f"{name} {kind}" for name, _, kind in _FIELDS))
    schema = StructType([*rows.select("doc_id").schema.fields, *added.fields])
    return rows.mapInArrow(look, schema)
