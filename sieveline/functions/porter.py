"""Porter stemming as Catalyst expressions.

M. F. Porter, "An algorithm for suffix stripping", Program 14(3), 1980, with the
extra rules the widely used NLTK implementation applies by default (short words
are left alone, ``dies`` -> ``die``, ``fulli`` -> ``ful``, a few irregular words).

Every step is a ``CASE`` over suffixes.  The tests on the remaining stem (its
measure, whether it holds a vowel, whether it ends consonant-vowel-consonant)
are anchored regular expressions, so a whole document is stemmed inside the JVM
by one chain of ``transform`` calls over its token array and nothing shuffles.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .arrays import bind

# Letter classes of the published algorithm.  A y counts as a
# consonant at the start of a word or after a vowel, and as a vowel elsewhere.
CONSONANTS = "[^aeiou][^aeiouy]*"
VOWELS = "[aeiouy][aeiou]*"

# Conditions on a stem, written [C](VC)^m[V] in the paper.
HAS_VOWEL = f"^({CONSONANTS}[aeiouy]|[aeiou])"
MEASURE_GT_0 = f"{HAS_VOWEL}[aeiou]*{CONSONANTS}"
MEASURE_GT_1 = f"{MEASURE_GT_0}{VOWELS}{CONSONANTS}"
MEASURE_EQ_1 = f"{MEASURE_GT_0}({VOWELS})?$"
# m = 1 and the stem ends consonant, vowel, consonant other than w, x, y;
# a two-letter vowel-consonant stem counts as well.
SHORT_STEM = f"^({CONSONANTS}[aeiouy][^aeiouwxy]|[aeiou][^aeiou])$"
# Doubled last consonant other than l, s, z.
DOUBLE_CONSONANT = (
    "(bb|cc|dd|ff|gg|hh|jj|kk|mm|nn|pp|qq|rr|tt|vv|ww|xx"
    "|(^|[aeiou])y(yy)+|[^aeiouy](yy)+)$"
)
DOUBLE_L_S_Z = "(ll|ss|zz)$"
ENDS_CONSONANT = "(^|[aeiou])(yy)*y$|[^aeiouy](yy)+$|[^aeiouy]$"

# Suffix rules of steps 2, 3 and 4, tried in this order.
STEP_2 = [
    ("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"),
    ("izer", "ize"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"),
    ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"),
    ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"),
    ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
    ("fulli", "ful"),
]
STEP_3 = [
    ("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"),
    ("ical", "ic"), ("ful", ""), ("ness", ""),
]
STEP_4 = [
    "al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment",
    "ent", "ion", "ou", "ism", "ate", "iti", "ous", "ive", "ize",
]

# Words with a stem of their own.
IRREGULAR = {
    "sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie",
    "news": "news", "innings": "inning", "inning": "inning",
    "outings": "outing", "outing": "outing", "cannings": "canning",
    "canning": "canning", "howe": "howe", "proceed": "proceed",
    "exceed": "exceed", "succeed": "succeed",
}


def _drop(word: Column, n: int) -> Column:
    """The word without its last ``n`` letters."""
    return F.substring(word, F.lit(1), F.length(word) - n)


def _ends(word: Column, suffix: str) -> Column:
    return F.endswith(word, F.lit(suffix))


def _case(branches: list[tuple[Column, Column]], otherwise: Column) -> Column:
    (cond, value), *rest = branches
    return reduce(lambda case, b: case.when(*b), rest, F.when(cond, value)).otherwise(otherwise)


def _first_suffix(word: Column, rules: list[tuple[str, Column]]) -> Column:
    """Result of the first suffix that fits.  Looking at the last letter first
    spares most words the whole list; suffixes with different last letters can
    never compete, so the order that matters is kept."""
    by_letter: dict[str, list[tuple[str, Column]]] = {}
    for suffix, value in rules:
        by_letter.setdefault(suffix[-1], []).append((suffix, value))
    return _case(
        [
            (_ends(word, letter), _case([(_ends(word, s), v) for s, v in group], word))
            for letter, group in by_letter.items()
        ],
        word,
    )


def _if_stem(word: Column, suffix: str, replacement: str, condition: str) -> Column:
    """The word with its suffix replaced if what precedes it qualifies."""
    stem = _drop(word, len(suffix))
    return F.when(F.rlike(stem, F.lit(condition)), F.concat(stem, F.lit(replacement))).otherwise(word)


def plural(w: Column) -> Column:
    """Step 1a."""
    return _first_suffix(w, [
        ("sses", _drop(w, 2)),
        ("ies", F.when(F.length(w) == 4, _drop(w, 1)).otherwise(_drop(w, 2))),
        ("ss", w),
        ("s", _drop(w, 1)),
    ])


def past_and_gerund(w: Column) -> Column:
    """Step 1b, first half.  A bar marks a stem whose ending is still to be mended."""
    def cut(n: int) -> Column:
        return F.when(F.rlike(_drop(w, n), F.lit(HAS_VOWEL)), F.concat(_drop(w, n), F.lit("|"))).otherwise(w)

    return _first_suffix(w, [
        ("ied", F.when(F.length(w) == 4, _drop(w, 1)).otherwise(_drop(w, 2))),
        ("eed", _if_stem(w, "eed", "ee", MEASURE_GT_0)),
        ("ed", cut(2)),
        ("ing", cut(3)),
    ])


def mend_ending(w: Column) -> Column:
    """Step 1b, second half."""
    stem = _drop(w, 1)
    mended = _case(
        [
            (F.rlike(stem, F.lit("(at|bl|iz)$")), F.concat(stem, F.lit("e"))),
            (F.rlike(stem, F.lit(DOUBLE_CONSONANT)), _drop(w, 2)),
            (F.rlike(stem, F.lit(DOUBLE_L_S_Z)), stem),
            (F.rlike(stem, F.lit(SHORT_STEM)), F.concat(stem, F.lit("e"))),
        ],
        stem,
    )
    return F.when(_ends(w, "|"), mended).otherwise(w)


def final_y(w: Column) -> Column:
    """Step 1c."""
    stem = _drop(w, 1)
    return F.when(
        _ends(w, "y") & (F.length(w) > 2) & F.rlike(stem, F.lit(ENDS_CONSONANT)),
        F.concat(stem, F.lit("i")),
    ).otherwise(w)


def derivational_alli(w: Column) -> Column:
    """Step 2, ahead of its list: ``alli`` -> ``al`` so that the list applies to the result."""
    return F.when(
        _ends(w, "alli") & F.rlike(_drop(w, 4), F.lit(MEASURE_GT_0)), _drop(w, 2)
    ).otherwise(w)


def derivational(w: Column) -> Column:
    """Step 2.  The l of ``logi`` counts towards the stem, so ``theologi`` qualifies."""
    logi = F.when(F.rlike(_drop(w, 3), F.lit(MEASURE_GT_0)), _drop(w, 1)).otherwise(w)
    return _first_suffix(w, [(s, _if_stem(w, s, r, MEASURE_GT_0)) for s, r in STEP_2] + [("logi", logi)])


def adjectival(w: Column) -> Column:
    """Step 3."""
    return _first_suffix(w, [(s, _if_stem(w, s, r, MEASURE_GT_0)) for s, r in STEP_3])


def residual(w: Column) -> Column:
    """Step 4.  ``ion`` goes only after s or t."""
    rules = [(s, _if_stem(w, s, "", MEASURE_GT_1)) for s in STEP_4 if s != "ion"]
    ion = F.when(F.rlike(w, F.lit("[st]ion$")), _if_stem(w, "ion", "", MEASURE_GT_1)).otherwise(w)
    return _first_suffix(w, rules + [("ion", ion)])


def final_e(w: Column) -> Column:
    """Step 5a."""
    stem = _drop(w, 1)
    drop = F.rlike(stem, F.lit(MEASURE_GT_1)) | (
        F.rlike(stem, F.lit(MEASURE_EQ_1)) & ~F.rlike(stem, F.lit(SHORT_STEM))
    )
    return F.when(_ends(w, "e") & drop, stem).otherwise(w)


def final_double_l(w: Column) -> Column:
    """Step 5b."""
    return F.when(_ends(w, "ll") & F.rlike(_drop(w, 1), F.lit(MEASURE_GT_1)), _drop(w, 1)).otherwise(w)


STEPS = [
    plural, past_and_gerund, mend_ending, final_y, derivational_alli, derivational,
    adjectival, residual, final_e, final_double_l,
]


def _keep_exceptions(word: Column, stem: Column) -> Column:
    """Words of one or two letters and irregular words do not follow the rules."""
    irregular = _case([(word == w, F.lit(s)) for w, s in IRREGULAR.items()], stem)
    return (
        F.when(F.length(word) <= 2, word)
        .when(word.isin(list(IRREGULAR)), irregular)
        .otherwise(stem)
    )


def stem_tokens(tokens: Column) -> Column:
    """Stem every element of an array of lower-case words."""
    def stem(words: Column) -> Column:
        return F.zip_with(words, reduce(F.transform, STEPS, words), _keep_exceptions)

    return bind(tokens, stem)


# The same steps for one word, for tasks that stem each distinct word once.

_HAS_VOWEL, _GT_0, _GT_1, _EQ_1, _SHORT, _DOUBLED, _CONSONANT = (
    re.compile(p) for p in (
        HAS_VOWEL, MEASURE_GT_0, MEASURE_GT_1, MEASURE_EQ_1, SHORT_STEM, DOUBLE_CONSONANT, ENDS_CONSONANT
    )
)


def _replaced(word: str, rules, condition: re.Pattern) -> str:
    for suffix, replacement in rules:
        if word.endswith(suffix):
            stem = word[:-len(suffix)]
            return stem + replacement if condition.search(stem) else word
    return word


def _without_plural(w: str) -> str:
    if w.endswith("sses"):
        return w[:-2]
    if w.endswith("ies"):
        return w[:-1] if len(w) == 4 else w[:-2]
    return w[:-1] if w.endswith("s") and not w.endswith("ss") else w


def _without_past_and_gerund(w: str) -> str:
    if w.endswith("ied"):
        return w[:-1] if len(w) == 4 else w[:-2]
    if w.endswith("eed"):
        return w[:-1] if _GT_0.search(w[:-3]) else w
    stem = w[:-2] if w.endswith("ed") else w[:-3] if w.endswith("ing") else None
    if stem is None or not _HAS_VOWEL.search(stem):
        return w
    if stem.endswith(("at", "bl", "iz")):
        return stem + "e"
    if _DOUBLED.search(stem):
        return stem[:-1]
    if stem.endswith(("ll", "ss", "zz")):
        return stem
    return stem + "e" if _SHORT.search(stem) else stem


def stem_word(word: str) -> str:
    """What :func:`stem_tokens` makes of one word of the letters a to z."""
    if len(word) <= 2:
        return word
    if word in IRREGULAR:
        return IRREGULAR[word]
    w = _without_past_and_gerund(_without_plural(word))
    if w.endswith("y") and len(w) > 2 and _CONSONANT.search(w[:-1]):
        w = w[:-1] + "i"
    if w.endswith("alli") and _GT_0.search(w[:-4]):
        w = w[:-2]
    if w.endswith("logi"):
        w = w[:-1] if _GT_0.search(w[:-3]) else w
    else:
        w = _replaced(w, STEP_2, _GT_0)
    w = _replaced(w, STEP_3, _GT_0)
    if w.endswith("ion"):
        w = w[:-3] if w.endswith(("sion", "tion")) and _GT_1.search(w[:-3]) else w
    else:
        w = _replaced(w, [(suffix, "") for suffix in STEP_4], _GT_1)
    if w.endswith("e"):
        stem = w[:-1]
        if _GT_1.search(stem) or (_EQ_1.search(stem) and not _SHORT.search(stem)):
            w = stem
    return w[:-1] if w.endswith("ll") and _GT_1.search(w[:-1]) else w
