"""Porter's algorithm letter by letter, to check the expression form against.

Works on the consonant-vowel pattern of a word instead of regular expressions.
"""

from itertools import groupby

from sieveline.functions.porter import IRREGULAR, STEP_2, STEP_3, STEP_4


def pattern(word):
    """The word in letters c and v."""
    kinds = ""
    for i, letter in enumerate(word):
        vowel = letter in "aeiou" or (letter == "y" and i > 0 and kinds[-1] == "c")
        kinds += "v" if vowel else "c"
    return kinds


def measure(word):
    return "".join(k for k, _ in groupby(pattern(word))).count("vc")


def short(word):
    kinds = pattern(word)
    return kinds == "vc" or (kinds.endswith("cvc") and word[-1] not in "wxy")


def apply(word, rules):
    for suffix, replacement, qualifies in rules:
        if word.endswith(suffix):
            stem = word[: len(word) - len(suffix)]
            return stem + replacement if qualifies(stem) else word
    return word


def step_1b(word):
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if measure(word[:-3]) > 0 else word
    for suffix in ("ed", "ing"):
        stem = word[: len(word) - len(suffix)]
        if word.endswith(suffix) and "v" in pattern(stem):
            if stem.endswith(("at", "bl", "iz")):
                return stem + "e"
            if len(stem) > 1 and stem[-1] == stem[-2] and pattern(stem)[-1] == "c":
                return stem if stem[-1] in "lsz" else stem[:-1]
            return stem + "e" if measure(stem) == 1 and short(stem) else stem
    return word


def stem(word):
    if word in IRREGULAR:
        return IRREGULAR[word]
    if len(word) <= 2:
        return word
    if word.endswith("ies") and len(word) == 4:
        word = word[:-1]
    else:
        word = apply(word, [("sses", "ss", bool), ("ies", "i", lambda s: True), ("ss", "ss", lambda s: True), ("s", "", lambda s: True)])
    word = step_1b(word)
    if word.endswith("y") and len(word) > 2 and pattern(word[:-1])[-1] == "c":
        word = word[:-1] + "i"
    if word.endswith("alli") and measure(word[:-4]) > 0:
        word = word[:-2]
    positive = lambda s: measure(s) > 0
    word = apply(word, [(s, r, positive) for s, r in STEP_2] + [("logi", "log", lambda s: measure(s + "l") > 0)])
    word = apply(word, [(s, r, positive) for s, r in STEP_3])
    long = lambda s: measure(s) > 1
    word = apply(word, [(s, "", (lambda t: long(t) and t[-1] in "st") if s == "ion" else long) for s in STEP_4])
    if word.endswith("e"):
        rest = word[:-1]
        if measure(rest) > 1 or (measure(rest) == 1 and not short(rest)):
            word = rest
    if word.endswith("ll") and measure(word[:-1]) > 1:
        word = word[:-1]
    return word
