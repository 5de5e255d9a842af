"""Text cleaning and tokenising as column expressions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .porter import stem_tokens

# English stop words.  Tokens hold letters only by the time they
# are tested, so the list has the pieces an apostrophe leaves (don, t, ll).
STOP_WORDS = """
i me my myself we our ours ourselves you your yours yourself yourselves he him
his himself she her hers herself it its itself they them their theirs themselves
what which who whom this that these those am is are was were be been being have
has had having do does did doing a an the and but if or because as until while
of at by for with about against between into through during before after above
below to from up down in out on off over under again further then once here
there when where why how all any both each few more most other some such no nor
not only own same so than too very s t can will just don should now d ll m o re
ve y ain aren couldn didn doesn hadn hasn haven isn ma mightn mustn needn shan
shouldn wasn weren won wouldn
""".split()

# The patterns of the cleaning step, in the order they apply.
ESCAPED_CRLF = r"\r\n"          # the four characters, not the control codes
NON_LETTER = "[^a-zA-Z]"
BLANKS = r"\s+"


def join_subject_message(subject: Column, message: Column, na_token: str | None = "") -> Column:
    """``subject + " " + message``.  A null side becomes ``na_token``; with
    ``na_token=None`` it makes the whole text null."""
    if na_token is not None:
        subject = F.coalesce(subject, F.lit(na_token))
        message = F.coalesce(message, F.lit(na_token))
    return F.concat(subject, F.lit(" "), message)


def strip_escaped_crlf(text: Column) -> Column:
    return F.replace(text, F.lit(ESCAPED_CRLF), F.lit(" "))


def strip_non_alpha(text: Column) -> Column:
    return F.regexp_replace(text, NON_LETTER, " ")


def collapse_spaces(text: Column) -> Column:
    return F.regexp_replace(text, BLANKS, " ")


def as_printed_row(text: Column) -> Column:
    """The text as the printed form of a one-column row shows it.

    Control characters appear as escapes, so a lone newline leaves an ``n`` glued
    to the next word, and the words ``row`` and ``joint`` lead every text.
    """
    for control, escape in (("\r", "\\r"), ("\n", "\\n"), ("\t", "\\t")):
        text = F.replace(text, F.lit(control), F.lit(escape))
    return F.concat(F.lit("Row(joint='"), F.coalesce(text, F.lit("None")), F.lit("')"))


def clean_text(text: Column, repr_compat: bool = False) -> Column:
    """Lower-case text with every run of other characters turned into one space.

    Replacing runs at once gives what :func:`strip_non_alpha` followed by
    :func:`collapse_spaces` gives, in one pass over the text.
    """
    if repr_compat:
        text = as_printed_row(text)
    return F.regexp_replace(strip_escaped_crlf(F.lower(text)), "[^a-z]+", " ")


def tokenize(cleaned: Column) -> Column:
    """Words of a cleaned text."""
    return F.filter(F.split(cleaned, " "), lambda t: t != "")


def remove_stopwords(tokens: Column, stop_words: Sequence[str] = STOP_WORDS) -> Column:
    if not stop_words:
        return tokens
    return F.filter(tokens, lambda t: ~t.isin(list(stop_words)))


def preprocess_tokens(
    text: Column, stop_words: Sequence[str] = STOP_WORDS, repr_compat: bool = False
) -> Column:
    """Stems of the words of a text that are not stop words, in order."""
    return stem_tokens(remove_stopwords(tokenize(clean_text(text, repr_compat)), stop_words))


def preprocess(
    text: Column, stop_words: Sequence[str] = STOP_WORDS, repr_compat: bool = False
) -> Column:
    """:func:`preprocess_tokens` joined by single spaces."""
    return F.array_join(preprocess_tokens(text, stop_words, repr_compat), " ")


def vectorizer_tokens(tokens: Column) -> Column:
    """Tokens the vectoriser sees: those of two or more characters."""
    return F.filter(tokens, lambda t: F.length(t) > 1)


def encode_label(label: Column, positive: str = "spam") -> Column:
    """1 for exactly the positive label, 0 for any other and for null."""
    return F.when(label == positive, 1).otherwise(0)


def truncate3(value: Column) -> Column:
    """Three decimals, cut off rather than rounded."""
    return F.when(value < 0, F.ceil(value * 1000)).otherwise(F.floor(value * 1000)) / F.lit(1000.0)
