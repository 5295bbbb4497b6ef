"""Text expressions shared by the operators.

Regexes stay inside the subset that Java and RE2 read the same way (no
look-around, no back-references) so every operator has a SQL twin.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Whitespace and word patterns used by tokenisers.
WS = r"\s+"
WORD_SPLIT = r"[^\p{L}\p{N}]+"
WORD = r"[\p{L}\p{N}]++"  # what WORD_SPLIT leaves (possessive: nothing to try again)
SENTENCE_SPLIT = r"[.!?]+(\s+|$)"


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_ws(c) -> Column:
    """Python-style ``str.strip()`` on ASCII whitespace (trim() only strips
    spaces)."""
    return F.regexp_replace(col(c), r"^\s+|\s+$", "")


def _split_nonempty(c: Column, sep: str) -> Column:
    """``split`` without empty pieces, with no per-element lambda: trim the
    separators at both ends first (a greedy separator never yields an empty
    piece in the middle) and map the empty string to an empty array."""
    core = F.regexp_replace(c, f"^(?:{sep})|(?:{sep})$", "")
    return F.when(core == "", F.array().cast("array<string>")).otherwise(F.split(core, sep))


def ws_tokens(c) -> Column:
    """Non-empty whitespace-separated tokens (the chunker's token)."""
    return _split_nonempty(col(c), WS)


def word_tokens(c) -> Column:
    """Lower-cased letter/digit runs (the lexical and judge token), found in
    one pass over the text."""
    return F.regexp_extract_all(F.lower(col(c)), F.lit(WORD), F.lit(0))


def sentences(c) -> Column:
    """Sentence split on terminal punctuation; blank pieces dropped."""
    return F.filter(F.transform(F.split(col(c), SENTENCE_SPLIT), strip_ws),
                    lambda s: s != F.lit(""))


def first_sentence(c) -> Column:
    return F.coalesce(F.get(sentences(c), 0), F.lit(""))


def last_line(c) -> Column:
    """Last ``\\n``-separated line, stripped."""
    return strip_ws(F.element_at(F.split(col(c), "\n"), -1))


def contains_yes(c) -> Column:
    """Verdict test: case-sensitive substring anywhere in the reply."""
    return F.coalesce(col(c).contains("Yes"), F.lit(False))
