"""String functions: normalising, tokenising, answer extraction, cleaning.

Everything here is a ``Column -> Column`` built from JVM expressions. Python's
own notions of punctuation, word character and whitespace are spelled out as
character classes, because Java's ``\\b`` and ``\\s`` differ from Python's on
combining marks and on the ASCII separators 0x1C-0x1F.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The 32 ASCII punctuation marks and the English articles that
# answer normalisation removes.
PUNCTUATION = "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
ARTICLES = ("a", "an", "the")

# Token classes of the recall tokenizer.
TOKEN_PATTERN = r"[\p{L}\p{N}\p{M}]+|[^\p{Z}\p{C}]"

_PUNCTUATION = "[" + "".join("\\" + mark for mark in PUNCTUATION) + "]+"
_WHITESPACE = r"[\t-\r\x1c-\x20\x85\p{Z}]+"
_ARTICLE = rf"(?<![\p{{L}}\p{{N}}])(?:{'|'.join(ARTICLES)})(?![\p{{L}}\p{{N}}])"


def as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once per row.

    Inside array lambdas Spark neither shares common subexpressions nor hoists
    them out of the loop, so a value used there several times needs a name.
    """
    return F.transform(F.array(value), body)[0]


def squeeze(text: Column) -> Column:
    """Runs of any Unicode whitespace become one space; the ends are trimmed."""
    return F.trim(F.regexp_replace(text, _WHITESPACE, " "))


def normalize_text(text: Column | str) -> Column:
    """Lowercase, drop punctuation and articles, squeeze whitespace."""
    bare = F.regexp_replace(F.lower(as_column(text)), _PUNCTUATION, "")
    return squeeze(F.regexp_replace(bare, _ARTICLE, " "))


def words(text: Column | str) -> Column:
    """Split on single spaces; an empty string gives an empty array."""
    text = as_column(text)
    return F.when(text == "", F.array().cast("array<string>")).otherwise(
        F.split(text, " ")
    )


def tokenize(text: Column | str, uncased: bool = True) -> Column:
    """Runs of letters, digits and marks, or single other visible characters."""
    tokens = F.regexp_extract_all(as_column(text), F.lit(TOKEN_PATTERN), F.lit(0))
    return F.transform(tokens, F.lower) if uncased else tokens


def _nfd(text: str | None) -> str | None:
    return None if text is None else unicodedata.normalize("NFD", text)


@F.pandas_udf(T.StringType())
def _nfd_texts(texts: pd.Series) -> pd.Series:
    return texts.map(_nfd)


@F.pandas_udf(T.ArrayType(T.StringType()))
def _nfd_lists(lists: pd.Series) -> pd.Series:
    return lists.map(lambda texts: None if texts is None else [_nfd(t) for t in texts])


# ASCII text is its own decomposition.
_FOREIGN = r"[^\x00-\x7f]"


def decompose(text: Column | str) -> Column:
    """Canonical decomposition (NFD).

    Spark has no built-in for it; only texts with other than ASCII characters
    are sent to Python, the rest travel as null.
    """
    text = as_column(text)
    # "Nondeterministic" keeps the optimizer from moving the call into the array
    # lambdas that read its result.
    nfd = _nfd_texts.asNondeterministic()
    return F.coalesce(nfd(F.when(text.rlike(_FOREIGN), text)), text)


def decompose_all(texts: Column | str) -> Column:
    """``decompose`` for every element of an array."""
    texts = as_column(texts)
    foreign = F.exists(texts, lambda t: t.rlike(_FOREIGN))
    nfd = _nfd_lists.asNondeterministic()
    return F.coalesce(nfd(F.when(foreign, texts)), texts)


def _checked(pattern: str | None) -> str | None:
    if not pattern:
        return None
    if re.compile(pattern).search(""):
        raise ValueError(f"pattern may not match the empty string: {pattern!r}")
    return pattern


def regex_answer(
    capture: str | None = None, stop: str | None = None
) -> Callable[[Column], Column]:
    """Answer processor: keep group 1 of the first match, cut at the first stop.

    Text without a match stays as it is; an empty pattern switches its part off.
    """
    # Capturing searches with "dot matches all" and "multi-line"; (?d) limits
    # line ends to \n and (?U) makes \w, \d and \s cover all scripts.
    capture = f"(?msdU){capture}" if capture else None
    if capture and re.compile(capture[len("(?msdU)"):]).groups < 1:
        raise ValueError("the capture pattern needs a group")
    stop = f"(?dU){stop}" if _checked(stop) else None

    def process(text: Column) -> Column:
        if capture:
            text = F.when(
                text.rlike(capture), F.regexp_extract(text, capture, 1)
            ).otherwise(text)
        if stop:
            text = F.split(text, stop, 2)[0]
        return text

    return process


def clean_document(text: Column | str) -> Column:
    """Squeeze blanks inside each line and drop the empty lines."""
    lines = F.transform(
        F.split(as_column(text), "\n"),
        lambda line: F.trim(F.regexp_replace(line, r"[ \t]+", " ")),
    )
    return F.array_join(F.filter(lines, lambda line: line != ""), "\n")


def chunk_words(
    text: Column | str, length: int = 200, overlap: int = 20
) -> Column:
    """Array of overlapping word windows over the whole text.

    Windows start every ``length - overlap`` words; the last one ends at the
    last word and may be shorter. A text without words gives no window.
    """
    step = length - overlap
    if length < 1 or overlap < 0 or step < 1:
        raise ValueError("need length > overlap >= 0")

    def cut(parts: Column) -> Column:
        count = F.size(parts)
        last = F.when(count <= length, F.lit(0)).otherwise(
            F.ceil((count - length) / F.lit(step)).cast("int") * step
        )
        windows = F.transform(
            F.sequence(F.lit(0), last, F.lit(step)),
            lambda start: F.array_join(F.slice(parts, start + 1, F.lit(length)), " "),
        )
        return F.filter(windows, lambda w: F.trim(w) != "")

    return let(words(text), cut)
