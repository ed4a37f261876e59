"""License notices, found exactly and with errors.

A notice may differ in k characters. Cut into k + 1 pieces, at least one piece then
stands unchanged, so the places of all pieces, found at once by an automaton, show
every candidate. Around each candidate, exact places are taken first; then bounded
error matching of the ``regex`` library verifies the rest and gives span and errors.

Texts are compared as words (letters, digits and all non-ASCII characters, A-Z in
lower case) joined by single spaces; spans begin and end at words.

Defined cases: null and empty texts have no words and no spans; overlapping notices
are all reported; repeated rows are treated alike; extra columns pass through.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import ahocorasick
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ragtables.llm.base import put
from ragtables.llm.words import NO_LETTERS

# The phrases whose exact places count.
BASE = (
    ("mit", "mit license"),
    ("apache", "apache license"),
    ("gpl", "general public license"),
)
# Short notices that are also found with errors.
NOTICES = (
    *BASE,
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy"),
    ("apache", "licensed under the apache license version 2 0"),
    ("gpl", "gnu general public license version 3"),
    ("lgpl", "gnu lesser general public license"),
    ("bsd", "redistribution and use in source and binary forms"),
    ("mpl", "mozilla public license"),
    ("cc", "creative commons attribution"),
    ("cc", "licensed under cc by"),
)
# One error for so many characters of a notice.
PER_ERROR = 10


class Span(NamedTuple):
    notice: int
    start: int  # in characters of the joined words
    stop: int
    errors: int


class Searcher:
    """Finds all notices in joined words."""

    def __init__(self, notices: tuple[tuple[str, str], ...], per_error: int = PER_ERROR) -> None:
        self.notices = notices
        self.errors = [len(phrase) // per_error for _, phrase in notices]
        seeds: dict[str, list[tuple[int, int]]] = {}
        self.patterns = []
        for number, (_, phrase) in enumerate(notices):
            k = self.errors[number]
            cuts = [len(phrase) * i // (k + 1) for i in range(k + 2)]
            for a, b in zip(cuts, cuts[1:]):
                seeds.setdefault(phrase[a:b], []).append((number, a))
            fuzzy = f"(?:{regex.escape(phrase, literal_spaces=True)}){{e<={k}}}" if k else regex.escape(phrase)
            self.patterns.append(regex.compile(rf"(?b)(?<![^ ]){fuzzy}(?![^ ])"))
        self.seeds = ahocorasick.Automaton()
        for seed, uses in seeds.items():
            self.seeds.add_word(seed, (len(seed), uses))
        self.seeds.make_automaton()

    def _regions(self, text: str) -> dict[int, list[list[int]]]:
        """Joined places where each notice may stand."""
        out: dict[int, list[list[int]]] = {}
        for end, (size, uses) in self.seeds.iter(text):
            for number, offset in uses:
                k, length = self.errors[number], len(self.notices[number][1])
                low = max(0, end - size + 1 - offset - k)
                high = min(len(text), end - size + 1 - offset + length + k)
                found = out.setdefault(number, [])
                if found and low <= found[-1][1] + 1:
                    found[-1][0] = min(low, found[-1][0])
                    found[-1][1] = max(high, found[-1][1])
                else:
                    found.append([low, high])
        return out

    def _near(self, number: int, text: str, low: int, high: int) -> list[Span]:
        """Inexact matches between two places: the best one, and then those on either
        side of it. A match is of whole words, so parts of words at the ends are left out."""
        out, todo = [], [(low, high)]
        while todo:
            a, b = todo.pop()
            while a < b and a and text[a - 1] != " ":
                a += 1
            while a < b < len(text) and text[b] != " ":
                b -= 1
            if b - a < len(self.notices[number][1]) // 2:
                continue
            m = self.patterns[number].search(text, a, b)
            own = m.group().strip(" ") if m else ""
            if not own:
                continue
            # An error may have taken up a space at an end.
            start = m.start() + len(m.group()) - len(m.group().lstrip(" "))
            stop = start + len(own)
            if sum(m.fuzzy_counts):
                out.append(Span(number, start, stop, sum(m.fuzzy_counts)))
            todo += [(stop, b), (a, start)]
        return out

    def spans(self, text: str) -> list[Span]:
        out = []
        for number, regions in sorted(self._regions(text).items()):
            phrase = self.notices[number][1]
            for low, high in regions:
                at = low
                rest = []  # between the exact places
                place = text.find(phrase, low, high)
                while place >= 0:
                    stop = place + len(phrase)
                    if (place == 0 or text[place - 1] == " ") and text[stop : stop + 1] in ("", " "):
                        out.append(Span(number, place, stop, 0))
                        rest.append((at, place))
                        at = stop
                    place = text.find(phrase, place + 1, high)
                rest.append((at, high))
                for a, b in rest:
                    out += self._near(number, text, a, b)
        return out


def _table() -> bytes:
    """Separators become spaces, A-Z lower case."""
    return bytes(
        0x20 if b in NO_LETTERS and not 0x41 <= b <= 0x5A else b + 32 if 0x41 <= b <= 0x5A else b
        for b in range(256)
    )


def _searched(notices: tuple[tuple[str, str], ...], base: int, text: str) -> Column:
    kind = (
        "struct<n_words: long, n_base: long, first_word: long, last_word: long,"
        " base_labels: string, labels: string, score: double,"
        " spans: array<struct<label: string, first: long, last: long, errors: int, words: string>>>"
    )

    @F.arrow_udf(kind)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        searcher, table = Searcher(notices), _table()
        fields = ("n_words n_base first_word last_word base_labels labels score spans").split()
        span_type = pa.struct(
            [("label", pa.string()), ("first", pa.int64()), ("last", pa.int64()), ("errors", pa.int32()), ("words", pa.string())]
        )
        types = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(span_type)]
        for texts in batches:
            rows = []
            for value in texts:
                words = (value.as_py() or "").encode("utf-8", "replace").translate(table).split()
                joined = b" ".join(words).decode()
                found = searcher.spans(joined)
                starts = [joined.count(" ", 0, s.start) for s in found]
                exact = sorted(p for s, p in zip(found, starts) if not s.errors and s.notice < base)
                score = max((1 - s.errors / len(notices[s.notice][1]) for s in found), default=0.0)
                spans = [
                    {
                        "label": notices[s.notice][0],
                        "first": p,
                        "last": p + joined.count(" ", s.start, s.stop),
                        "errors": s.errors,
                        "words": joined[s.start : s.stop],
                    }
                    for s, p in zip(found, starts)
                ]
                rows.append(
                    (
                        len(words),
                        len(exact),
                        exact[0] if exact else None,
                        exact[-1] if exact else None,
                        ",".join(sorted({notices[s.notice][0] for s in found if not s.errors and s.notice < base})),
                        ",".join(sorted({s["label"] for s in spans})),
                        max(0.0, score),
                        spans,
                    )
                )
            columns = zip(*rows) if rows else [[]] * len(fields)
            yield pa.StructArray.from_arrays(
                [pa.array(list(c), t) for c, t in zip(columns, types)], fields
            )

    return run(F.col(f"`{text}`"))


def license_scan(
    docs: DataFrame,
    text: str = "text",
    base: tuple[tuple[str, str], ...] = BASE,
    more: tuple[tuple[str, str], ...] = NOTICES[len(BASE) :],
) -> DataFrame:
    """``docs`` with ``n_words``, ``n_base``, ``first_word``, ``last_word``,
    ``base_labels``, ``labels``, ``score`` (1 less the best span's share of errors)
    and ``spans`` (label, first and last word, errors, words)."""
    rows = put(docs, found_=_searched((*base, *more), len(base), text))
    names = "n_words n_base first_word last_word base_labels labels score spans".split()
    return put(rows, **{n: F.col(f"found_.{n}") for n in names}).drop("found_")
