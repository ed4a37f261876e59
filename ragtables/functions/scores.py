"""Answer scores as column expressions.

Each score takes the prediction and an array of accepted references, and
returns the best score over the references; an empty array scores 0.

Cleaning and normalising text, and every score that is a comparison or a search,
stay in the JVM. Counting shared tokens and finding common subsequences have no
built-in: written as array lambdas they run interpreted (measured four times
slower on 1,000-character answers), so they are Arrow functions that get cleaned
text and return numbers.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator, Sequence
from itertools import islice

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ragtables.functions.text import as_column, let, normalize_text, tokenize

# The names of the ROUGE scores.
ROUGE = ("rouge1", "rouge2", "rougeL", "rougeLsum")


def f_measure(hits: int, said: int, wanted: int) -> float:
    if not hits:
        return 0.0
    precision, recall = hits / said, hits / wanted
    return 2 * precision * recall / (precision + recall)


def overlap_f(said: Counter, wanted: Counter) -> float:
    """F-measure of the multiset overlap of two token counts."""
    return f_measure((said & wanted).total(), said.total(), wanted.total())


def _texts(values: Sequence[str | None] | None) -> list[str]:
    return [v for v in values if v is not None] if values is not None else []


@F.pandas_udf(T.DoubleType())
def _f1(said: pd.Series, wanted: pd.Series) -> pd.Series:
    scores = []
    for prediction, references in zip(said, wanted):
        tokens = Counter((prediction or "").split())
        scores.append(
            max(
                (overlap_f(tokens, Counter(r.split())) for r in _texts(references)),
                default=0.0,
            )
        )
    return pd.Series(scores, dtype="float64")


def f1(prediction: Column | str, references: Column | str) -> Column:
    """Token F1 of the normalised texts."""
    return f1_normalized(
        normalize_text(prediction), F.transform(as_column(references), normalize_text)
    )


def f1_normalized(prediction: Column | str, references: Column | str) -> Column:
    """Token F1 of texts that are normalised already."""
    return _f1(as_column(prediction), as_column(references))


def exact_match(prediction: Column | str, references: Column | str) -> Column:
    """1 if the normalised prediction equals a normalised reference."""
    return exact_match_normalized(
        normalize_text(prediction), F.transform(as_column(references), normalize_text)
    )


def exact_match_normalized(
    prediction: Column | str, references: Column | str
) -> Column:
    """1 if the prediction equals a reference, both normalised already."""
    hit = F.array_contains(as_column(references), as_column(prediction))
    return F.coalesce(hit, F.lit(False)).cast("double")


def string_match(prediction: Column | str, groups: Column | str) -> Column:
    """Share of answer groups with a candidate inside the normalised prediction.

    Candidates are searched as they are given, without normalising them.
    """
    return string_match_normalized(normalize_text(prediction), groups)


def string_match_normalized(prediction: Column | str, groups: Column | str) -> Column:
    """``string_match`` with a prediction that is normalised already."""
    groups = as_column(groups)
    found = let(
        as_column(prediction),
        lambda said: F.size(
            F.filter(groups, lambda g: F.exists(g, lambda c: F.contains(said, c)))
        ),
    )
    return F.when(F.size(groups) > 0, found / F.size(groups)).otherwise(F.lit(0.0))


def recall_match(prediction: Column | str, references: Column | str) -> Column:
    """1 if the tokens of a reference occur in a row in the prediction.

    Both sides must be decomposed already (``text.decompose``), in a step of its
    own: Spark allows no Python function inside an array lambda. No token holds a
    blank, so the search is one substring test on the tokens joined by blanks. A
    reference without tokens is always found.
    """
    prediction, references = as_column(prediction), as_column(references)

    def padded(text: Column) -> Column:
        joined = F.lower(F.array_join(tokenize(text, uncased=False), " "))
        return F.concat(F.lit(" "), joined, F.lit(" "))

    def found(said: Column) -> Column:
        return F.exists(
            references,
            lambda r: let(padded(r), lambda p: (p == "  ") | F.contains(said, p)),
        )

    hit = let(padded(prediction), found)
    return F.coalesce(hit, F.lit(False)).cast("double")


def yes_no_class(text: Column | str) -> Column:
    """1 if the text contains "yes", else 0 if it contains "no", else 2."""
    text = as_column(text)
    return (
        F.when(F.contains(text, F.lit("yes")), 1)
        .when(F.contains(text, F.lit("no")), 0)
        .otherwise(2)
    )


def label_class(label: Column | str, mapping: dict[str, int], other: int = 2) -> Column:
    """Class of a normalised label, ``other`` if it is not mapped."""
    label = as_column(label)
    result = F.lit(other)
    for text, number in mapping.items():
        result = F.when(label == text, number).otherwise(result)
    return result


def _bits(tokens: list[str]) -> dict[str, int]:
    """The positions of each token, as the bits of a number."""
    where: dict[str, int] = {}
    for position, token in enumerate(tokens):
        where[token] = where.get(token, 0) | (1 << position)
    return where


def _lcs_rows(
    down: list[str], across: dict[str, int], width: int, row: int | None = None
) -> Iterator[int]:
    """Rows of the common-subsequence table, one bit per token of ``across``, from the
    first or, below a known ``row``, from that one.

    A clear bit marks a column where the length grows by one, so one Python
    integer holds a whole row (bit-parallel method of Hyyro 2004).
    """
    everything = (1 << width) - 1
    row = everything if row is None else row
    yield row
    for token in down:
        matched = row & across.get(token, 0)
        row = ((row + matched) | (row - matched)) & everything
        yield row


class _LcsTable:
    """The rows of a table, by number, to be asked for from the last to the first.

    Every so many rows one is kept, and the stretch below it is computed again when it
    is reached, so about twice the square root of the number of rows is held.
    """

    def __init__(self, down: list[str], across: list[str]):
        self.down, self.across, self.width = down, _bits(across), len(across)
        self.step = math.isqrt(len(down)) + 1
        self.kept = list(islice(self._rows(0, len(down)), 0, None, self.step))
        self.first, self.stretch = len(down) + 1, []

    def _rows(self, first: int, last: int, row: int | None = None) -> Iterator[int]:
        return _lcs_rows(self.down[first:last], self.across, self.width, row)

    def __getitem__(self, number: int) -> int:
        if number < self.first:
            block = number // self.step
            self.first = block * self.step
            self.stretch = list(
                self._rows(self.first, self.first + self.step - 1, self.kept[block])
            )
        return self.stretch[number - self.first]


def lcs_length(left: list[str], right: list[str]) -> int:
    """Length of the longest common subsequence."""
    row = 0
    for row in _lcs_rows(right, _bits(left), len(left)):
        pass
    return len(left) - row.bit_count()


def lcs_positions(wanted: list[str], said: list[str]) -> list[int]:
    """Positions in ``wanted`` that lie on one longest common subsequence.

    Walks back from both ends: take a match, else step to the larger neighbour;
    on a tie the wanted token is dropped.
    """
    across, down = _LcsTable(wanted, said), _LcsTable(said, wanted)
    i, j, kept = len(wanted), len(said), []
    while i and j:
        if wanted[i - 1] == said[j - 1]:
            i, j = i - 1, j - 1
            kept.append(i)
        # The left neighbour is larger if the length does not grow along the row
        # but does grow down the column.
        elif across[i] >> (j - 1) & 1 and not down[j] >> (i - 1) & 1:
            j -= 1
        else:
            i -= 1
    return kept


def lcs_f(said: list[str], wanted: list[str]) -> float:
    """ROUGE-L of two token lists."""
    return f_measure(lcs_length(wanted, said), len(said), len(wanted))


def lcs_lines_f(said: list[list[str]], wanted: list[list[str]]) -> float:
    """ROUGE-Lsum: per reference line, the union over all predicted lines."""
    if len(said) == len(wanted) == 1:
        return lcs_f(said[0], wanted[0])
    spare = Counter(t for line in said for t in line)
    open_ = Counter(t for line in wanted for t in line)
    sizes = spare.total(), open_.total()
    hits = 0
    for line in wanted:
        tokens = set(line)
        kept = {
            position
            for other in said
            if not tokens.isdisjoint(other)
            for position in lcs_positions(line, other)
        }
        for token in (line[p] for p in sorted(kept)):
            if spare[token] > 0 and open_[token] > 0:
                spare[token] -= 1
                open_[token] -= 1
                hits += 1
    return f_measure(hits, *sizes)


def _grams(tokens: list[str], n: int) -> Counter:
    return Counter(zip(*[tokens[i:] for i in range(n)]))


def _rouge_score(name: str, said: list[list[str]], wanted: list[list[str]]) -> float:
    """One score of two texts given as lines of tokens."""
    if name == "rougeLsum":
        return lcs_lines_f(said, wanted)
    flat, goal = ([t for line in text for t in line] for text in (said, wanted))
    if name == "rougeL":
        return lcs_f(flat, goal)
    n = int(name.removeprefix("rouge"))
    return overlap_f(_grams(flat, n), _grams(goal, n))


def rouge_lines(text: Column | str) -> Column:
    """Lines of lowercased runs of ASCII letters and digits, joined by blanks."""
    return F.transform(
        F.split(as_column(text), "\n"),
        lambda line: F.trim(F.regexp_replace(F.lower(line), "[^a-z0-9]+", " ")),
    )


def rouge(
    prediction: Column | str, references: Column | str, names: Sequence[str] = ROUGE
) -> Column:
    """Struct of the named F-measures, each the best over the references."""
    unknown = [n for n in names if n not in ROUGE]
    if unknown:
        raise ValueError(f"unknown scores {unknown}; there are {ROUGE}")
    names = list(names)

    @F.pandas_udf(T.StructType([T.StructField(n, T.DoubleType()) for n in names]))
    def score(said: pd.Series, wanted: pd.Series) -> pd.DataFrame:
        rows = []
        for prediction, references in zip(said, wanted):
            lines = [t.split() for t in _texts(prediction) if t]
            goals = [
                [t.split() for t in _texts(reference) if t]
                for reference in (references if references is not None else [])
            ]
            rows.append(
                [
                    max((_rouge_score(n, lines, goal) for goal in goals), default=0.0)
                    for n in names
                ]
            )
        return pd.DataFrame(rows, columns=names)

    return score(
        rouge_lines(prediction), F.transform(as_column(references), rouge_lines)
    )


def cosine(left: Column | str, right: Column | str) -> Column:
    """Cosine of two vector columns, accumulated in double; 0 for a zero vector."""
    left, right = as_column(left), as_column(right)
    norms = F.sqrt(dot(left, left)) * F.sqrt(dot(right, right))
    return F.when(norms > 0, dot(left, right) / norms).otherwise(F.lit(0.0))


def dot(left: Column | str, right: Column | str) -> Column:
    """Dot product of two vector columns, accumulated in double."""
    products = F.zip_with(
        as_column(left),
        as_column(right),
        lambda x, y: x.cast("double") * y.cast("double"),
    )
    return F.aggregate(products, F.lit(0.0), lambda total, x: total + x)
