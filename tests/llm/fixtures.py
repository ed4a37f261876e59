"""Small tables with every awkward case, and plain versions of the operators."""

from __future__ import annotations

import random
import re

from pyspark.sql import types as T

SCHEMA = T.StructType(
    [
        T.StructField("doc_id", T.LongType()),
        T.StructField("text", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("source", T.StringType()),
        T.StructField("n_chars", T.LongType()),
        # Names that the operators use themselves, in other letter case.
        T.StructField("Score", T.StringType()),
        T.StructField("N_Words", T.StringType()),
        T.StructField("row_", T.StringType()),
    ]
)


def rows() -> list[tuple]:
    """Nulls in any column, empty and very long texts, copies, near copies, repeated
    rows, odd white space, non-ASCII words."""
    draw = random.Random(3)
    vocabulary = ["".join(draw.choices("abcdeiorstu", k=draw.randint(2, 8))) for _ in range(900)]

    def words(n: int) -> list[str]:
        return draw.choices(vocabulary, k=n)

    texts: list[str | None] = [None, "", "   \n\t ", "one", "two words", "É é ß", "...", "!!! ???"]
    base = words(120)
    texts += [" ".join(base)] * 3 + ["\n".join(base), " ".join(base).upper()]
    for edits in (1, 2, 3, 4, 6, 12):
        near = list(base)
        for at in draw.sample(range(len(near)), edits):
            near[at] = "edit" + str(at)
        texts.append(" ".join(near))
    passage = words(60)
    for n in (10, 40, 90):
        texts.append(" ".join(words(n) + passage + words(n)))
    texts.append(" ".join(words(20) + passage[:49] + words(20)))
    texts.append(" ".join(passage + words(3) + passage))
    texts.append(" ".join(words(30_000)))
    texts.append(" ".join(["again"] * 500))
    texts += [" ".join(words(draw.randint(3, 80))) + " É…ñ, x." for _ in range(20)]
    out: list[tuple] = []
    for i, text in enumerate(texts):
        source = [None, "a", "b", "c", "c", "c"][i % 6]
        out.append((i + 100, text, "en" if i % 3 else None, source, i, f"s{i}", None, "r"))
    out.append(out[9])  # a repeated row
    out.append((None, " ".join(words(30)), None, None, None, None, None, None))
    out.append((None, None, None, None, None, None, None, None))
    return out


def spaced(text: str | None) -> list[str]:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x20\x09-\x0D]+", low)


def lettered(text: str | None) -> list[str]:
    low = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def shingles(text: str | None, size: int = 5) -> frozenset[tuple[str, ...]]:
    w = spaced(text)
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1)))


def groups(texts: list[str | None]) -> list[int]:
    """For each text the number of its component of near copies."""
    sets = [shingles(t) for t in texts]
    parent = list(range(len(texts)))

    def root(i: int) -> int:
        while parent[i] != i:
            i = parent[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            shared = len(a & sets[j])
            if shared and 100 * shared >= 80 * (len(a) + len(sets[j]) - shared):
                parent[root(i)] = root(j)
    return [root(i) for i in range(len(texts))]
