import itertools

import fixtures
from ragtables.llm.licenses import BASE, NOTICES, PER_ERROR, Searcher, license_scan


def distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        last, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
    return row[-1]


def plain_labels(text: str) -> set:
    """Labels of notices that some run of whole words comes near enough to."""
    words = fixtures.lettered(text)
    out = set()
    for label, phrase in NOTICES:
        k, n = len(phrase) // PER_ERROR, len(phrase.split())
        for size in range(max(1, n - k), n + k + 1):
            for i in range(len(words) - size + 1):
                run = " ".join(words[i : i + size])
                if abs(len(run) - len(phrase)) <= k and distance(run, phrase) <= k:
                    out.add(label)
    return out


def plain_base(text):
    words = fixtures.lettered(text)
    places, labels = [], set()
    for label, phrase in BASE:
        own = phrase.split()
        for i in range(len(words) - len(own) + 1):
            if words[i : i + len(own)] == own:
                places.append(i)
                labels.add(label)
    return len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels))


TEXTS = [
    "Released under the MIT License.", "released under the MIT-License, MIT license mit license", "mitlicense", "mit licence",
    "summit license", "mit licenses", "the Apache Licence, version 2.0", "Licensed under the Apache License, Version 2.0 (the",
    "GNU General Public License version 3", "GNU Genral Public Licence version 3", "gnu lesser general public license",
    "Permission is hereby granted, free of charge, to any person obtaining a copy", "permision is herby granted free of charge to any persons obtaining a copy",
    "redistribution and use in sorce and binary forms", "mozila public license", "Creative Commons Atribution", "licensed under CC-BY-NC",
    "general public general public license apache apache license", "apache", "license mit", "MIT LICENSE\nMIT LICENSE", "mit é license", "a mit license b mit lcense c",
]


def test_matches_plain_search(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "doc_id long, text string")
    for r in license_scan(docs).collect():
        text = TEXTS[r.doc_id]
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == plain_base(text), text
        assert set(filter(None, r.labels.split(","))) == plain_labels(text), text
        assert 0 <= r.score <= 1 and (r.score == 1) == any(s.errors == 0 for s in r.spans), text
        for s in r.spans:
            words = fixtures.lettered(text)
            assert " ".join(words[s.first : s.last + 1]) == s.words
            assert any(label == s.label and distance(s.words, p) <= len(p) // PER_ERROR for label, p in NOTICES)


def test_awkward_rows(odd, none):
    found = license_scan(odd)
    assert found.count() == odd.count() and "N_Words" not in found.columns
    want = sorted(plain_base(r[1])[:2] for r in fixtures.rows())
    assert sorted((r.n_words, r.n_base) for r in found.collect()) == want
    assert license_scan(none).count() == 0


def test_every_notice_is_found_with_its_errors():
    searcher = Searcher(NOTICES)
    for number, (_, phrase) in enumerate(NOTICES):
        k = len(phrase) // PER_ERROR
        text = list(phrase)
        for i in range(k):  # spread substitutions
            at = (i * 2 + 1) * len(phrase) // (2 * k)
            if text[at] != " ":
                text[at] = "q"
        assert any(s.notice == number for s in searcher.spans("before " + "".join(text) + " after")), phrase


def test_adjacent_notices_are_all_found():
    """Spans of one notice, whose regions have merged, in every order."""
    number = next(n for n, (_, p) in enumerate(NOTICES) if p == "mozilla public license")
    phrase, k = NOTICES[number][1], len(NOTICES[number][1]) // PER_ERROR
    forms = ["mozila publc license", "mozilla public licens", "mozilla public license"]
    for order in itertools.product(forms, repeat=3):
        for between in (" or ", " "):
            text = between.join(order)
            found = {(s.start, s.stop): s.errors for s in Searcher(NOTICES).spans(text) if s.notice == number}
            starts = [sum(len(f) + len(between) for f in order[:i]) for i in range(3)]
            for start, form in zip(starts, order):
                assert distance(form, phrase) <= k
                assert found.get((start, start + len(form))) == distance(form, phrase), text
