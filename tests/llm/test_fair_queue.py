import collections
import hashlib

import pytest

import fixtures
from ragtables.llm.fair_queue import SEED, fair_mix, mixed_documents


def plain_targets(sizes: dict, weights=(3, 1, 2), budget=1.5, passes=2) -> dict:
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, open_, out = budget * sum(sizes.values()), set(names), {}
    while open_:
        level = left / sum(weight[s] for s in open_)
        full = {s for s in open_ if weight[s] * level > passes * sizes[s]}
        if not full:
            out.update({s: weight[s] * level for s in open_})
            break
        for s in full:
            out[s] = passes * sizes[s]
            left -= out[s]
        open_ -= full
    return out


def place(doc_id, text) -> int:
    key = f"{SEED}:{doc_id if doc_id is not None else text or ''}"
    return int(hashlib.md5(key.encode()).hexdigest()[:15], 16)


def plain_mix(rows):
    """``(doc_id, size, source) -> taken`` by one queue."""
    sizes = collections.Counter()
    for doc_id, text, source in rows:
        sizes[source] += len(fixtures.spaced(text))
    targets = plain_targets(sizes)
    order = sorted(sizes, key=lambda s: (s is None, s or ""))
    events = []
    for source in sizes:
        own = sorted((place(d, t), d, len(fixtures.spaced(t))) for d, t, s in rows if s == source)
        by_place = collections.Counter()
        for p, _, size in own:
            by_place[p] += size
        for turn in range(2):
            total = turn * sizes[source]
            for p in sorted(by_place):
                total += by_place[p]
                finish = total / targets[source] if targets[source] else 0.0
                events.append((finish, order.index(source), turn, p, by_place[p], source))
    taken, run = collections.Counter(), 0
    events.sort()
    at = 0
    while at < len(events):
        same = [e for e in events[at:] if e[:3] == events[at][:3]]
        run += sum(e[4] for e in same)
        if run > 1.5 * sum(sizes.values()):
            break
        for e in same:
            taken[(e[5], e[3])] += 1
        at += len(same)
    return targets, sizes, taken


def test_matches_one_queue(odd):
    rows = [(r[0], r[1], r[3]) for r in fixtures.rows()]
    targets, sizes, taken = plain_mix(rows)
    want = sorted(
        (str(d), n := len(fixtures.spaced(t)), sizes[s], round(targets[s], 6), n * taken[(s, place(d, t))])
        for d, t, s in rows
    )
    got = sorted(
        (str(r.doc_id), r["size"], r.source_size, round(r.target, 6), r.taken) for r in fair_mix(odd).collect()
    )
    assert got == want


def test_rows_follow_the_plan_and_reruns_agree(odd):
    copies = collections.Counter()
    for r in fair_mix(odd).collect():
        copies[r.doc_id] += r.copies
    mixed = mixed_documents(odd)
    assert mixed.columns == odd.columns
    first = collections.Counter(r.doc_id for r in mixed.collect())
    assert first == +copies
    again = collections.Counter(r.doc_id for r in mixed_documents(odd.repartition(7)).collect())
    assert again == first


@pytest.mark.parametrize("n", [3, 40])
def test_shares_come_near_their_targets(spark, n):
    rows = [(s * 10_000 + i, "w " * (1 + (i * 7 + s) % 30), f"s{s}") for s in range(n) for i in range(100 + 300 * (s % 4))]
    got = fair_mix(spark.createDataFrame(rows, "doc_id long, text string, source string")).collect()
    by = collections.defaultdict(int)
    for r in got:
        assert r.taken in (0, r["size"], 2 * r["size"])
        by[(r.source_size, r.target)] += r.taken
    for r in got:
        assert r.target <= 2 * r.source_size
    taken = sum(r.taken for r in got)
    total = sum(r["size"] for r in got)
    assert 1.5 * total - 60 <= taken <= 1.5 * total
    sources = collections.defaultdict(lambda: [0, 0.0])
    for r in got:
        sources[r.doc_id // 10_000][0] += r.taken
        sources[r.doc_id // 10_000][1] = r.target
    assert all(abs(t - target) <= 60 for t, target in sources.values())


def test_empty_tables(spark, none):
    assert fair_mix(none).count() == 0 and mixed_documents(none).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (2, "", None)], "doc_id long, text string, source string")
    assert {(r.doc_id, r.taken, r.target) for r in fair_mix(blank).collect()} == {(1, 0, 0.0), (2, 0, 0.0)}
