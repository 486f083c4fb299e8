"""Vector codes against brute force."""

import hashlib
import math
import random

import numpy as np
import pytest

from catalog_spark.llm import codes

SCHEMA = "vec_id long, embedding array<double>, label int, w string, code string, components int"


def plain(rows, parts, entries, rounds):
    """The contract in loops over whole numbers."""
    kept = [(v, [math.floor(256 * x) for x in e], lab) for v, e, lab in rows if e is not None and all(x is not None and math.isfinite(x) for x in e)]
    depth = -(-max((len(e) for _, e, _ in kept), default=0) // parts)
    kept = [(v, e + [0] * (parts * depth - len(e)), lab) for v, e, lab in kept]
    least = sorted({v for v, _, _ in kept if v is not None})[:entries]
    start = [min(e for v, e, _ in kept if v == i) for i in least]
    books = [[e[p * depth : (p + 1) * depth] for e in start] for p in range(parts)]

    def assign():
        out = []
        for _, e, _ in kept:
            found = []
            for p in range(parts):
                own = e[p * depth : (p + 1) * depth]
                found.append(min((sum((x - y) ** 2 for x, y in zip(own, b)), i) for i, b in enumerate(books[p])))
            out.append(found)
        return out

    if not least:
        return [(v, None, None, None, hashlib.sha256(b"").hexdigest()) for v, _, _ in kept]
    for _ in range(rounds):
        found = assign()
        for p in range(parts):
            for i in range(len(least)):
                own = [e[p * depth : (p + 1) * depth] for (_, e, _), f in zip(kept, found) if f[p][1] == i]
                if own:
                    books[p][i] = [sum(x) // len(own) for x in zip(*own)]
    found = assign()
    error = [sum(d for d, _ in f) for f in found]
    digest = hashlib.sha256(",".join(str(x) for b in books for e in b for x in e).encode()).hexdigest()
    by_label = {lab: sum(e for e, (_, _, other) in zip(error, kept) if other == lab) for _, _, lab in kept}
    return [(v, "".join(f"{i:02x}" for _, i in f), e, by_label[lab], digest) for (v, _, lab), f, e in zip(kept, found, error)]


def check(spark, rows, parts=4, entries=3, rounds=2):
    table = spark.createDataFrame([(v, e, lab, "x", "y", 1) for v, e, lab in rows], SCHEMA).repartition(3)
    got = [tuple(r) for r in codes.compress(table, parts, entries, rounds).collect()]
    assert sorted(got, key=repr) == sorted(plain(rows, parts, entries, rounds), key=repr)


def test_against_brute_force(spark):
    r = random.Random(5)
    rows = [(i, [r.choice([-0.1, -0.004, 0.0, 0.02, 0.3, r.gauss(0, 0.2)]) for _ in range(8)], r.choice([0, 1, None])) for i in range(60)]
    check(spark, rows)


def test_nulls_ties_repeats_and_lengths(spark):
    one = [0.1, -0.1, 0.5, 0.5]
    rows = [(5, one, 1), (5, one, 1), (5, [0.1, -0.2, 0.5, 0.5], None), (None, [0.2] * 7, None), (7, None, 1), (8, [0.1, None], 2), (9, [float("nan")], 2)]
    rows += [(10, [float("inf"), 0.0], 2), (11, [], 2), (12, [-0.001], 3), (13, [0.0, 0.0], 3)] + [(20 + i, one, 1) for i in range(30)]
    check(spark, rows)


@pytest.mark.parametrize("rows", [[], [(1, None, 1)], [(None, [0.5, 0.25], None)], [(1, [], None), (2, [], 3)]])
def test_little_or_nothing(spark, rows):
    check(spark, rows)


def test_huge_components_are_refused(spark):
    table = spark.createDataFrame([(1, [1e30], 1)], "vec_id long, embedding array<double>, label int")
    with pytest.raises(Exception, match="a component is beyond"):
        codes.compress(table).collect()


@pytest.mark.parametrize("leaves", [1, 4, 1000])
def test_walk_of_the_trie(monkeypatch, leaves):
    monkeypatch.setattr(codes, "LEAVES", leaves)
    r = np.random.default_rng(3)
    for depth in (1, 3, 5):
        rows = np.unique(r.integers(-4, 4, (300, depth)), axis=0)
        book = r.integers(-5, 5, (9, depth))
        far = ((rows[:, None] - book) ** 2).sum(axis=2)
        entry, best = codes.nearest(rows, book)
        assert (entry == far.argmin(axis=1)).all() and (best == far.min(axis=1)).all()


def test_parts_are_counted_once(spark):
    rows = spark.createDataFrame([(i, [1, 2, 3, 4]) for i in range(50)], "vec_id long, w array<int>")
    assert sorted(tuple(x) for x in codes.distinct_parts(rows, 2, 2).collect()) == [(0, [1, 2], 50), (1, [3, 4], 50)]
