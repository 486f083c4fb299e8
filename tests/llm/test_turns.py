"""Trie of conversations against brute force."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest

from catalog_spark.llm import turns

SCHEMA = "conv_id long, turn int, role string, text string, block int, prior string, t0 string, node long, total string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "x", "y", 2, "z") for r in rows], SCHEMA).repartition(3)


def in_order(rows):
    own = defaultdict(list)
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    for c, turn, role, text in rows:
        if c is not None:
            own[c].append(((turn is not None, turn or 0), role or "", sha(sha(text or "") + (role or "")), text or ""))
    return {c: [(role, text) for _, role, _, text in sorted(v)] for c, v in own.items()}


def with_heads(own):
    out = {}
    for c, seq in own.items():
        h = zlib.crc32(str(c).encode()) % 9
        out[c] = own.get(c - c % 5, [])[:h] + seq[h:]
    return out


def plain(convs):
    members = defaultdict(list)
    for c, seq in convs.items():
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
    out = []
    for path, own in members.items():
        below = [p for p in members if p[: len(path)] == path]
        leaves = sum(not any(len(q) == len(p) + 1 and q[: len(p)] == p for q in members) for p in below)
        saved = sum((len(members[p]) - 1) * len(p[-1][1].encode()) for p in below if p)
        ends = ",".join(map(str, sorted(c for c in own if len(convs[c]) == len(path))))
        children = sum(len(p) == len(path) + 1 for p in below)
        out.append((min(own), len(path), min(members[path[:-1]]) if path else None, len(own), children, leaves, saved, hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=repr)


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_rebuilt_conversations(spark):
    r = random.Random(2)
    rows = [(c, t, r.choice(["user", "assistant", None]), r.choice(["a", "b", "", None, "é" * 30])) for c in r.sample(range(60), 40) for t in range(r.randint(1, 12))]
    assert found(turns.prefix_trie(table(spark, rows))) == plain(with_heads(in_order(rows)))


@pytest.mark.parametrize("width", [1, 2, 3])
def test_many_blocks(spark, width):
    r = random.Random(width)
    rows = [(c, t, "user", "same" if t < 9 and c % 2 else r.choice("ab")) for c in range(12) for t in range(r.choice([1, 2, 5, 12, 13]))]
    assert found(turns.prefix_trie(table(spark, rows), new_heads=False, width=width)) == plain(in_order(rows))


def test_a_third_are_copies(spark):
    rows = [(c, t, "user", f"turn {t}") for c in range(300) for t in range(3)] + [(1000 + c, 0, "user", str(c)) for c in range(60)]
    for new in (True, False):
        own = in_order(rows)
        assert found(turns.prefix_trie(table(spark, rows), new)) == plain(with_heads(own) if new else own)


def test_nulls_ties_and_repeats(spark):
    rows = [(1, None, None, None), (1, 0, "user", "x"), (1, 0, "user", "x"), (1, 0, "assistant", "x"), (None, 0, "user", "lost"), (2, 5, "user", ""), (2, None, "", "")]
    rows += [(3, 1, "user", "long " * 50_000), (4, 1, "user", "long " * 50_000), (5, 2, "ab", "c"), (6, 2, "a", "bc")]
    for new in (True, False):
        own = in_order(rows)
        assert found(turns.prefix_trie(table(spark, rows), new)) == plain(with_heads(own) if new else own)


def test_without_turns_or_rows(spark):
    alone = next(c for c in range(1, 100) if c % 5 and zlib.crc32(str(c).encode()) % 9 > 2)  # its only turn goes
    assert found(turns.prefix_trie(table(spark, [(alone, 0, "user", "x")]))) == [(alone, 0, None, 1, 0, 1, 0, hashlib.sha256(str(alone).encode()).hexdigest())]
    assert found(turns.prefix_trie(table(spark, []))) == []


def test_many_ends_in_pieces(spark, monkeypatch):
    rows = [(c, 0, "user", "x") for c in range(0, 90_000, 3)]
    monkeypatch.setattr(turns, "PIECE", 100)
    got = {r["depth"]: r for r in turns.prefix_trie(table(spark, rows), False).collect()}
    assert got[1]["n_convs"] == 30_000 and got[1]["ends_sha256"] == hashlib.sha256(",".join(str(c) for c in range(0, 90_000, 3)).encode()).hexdigest()
