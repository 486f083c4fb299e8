"""Removal of repeated phrases against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from catalog_spark.llm import phrases

SCHEMA = "doc_id long, text string, key string, copies int, anchor string, runs int, shard long"


def plain(rows, length):
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for _, t in rows]
    seen = Counter(tuple(w[i : i + length]) for w in words for i in range(len(w) - length + 1))
    out = []
    for (doc, _), w in zip(rows, words):
        gone = {i + j for i in range(len(w) - length + 1) if seen[tuple(w[i : i + length])] > 1 for j in range(length)}
        text = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc, len(w), len(gone), hashlib.sha256(text.encode()).hexdigest(), text))
    return sorted(out, key=repr)


def check(spark, rows, length):
    table = spark.createDataFrame([(d, t, "k", 1, "a", 2, 3) for d, t in rows], SCHEMA).repartition(3)
    assert sorted((tuple(r) for r in phrases.remove_repeated(table, length, with_text=True).collect()), key=repr) == plain(rows, length)


def some(seed, n, vocabulary, longest, blanks=(" ",)):
    r = random.Random(seed)
    shared = [[r.choice(vocabulary) for _ in range(r.randint(3, 40))] for _ in range(6)]
    rows = []
    for i in range(n):
        words = [r.choice(vocabulary) for _ in range(r.randint(0, longest))]
        for _ in range(r.randint(0, 2)):
            part = r.choice(shared)
            a = r.randint(0, len(part) - 1)
            at = r.randint(0, len(words))
            words[at:at] = part[a : r.randint(a, len(part))]
        rows.append((i, "".join(w + r.choice(blanks) for w in words)))
    return rows


@pytest.mark.parametrize("length,vocabulary", [(3, "abc"), (5, [f"w{i}" for i in range(30)]), (35, [f"ü{i}" for i in range(500)])])
def test_against_brute_force(spark, length, vocabulary):
    check(spark, some(length, 40, list(vocabulary), 60, (" ", "  ", "\t", "\n ")), length)


def test_hot_anchors_and_copied_automata(spark, monkeypatch):
    for name, value in (("HOT_BYTES", 40), ("SHARD_BYTES", 200), ("COPY_BYTES", 100), ("GRAM", 2)):
        monkeypatch.setattr(phrases, name, value)
    words = [f"w{i}" for i in range(12)]
    check(spark, some(1, 60, words, 20) + [(100 + i, f"x{i} the common phrase of many texts y{i}") for i in range(60)], 4)


def test_repeats_nulls_and_odd_texts(spark):
    copy = " ".join(f"c{i}" for i in range(9))
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, copy), (4, copy), (None, copy + " tail"), (5, "a b c"), (6, "a b c"), (7, "one one one one one"), (8, "x y x y x y x y"), (9, " a  \x0b\x1cb")]
    check(spark, rows, 4)
    check(spark, rows + [(i, copy) for i in range(20, 80)], 4)  # half are copies


def test_very_long_texts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "LONG_BYTES", 1 << 12)
    r = random.Random(9)
    body = " ".join(r.choice(["aa", "b", "cc" * 900]) + str(r.randint(0, 300)) for _ in range(3000))
    check(spark, [(1, body), (2, "z" * 300_000), (3, body[5000:9000] + " new"), (4, "same " * 20_000)], 6)


def test_empty_table(spark):
    check(spark, [], 35)


def test_windows_that_recur():
    r = np.random.default_rng(4)
    for length in (1, 2, 3, 7, 8):
        sizes = r.integers(length, length + 6, 30)
        number = r.integers(0, 2, sizes.sum())
        begin, n, copies = np.cumsum(sizes) - sizes, sizes - length + 1, r.integers(1, 3, 30)
        windows = [tuple(number[b + i : b + i + length]) for b, k in zip(begin, n) for i in range(k)]
        seen = Counter()
        for w, c in zip(windows, np.repeat(copies, n)):
            seen[w] += c
        assert phrases.recurring(number, begin, n, copies, length).tolist() == [seen[w] > 1 for w in windows]


def test_phrases_are_the_longest_chains():
    texts = pa.array([b"a b c d e", b"x b c d y", b"a b c q"], pa.binary())
    assert phrases.phrases_of(texts, np.array([3, 3, 2]), np.array([1, 1, 1]), 3) == [b"a b c", b"a b c d", b"b c d"]


def test_automaton_joins_matches():
    found = phrases.Automaton([b"a b c", b"b c d e", b"x y"])
    assert found.covered(b"q a b c d e z x y") == [(1, 6), (7, 9)] and found.covered(b"a b d") == []
