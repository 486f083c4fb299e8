"""SimHash components, passage removal and its suffix sorting against brute force."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
import xxhash

from catalog_spark.llm import graph, induced, simhash, suffix

DOCS = "doc_id long, text string, lang string, source string, n_chars long, bits string, row int"


def documents(rows, values):
    return rows([(i, t, None, "s", None, "x", 1) for i, t in values], DOCS)


def texts(seed=1):
    """Random texts with passages in common, copies, nulls, blanks, ties and a long one."""
    r = random.Random(seed)
    word = lambda: "".join(r.choice("abcdé") for _ in range(r.randint(1, 7)))
    passages = [" ".join(word() for _ in range(25)) for _ in range(4)]
    out = []
    for i in range(60):
        parts = [" ".join(word() for _ in range(r.randint(0, 30))) for _ in range(2)]
        parts.insert(1, r.choice(passages)[r.randint(0, 20) :] if i % 3 == 0 else "")
        out.append(" ".join(parts))
    out += [out[3], out[3], out[6] + " x", None, "", "   ", "a" * 400, "a" * 300, "ab" * 5000, "short", "short"]
    return list(enumerate(out))


# --- components -----------------------------------------------------------------------------------------------------


def test_components(rows, spark):
    r = random.Random(2)
    pairs = [(r.randrange(200), r.randrange(200)) for _ in range(120)] + [(7, 7), (7, 7), (None, 3)] + [(1000, i) for i in range(300, 360)] + [(i, i + 1) for i in range(500, 530)]
    best = {x: x for p in pairs for x in p if x is not None}
    for _ in best:
        for a, b in pairs:
            if a is not None:
                best[a] = best[b] = min(best[a], best[b])
    got = {x["node"]: x["root"] for x in graph.components(rows(pairs, "a long, b long"), "a", "b").collect()}
    assert got == {x: y for x, y in best.items() if x != y}
    assert graph.components(rows([], "a long, b long"), "a", "b").count() == 0


# --- SimHash --------------------------------------------------------------------------------------------------------


def plain_fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, limit=3):
    label = {i: i for i, _ in prints}
    while True:
        new = {i: min(label[j] for j, g in prints if (f ^ g).bit_count() <= limit) for i, f in prints}
        if new == label:
            return label
        label = new


@pytest.mark.parametrize("text", [None, "", " \t", "One", "a b", "A b C", "a\x0bb\x1cc d " * 300, "é É ß x y z"])
def test_fingerprint(text):
    assert simhash.fingerprint((text or "").encode() if text is not None else None) == plain_fingerprint(text)


def test_fingerprint_of_a_text_in_pieces(monkeypatch):
    monkeypatch.setattr(simhash, "PIECE_BYTES", 10)
    text = "the quick brown fox jumps over a lazy dog and runs " * 20
    assert simhash.fingerprint(text.encode()) == plain_fingerprint(text)


def test_simhash_query(rows):
    values = texts()
    prints = [(i, plain_fingerprint(t)) for i, t in values]
    want = plain_components(prints)
    got = simhash.near_duplicates(documents(rows, [*values, (None, "a b c d"), (3, dict(values)[3])])).collect()
    assert {x["doc_id"]: (int(x["fingerprint"], 16), x["component_id"]) for x in got if x["doc_id"] is not None} == {i: (f, want[i]) for i, f in prints}
    assert len(got) == len(values) + 2 and [x["component_id"] for x in got if x["doc_id"] is None] == [None]


def test_index_of_crowded_buckets(rows):
    r = random.Random(4)
    prints = {0, 2**64 - 1}
    for _ in range(6):
        base = r.getrandbits(64)
        for _ in range(60):
            prints.add(base ^ sum(1 << b for b in r.sample(range(64), r.randint(0, 4))))
    prints = list(enumerate(sorted(prints)))
    table = rows([(i, f - 2**64 if f >> 63 else f) for i, f in prints], "doc_id long, bits long")
    want = plain_components(prints)
    for hot in (20_000, 3):
        edges = simhash.links(table, 3, hot)
        got = {x["node"]: x["root"] for x in graph.components(edges, "a", "b").collect()}
        assert {i: got.get(i, i) for i, _ in prints} == want


def test_simhash_of_nothing(rows):
    assert simhash.near_duplicates(documents(rows, [])).count() == 0
    assert simhash.one_of_each(documents(rows, [])).count() == 0
    kept = simhash.one_of_each(documents(rows, [(5, "a b c d"), (2, "a b c d"), (9, None), (None, "q"), (None, None)]))
    assert sorted((x["doc_id"] is None, x["doc_id"] or 0) for x in kept.collect()) == [(False, 2), (False, 9), (True, 0), (True, 0)]


# --- suffixes -------------------------------------------------------------------------------------------------------


@pytest.mark.parametrize("base, memory", [(10**6, 10**6), (3, 20), (1, 1)])
def test_sorted_suffixes(base, memory):
    rng = np.random.default_rng(0)
    for trial in range(40):
        text = rng.integers(0, rng.integers(1, 5) + 1, rng.integers(1, 200)).astype(np.uint16)
        if trial % 2:
            text = np.concatenate([text, text[: len(text) // 2], text[:70], [0], text])
        pieces = list(induced.sorted_suffixes(text, base, memory))
        place, common = (np.concatenate(x) for x in zip(*pieces))
        assert sorted(place) == list(range(len(text)))
        plain = text.tolist()
        for at in range(1, len(place)):
            a, b = plain[place[at - 1] :][: induced.DEPTH], plain[place[at] :][: induced.DEPTH]
            assert a >= b
            assert common[at] == next((k for k, (x, y) in enumerate(zip(a, b)) if x != y), min(len(a), len(b)))
    assert list(induced.sorted_suffixes(np.zeros(0, np.uint16))) == []


def plain_removal(values, length):
    first, out = {}, {}
    for i, t in sorted(values):
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            first.setdefault(b[p : p + length], i)
    for i, t in values:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        kept = bytes(c for c, g in zip(b, gone) if not g)
        out[i] = (len(b), sum(gone), sum(1 for k, g in enumerate(gone) if g and not (k and gone[k - 1])), hashlib.sha256(kept).hexdigest())
    return out


@pytest.mark.parametrize("seed, length", [(1, 50), (2, 50), (3, 30)])
def test_removal(rows, seed, length):
    values = texts(seed)
    random.Random(seed).shuffle(values)
    got = suffix.remove_repeated(documents(rows, values), length=length).collect()
    assert {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in got} == plain_removal(values, length)


@pytest.mark.parametrize("hot", [3000, 100])
def test_shards_are_sized_and_crowded_anchors_split(rows, tmp_path, monkeypatch, hot):
    rng = random.Random(4)
    noise = lambda n: "".join(rng.choice("abcdefgh") for _ in range(n))
    common, longer, passage = noise(18), noise(30), noise(70)
    values = [(i, noise(60) + (common, longer, passage)[i % 3] + noise(60)) for i in range(300)]
    values += [(300 + i, noise(20) + values[i][1][20:-20] + noise(20)) for i in range(0, 150)]
    original = suffix._sorted_shard

    def spied(length):
        inner, folder = original(length), str(tmp_path)

        def run(batches):
            batches = list(batches)
            n = sum(len(x.as_py()) for b in batches for x in b.column("piece"))
            with open(f"{folder}/{id(batches)}-{rng.random()}-{n}", "w"):
                pass
            yield from inner(iter(batches))

        return run

    monkeypatch.setattr(suffix, "_sorted_shard", spied)
    monkeypatch.setattr(suffix, "HOT_BYTES", hot, raising=False)
    monkeypatch.setattr(suffix, "SHARD_BYTES", 2000, raising=False)
    got = suffix.remove_repeated(documents(rows, values), length=50).collect()
    assert {x["doc_id"]: (x["n_bytes"], x["n_removed"], x["n_spans"], x["kept_sha256"]) for x in got} == plain_removal(values, 50)
    sizes = [int(f.name.split("-")[-1]) for f in tmp_path.iterdir()]
    assert len(sizes) > 16 and max(sizes) < 2000 + 3 * hot


def test_long_texts_in_pieces():
    rng = np.random.default_rng(1)
    data = rng.integers(97, 100, 5000).astype(np.uint8)
    start, end = np.array([0, 3000]), np.array([3000, 5000])
    whole = suffix._runs(data, start, end, 50)
    original, suffix.PIECE_BYTES = suffix.PIECE_BYTES, 700
    try:
        parts = suffix._all_runs(data, start, end, 50)
    finally:
        suffix.PIECE_BYTES = original
    windows = lambda runs: {(d, w, int(a)) for d, low, n, a in zip(*runs) for w in range(low, low + n)}
    assert windows(whole) == windows(parts)


def test_runs_in_blocks(monkeypatch):
    rng = np.random.default_rng(2)
    size = rng.choice([0, 1, 49, 50, 51, 300], 40)
    data, end = rng.integers(97, 100, size.sum()).astype(np.uint8), np.cumsum(size)
    whole = suffix._runs(data, end - size, end, 50)
    assert len(whole[0]) > 40 and set(whole[0]) == set(np.flatnonzero(size >= 50))
    for block in (1, 7, 64):
        monkeypatch.setattr(suffix, "BLOCK_BYTES", block)
        assert all(np.array_equal(x, y) for x, y in zip(whole, suffix._runs(data, end - size, end, 50)))


@pytest.mark.parametrize("parts", [1, 5, 3000])
def test_packing_does_not_grow_with_the_buckets(monkeypatch, parts):
    """The columns of a chunk are packed in one go each, whatever the number of buckets, and come out as they went in."""
    calls, original = [], suffix._planes
    monkeypatch.setattr(suffix, "_planes", lambda *a: calls.append(1) or original(*a))
    rng = random.Random(6)
    texts = ["".join(rng.choice("abcdef") for _ in range(2000)).encode() for _ in range(20)]
    texts += [t[500:1200] for t in texts[:10]] + texts[:5]
    row = pa.array([hash(t) for t in texts], pa.int64())
    entries = list(suffix._anchors(50, parts)(iter([pa.RecordBatch.from_arrays([row, pa.array(texts, pa.binary())], ["row", "body"])])))
    assert len(calls) == 5
    bucket = pa.Table.from_batches(entries)
    got = set()
    for k in set(bucket["bucket"].to_pylist()):
        for out in suffix._repeated(iter(bucket.filter(pa.array([b == k for b in bucket["bucket"].to_pylist()])).drop_columns(["bucket"]).to_batches())):
            got |= {(r["row"], r["low"], r["n"]) for r in out.to_pylist()}
    runs = [(hash(t), int(low), int(n), int(a)) for t in dict.fromkeys(texts) for _, low, n, a in zip(*suffix._runs(np.frombuffer(t, np.uint8), np.array([0]), np.array([len(t)]), 50))]
    owners = {}
    for t, _, _, a in runs:
        owners.setdefault(a & ((1 << 48) - 1), set()).add(t)
    assert got == {(t, low, n) for t, low, n, a in runs if len(owners[a & ((1 << 48) - 1)]) > 1}


def test_suffixes_are_sorted_by_one_key(monkeypatch):
    """Rank and stretch fit one number, so no sort of two keys is needed; symbols are compared by words, at the end of the text too."""
    monkeypatch.setattr(np, "lexsort", None)
    rng = np.random.default_rng(5)
    passage = rng.integers(98, 102, 90)
    text = np.concatenate([rng.integers(98, 102, 3000), passage, [0], rng.integers(98, 102, 500), passage]).astype(np.uint16)
    place, common = (np.concatenate(x) for x in zip(*induced.sorted_suffixes(text)))
    plain = text.tolist()
    assert sorted(place) == list(range(len(text)))
    for a, b, c in zip(place, place[1:], common[1:]):
        x, y = plain[a:][: induced.DEPTH], plain[b:][: induced.DEPTH]
        assert x >= y and c == next((k for k, (u, v) in enumerate(zip(x, y)) if u != v), min(len(x), len(y)))


def test_spans_merge_by_row():
    kind = pa.list_(pa.struct([("from", pa.int64()), ("to", pa.int64())]))
    spans = [None, [(0, 50), (10, 60), (60, 70), (71, 80)], [], [(5, 55)], [(0, 90), (3, 53), (95, 99)]]
    column = pa.array([None, *(None if s is None else [{"from": a, "to": b} for a, b in s] for s in spans)], kind)[1:]
    owner, low, high = suffix._merged(column)
    assert list(zip(owner, low, high)) == [(1, 0, 70), (1, 71, 80), (3, 5, 55), (4, 0, 90), (4, 95, 99)]
    body = bytes(range(100))
    batch = pa.RecordBatch.from_arrays([pa.array([3] * 5), pa.array([3, 3, 3, 3, 1]), pa.array([body] * 5, pa.binary()), column], ["id", "first", "body", "spans"])
    whole, cut, none, one, copy = suffix._left(batch, 50)
    assert whole == none == (body, 100, 0, 0) and copy == (b"", 100, 100, 1)
    assert cut == (body[70:71] + body[80:], 100, 79, 2) and one == (body[:5] + body[55:], 100, 50, 1)


def test_removal_at_the_edges(rows):
    passage = "x" + "".join(chr(97 + i % 23) for i in range(59))
    values = [(1, passage), (2, "é" + passage + "é"), (None, passage), (4, passage[:49]), (4, passage), (4, passage)]
    got = suffix.remove_repeated(documents(rows, values)).collect()
    assert sorted((x["doc_id"] or 99, x["n_bytes"], x["n_removed"]) for x in got) == [(1, 60, 0), (2, 64, 60), (4, 49, 0), (4, 60, 60), (4, 60, 60), (99, 60, 60)]
    left = suffix.trimmed(documents(rows, values)).collect()
    assert sorted((x["doc_id"], x["text"], x["bits"]) for x in left) == [(1, passage, "x"), (2, "éé", "x"), (4, passage[:49], "x")]
    assert suffix.remove_repeated(documents(rows, [])).count() == 0
    with pytest.raises(ValueError):
        suffix.repeated_spans(documents(rows, []), length=10)
