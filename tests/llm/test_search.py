"""Piece ids, exact top-k, near-duplicate vectors, licences and the pipeline."""

import random
import tempfile
import textwrap
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import queries
from catalog_spark.llm import licences, pieces, polytope, topk

corpus_pipeline = pytest.importorskip("corpus_pipeline")


# --- pieces ---------------------------------------------------------------------------------------------------------


def small(pairs):
    """A vocabulary of (piece, score), with bytes to fall back to."""
    surface = [p.replace("▁", " ").encode() for p, _ in pairs] + [bytes([b]) for b in range(256)]
    return pieces.Vocabulary(surface, {p: (i, s) for i, (p, s) in enumerate(pairs)}, list(range(len(pairs), len(pairs) + 256)), 0, True)


def plain_score(words, text):
    best = [0.0] + [float("-inf")] * len(text)
    for i in range(len(text)):
        for j in range(i + 1, min(len(text), i + words.longest) + 1):
            found = words.ids.get(text[i:j])
            if found:
                best[j] = max(best[j], best[i] + found[1])
        if text[i] not in words.ids:
            best[i + 1] = max(best[i + 1], best[i] + words.unknown_score)
    return best[-1]


def score_of(words, ids):
    by_id = {i: s for i, s in words.ids.values()}
    return sum(by_id.get(i, 0.0) for i in ids)


@pytest.mark.parametrize("seed", range(4))
def test_viterbi_against_brute_force(seed):
    r = random.Random(seed)
    pairs = {"".join(r.choice("ab▁c") for _ in range(r.randint(1, 5))): -float(r.randint(1, 30)) for _ in range(25)} | {c: -20.0 for c in "ab▁c"}
    words = small(sorted(pairs.items()))
    for _ in range(60):
        text = "".join(r.choice("aab c") for _ in range(r.randint(0, 120)))
        marked = "▁" + text.replace(" ", "▁")
        encoder, stream = pieces.Encoder(words), pieces.StreamingViterbi(words)
        ids = np.frombuffer(encoder.encode(text), np.int32).tolist()
        assert pieces.decode_ids(words, ids) == text
        parts, at = [], 0
        while at < len(marked):
            step = r.randint(1, 9)
            parts += stream.feed(marked[at : at + step])
            at += step
        parts += stream.feed("", last=True)
        if text:
            assert score_of(words, ids) == score_of(words, parts) == plain_score(words, marked)


def test_window_stays_small():
    words = small([("▁", -1.0), ("a", -3.0), ("aa", -4.0), ("aaa", -7.0), ("b", -2.0)])
    stream, widest, ids = pieces.StreamingViterbi(words), 0, []
    for _ in range(3000):
        ids += stream.feed("a")
        widest = max(widest, len(stream.text))
    ids += stream.feed("", last=True)
    assert widest < 20 * words.longest and b"".join(words.surface[i] for i in ids) == b"a" * 3000


def test_public_model(spark, data):
    words = pieces.load()
    rows = [(1, "Hello  wörld\n\tこ \x00 x"), (2, ""), (3, None), (4, "a" * 30000), (4, "a" * 30000), (None, "▁ _")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = pieces.round_trip(docs, words).collect()
    assert all(r["same"] for r in got) and sorted(r["n_ids"] for r in got)[:2] == [0, 0] and len(got) == 6
    assert pieces.round_trip(docs.where("false"), words).count() == 0
    whole = queries()["op8_sentencepiece"](spark, data)
    assert whole.where("not same").count() == 0 and whole.count() == spark.read.parquet(f"{data}/documents.parquet").count()
    with pytest.raises(ValueError):
        pieces.encode(docs, words, ids="doc_id")


# --- vectors --------------------------------------------------------------------------------------------------------

VECTORS = "vec_id long, embedding array<float>, label int, rank int, score string"


def vectors(rows, n=300, seed=0):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(20, 16))
    out = []
    for i in range(n):
        x = centres[i % 20] + rng.normal(size=16) * rng.choice([0.02, 0.15, 1.0])
        out.append((i, [float(v) for v in np.float32(x)], int(i % 3), 0, "s"))
    out += [(1000 + i, out[5][1], out[5][2], 0, "s") for i in range(40)]
    nan, inf = float("nan"), float("inf")
    out += [(2000, None, 1, 0, "s"), (2050, [0.0] * 16, 1, 0, "s"), (2002, [nan] + [1.0] * 15, 1, 0, "s"), (2003, [inf] * 16, 1, 0, "s"), (2004, out[5][1], None, 0, "s"), (2005, [None] + [1.0] * 15, 1, 0, "s"), (2006, [1.0, 2.0], 1, 0, "s"), (None, out[5][1], 2, 0, "s"), (2007, [], 1, 0, "s")]
    return out, rows(out, VECTORS)


def test_top_k(rows):
    values, table = vectors(rows)
    made_ = topk.weights(table)
    got = [(r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in topk.top_k(made_.where("vec_id % 50 = 0"), made_, 5).collect()]
    sound = [(i, [int(np.floor(256.0 * x)) for x in v]) for i, v, *_ in values if i is not None and v is not None and all(x is not None and np.isfinite(x) for x in v)]
    want = []
    for q, w in sound:
        if q % 50 == 0:
            best = sorted((-sum(a * b for a, b in zip(w, x)), i) for i, x in sound if i != q)[:5]
            want += [(q, k, i, -s) for k, (s, i) in enumerate(best, 1)]
    assert sorted(got) == sorted(want)
    assert topk.top_k(made_.where("false"), made_, 5).count() == 0 == topk.top_k(made_, made_.where("false"), 5).count()


@pytest.mark.parametrize("hot", [20_000, 5])
def test_near_duplicate_vectors(rows, hot):
    values, table = vectors(rows)
    got = {r["vec_id"]: r for r in polytope.near_duplicates(table, 0.93, hot_bucket=hot).collect()}
    fine = [(i, np.array(v, float), l) for i, v, l, *_ in values if i is not None and l is not None and v and None not in v and np.isfinite(v).all() and np.any(v)]
    links = {i: [j for j, y, m in fine if j != i and m == l and len(x) == len(y) and x @ y / np.sqrt((x @ x) * (y @ y)) >= 0.93] for i, x, l in fine}
    label = {i: i for i in links}
    while True:
        new = {i: min([label[i], *(label[j] for j in links[i])]) for i in links}
        if new == label:
            break
        label = new
    assert {i: (got[i]["n_links"], got[i]["component_id"]) for i in links} == {i: (len(links[i]), label[i]) for i in links}
    others = [r for i, r in got.items() if i not in links]
    assert len(got) == len(values) and all(r["n_links"] == 0 and r["kept"] and r["component_id"] == r["vec_id"] for r in others)
    assert polytope.near_duplicates(table.where("false")).count() == 0


@pytest.mark.parametrize("hot", [20_000, 50])
def test_pairs_without_a_common_bucket_are_linked(rows, hot):
    rng = np.random.default_rng(3)
    first = rng.normal(size=(150, 48))
    x = np.float32(np.vstack([first, first + rng.normal(size=first.shape) * 0.36])).astype(float)
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    near = (unit @ unit.T >= 0.93) & ~np.eye(len(x), dtype=bool)
    codes = polytope.probe_codes(unit, 1)
    apart = [(i, j) for i, j in zip(*np.nonzero(near)) if not set(codes[i]) & set(codes[j])]
    table = rows([(i, v.tolist(), 1, 0, "s") for i, v in enumerate(x)], VECTORS)
    got = {r["vec_id"]: r["n_links"] for r in polytope.near_duplicates(table, 0.93, tables=1, hot_bucket=hot).collect()}
    assert apart and got == dict(enumerate(near.sum(axis=1).tolist()))


def test_crowded_bucket_is_compared_in_blocks(rows, tmp_path, monkeypatch):
    rng = np.random.default_rng(8)
    values = [(i, [float(x) for x in np.r_[np.ones(8), np.zeros(8)] + rng.normal(0, 0.12, 16)], "a") for i in range(300)]
    original, folder = polytope._search, str(tmp_path)

    def spied(threshold, tables):
        inner = original(threshold, tables)

        def run(batches):
            batches = list(batches)
            keys = Counter(k for b in batches for k in zip(b["bucket"].to_pylist(), b["salt"].to_pylist()))
            with tempfile.NamedTemporaryFile(dir=folder, suffix=f"-{max(keys.values(), default=0)}", delete=False):
                pass
            yield from inner(iter(batches))

        return run

    table = rows(values, "vec_id long, embedding array<double>, label string")
    plain = {r["vec_id"]: tuple(r) for r in polytope.near_duplicates(table, 0.93).collect()}
    monkeypatch.setattr(polytope, "_search", spied)
    got = {r["vec_id"]: tuple(r) for r in polytope.near_duplicates(table, 0.93, hot_bucket=40).collect()}
    assert got == plain and sum(n for _, n, *_ in got.values()) > 300
    assert 0 < max(int(f.name.split("-")[-1]) for f in tmp_path.iterdir()) < 100


# --- licences -------------------------------------------------------------------------------------------------------


def test_licences(spark):
    mit = dict(licences.KNOWN[:1])["MIT"]
    rows = [
        (1, mit),
        (2, "Copyright (c) 2001 Some Body\n\n" + mit.upper().replace(" ", "\n  ").replace("SUBLICENSE", "sub-licence")),
        (3, mit + " more"),
        (4, "word word\nLicensed under CC BY-NC 4.0.\nReleased under the MIT Licence\nReleased under the MIT License."),
        (5, None),
        (6, ""),
        (7, "x " * 20000),
        (None, "mit license"),
        (4, "word"),
    ]
    docs = spark.createDataFrame([(i, t, "clash", "clash") for i, t in rows], "doc_id long, text string, digest string, licence string")
    got = licences.scan(docs, licences.known_licences(spark)).collect()
    assert len(got) == len(rows)
    found = {(r["doc_id"], r["licence"], tuple(r["notices"])) for r in got}
    assert found == {(1, "MIT", ("MIT",)), (2, "MIT", ()), (3, None, ()), (4, None, ("CC-BY-NC-4.0", "MIT")), (4, None, ()), (5, None, ()), (6, None, ()), (7, None, ()), (None, "MIT", ("MIT",))}
    assert licences.scan(docs.where("false"), licences.known_licences(spark)).count() == 0


def test_titled_wrapped_and_one_line_licences(spark):
    holder = "Copyright (c) 2020 Jane Doe"
    titles = {"MIT": "MIT License", "ISC": "ISC License", "0BSD": "BSD Zero Clause License", "BSD-2-Clause": "BSD 2-Clause License", "BSD-3-Clause": "BSD 3-Clause License"}
    values = []
    for name, title in titles.items():
        body = next(b for n, b in licences.KNOWN if n == name and len(b) > 300)
        for head in (title + "\n\n" + holder + "\n\n", holder + "\n", title + "\n", title + " " + holder + " ", ""):
            values += [(name, head + body), (name, head + textwrap.fill(body, 60)), (name, (head + body).upper())]
    for name, body in licences.full_texts():
        plain = body.split("\n\n")
        values += [(name, body), (name, " ".join(body.split())), (name, "\n\n".join(textwrap.fill(p, 71) if "opyright" not in p else p for p in plain))]
    docs = spark.createDataFrame([(i, t) for i, (_, t) in enumerate(values)], "doc_id long, text string")
    got = {r["doc_id"]: r["licence"] for r in licences.scan(docs, licences.known_licences(spark)).collect()}
    assert [(i, name, values[i][1][:60]) for i, (name, _) in enumerate(values) if got[i] != name] == []
    assert {"Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "MPL-2.0", "CC0-1.0"} <= {n for n, _ in values}
    notice = spark.createDataFrame([(1, holder + ". Licensed under the MIT License.\nmore")], "doc_id long, text string")
    assert licences.scan(notice, licences.known_licences(spark)).first()["notices"] == ["MIT"]


# --- pipeline -------------------------------------------------------------------------------------------------------


def test_pipeline(spark, data):
    from catalog_spark.session import materialize

    docs = spark.read.parquet(f"{data}/documents.parquet")
    columns, count = docs.columns, docs.count()
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = materialize(stage(spark, docs, data), name)
        assert docs.columns == columns
        if name != "source_mixing":
            assert docs.count() <= count
        assert docs.where("text is null").count() == 0
        count = docs.count()
    ids = corpus_pipeline.STAGES[-1][1](spark, docs, data)
    assert ids.count() == count and ids.where("not same").count() == 0


def test_pipeline_stages_of_nothing(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").where("false")
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, data).count() == 0


def test_pipeline_keeps_columns_with_clashing_names(spark, data):
    docs = spark.read.parquet(f"{data}/documents.parquet").limit(40).withColumns({c: F.lit(1) for c in ("row", "id", "body", "bits", "p", "tokens", "score", "spans", "first")})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, data).columns == docs.columns
