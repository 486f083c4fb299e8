"""Language, quality, toxicity and mixing: gradients, held-out accuracy, and odd rows."""

import random
import tracemalloc

import numpy as np
import pytest
from pyspark.sql import functions as F

from catalog_spark.llm import langid, mixing, quality, text as flat, toxicity

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
SYLLABLES = {"xx": ["ka", "to", "mi", "ra", "so"], "yy": ["glu", "fre", "nd", "ich", "ö"], "zz": ["qui", "elle", "eau", "é", "ment"]}
BAD = ["grumpfel", "snarkof", "blistag"]


def made(seed, n=240):
    """(doc_id, text, lang, quality, toxic): made-up languages, shouted or symbol-ridden texts, planted words."""
    r, out = random.Random(seed), []
    for i in range(n):
        lang = r.choice(sorted(SYLLABLES))
        words = ["".join(r.choice(SYLLABLES[lang]) for _ in range(r.randint(1, 4))) for _ in range(r.randint(15, 60))]
        good, toxic = r.random() < 0.7, r.random() < 0.4
        if not good:
            words = [w + "%%%" for w in words] if r.random() < 0.5 else words[:1] * len(words)
        if toxic:
            for _ in range(2):
                words.insert(r.randrange(len(words)), r.choice(BAD))
        out.append((i, " ".join(words), lang, int(good), int(toxic)))
    return out


ODD = [(9001, None), (9002, ""), (9003, "12 % 34"), (None, "ka to mi"), (9004, "ka" * 20000), (9004, "ka" * 20000)]


@pytest.fixture(scope="module")
def tables(spark):
    rows = made(1)
    docs = [(i, t, l, "s", 1) for i, t, l, _, _ in rows] + [(i, t, None, None, None) for i, t in ODD]
    return spark.createDataFrame(docs, DOCS), spark.createDataFrame([(i, q, x) for i, _, _, q, x in rows], "doc_id long, quality int, toxic int"), rows


# --- words ----------------------------------------------------------------------------------------------------------


def test_words_and_hashes():
    import pyarrow as pa

    column = pa.array(["xx", "ab%% cd\n", None, "", "éa b", "cd"])[1:]
    data, start, end = flat.flat_bytes(column)
    owner, at, to = flat.spans(data, start, end, symbols=True)
    assert [(int(o), bytes(data[a:b])) for o, a, b in zip(owner, at, to)] == [(0, b"ab"), (0, b"%%"), (0, b"cd"), (3, "éa".encode()), (3, b"b"), (4, b"cd")]
    owner, at, to = flat.spans(data, start, end, symbols=False)
    assert [bytes(data[a:b]) for a, b in zip(at, to)] == [b"ab%%", b"cd", "éa".encode(), b"b", b"cd"]
    h = flat.hashed(data, at, to)
    assert h[1] == h[4] and len(set(h.tolist())) == 4
    assert flat.chunks(np.array([0, 5, 5, 30]), np.array([5, 5, 30, 31]), 10) == [slice(0, 2), slice(2, 3), slice(3, 4)]


def test_folded_hashes():
    data = np.frombuffer("Ab aB \u00c9a \u00e9a [ @ { ab".encode(), np.uint8)
    _, at, to = flat.spans(data, np.array([0]), np.array([len(data)]), symbols=False)
    folded = flat.hashed(data, at, to, fold=True)
    assert np.array_equal(folded, flat.hashed(flat.lower(data), at, to))
    assert folded[0] == folded[1] == folded[-1] and len(set(folded.tolist())) == len(at) - 2


def test_a_chunk_reads_no_more_than_its_texts():
    """A batch is taken in chunks; what one of them needs does not grow with the batch around it."""
    text = b"One two %% TWO three 12 one one"
    low = 1 << 22
    data = np.full(1 << 24, 32, np.uint8)
    data[low : low + len(text)] = np.frombuffer(text, np.uint8)
    alone = np.frombuffer(text, np.uint8)
    start, end = np.array([low, low + 8]), np.array([low + 8, low + len(text)])
    for found in (mixing._features, toxicity.words_of):
        plain = found(alone, start - low, end - low)
        tracemalloc.start()
        got = found(data, start, end)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        shift = [0, 0, 0] if found is mixing._features else [0, 0, low, low]
        assert all(np.array_equal(x, y + s) for x, y, s in zip(got, plain, shift))
        assert peak < 1 << 20
    owner, feature, words = mixing._features(data, start, end)
    pairs = list(zip(owner.tolist(), feature.tolist()))
    assert pairs == sorted(set(pairs)) and words.tolist() == [2, 6]
    assert all(len(x) == 0 for x in mixing._features(data[:0], np.zeros(0, int), np.zeros(0, int)))


# --- language -------------------------------------------------------------------------------------------------------


def test_gradients_of_the_network():
    rng = np.random.default_rng(1)
    model = langid._fresh(["a", "b"], 3, rng)
    x, y = rng.integers(0, 6, (5, 4)), np.array([0, 1, 0, 1])
    x[4, 0] = langid.PAD
    _, grads = langid._gradients(model, x, y)
    for k, w in enumerate([model.out, model.bias, model.table[0], model.loop[0], model.table[1], model.loop[1]]):
        for _ in range(6):
            at = tuple(rng.integers(0, 6 if s == 257 else s) for s in w.shape)
            kept = w[at]
            w[at] = kept + 1e-2
            up = langid._gradients(model, x, y)[0]
            w[at] = kept - 1e-2
            down = langid._gradients(model, x, y)[0]
            w[at] = kept
            assert abs((up - down) / 2e-2 - grads[k][at]) < 2e-3


def test_padding_changes_nothing():
    model = langid._fresh(["a", "b"], 4, np.random.default_rng(2))
    data = np.random.default_rng(3).integers(0, 256, 900).astype(np.uint8)
    start, end = np.array([0, 300, 300, 310]), np.array([300, 300, 310, 900])
    together = langid._pooled(model, data, start, end)
    alone = np.concatenate([langid._pooled(model, data, start[i : i + 1], end[i : i + 1]) for i in range(4)])
    assert np.allclose(together, alone, atol=1e-5) and not together[1].any()


def test_language(tables):
    docs, _, rows = tables
    model = langid.fit(docs.where("doc_id % 3 <> 1"))
    got = {r["doc_id"]: r for r in langid.identify(docs, model).collect()}
    held = [(i, l) for i, _, l, _, _ in rows if i % 3 == 1]
    assert np.mean([got[i]["lang_pred"] == l for i, l in held]) > 0.95
    assert [(got[i]["lang_pred"], got[i]["score"]) for i in (9001, 9002, 9003)] == [("und", 0.0)] * 3
    assert got[None]["lang_pred"] == "xx" and got[9004]["lang_pred"] == "xx" and 0 <= got[9004]["score"] <= 1
    with pytest.raises(ValueError):
        langid.identify(docs.withColumn("score", F.lit(1)), model)


def test_nothing_to_learn_from(tables, spark):
    docs, labels, _ = tables
    none, no_labels = docs.where("false"), labels.where("false")
    assert langid.fit(none) is None and langid.identify(none, None).count() == 0
    assert {r["lang_pred"] for r in langid.identify(docs, None).collect()} == {"und"}
    assert toxicity.fit(docs, no_labels) is None
    assert {r["score"] for r in toxicity.score(docs, None).collect()} == {0.0}
    assert {r["score"] for r in quality.quality(docs, no_labels).collect()} == {0.5}
    assert quality.quality(none, labels).count() == 0
    assert mixing.mix(none, None, {"a": 1.0}).count() == 0
    assert {r["copies"] for r in mixing.mix(docs, None, {}).collect()} == {1}


# --- quality and toxicity -------------------------------------------------------------------------------------------


def test_context_vectors_against_plain_sums():
    places = quality.index_places()
    owner, slot = np.array([0, 0, 0, 1, 1]), np.array([5, 7, 5, 7, 9])
    want = np.zeros((quality.SLOTS, quality.WIDTH), int)
    for i in range(5):
        for j in range(5):
            if i != j and abs(i - j) <= quality.REACH and owner[i] == owner[j]:
                want[slot[i], places[slot[j], 0]] += 1
                want[slot[i], places[slot[j], 1]] -= 1
    assert (quality.context_counts(owner, slot, places) == want).all()


def test_quality(tables):
    docs, labels, rows = tables
    got = {r["doc_id"]: r["score"] for r in quality.quality(docs, labels.where("doc_id % 4 <> 2")).collect()}
    held = [(got[i], q) for i, _, _, q, _ in rows if i % 4 == 2]
    assert np.mean([(s >= 0.5) == q for s, q in held]) > 0.9
    assert len(got) == len(rows) + 5 and all(0 <= s <= 1 for s in got.values())


def test_toxicity_and_unseen_spellings(tables, spark):
    docs, labels, rows = tables
    model = toxicity.fit(docs, labels.where("doc_id % 3 <> 1"))
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    held = [(scored[i], x) for i, _, _, _, x in rows if i % 3 == 1]
    assert np.mean([(s >= 0.7) == x for s, x in held]) > 0.9
    assert scored[9001] == scored[9002] == scored[9003] == 0.0
    odd = spark.createDataFrame([(1, "ka to grumpfell mi"), (2, "ka to mi ra")], "doc_id long, text string")
    a, b = (r["score"] for r in toxicity.score(odd, model).orderBy("doc_id").collect())
    assert a > 0.5 > b
    with pytest.raises(ValueError):
        toxicity.score(docs, model, name="lang")


# --- mixing ---------------------------------------------------------------------------------------------------------


def test_mixing(tables):
    docs, labels, rows = tables
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").otherwise("good")
    model = mixing.fit_domains(docs, labels.select("doc_id", domain.alias("domain")))
    assert model.domains == ["good", "low", "toxic"]
    targets = {"good": 0.7, "low": 0.1, "toxic": 0.2}
    got = mixing.mix(docs, model, targets).collect()
    assert len(got) == len(rows) + len(ODD)
    p = np.array([r["p"] for r in got])
    assert np.allclose(p.sum(axis=1), 1) and all(model.domains[i] == r["domain"] for i, r in zip(p.argmax(axis=1), got))
    tokens, rate = (np.array([r[k] for r in got], float) for k in ("tokens", "rate"))
    reached = (tokens * rate) @ p
    assert np.allclose(reached / tokens.sum(), [0.7, 0.1, 0.2], atol=2e-3) and (rate >= 0).all()
    assert all(np.floor(r["rate"]) <= r["copies"] <= np.ceil(r["rate"]) for r in got)
    copied = mixing.mixed(docs, model, targets)
    assert copied.columns == docs.columns
    once = {r["row"]: r["copies"] for r in got}
    assert copied.count() == sum(once[r["row"]] for r in got)


def test_rates_stop_at_zero(spark):
    members = spark.createDataFrame([(10, [1.0, 0.0]), (10, [0.0, 1.0]), (0, [0.5, 0.5])], "tokens long, p array<double>")
    fit = mixing.fit_steps(members, ["a", "b"], {"a": 1.0})
    assert fit.met and np.allclose(fit.wanted, [20, 0]) and np.allclose(fit.reached, fit.wanted, atol=0.02)
    assert (mixing._rates(np.array([[1.0, 0], [0, 1.0]]), fit.steps)[0] >= 0).all()


def closest(p, tokens, wanted):
    """Brute force: the totals of the cone of the documents that are closest to the targets, K being 2."""
    weight = 1 / np.einsum("i,ij,ij->j", tokens, p, p)
    best = None
    for a in range(len(p)):
        for b in range(a, len(p)):
            rays = p[[a, b]].T * np.sqrt(weight)[:, None]
            r = np.linalg.lstsq(rays, wanted * np.sqrt(weight), rcond=None)[0]
            options = [np.maximum(0, r)] if (r >= 0).all() else []
            options += [np.eye(2)[i] * max(0.0, rays[:, i] @ (wanted * np.sqrt(weight)) / (rays[:, i] ** 2).sum()) for i in range(2)]
            for o in options:
                cost = ((rays @ o - wanted * np.sqrt(weight)) ** 2).sum()
                if best is None or cost < best[0]:
                    best = (cost, p[[a, b]].T @ o)
    return best[1]


@pytest.mark.parametrize("posteriors, share", [([(0.6, 0.4), (0.55, 0.45), (0.5, 0.5)], 0.9), ([(0.52, 0.48), (0.45, 0.55), (0.5, 0.5)], 0.51)])
@pytest.mark.parametrize("replay", [7, 960])
def test_overlapping_posteriors(spark, monkeypatch, posteriors, share, replay):
    """Targets out of reach end at the closest totals and say so; those just in reach are met, with rates written down or not."""
    monkeypatch.setattr(mixing, "REPLAY", replay)
    members = spark.createDataFrame([(10, list(p)) for p in posteriors], "tokens long, p array<double>")
    fit = mixing.fit_steps(members, ["a", "b"], {"a": share, "b": 1 - share})
    p, tokens = np.array(posteriors), np.full(len(posteriors), 10.0)
    assert fit.met == (share < 0.52)
    assert np.allclose(fit.reached, closest(p, tokens, fit.wanted), atol=mixing.PROOF * 30)
    early = mixing.fit_steps(members, ["a", "b"], {"a": 0.9, "b": 0.1}, most=2)
    assert early.taken == 2 and not early.met


def test_mixing_reports_missed_targets(spark):
    docs = spark.createDataFrame([(i, "one two three", "en", "s", 13) for i in range(6)], DOCS)
    labels = spark.createDataFrame([(i, "ab"[i % 2]) for i in range(6)], "doc_id long, domain string")
    model = mixing.fit_domains(docs, labels)
    rows = mixing.mix(docs, model, {"a": 1.0}).collect()
    assert all(r["wanted"] != pytest.approx(r["reached"], rel=0.01) for r in rows)
    with pytest.raises(ValueError, match="no rates meet"):
        mixing.mix(docs, model, {"a": 1.0}, strict=True)


def test_mixing_with_clashing_columns_and_repeated_rows(tables):
    docs, labels, _ = tables
    domain = F.when(F.col("toxic") == 1, "toxic").otherwise("good").alias("domain")
    wide = docs.withColumns({n: F.lit(n) for n in ("domain", "row", "check", "t", "kept", "copy", "copies", "__copies", "__key", "__id", "__doc", "__text", "tokens", "p", "now", "last")})
    model = mixing.fit_domains(wide.unionByName(wide), labels.select("doc_id", domain))
    plain = mixing.fit_domains(docs, labels.select("doc_id", domain))
    assert (model.weights == plain.weights).all()  # copies of a labelled row count once
    got = mixing.mixed(wide, model, {"good": 0.5, "toxic": 0.5})
    assert got.columns == wide.columns
    want = mixing.mixed(docs, model, {"good": 0.5, "toxic": 0.5})
    assert sorted(map(str, got.select(docs.columns).collect())) == sorted(map(str, want.collect()))
    assert {(r["domain"], r["__copies"], r["__key"]) for r in got.collect()} == {("domain", "__copies", "__key")}


def test_copies_do_not_widen_the_language_sample(spark, monkeypatch):
    """Each distinct text is trained on once, whatever the number of its copies."""
    seen = []
    monkeypatch.setattr(langid, "train", lambda texts, labels: seen.append((sorted(texts), sorted(labels))))
    once = spark.createDataFrame([("ein Satz", "de"), ("une phrase", "fr"), ("une phrase", "de")], "text string, lang string")
    langid.fit(once)
    langid.fit(once.join(spark.range(50).select(F.lit(1).alias("n"))).select("text", "lang"))
    assert seen[0] == seen[1] and len(seen[0][0]) == 3 * langid.WINDOWS
