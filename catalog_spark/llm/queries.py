"""One registered query per operator, over its whole table with production parameters."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..queries.registry import query
from . import codes, langid, licences, mixing, phrases, pieces, polytope, quality, simhash, suffix, topk, toxicity, turns

#: Wanted shares of the tokens of good, low-quality and toxic documents.
TARGETS = {"good": 0.90, "low": 0.07, "toxic": 0.03}

TOP_K_SQL = """
WITH w AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(list_zip(q.w, c.w), lambda p: p[1] * p[2])) AS BIGINT) AS score
  FROM w q JOIN w c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
) WHERE rank <= 5
"""


def _nearest_sql(book: str) -> str:
    """Each part with the number of its nearest entry and the squared distance: the least of distance and number together."""
    return f"""SELECT r, p, a, b, c, d, m % 64 AS e, m // 64 AS dist FROM (
      SELECT r, p, a, b, c, d, min(((a - y.ya) * (a - y.ya) + (b - y.yb) * (b - y.yb) + (c - y.yc) * (c - y.yc) + (d - y.yd) * (d - y.yd)) * 64 + y.e) AS m
      FROM parts JOIN {book} y USING (p) GROUP BY ALL)"""


def _round_sql(near: str, book: str) -> str:
    """The entries at the means, rounded down, of their parts; unused ones stay."""
    down = lambda s: f"CAST(({s} - ((({s}) % n) + n) % n) // n AS BIGINT)"
    return f"""SELECT p, y.e, {", ".join(f"CASE WHEN n > 0 THEN {down('s' + x)} ELSE y{x} END AS y{x}" for x in "abcd")} FROM {book} y
      LEFT JOIN (SELECT p, e, count(*) AS n, sum(a) AS sa, sum(b) AS sb, sum(c) AS sc, sum(d) AS sd FROM {near} GROUP BY ALL) USING (p, e)"""


CODES_SQL = f"""
WITH kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT r, vec_id, p, w[4 * p + 1] AS a, w[4 * p + 2] AS b, w[4 * p + 3] AS c, w[4 * p + 4] AS d FROM kept, range(16) AS t(p)
), ids AS (SELECT r, row_number() OVER (ORDER BY vec_id) - 1 AS e FROM kept ORDER BY vec_id LIMIT 64),
book0 AS MATERIALIZED (SELECT p, e, a AS ya, b AS yb, c AS yc, d AS yd FROM parts JOIN ids USING (r)),
near0 AS MATERIALIZED ({_nearest_sql("book0")}), book1 AS MATERIALIZED ({_round_sql("near0", "book0")}),
near1 AS MATERIALIZED ({_nearest_sql("book1")}), book2 AS MATERIALIZED ({_round_sql("near1", "book1")}),
near2 AS MATERIALIZED ({_nearest_sql("book2")}),
coded AS (SELECT r, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(dist) AS BIGINT) AS error FROM near2 GROUP BY r),
whole AS (SELECT sha256(string_agg(concat_ws(',', ya, yb, yc, yd), ',' ORDER BY p, e)) AS codebooks_sha256 FROM book2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM kept JOIN coded USING (r), whole
"""

TRIE_SQL = """
WITH t AS MATERIALIZED (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(sha256(coalesce(text, '')) || coalesce(role, ''))) AS pos,
    struct_pack(role := coalesce(role, ''), body := coalesce(text, '')) AS x
  FROM conversations WHERE conv_id IS NOT NULL
), ids AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(4294967295, list_reduce(
    list_prepend(4294967295, flatten(list_transform(string_split(CAST(conv_id AS VARCHAR), ''), lambda d: [CAST(ascii(d) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, b: xor(xor(a, b) >> 1, CASE WHEN xor(a, b) & 1 = 1 THEN 3988292384 ELSE 0 END))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), lists AS (SELECT conv_id, list(x ORDER BY pos) AS xs FROM t GROUP BY conv_id),
seqs AS MATERIALIZED (
  SELECT ids.conv_id, list_concat(coalesce(b.xs[1:h], []), coalesce(o.xs[h + 1:], [])) AS xs
  FROM ids JOIN lists o USING (conv_id) LEFT JOIN lists b ON b.conv_id = ids.base
), nodes AS MATERIALIZED (
  SELECT path, depth, min(conv_id) AS conv_id, count(*) AS n_convs, string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(xs) = depth) AS ends
  FROM (SELECT conv_id, xs, depth, xs[1:depth] AS path FROM (SELECT *, unnest(range(len(xs) + 1)) AS depth FROM seqs)) GROUP BY path, depth
), kids AS (
  SELECT n.path, n.depth, count(k.path) AS n_children FROM nodes n LEFT JOIN nodes k ON k.depth = n.depth + 1 AND k.path[1:n.depth] = n.path GROUP BY ALL
), sums AS (
  SELECT path[1:up] AS path, up AS depth, count(*) FILTER (n_children = 0) AS n_leaves,
    sum(CASE WHEN depth > 0 THEN (n_convs - 1) * strlen(path[depth].body) ELSE 0 END) AS saved_tokens
  FROM (SELECT *, unnest(range(depth + 1)) AS up FROM nodes JOIN kids USING (path, depth)) GROUP BY ALL
)
SELECT n.conv_id, n.depth, p.conv_id AS parent_conv_id, n.n_convs, n_children, n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, sha256(coalesce(n.ends, '')) AS ends_sha256
FROM nodes n JOIN kids USING (path, depth) JOIN sums USING (path, depth) LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
"""


PHRASES_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x09-\x0D\x20]+'), lambda w: w <> '') AS words FROM documents
), windows AS MATERIALIZED (
  SELECT r, pos, array_to_string(words[pos:pos + 34], ' ') AS body FROM (SELECT r, words, unnest(range(1, len(words) - 33)) AS pos FROM d WHERE len(words) >= 35)
), again AS (SELECT body FROM windows GROUP BY body HAVING count(*) > 1),
gone AS MATERIALIZED (SELECT DISTINCT r, unnest(range(pos, pos + 35)) AS place FROM windows SEMI JOIN again USING (body)),
kept AS (
  SELECT r, string_agg(w, ' ' ORDER BY place) AS body, count(*) AS n FROM (SELECT r, unnest(words) AS w, unnest(range(1, len(words) + 1)) AS place FROM d) ANTI JOIN gone USING (r, place) GROUP BY r
)
SELECT doc_id, len(words) AS n_words, len(words) - coalesce(n, 0) AS n_removed, sha256(coalesce(body, '')) AS kept_sha256 FROM d LEFT JOIN kept USING (r)
"""


def _remainder(key: str, parts: int) -> Column:
    """Fold of a row: crc32 of the id as text."""
    return F.crc32(F.coalesce(F.col(key).cast("string"), F.lit("")).cast("binary")) % parts


def domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labelled documents; a row without both labels has none."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").when(F.col("quality") == 1, "good")
    return labels.select("doc_id", domain.alias("domain"))


@query("op1_source_mixing")
def _mixing(t):
    """Rates and copies of all documents so that the expected tokens of the domains match the targets."""
    model = mixing.fit_domains(t.documents, domains(t.labels))
    return mixing.mix(t.documents, model, TARGETS).drop("row", "check")


@query("op2_language_id")
def _language(t):
    """Language of every document, learnt from the rows that are not held out."""
    model = langid.fit(t.documents.where(_remainder("doc_id", 3) != 1))
    found = langid.identify(t.documents.select("doc_id", "text"), model)
    return found.select("doc_id", (_remainder("doc_id", 3) == 1).alias("held_out"), "lang_pred", "score")


@query("op3_quality")
def _quality(t):
    """Quality score of every document, learnt from the labels that are not held out."""
    found = quality.quality(t.documents, t.labels.where(_remainder("doc_id", 4) != 2))
    return found.select("doc_id", (_remainder("doc_id", 4) == 2).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op4_license_scan")
def _licences(t):
    """Licences of every document: of the whole text, and of whole lines."""
    return licences.scan(t.documents, licences.known_licences(t.spark))


@query("op5_toxicity")
def _toxicity(t):
    """Toxicity score of every document, learnt from the labels that are not held out."""
    model = toxicity.fit(t.documents, t.labels.where(_remainder("doc_id", 3) != 1))
    found = toxicity.score(t.documents.select("doc_id", "text"), model)
    return found.select("doc_id", (_remainder("doc_id", 3) == 1).alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query("op6_suffix_array_dedup")
def _suffix(t):
    """Documents without the bytes of 50-byte strings that an earlier document holds."""
    found = suffix.remove_repeated(t.documents, length=50)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


@query("op7_embedding_near_dedup")
def _polytope(t):
    """Vectors of one label with cosine 0.93 or more: links, components, the first of each kept."""
    return polytope.near_duplicates(t.embeddings, threshold=0.93)


@query("op8_sentencepiece")
def _pieces(t):
    """Piece ids of every document, and whether they decode to its text."""
    return pieces.round_trip(t.documents, pieces.load())


@query("op9_exact_top_k", TOP_K_SQL)
def _top_k(t):
    """The five highest integer inner products of every fiftieth vector with all others."""
    found = topk.weights(t.embeddings)
    return topk.top_k(found.where("vec_id % 50 = 0"), found, k=5)


@query("op10_simhash_near_dedup")
def _simhash(t):
    """Documents by component of 3-word SimHash fingerprints at most 3 bits apart."""
    return simhash.near_duplicates(t.documents, shingle=3, limit=3)


@query("op13_vector_codes", CODES_SQL)
def _codes(t):
    """Codes of all vectors by 16 codebooks of 64 entries, after two rounds over their distinct parts."""
    return codes.compress(t.embeddings)


@query("op11_phrase_dedup", PHRASES_SQL)
def _phrases(t):
    """Documents without the words of 35-word passages that occur more than once."""
    return phrases.remove_repeated(t.documents, length=35)


@query("op12_conversation_trie", TRIE_SQL)
def _turns(t):
    """Trie of the beginnings of all conversations, rebuilt with shared heads."""
    return turns.prefix_trie(t.conversations)
