"""Registered queries of the operators in this subpackage, and their SQL."""

from __future__ import annotations

import functools

from pyspark.sql import functions as F

from campuslens.llm import ann, hard_negatives, jaccard_join, lexical, mixing, passages, quality, sentencepiece_codec, site_tree, token_blocks, token_counts, top_k, toxicity
from campuslens.llm.ship import ship

QUERIES: dict = {}
ORACLES: dict = {}


def query(name: str, sql: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark, sf_dir):
            ship(spark)
            return fn(spark, sf_dir)

        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run
    return deco


def read(spark, sf_dir: str, name: str):
    """One of the given tables; always read anew, by Spark's own readers."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return str(public_tokenizers.path(name))


@query("op2_token_files")
def op2_token_files(spark, sf_dir):
    """Token files of all documents, read back: place, size and checksum."""
    return token_blocks.token_files(read(spark, sf_dir, "documents"), tokenizer_file("word_bpe_49k.json"),
                                    vocab=49_408, digest=True)


@query("op8_sentencepiece")
def op8_sentencepiece(spark, sf_dir):
    """Piece ids of every document, decoded again."""
    return sentencepiece_codec.encode_decode(read(spark, sf_dir, "documents"), tokenizer_file("piece_bpe_32k.model"))


@query("op10_token_counts")
def op10_token_counts(spark, sf_dir):
    """Tokens of every line of every document, encoded as a whole."""
    import public_tokenizers

    return token_counts.section_token_counts(read(spark, sf_dir, "documents"),
                                             tokenizer_file("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


@query("op4_top_k", """
WITH v AS (
    SELECT vec_id, list_transform(embedding, lambda x: floor(1024 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS query_id, b.vec_id, CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id)
SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id, score
FROM s QUALIFY rank <= 10""")
def op4_top_k(spark, sf_dir):
    """The ten vectors of the highest integer inner product, by query row."""
    return top_k.top_k(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, 10)


@query("op5_mixing", f"""
WITH d AS (
    SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '{mixing.WORD}')), 0) AS BIGINT) AS size,
           md5('{mixing.SEED}:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS draw
    FROM documents),
s AS (
    SELECT source, CAST(sum(size) AS BIGINT) AS source_size,
           CASE row_number() OVER (ORDER BY source NULLS LAST) % 3 WHEN 1 THEN 5 WHEN 2 THEN 2 ELSE 1 END AS w
    FROM d GROUP BY source),
l AS (
    SELECT *, 3 * source_size AS cap, CAST(sum(source_size) OVER () AS BIGINT) AS total,
           CAST(coalesce(sum(3 * source_size) OVER (ORDER BY 3 * source_size / w, source NULLS LAST
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS cap_before,
           CAST(sum(w) OVER (ORDER BY 3 * source_size / w, source NULLS LAST
               ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS BIGINT) AS w_left
    FROM s),
c AS (SELECT *, cap * w_left < (total - cap_before) * w AS capped FROM l),
t AS (
    SELECT source, source_size, cap,
           CASE WHEN capped THEN CAST(cap AS DOUBLE)
                ELSE CAST((total - CAST(coalesce(sum(cap) FILTER (capped) OVER (), 0) AS BIGINT)) * w AS DOUBLE)
                     / CAST(sum(w) FILTER (NOT capped) OVER () AS DOUBLE) END AS target
    FROM c),
g AS (
    SELECT source, source_size, target, least(CAST(floor(target + 0.5) AS BIGINT), cap) AS goal,
           CASE WHEN source_size > 0 THEN least(CAST(floor(target + 0.5) AS BIGINT), cap) // source_size ELSE 0 END AS whole
    FROM t),
r AS (
    SELECT *, CAST(coalesce(sum(size) OVER (PARTITION BY source ORDER BY draw, doc_id, size
               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS ahead
    FROM d)
SELECT r.doc_id, r.size, g.source_size, g.target,
       CAST(g.whole * r.size + greatest(0, least(r.size, g.goal - g.whole * g.source_size - r.ahead)) AS BIGINT) AS taken
FROM r JOIN g ON r.source IS NOT DISTINCT FROM g.source""")
def op5_mixing(spark, sf_dir):
    """Words of every document that a mix of the sources by weight takes."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "source", "text")
    return mixing.mix(docs).select("doc_id", "size", "source_size", "target", "taken")


@query("op9_nearest")
def op9_nearest(spark, sf_dir):
    """The twenty nearest vectors found, by query row."""
    return ann.nearest(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, 20)


@query("op12_hard_negatives", """
WITH v AS (
    SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
      AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
           CAST(list_dot_product(a.q, b.q) AS BIGINT) AS score
    FROM v a JOIN v b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
p AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id,
       CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
       vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10""")
def op12_hard_negatives(spark, sf_dir):
    """Ten negatives of every positive of every anchor, where a seventh of the labels are moved on."""
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(read(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0, relabel=moved)


@query("op13_lexical_search", """
WITH d AS (
    SELECT doc_id, row_number() OVER () AS r,
           regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                              '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
    FROM documents WHERE text IS NOT NULL),
n AS (SELECT r, doc_id, CAST(len(t) AS BIGINT) AS n FROM d WHERE len(t) > 0),
s AS (SELECT count(*) AS n_docs, CAST(sum(n) AS BIGINT) AS n_terms FROM n),
f AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY ALL),
w AS (
    SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(n_docs) + 2 AS DOUBLE) / CAST(2 * count(*) + 1 AS DOUBLE)))
                      AS BIGINT) AS w
    FROM f, s GROUP BY term),
i AS (
    SELECT DISTINCT item_id, unnest(regexp_extract_all(
        translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term
    FROM benchmark WHERE text IS NOT NULL),
m AS (SELECT r, doc_id, 100 - 50 + (50 * n * n_docs) // n_terms AS m FROM n, s),
c AS (
    SELECT i.item_id, f.r, CAST(sum(w.w * ((1000000000 * f.tf) // (1000 * f.tf + 20 * m.m))) AS BIGINT) AS score
    FROM i JOIN w USING (term) JOIN f USING (term) JOIN m USING (r) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
       doc_id, score
FROM c JOIN n USING (r) WHERE score > 0 QUALIFY rank <= 50""")
def op13_lexical_search(spark, sf_dir):
    """The fifty highest-scoring documents of every benchmark item."""
    return lexical.ranked(read(spark, sf_dir, "documents").select("doc_id", "text"),
                          read(spark, sf_dir, "benchmark").select("item_id", "text"), 50)


@query("op6_toxicity")
def op6_toxicity(spark, sf_dir):
    """Toxicity of every document; the fold ``held_out`` teaches nothing."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, read(spark, sf_dir, "labels"), ~toxicity.held_out())
    return toxicity.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query("op11_quality")
def op11_quality(spark, sf_dir):
    """Quality of every document; the fold ``held_out`` teaches nothing."""
    docs = read(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = quality.train(docs, read(spark, sf_dir, "labels"), ~toxicity.held_out())
    return quality.score(docs, model).select("doc_id", toxicity.held_out().alias("held_out"), "score", "predicted")


@query("op7_main_text")
def op7_main_text(spark, sf_dir):
    """The article text of every page."""
    return site_tree.main_text(read(spark, sf_dir, "pages"))


@query("op1_jaccard_join", """
WITH RECURSIVE w AS (
    SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                                'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w
    FROM documents),
s AS (
    SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(w) - 4, 1) + 1),
                                                  lambda i: array_to_string(w[i:i + 4], ' '))) AS s
    FROM w WHERE len(w) > 0),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS (
    SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS o
    FROM s a JOIN s b ON a.s = b.s AND a.doc_id <> b.doc_id GROUP BY ALL),
e AS (
    SELECT x, y FROM o JOIN n p ON p.doc_id = x JOIN n q ON q.doc_id = y
    WHERE 100 * o >= 80 * (p.n + q.n - o)),
r AS (SELECT x, y FROM e UNION SELECT r.x, e.y FROM r JOIN e ON r.y = e.x),
g AS (SELECT doc_id, s, min(doc_id) OVER (PARTITION BY f) AS class_id
      FROM (SELECT doc_id, 0 AS s, list_sort(list(s)) AS f FROM s GROUP BY doc_id)),
d AS (SELECT x, count(*) AS links FROM e GROUP BY x)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(w.doc_id, (SELECT min(y) FROM r WHERE r.x = w.doc_id)) AS component_id,
       coalesce(g.class_id, w.doc_id) AS class_id, CAST(coalesce(d.links, 0) AS BIGINT) AS n_links
FROM w LEFT JOIN n USING (doc_id) LEFT JOIN g USING (doc_id) LEFT JOIN d ON d.x = w.doc_id""")
def op1_jaccard_join(spark, sf_dir):
    """The near-duplicate component of every document."""
    return jaccard_join.similarity_classes(read(spark, sf_dir, "documents"))


@query("op3_passages")
def op3_passages(spark, sf_dir):
    """Passages of fifty words or more that repeat a document of a smaller doc_id."""
    return passages.repeated_passages(read(spark, sf_dir, "documents"))
