"""The registered queries of this subpackage: each applies its operator to its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skeinworks.llm import language_id, toxicity
from skeinworks.llm._common import crc_mod
from skeinworks.llm.chat_format import conversation_digests, with_probe
from skeinworks.llm.embedding_dedup import near_duplicates
from skeinworks.llm.fingerprints import edited_fingerprints
from skeinworks.llm.html_extract import main_texts
from skeinworks.llm.jaccard_join import near_duplicate_classes
from skeinworks.llm.packing import pack
from skeinworks.llm.ranked_search import build, search
from skeinworks.llm.token_counts import token_counts
from skeinworks.llm.topk_search import top_k
from skeinworks.llm.vector_codes import compress
from skeinworks.llm.word_bpe import encode_digests
from skeinworks.session import table


def vocabulary(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0, k=5)


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), length=1024)


def op3_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return edited_fingerprints(table(spark, sf_dir, "documents"))


def op4_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicate_classes(table(spark, sf_dir, "documents"), words=3, percent=90)


def op5_bpe_encoding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), vocabulary("word_bpe_49k.json"))


def op6_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), vocabulary("byte_bpe_50k.json"), limit=1024)


def op7_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_digests(with_probe(table(spark, sf_dir, "conversations")), vocabulary("byte_bpe_50k.json"))


def op8_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return main_texts(table(spark, sf_dir, "pages"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"), learn=crc_mod("doc_id", 3) != 1)
    scored = toxicity.toxicity(docs, model)
    return scored.select("doc_id", (crc_mod("doc_id", 3) == 1).alias("held_out"), "score", F.when(F.col("score") >= 0.7, 1).otherwise(0).alias("predicted"))


def op10_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    net = language_id.train(docs, learn=crc_mod("doc_id", 4) != 2)
    found = language_id.identify(docs, net)
    return found.select("doc_id", (crc_mod("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return compress(table(spark, sf_dir, "embeddings"), parts=16, entries=64, rounds=2)


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search(build(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), k=50)


def op13_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"), least=0.98)


QUERIES = {
    "op1_topk_search": op1_topk_search,
    "op2_packing": op2_packing,
    "op3_fingerprints": op3_fingerprints,
    "op4_jaccard_join": op4_jaccard_join,
    "op5_bpe_encoding": op5_bpe_encoding,
    "op6_token_counts": op6_token_counts,
    "op7_chat_format": op7_chat_format,
    "op8_html_extraction": op8_html_extraction,
    "op9_toxicity": op9_toxicity,
    "op10_language_id": op10_language_id,
    "op11_vector_codes": op11_vector_codes,
    "op12_ranked_search": op12_ranked_search,
    "op13_embedding_dedup": op13_embedding_dedup,
}


def _codes_sql(parts: int = 16, entries: int = 64, rounds: int = 2) -> str:
    """The codebooks' rounds written out, each as a nearest-entry join and an update by means."""
    said = f"""
        WITH v AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS x FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (SELECT vec_id, label, p, x[p * (len(x) // {parts}) + 1 : (p + 1) * (len(x) // {parts})] AS x FROM v, range({parts}) t(p)),
        b0 AS (SELECT p, e, x AS c FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM s) WHERE e < {entries}),"""
    for i in range(rounds + 1):
        said += f"""
        d{i} AS (SELECT s.vec_id, s.label, s.p, s.x, b.e, list_sum(list_transform(list_zip(s.x, b.c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS d FROM s JOIN b{i} b ON b.p = s.p),
        n{i} AS (SELECT vec_id, label, p, x, e, d FROM (SELECT *, row_number() OVER (PARTITION BY vec_id, p ORDER BY d, e) AS k FROM d{i}) WHERE k = 1),"""
        if i < rounds:
            said += f"""
        u{i} AS (SELECT p, e, i, CAST(floor(sum(x[i]) / count(*)) AS BIGINT) AS c FROM n{i}, range(1, 1025) t(i) WHERE i <= len(x) GROUP BY p, e, i),
        b{i + 1} AS (
            SELECT b.p, b.e, coalesce(u.c, b.c) AS c FROM b{i} b LEFT JOIN (SELECT p, e, list(c ORDER BY i) AS c FROM u{i} GROUP BY p, e) u ON u.p = b.p AND u.e = b.e),"""
    return said + f"""
        h AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS digest FROM b{rounds}),
        o AS (SELECT vec_id, label, string_agg(printf('%02x', e), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM n{rounds} GROUP BY vec_id, label)
        SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h.digest AS codebooks_sha256 FROM o, h
    """


_CODES = _codes_sql()

#: DuckDB SQL where SQL can express a query.
ORACLES: dict[str, str] = {
    "op1_topk_search": """
        WITH v AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id AS vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON c.vec_id <> q.vec_id WHERE q.vec_id % 50 = 0),
        r AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
    """,
    "op12_ranked_search": """
        WITH d AS (
            SELECT row_number() OVER () AS r, doc_id,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS t
            FROM documents WHERE text IS NOT NULL),
        q AS (
            SELECT row_number() OVER () AS item, item_id,
                   list_distinct(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS t
            FROM benchmark WHERE text IS NOT NULL),
        c AS (SELECT CAST(count(*) AS BIGINT) AS n, CAST(sum(len(t)) AS BIGINT) AS l FROM d WHERE len(t) > 0),
        m AS (SELECT r, doc_id, 50 + (50 * CAST(len(t) AS BIGINT) * c.n) // c.l AS m FROM d, c WHERE len(t) > 0),
        p AS (SELECT r, term, CAST(count(*) AS BIGINT) AS tf FROM (SELECT r, unnest(t) AS term FROM d) GROUP BY ALL),
        w AS (SELECT term, CAST(floor(1000 * ln((2.0::DOUBLE * c.n + 2) / (2.0::DOUBLE * count(*) + 1))) AS BIGINT) AS w FROM p, c GROUP BY term, c.n),
        s AS (
            SELECT item, item_id, doc_id, m.r, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m))) AS BIGINT) AS score
            FROM (SELECT item, item_id, unnest(t) AS term FROM q) JOIN w USING (term) JOIN p USING (term) JOIN m USING (r) GROUP BY ALL),
        k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
        SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 50
    """,
    "op11_vector_codes": _CODES,
    "op13_embedding_dedup": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS e FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
        l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.e, b.e) >= 0.98),
        r AS (SELECT a AS node, a AS other FROM l UNION SELECT r.node, l.b FROM r JOIN l ON l.a = r.other),
        c AS (SELECT node, min(other) AS component_id FROM r GROUP BY node),
        n AS (SELECT a AS node, count(*) AS n_links FROM l GROUP BY a)
        SELECT e.vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, coalesce(component_id, e.vec_id) AS component_id, e.vec_id = coalesce(component_id, e.vec_id) AS kept
        FROM embeddings e LEFT JOIN n ON n.node = e.vec_id LEFT JOIN c ON c.node = e.vec_id
    """,
}
