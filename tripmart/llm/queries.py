"""The registered queries of this subpackage: each operator over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from tripmart.config import use_utc
from tripmart.llm import (
    class_model,
    conversation_trie,
    language,
    lexical_search,
    near_vectors,
    ngram_join,
    packing,
    secrets,
    sharding,
    surrogates,
    tiling,
    token_counts,
    toxicity,
)
from tripmart.llm.common import is_held_out, ready, table


def op1_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"))
    # the checksum stands for the ids, so that packing moves lengths and not ids
    slim = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.pack(slim)


def op2_line_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.section_tokens(table(spark, sf_dir, "documents"))


def op3_tiled_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = tiling.find_passages(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "item_id", "item_words", "matched_words", "coverage", F.size("tiles").alias("n_tiles")
    )


def op4_signature_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.ngram_components(table(spark, sf_dir, "documents"), width=3, num=90, den=100)


def op5_minimax_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = sharding.shard_documents(table(spark, sf_dir, "documents"))
    return placed.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op6_sentence_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.score(docs, model).select(
        "doc_id", is_held_out("doc_id", 5, 0).alias("held_out"), "score", "predicted",
        F.size("offending").alias("n_offending"),
    )


def op7_byte_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labelled = language.label(docs, language.train(docs))
    return labelled.select("doc_id", is_held_out("doc_id", 3, 1).alias("held_out"), "lang_pred", "score")


def op8_trigram_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_digest(secrets.find_secrets(table(spark, sf_dir, "documents")))


def op9_lattice_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op10_surrogate_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    clean = surrogates.replace_personal_data(docs, key="example key", found_col="found")
    return clean.select(
        "doc_id",
        "text",
        F.size("found").alias("n_entities"),
        F.array_join(F.transform("found", lambda e: e["kind"]), ",").alias("kinds"),
    )


def op11_max_sketch_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("item_id", "rank", "doc_id", "score")


def op12_class_ngrams(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held_out = is_held_out("doc_id", 7, 2)
    scored = class_model.score(docs, class_model.train(docs.where(~held_out)))
    return scored.select(
        "doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score",
        "perplexity",
    )


def op13_truncated_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_trie.conversation_trie(table(spark, sf_dir, "conversations"))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    return corpus_pipeline.run(spark, sf_dir)


QUERIES = {
    name: (lambda spark, sf_dir, query=query: query(use_utc(ready(spark)), sf_dir))
    for name, query in list(globals().items())
    if callable(query) and (name.startswith("op") or name == "pipeline")
}

# the checksum of an id's digits, bit by bit, since the SQL has no function for it
_CRC32 = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT,
  list_transform(string_split(conv_id::VARCHAR, ''), lambda d: ascii(d)::BIGINT)), lambda c, d: list_reduce(
  list_prepend(xor(c, d), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
  lambda x, i: xor(x >> 1, CASE WHEN x & 1 = 1 THEN 3988292384::BIGINT ELSE 0::BIGINT END))))"""

_TERMS = r"""regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
  'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"""

ORACLES: dict[str, str] = {
    "op11_max_sketch_search": f"""
    WITH tf AS (SELECT row, doc_id, term, count(*) AS tf
      FROM (SELECT row_number() OVER () AS row, doc_id, unnest({_TERMS}) AS term FROM documents) GROUP BY ALL),
    lengths AS (SELECT row, sum(tf)::BIGINT AS n FROM tf GROUP BY row),
    totals AS (SELECT count(*) AS n_docs, sum(n)::BIGINT AS n_terms FROM lengths),
    weights AS (SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, totals GROUP BY term, n_docs),
    parts AS (SELECT row, 100 - 75 + (75 * n * n_docs) // n_terms AS m FROM lengths, totals),
    wanted AS (SELECT item, item_id, term, count(*) AS times FROM (
        SELECT row_number() OVER () AS item, item_id, unnest({_TERMS}) AS term
        FROM (SELECT DISTINCT item_id, text FROM benchmark)) GROUP BY ALL),
    scores AS (SELECT item, item_id, row, doc_id,
        sum(times * w * ((1000000000 * tf) // (1000 * tf + 8 * m)))::BIGINT AS score
      FROM wanted JOIN weights USING (term) JOIN tf USING (term) JOIN parts USING (row) GROUP BY ALL),
    ranked AS (SELECT *, CAST(row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST) AS INTEGER)
      AS rank FROM scores WHERE score > 0)
    SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 10""",
    "op13_truncated_trie": f"""
    WITH turns AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text
      FROM conversations WHERE conv_id IS NOT NULL),
    own AS (SELECT conv_id, list({{'role': role, 'text': text}}
        ORDER BY turn NULLS FIRST, md5(md5(role) || md5(text))) AS path, {_CRC32} % 9 AS h
      FROM turns GROUP BY conv_id),
    rebuilt AS (SELECT o.conv_id, list_concat(coalesce(b.path, [])[1:o.h], o.path[o.h + 1:]) AS path
      FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
    prefixes AS (SELECT conv_id, d, path[1:d] AS prefix, d = len(path) AS ended
      FROM (SELECT conv_id, path, unnest(range(0, len(path) + 1)) AS d FROM rebuilt)),
    nodes AS (SELECT d, prefix, min(conv_id) AS conv_id, count(*) AS n_convs,
        sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ended), '')) AS ends
      FROM prefixes GROUP BY d, prefix),
    children AS (SELECT d - 1 AS d, prefix[1:d - 1] AS prefix, count(*) AS n FROM nodes WHERE d > 0 GROUP BY 1, 2),
    counted AS (SELECT nodes.*, coalesce(n, 0) AS n_children,
        CASE WHEN d = 0 THEN 0 ELSE (n_convs - 1) * strlen(prefix[d].text) END AS saved
      FROM nodes LEFT JOIN children USING (d, prefix)),
    subtrees AS (SELECT e AS d, prefix[1:e] AS prefix, sum(saved)::BIGINT AS saved_tokens,
        count(*) FILTER (n_children = 0) AS n_leaves
      FROM (SELECT *, unnest(range(0, d + 1)) AS e FROM counted) GROUP BY 1, 2)
    SELECT c.conv_id, c.d AS depth, p.conv_id AS parent_conv_id, c.n_convs, c.n_children, s.n_leaves,
      s.saved_tokens, c.ends AS ends_sha256
    FROM counted c JOIN subtrees s USING (d, prefix)
    LEFT JOIN nodes p ON p.d = c.d - 1 AND p.prefix = c.prefix[1:c.d - 1]""",
}
