"""The registered queries of the operators, over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pomelo.llm import bpe_tree, chat_template, fim, license_digest, mtree, outlier_rules, packing, prefix_trie, quality_mil, secret_dfa, simhash, toxicity_crf, warc
from pomelo.llm.common import table


def op1_chat_template(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    said = "\\### Assistant: </turn> ok"
    own = spark.createDataFrame([(-7, 0, "user", said), (-7, 1, "assistant", said)], rows.schema)
    return chat_template.report(rows.unionByName(own))


def op2_robust_outliers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outlier_rules.report(table(spark, sf_dir, "documents"))


def op3_secret_automaton(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_dfa.report(table(spark, sf_dir, "documents"))


def op4_attention_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_mil.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_license_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_digest.report(table(spark, sf_dir, "documents"))


def op6_bpe_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe_tree.encode_decode_report(table(spark, sf_dir, "documents"))


def op7_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_crf.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_sum_of_squares_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed(table(spark, sf_dir, "documents"))


def op9_simhash_multi_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.report(table(spark, sf_dir, "documents"))


def op10_mtree_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mtree.top_k(table(spark, sf_dir, "embeddings"), F.col("id") % 100 == 0)


def op11_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.report(table(spark, sf_dir, "conversations"))


def op12_fim_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fim.report(table(spark, sf_dir, "documents"))


def op13_warc_salvage(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.report(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_chat_template": op1_chat_template,
    "op2_robust_outliers": op2_robust_outliers,
    "op3_secret_automaton": op3_secret_automaton,
    "op4_attention_mil": op4_attention_mil,
    "op5_license_digest": op5_license_digest,
    "op6_bpe_tree": op6_bpe_tree,
    "op7_crf_toxicity": op7_crf_toxicity,
    "op8_sum_of_squares_packing": op8_sum_of_squares_packing,
    "op9_simhash_multi_index": op9_simhash_multi_index,
    "op10_mtree_top_k": op10_mtree_top_k,
    "op11_prefix_trie": op11_prefix_trie,
    "op12_fim_rotation": op12_fim_rotation,
    "op13_warc_salvage": op13_warc_salvage,
}

_ESCAPED = ("replace(replace(replace(replace({0}, '\\', '\\\\'), '<turn>', '\\<turn>'), "
            "'<text>', '\\<text>'), '</turn>', '\\</turn>')")

ORACLES: dict[str, str] = {
    "op1_chat_template": f"""
        WITH r AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT -7, 0, 'user', '\\### Assistant: </turn> ok'
            UNION ALL SELECT -7, 1, 'assistant', '\\### Assistant: </turn> ok'),
        c AS (
            SELECT conv_id, count(*) AS n_turns,
                   sha256(string_agg(role || chr(10) || text || chr(10), ''
                                     ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
                   coalesce(string_agg(CASE WHEN role = 'assistant' THEN text END, ''
                                       ORDER BY turn NULLS FIRST, role, text), '') AS loss,
                   sum(length({_ESCAPED.format('role')}) + length({_ESCAPED.format('text')}) + 20) AS size
            FROM r GROUP BY conv_id)
        SELECT conv_id, n_turns, turns_sha256, CAST(length(loss) AS BIGINT) AS loss_chars,
               sha256(loss) AS loss_sha256, CAST(size AS BIGINT) AS formatted_chars FROM c
    """,
    "op2_robust_outliers": outlier_rules.oracle(),
    "op3_secret_automaton": secret_dfa.oracle(),
    "op5_license_digest": license_digest.oracle(),
    "op11_prefix_trie": prefix_trie.oracle(),
    "op12_fim_rotation": fim.oracle(),
    "op13_warc_salvage": warc.oracle(),
    "op10_mtree_top_k": """
        WITH v AS (
            SELECT vec_id, min(list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS BIGINT))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
            GROUP BY vec_id),
        s AS (
            SELECT q.vec_id AS query_id, c.vec_id,
                   CAST(list_sum(list_transform(list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id % 100 = 0 AND q.vec_id <> c.vec_id)
        SELECT query_id, rank, vec_id, score FROM (
            SELECT query_id, vec_id, score,
                   CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
        WHERE rank <= 10
    """,
}
