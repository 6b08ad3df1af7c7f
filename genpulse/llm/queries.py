"""The text queries by name, each over its whole table, and the SQL that states the same result."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .byte_bpe import round_trip
from .chat import canonical_turns, format_conversations, read_back
from .common import documents
from .exact_dedup import exact_groups
from .hard_negatives import hard_negatives
from .line_dedup import line_dedup
from .near_dedup import near_duplicates
from .packing import pack
from .pii import personal_data
from .quality_oracle import OP2_SQL
from .quality_rules import COUNTS, quality
from .secrets import find_secrets
from .spelling import spelling_variants
from .streaming_bpe import streaming_round_trip
from .substring_dedup import substring_dedup


def op1_suffix_arrays(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir)).drop("kept")


def op5_cost_balanced_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


def op10_credential_linking(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_secrets(documents(spark, sf_dir))


def op2_weak_supervision(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality(documents(spark, sf_dir)).select("doc_id", *COUNTS, "base_failed", "kept")


def op8_content_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(documents(spark, sf_dir), keep="max")


OP8_SQL = """
SELECT doc_id,
       max(doc_id) OVER g AS keep_id,
       count(*) OVER g AS group_size,
       doc_id = max(doc_id) OVER g AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
WINDOW g AS (PARTITION BY coalesce(text, ''))
"""

def op3_char_bilstm_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = personal_data(documents(spark, sf_dir).select("doc_id", "text"))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans")


def op6_lsh_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(documents(spark, sf_dir))


def op7_recursive_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return round_trip(documents(spark, sf_dir), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)


#: A conversation whose texts hold the control strings of common templates.
CONTROL_TURNS = [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]


def op4_schema_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text")
    rows = rows.unionByName(spark.createDataFrame(CONTROL_TURNS, "conv_id long, turn int, role string, text string"))
    record = F.to_json(F.struct("role", "text"), {"ignoreNullFields": "false"})
    return read_back(format_conversations(canonical_turns(rows.withColumn("record", record), "conv_id", "record", "turn")))


def op9_fuzzy_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir))


OP4_SQL = """
WITH turns AS (
    SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
    UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
    UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
escaped AS (
    SELECT *, regexp_replace(text, '(<|\\[)(\\\\*)(\\|im_start\\|>|\\|im_end\\|>|\\|endoftext\\|>|s>|/s>|INST\\]|/INST\\]|<SYS>>|</SYS>>)', '\\1\\\\\\2\\3', 'g') AS body
    FROM turns)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<|im_start|>') + length(role) + 2 + length(body) + length('<|im_end|>'))::BIGINT AS formatted_chars
FROM escaped GROUP BY conv_id
"""

def op11_quantised_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet").withColumn("label", label)
    return hard_negatives(vectors, F.col("vec_id") % 100 == 0)


OP11_SQL = """
WITH v AS (
    SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
           list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
    FROM embeddings
    WHERE label IS NOT NULL AND embedding IS NOT NULL
      AND coalesce(list_bool_and(list_transform(embedding, lambda x: x IS NOT NULL AND isfinite(x))), true)),
scored AS (
    SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, list_inner_product(a.x, b.x)::BIGINT AS score
    FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
    SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
SELECT anchor_id, positive_id, (row_number() OVER w)::INTEGER AS rank, vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scored USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY rank <= 10
"""


def op12_aho_corasick_halves(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling_variants(documents(spark, sf_dir), one_in=199)


#: The checksum is worked out byte by byte from a table that SQL makes of its polynomial.
OP12_SQL = """
WITH RECURSIVE bytes AS (
    SELECT list(list_reduce([b, 1, 2, 3, 4, 5, 6, 7, 8], lambda c, k: CASE WHEN c % 2 = 1 THEN xor(c >> 1, 3988292384::BIGINT) ELSE c >> 1 END) ORDER BY b) AS made
    FROM range(256) r(b)),
runs AS (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents),
counted AS (SELECT doc_id, run, count(*) AS n FROM runs WHERE length(run) >= 6 GROUP BY ALL),
hashed AS (
    SELECT run, n, xor(4294967295::BIGINT, list_reduce(
        list_prepend(4294967295::BIGINT, list_transform(range(strlen(doc_id || ':' || run)), lambda i: ('0x' || substr(hex(doc_id || ':' || run), 2 * i + 1, 2))::BIGINT)),
        lambda c, b: xor(c >> 8, made[xor(c, b) % 256 + 1]))) AS h
    FROM counted, bytes),
written AS (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM hashed),
words AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM written WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS MATERIALIZED (SELECT word, k, substr(word, 1, k - 1) || substr(word, k + 1) AS cut FROM (SELECT word, unnest(range(1, length(word) + 1)) AS k FROM words)),
near AS (
    SELECT a.word, b.word AS other FROM cuts a JOIN cuts b ON a.k = b.k AND a.cut = b.cut AND a.word <> b.word
    UNION SELECT a.word, b.word FROM cuts a JOIN words b ON a.cut = b.word
    UNION SELECT b.word, a.word FROM cuts a JOIN words b ON a.cut = b.word),
best AS (
    SELECT near.word, count(*) AS n_near, first(o.word ORDER BY o.n DESC, o.word) AS form, max(o.n) AS form_n
    FROM near JOIN words o ON o.word = near.other GROUP BY near.word),
forms AS MATERIALIZED (
    SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN form_n >= 5 * w.n THEN form END AS form, CASE WHEN form_n >= 5 * w.n THEN form_n END AS form_n
    FROM words w LEFT JOIN best USING (word)),
steps AS (
    SELECT word, word AS root FROM forms
    UNION ALL SELECT s.word, f.form FROM steps s JOIN forms f ON f.word = s.root WHERE f.form IS NOT NULL),
ends AS (SELECT s.word, s.root FROM steps s JOIN forms f ON f.word = s.root WHERE f.form IS NULL)
SELECT word, form, root, n, n_near, form_n FROM forms JOIN ends USING (word)
"""


def op13_streaming_transducer(spark: SparkSession, sf_dir: str) -> DataFrame:
    return streaming_round_trip(documents(spark, sf_dir), public_tokenizers.path("word_bpe_49k.json"))


QUERIES = {"op11_quantised_negatives": op11_quantised_negatives, "op12_aho_corasick_halves": op12_aho_corasick_halves, "op13_streaming_transducer": op13_streaming_transducer, "op1_suffix_arrays": op1_suffix_arrays, "op9_fuzzy_lines": op9_fuzzy_lines, "op3_char_bilstm_crf": op3_char_bilstm_crf, "op6_lsh_forest": op6_lsh_forest, "op7_recursive_bpe": op7_recursive_bpe, "op4_schema_fingerprints": op4_schema_fingerprints, "op5_cost_balanced_packing": op5_cost_balanced_packing, "op10_credential_linking": op10_credential_linking, "op2_weak_supervision": op2_weak_supervision, "op8_content_sort": op8_content_sort}
ORACLES = {"op11_quantised_negatives": OP11_SQL, "op12_aho_corasick_halves": OP12_SQL, "op4_schema_fingerprints": OP4_SQL, "op2_weak_supervision": OP2_SQL, "op8_content_sort": OP8_SQL}
