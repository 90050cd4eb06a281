"""The registered queries of the corpus operators and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .ball_tree import ranked_search
from .chunk_fingerprint import chunk_fingerprints
from .decontam import contamination
from .html_template import extract_main_text
from .minhash import near_duplicates
from .packing import pack_documents
from .passages import repeated_passages
from .pii import personal_data
from .piece_table import encode_documents
from .secret_scan import scan_secrets
from .tables import table
from .token_alignment import align_tokens
from .toxicity import toxicity
from .url_markov import judge_urls


def op1_url_language_models(spark: SparkSession, folder: str) -> DataFrame:
    return judge_urls(table(spark, folder, "pages"))


def op2_template_extraction(spark: SparkSession, folder: str) -> DataFrame:
    return extract_main_text(table(spark, folder, "pages"))


def op3_chunk_fingerprints(spark: SparkSession, folder: str) -> DataFrame:
    return chunk_fingerprints(table(spark, folder, "documents"))


def op4_token_efficiency_secrets(spark: SparkSession, folder: str) -> DataFrame:
    return scan_secrets(table(spark, folder, "documents"))


def op5_vector_bin_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(table(spark, folder, "documents"))


def op6_toxic_segments(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity(table(spark, folder, "documents"), table(spark, folder, "labels"))


def op7_contextual_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    return personal_data(table(spark, folder, "documents"))


def op8_circulant_minhash(spark: SparkSession, folder: str) -> DataFrame:
    return near_duplicates(table(spark, folder, "documents"))


def op9_suffix_array_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    found = contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def op10_compact_window_passages(spark: SparkSession, folder: str) -> DataFrame:
    return repeated_passages(table(spark, folder, "documents"))


def op11_cross_tokenizer_alignment(spark: SparkSession, folder: str) -> DataFrame:
    return align_tokens(table(spark, folder, "documents"))


def op12_ball_tree_search(spark: SparkSession, folder: str) -> DataFrame:
    return ranked_search(table(spark, folder, "documents"), table(spark, folder, "benchmark"))


def op13_distinct_chunk_pieces(spark: SparkSession, folder: str) -> DataFrame:
    found = encode_documents(table(spark, folder, "documents"), with_text=True)
    return found.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join("ids", ","), 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )


QUERIES = {
    "op1_url_language_models": op1_url_language_models,
    "op2_template_extraction": op2_template_extraction,
    "op3_chunk_fingerprints": op3_chunk_fingerprints,
    "op4_token_efficiency_secrets": op4_token_efficiency_secrets,
    "op5_vector_bin_packing": op5_vector_bin_packing,
    "op6_toxic_segments": op6_toxic_segments,
    "op7_contextual_personal_data": op7_contextual_personal_data,
    "op8_circulant_minhash": op8_circulant_minhash,
    "op9_suffix_array_decontamination": op9_suffix_array_decontamination,
    "op10_compact_window_passages": op10_compact_window_passages,
    "op11_cross_tokenizer_alignment": op11_cross_tokenizer_alignment,
    "op12_ball_tree_search": op12_ball_tree_search,
    "op13_distinct_chunk_pieces": op13_distinct_chunk_pieces,
}
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

_NEAR_DUPLICATES = f"""
WITH RECURSIVE d AS (
  SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 4], ' ') AS g
  FROM d, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS t(i) WHERE len(w) > 0
), sizes AS (
  SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS n
  FROM shingles x JOIN shingles y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b
  WHERE 100 * shared.n >= 85 * (p.n + q.n - shared.n)
), reach AS (
  SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a
), least_id AS (
  SELECT a, min(b) AS b FROM reach GROUP BY a
)
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(b, d.doc_id)) AS component_id,
       d.doc_id = least(d.doc_id, coalesce(b, d.doc_id)) AS kept
FROM d LEFT JOIN sizes ON sizes.doc_id = d.doc_id LEFT JOIN least_id ON least_id.a = d.doc_id
"""

_WORDS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"

_CONTAMINATION = f"""
WITH items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark WHERE item_id IS NOT NULL
), windows AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + least(len(w), 10) - 1], ' ') AS g
  FROM items, unnest(range(1, len(w) - least(len(w), 10) + 2)) AS t(i) WHERE len(w) > 0
), d AS (
  SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents
), places AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS g
  FROM d JOIN (SELECT DISTINCT n FROM windows) ON len(w) >= n, unnest(range(1, len(w) - n + 2)) AS t(i)
), found AS (
  SELECT r, i, places.n, item FROM places JOIN windows ON windows.n = places.n AND windows.g = places.g
), hits AS (
  SELECT r, count(DISTINCT k) AS n FROM found, unnest(range(i, i + n)) AS t(k) GROUP BY r
), listed AS (
  SELECT r, count(*) AS n, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM found) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(hits.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(listed.n, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
       coalesce(hits.n, 0) > 0 AS contaminated
FROM d LEFT JOIN hits ON hits.r = d.r LEFT JOIN listed ON listed.r = d.r
"""

_TERMS = f"regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

_RANKED = f"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents
), corpus AS (
  SELECT count(*) AS docs, CAST(sum(len(w)) AS BIGINT) AS terms FROM d WHERE len(w) > 0
), times AS (
  SELECT r, doc_id, CAST(len(w) AS BIGINT) AS n, t, count(*) AS tf FROM (SELECT r, doc_id, w, unnest(w) AS t FROM d) GROUP BY ALL
), items AS (
  SELECT item_id, unnest(list_distinct({_TERMS})) AS t FROM benchmark
), held AS (
  SELECT t, count(*) AS df FROM times WHERE t IN (SELECT t FROM items) GROUP BY t
), weights AS (
  SELECT t, CAST(floor(1000 * ln(CAST(2 * docs + 2 AS DOUBLE) / (2 * df + 1))) AS BIGINT) AS w FROM held, corpus
), scores AS (
  SELECT item_id, r, doc_id,
         CAST(sum(weights.w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // terms)))) AS BIGINT) AS score
  FROM items JOIN weights USING (t) JOIN times USING (t), corpus GROUP BY item_id, r, doc_id
), ranked AS (
  SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank
  FROM scores WHERE score > 0
)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM ranked WHERE rank <= 10
"""

#: The other queries return what tokenizers, learned scores or chunk hashes make; tests hold them
#: against brute force.
SQL: dict[str, str] = {
    "op8_circulant_minhash": _NEAR_DUPLICATES,
    "op9_suffix_array_decontamination": _CONTAMINATION,
    "op12_ball_tree_search": _RANKED,
}
