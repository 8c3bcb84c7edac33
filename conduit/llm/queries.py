"""The queries of this subpackage and, where SQL can say the same, their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from conduit.llm import (
    alignment,
    merkle,
    neighbours,
    packing,
    pii,
    recompress,
    resampling,
    sentencepieces,
    simhash,
    sitetree,
    tokencounts,
    toxicity,
    wordids,
)
from conduit.llm.common import table


def op1_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded and decoded again."""
    return sentencepieces.round_trips(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


def op2_pack_sequences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents' tokens in sequences of 2048."""
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of all documents, learnt from the labels that are not held out."""
    return toxicity.toxicity(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_simhash_near_copies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints and components of all documents."""
    return simhash.near_copies(table(spark, sf_dir, "documents"))


def op5_nearest_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten nearest of every hundredth embedding."""
    return neighbours.nearest(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data of all documents."""
    return pii.personal_data(table(spark, sf_dir, "documents"))


def op7_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of all pages."""
    return sitetree.main_text(table(spark, sf_dir, "pages"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of all documents before and after edits drawn from their own texts."""
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return tokencounts.counted(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


def op9_document_prints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of all documents and of their edited texts."""
    return merkle.document_prints(table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of all documents that a smaller doc_id's windows cover, removed."""
    return recompress.without_repeats(table(spark, sf_dir, "documents"))


def op11_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of two tokenizers aligned over all documents."""
    a, b = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return alignment.aligned(table(spark, sf_dir, "documents"), a, b)


def op12_resampled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Five in a hundred of all documents, drawn towards the benchmark's texts."""
    return resampling.resampled(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents encoded by a multilingual vocabulary and decoded again."""
    ranks = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    return wordids.digests(table(spark, sf_dir, "documents"), ranks, public_tokenizers.PATTERN)


QUERIES = {
    f.__name__: f
    for f in (
        op1_sentence_pieces,
        op2_pack_sequences,
        op3_toxicity,
        op4_simhash_near_copies,
        op5_nearest_vectors,
        op6_personal_data,
        op7_main_text,
        op8_token_counts,
        op9_document_prints,
        op10_substring_dedup,
        op11_alignment,
        op12_resampled,
        op13_byte_pairs,
    )
}

def _crc_table() -> list[int]:
    """The table of CRC-32 by bytes, from its polynomial."""
    table = []
    for byte in range(256):
        for _ in range(8):
            byte = (byte >> 1) ^ (0xEDB88320 if byte & 1 else 0)
        table.append(byte)
    return table


def _words_sql(name: str, more: str = "") -> str:
    """``w``: the words of every text of a table; ``g``: its runs of one to three of them."""
    lower = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    return rf"""
{name}_words AS (SELECT {more} regexp_extract_all({lower}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM {name}),
{name}_runs AS (SELECT {more} array_to_string(list_slice(w, p, p + k - 1), ' ') AS g
      FROM (SELECT {more} w, k, unnest(range(1, len(w) - k + 2)) AS p FROM {name}_words, range(1, 4) t(k)))"""


ORACLES = {
    "op12_resampled": rf"""
WITH {_words_sql("documents", "doc_id,")}, {_words_sql("benchmark")},
hashed AS (SELECT g, xor(list_reduce(list_prepend(4294967295::BIGINT,
               list_transform(range(1, len(x), 2), lambda i: ('0x' || substr(x, i, 2))::BIGINT)),
               lambda a, y: xor(a >> 8, ({_crc_table()})[(xor(a, y) & 255) + 1])), 4294967295) % 10000 AS bucket
           FROM (SELECT g, hex(encode(g)) AS x FROM (SELECT g FROM documents_runs UNION SELECT g FROM benchmark_runs))),
source AS (SELECT bucket, count(*) AS s FROM documents_runs JOIN hashed USING (g) GROUP BY bucket),
target AS (SELECT bucket, count(*) AS t FROM benchmark_runs JOIN hashed USING (g) GROUP BY bucket),
totals AS (SELECT (SELECT count(*) FROM documents_runs) AS s_all, (SELECT count(*) FROM benchmark_runs) AS t_all),
gains AS (SELECT bucket, floor(1000 * ln((coalesce(t, 0) + 1)::DOUBLE * (s_all + 10000)::DOUBLE
               / ((s + 1)::DOUBLE * (t_all + 10000)::DOUBLE)))::BIGINT AS gain
          FROM source LEFT JOIN target USING (bucket), totals),
weights AS (SELECT doc_id, count(*) AS n, sum(gain)::BIGINT AS weight
            FROM documents_runs JOIN hashed USING (g) JOIN gains USING (bucket) GROUP BY doc_id),
scores AS (SELECT doc_id, len(w) >= 20 AS free, coalesce(n, 0)::BIGINT AS n_features, coalesce(weight, 0)::BIGINT AS weight,
             coalesce(weight, 0)::BIGINT + floor(-1000 * ln(-ln((('0x' || substr(sha256('42:' || doc_id), 1, 8))::BIGINT + 0.5::DOUBLE)
               / 4294967296::DOUBLE)))::BIGINT AS score
           FROM documents_words LEFT JOIN weights USING (doc_id)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY free ORDER BY score DESC, doc_id) AS place,
             5 * count(*) FILTER (free) OVER () // 100 AS drawn FROM scores)
SELECT doc_id, n_features, weight, score, CASE WHEN free AND place <= drawn THEN place END AS rank FROM ranked
""",
    "op10_substring_dedup": r"""
WITH d AS (SELECT doc_id,
             list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
           FROM documents),
w AS (SELECT doc_id, p, list_slice(w, p, p + 12) AS g
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS p FROM d WHERE len(w) >= 13)),
f AS (SELECT g, min(doc_id) AS first FROM w GROUP BY g HAVING min(doc_id) < max(doc_id)),
c AS (SELECT DISTINCT doc_id, unnest(range(p, p + 13)) AS k FROM w JOIN f USING (g) WHERE doc_id > first),
k AS (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS k FROM d),
t AS (SELECT k.doc_id, string_agg(k.word, ' ' ORDER BY k.k) FILTER (WHERE c.k IS NULL) AS kept,
        count(*) AS n_words, count(c.k) AS n_removed
      FROM k LEFT JOIN c ON k.doc_id = c.doc_id AND k.k = c.k GROUP BY k.doc_id)
SELECT d.doc_id, coalesce(n_words, 0)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN t USING (doc_id)
"""
}
