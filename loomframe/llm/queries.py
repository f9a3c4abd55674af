"""One query per operator over its whole table, with SQL where SQL can state the result."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from loomframe.llm import (
    chat,
    collocations,
    exact_dedup,
    languages,
    neighbour_tree,
    packing,
    pieces,
    quality,
    repeats,
    secret_scan,
    simhash,
    toxicity,
    turn_repair,
)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECKS: dict[str, str] = {}

#: The tokenizers' files; installed under one path on every machine.
WORD_MODEL = public_tokenizers.path("word_bpe_49k.json")
PIECE_MODEL = public_tokenizers.path("piece_bpe_32k.model")


def query(name: str, check: str | None = None):
    def register(function):
        QUERIES[name] = function
        if check is not None:
            CHECKS[name] = check
        return function

    return register


def read(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


@query(
    "op1_exact_dedup",
    r"""
    WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g'))
                 AS text_sha256 FROM documents)
    SELECT doc_id, min(doc_id) OVER (PARTITION BY text_sha256) AS keep_id,
           count(*) OVER (PARTITION BY text_sha256) AS group_size,
           doc_id = min(doc_id) OVER (PARTITION BY text_sha256) AS kept, text_sha256
    FROM t""",
)
def op1(spark: SparkSession, folder: str) -> DataFrame:
    return exact_dedup.dedup_table(read(spark, folder, "documents"))


@query("op2_packing")
def op2(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), WORD_MODEL).drop("ids")


@query("op3_sentencepiece")
def op3(spark: SparkSession, folder: str) -> DataFrame:
    return pieces.encoding_report(read(spark, folder, "documents"), PIECE_MODEL)


@query("op5_secret_scan")
def op5(spark: SparkSession, folder: str) -> DataFrame:
    return secret_scan.secret_report(read(spark, folder, "documents"))


@query("op6_quality_classifier")
def op6(spark: SparkSession, folder: str) -> DataFrame:
    return quality.assess(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query("op8_simhash_near_dedup")
def op8(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents")).select(
        "doc_id", "fingerprint", "component_id"
    )


@query("op9_toxicity")
def op9(spark: SparkSession, folder: str) -> DataFrame:
    return toxicity.assess(read(spark, folder, "documents"), read(spark, folder, "labels"))


@query("op7_nearest_neighbours")
def op7(spark: SparkSession, folder: str) -> DataFrame:
    return neighbour_tree.search(read(spark, folder, "embeddings"), F.col("vec_id") % 50 == 0)


@query("op10_chat_format")
def op10(spark: SparkSession, folder: str) -> DataFrame:
    return chat.parse(read(spark, folder, "conversations"))


@query("op4_suffix_array_dedup")
def op4(spark: SparkSession, folder: str) -> DataFrame:
    return repeats.repeat_report(read(spark, folder, "documents"))


@query(
    "op11_phrase_collocations",
    r"""
    WITH pieces AS (
      SELECT lang, row_number() OVER () AS piece, x FROM (
        SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
          '[.,;:!?\x0A-\x0D]')) AS x
        FROM documents)),
    words AS (
      SELECT lang, piece, unnest(w) AS w, generate_subscripts(w, 1) AS pos
      FROM (SELECT lang, piece, list_filter(regexp_split_to_array(x, '[ \t]+'), lambda v: v <> '') AS w FROM pieces)),
    sizes AS (SELECT lang, count(*) AS n FROM words GROUP BY lang),
    starts AS (
      SELECT lang, w AS w1,
             lead(w, 1) OVER (PARTITION BY piece ORDER BY pos) AS w2,
             lead(w, 2) OVER (PARTITION BY piece ORDER BY pos) AS w3,
             lead(w, 3) OVER (PARTITION BY piece ORDER BY pos) AS w4,
             lead(w, 4) OVER (PARTITION BY piece ORDER BY pos) AS w5
      FROM words),
    f AS (
      SELECT lang, phrase, k, count(*) AS a FROM (
        SELECT lang, w1 AS phrase, 1 AS k FROM starts
        UNION ALL SELECT lang, concat_ws(' ', w1, w2), 2 FROM starts WHERE w2 IS NOT NULL
        UNION ALL SELECT lang, concat_ws(' ', w1, w2, w3), 3 FROM starts WHERE w3 IS NOT NULL
        UNION ALL SELECT lang, concat_ws(' ', w1, w2, w3, w4), 4 FROM starts WHERE w4 IS NOT NULL
        UNION ALL SELECT lang, concat_ws(' ', w1, w2, w3, w4, w5), 5 FROM starts WHERE w5 IS NOT NULL)
      GROUP BY lang, phrase, k HAVING count(*) >= 100),
    candidates AS (SELECT *, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
    kept AS (
      SELECT c.* FROM candidates c WHERE NOT EXISTS (
        SELECT 1 FROM candidates d
        WHERE d.lang = c.lang AND d.k > c.k AND 100 * d.a >= 100 * c.a
          AND contains(' ' || d.phrase || ' ', ' ' || c.phrase || ' '))),
    cuts AS (
      SELECT kept.lang, kept.phrase, kept.a, sizes.n, i, l.a AS l, r.a AS r,
             (1000::HUGEINT * kept.a * sizes.n) // (l.a::HUGEINT * r.a) AS score
      FROM (SELECT *, unnest(range(1, k)) AS i FROM kept) kept
      JOIN sizes ON sizes.lang = kept.lang
      JOIN f l ON l.lang = kept.lang AND l.k = i AND l.phrase = array_to_string(w[1:i], ' ')
      JOIN f r ON r.lang = kept.lang AND r.k = kept.k - i AND r.phrase = array_to_string(w[i + 1:], ' ')),
    best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, i) = 1)
    SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank,
           phrase, a, l, r, n, score::BIGINT AS score
    FROM best QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000""",
)
def op11(spark: SparkSession, folder: str) -> DataFrame:
    return collocations.collocations(read(spark, folder, "documents"))


@query("op12_conversation_repair")
def op12(spark: SparkSession, folder: str) -> DataFrame:
    conversations = read(spark, folder, "conversations")
    return turn_repair.report(conversations, turn_repair.damaged(conversations))


@query("op13_language_id")
def op13(spark: SparkSession, folder: str) -> DataFrame:
    return languages.report(read(spark, folder, "documents"))
