"""Registered queries of the numbered operators, each over a whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm.conversations import conversation_reports
from tablework.llm.hard_negatives import mine_hard_negatives
from tablework.llm.language_id import identify_languages
from tablework.llm.language_model import score_documents
from tablework.llm.line_dedup import drop_repeated_lines
from tablework.llm.mixing import mix_sources
from tablework.llm.neighbours import approximate_neighbours
from tablework.llm.packing import byte_pair_encoder, pack_documents
from tablework.llm.sanitize import base_only, n_of_kind, rendered, sanitize
from tablework.llm.sentence_pieces import encode_documents
from tablework.llm.simhash import fingerprint_text, near_duplicates
from tablework.llm.suffix_dedup import remove_repeats
from tablework.llm.topk import exact_top_k

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, oracle: str | None = None):
    def register(function):
        QUERIES[name] = function
        if oracle is not None:
            ORACLES[name] = oracle
        return function

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def piece_model_path() -> str:
    """Where the public vocabulary file is installed."""
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


LINES_SQL = """
WITH lines AS (
    SELECT doc_id, n, line, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11)
        || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
    FROM (SELECT doc_id, unnest(parts) AS line, generate_subscripts(parts, 1) AS n
          FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS parts
                FROM documents))),
shared AS (
    SELECT key, min(doc_id) AS first_id FROM lines WHERE length(key) >= 10
    GROUP BY key HAVING count(DISTINCT doc_id) >= 2),
judged AS (
    SELECT l.*, s.first_id IS NOT NULL AND l.doc_id > s.first_id AS dropped
    FROM lines l LEFT JOIN shared s USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
    sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT dropped), ''))
        AS kept_sha256
FROM judged GROUP BY doc_id
"""


@query("op1_line_dedup", LINES_SQL)
def op1_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = drop_repeated_lines(table(spark, sf_dir, "documents"))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("text", 256).alias("kept_sha256"))


MIX_SQL = """
WITH RECURSIVE counts AS (
    SELECT source, count(*) AS n, CAST(floor(sqrt(CAST(count(*) AS DOUBLE)) * 1000) AS BIGINT)
        AS weight
    FROM documents GROUP BY source),
rates AS (
    SELECT source, rate, greatest(1, CAST(ceil(rate / 8.0) AS BIGINT)) AS draws
    FROM (SELECT source, CAST(weight AS DOUBLE) * CAST((SELECT sum(n) FROM counts) AS DOUBLE)
            / (CAST((SELECT sum(weight) FROM counts) AS DOUBLE) * CAST(n AS DOUBLE)) AS rate
          FROM counts)),
terms AS (
    SELECT source, rate / draws AS mean, 0 AS k, exp(-(rate / draws)) AS p,
        exp(-(rate / draws)) AS total
    FROM rates
    UNION ALL
    SELECT source, mean, k + 1, p * mean / (k + 1), total + p * mean / (k + 1)
    FROM terms WHERE k < 64),
drawn AS (
    SELECT d.doc_id, d.text, d.lang, d.source, d.n_chars, r.rate, s.draw
    FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source,
        LATERAL (SELECT unnest(generate_series(1, r.draws)) AS draw) s),
hashed AS (
    SELECT *, CAST('0x' || substr(md5('mix|' || doc_id || '|' || draw), 1, 13) AS BIGINT)
        / 4503599627370496.0 AS u
    FROM drawn),
counted AS (
    SELECT h.*, (SELECT count(*) FROM terms t
                 WHERE t.source IS NOT DISTINCT FROM h.source AND t.total <= h.u) AS copies
    FROM hashed h)
SELECT doc_id, text, lang, source, n_chars, rate, draw, c.copy,
    CAST('0x' || substr(md5('mix|order|' || doc_id || '|' || draw || '|' || c.copy), 1, 13)
        AS BIGINT) AS order_key
FROM counted, LATERAL (SELECT unnest(generate_series(1, copies)) AS copy) c
"""


@query("op2_source_mixing", MIX_SQL)
def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(table(spark, sf_dir, "documents"))


@query("op8_sentence_pieces")
def op8_sentence_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    encoded = encode_documents(
        table(spark, sf_dir, "documents").select("doc_id", "text"), piece_model_path()
    )
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query("op9_simhash")
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = near_duplicates(table(spark, sf_dir, "documents"))
    return found.select(
        "doc_id", fingerprint_text(F.col("code")).alias("fingerprint"), "component_id"
    )


@query("op5_language_id")
def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = identify_languages(table(spark, sf_dir, "documents"), piece_model_path())
    return judged.select("doc_id", "held_out", "lang_pred", "score")


#: Terms of the query may stand without the entity too: in up to ``n_term / n_both = (documents a
#: document with the entity) ** (1 / 11)``.
DISCLOSING_ALPHA = 1.1


@query("op6_personal_data")
def op6_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = sanitize(docs, alpha=DISCLOSING_ALPHA, reach=None)
    spans = F.col("spans")
    return found.select(
        "doc_id",
        *[n_of_kind(spans, kind).alias(f"n_{kind}") for kind in ("email", "ip", "card", "phone")],
        F.sha2(rendered(base_only(spans)), 256).alias("base_sha256"),
        rendered(spans).alias("spans"),
    )


TOP_K_SQL = """
WITH usable AS (
    SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT))
        AS v
    FROM embeddings
    WHERE embedding IS NOT NULL AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT q.vec_id AS query_id, c.vec_id, CAST(list_sum(list_transform(
        list_zip(q.v, c.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
    FROM usable q JOIN usable c ON q.vec_id % 50 = 0 AND c.vec_id <> q.vec_id)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank
      FROM scored)
WHERE rank <= 5
"""


@query("op3_exact_top_k", TOP_K_SQL)
def op3_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(table(spark, sf_dir, "embeddings"))


@query("op10_neighbours")
def op10_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return approximate_neighbours(table(spark, sf_dir, "embeddings"))


@query("op7_language_model")
def op7_language_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = score_documents(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return scored.select("doc_id", "n_tokens", "log_prob", "mean_log_prob")


@query("op4_suffix_dedup")
def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = remove_repeats(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return kept.select(
        "doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256")
    )


def damaged(turns: DataFrame) -> DataFrame:
    """Conversations with planted faults; rows that are not ``present`` are the dropped ones."""
    place = [F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")]
    fate = F.crc32(F.concat(place[0], F.lit(":"), place[1])) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return turns.select(
        "conv_id",
        "turn",
        F.when(fate == 4, "user").otherwise(role).alias("role"),
        F.when(fate == 1, "").when(fate == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text)
        .alias("text"),
        (fate != 0).alias("present"),
        F.explode(F.when(fate == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1))))
        .alias("copy"),
    )


@query("op11_conversation_repair")
def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_reports(
        damaged(table(spark, sf_dir, "conversations")), present_col="present"
    )


#: The id that ends a document in packed sequences.
END_OF_DOCUMENT = 1


def byte_pair_ids():
    """What makes the encoder of the public byte-level vocabulary, in the task that uses it.

    Its file of ranks gives the ids of the tokenizers library's file, several times as fast.
    """
    import public_tokenizers

    path, pattern = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
    return lambda: byte_pair_encoder(path, pattern, "<|endoftext|>")


@query("op12_packing")
def op12_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = pack_documents(
        table(spark, sf_dir, "documents"), byte_pair_ids(), END_OF_DOCUMENT
    )
    return packed.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


NEGATIVES_SQL = """
WITH usable AS (
    SELECT row_number() OVER () AS place, vec_id, len(embedding) AS size,
        CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
        list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
    FROM embeddings
    WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
        AND len(embedding) > 0
        AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
    SELECT a.place AS anchor, a.vec_id AS anchor_id, c.place, c.vec_id, a.label = c.label AS same,
        CAST(list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2])) AS BIGINT)
            AS score
    FROM usable a JOIN usable c ON a.vec_id % 100 = 0 AND c.place <> a.place AND c.size = a.size),
positives AS (
    SELECT anchor, place, vec_id AS positive_id, score AS positive_score
    FROM scored WHERE same
    QUALIFY row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, place) <= 5)
SELECT n.anchor_id, p.positive_id, CAST(row_number() OVER best AS INTEGER) AS rank,
    n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
FROM positives p JOIN scored n ON n.anchor = p.anchor AND NOT n.same
    AND 30 * p.positive_score <= 100 * n.score AND 100 * n.score <= 90 * p.positive_score
WINDOW best AS (PARTITION BY p.anchor, p.place ORDER BY n.score DESC, n.vec_id, n.place)
QUALIFY row_number() OVER best <= 10
"""


@query("op13_hard_negatives", NEGATIVES_SQL)
def op13_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine_hard_negatives(table(spark, sf_dir, "embeddings"), label=moved)
