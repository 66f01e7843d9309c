"""The corpus pipeline: documents through five operators, each stage's rows written as Parquet.

Texts without a recognisable language go, lines that several documents share are dropped, one
document of each group of near copies stays, sources are repeated towards their target weights,
and what remains is encoded.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tablework.llm.language_id import UNDETERMINED, identify_languages
from tablework.llm.line_dedup import drop_repeated_lines
from tablework.llm.mixing import mix_sources
from tablework.llm.queries import piece_model_path
from tablework.llm.sentence_pieces import encode_documents
from tablework.llm.simhash import one_of_each_group
from tablework.workspace import checkpointed

#: A text whose likeliest language has a posterior below this is rejected like one without letters.
MIN_LANGUAGE_SCORE = 0.5


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a language; nulls and texts without letters go, all columns stay."""
    judged = identify_languages(docs, piece_model_path())
    clear = (F.col("lang_pred") != UNDETERMINED) & (F.col("score") >= MIN_LANGUAGE_SCORE)
    return judged.where(clear).select(*docs.columns)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, without the lines that a smaller id holds too; ``n_chars`` follows."""
    kept = drop_repeated_lines(docs)
    return kept.withColumn("n_chars", F.char_length("text").cast("long")).select(*docs.columns)


def near_copy_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group whose fingerprints are linked."""
    return one_of_each_group(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated towards their sources' weights, in hash order."""
    return mix_sources(docs).select(*docs.columns)


def encoding_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every remaining row, their number and the text they decode to."""
    encoded = encode_documents(docs, piece_model_path())
    return encoded.select("doc_id", "lang", "source", "token_ids", "n_tokens", "decoded")


STAGES = [
    ("language ID", language_stage),
    ("line dedup", line_stage),
    ("SimHash near-dedup", near_copy_stage),
    ("mixing sources", mixing_stage),
    ("SentencePiece", encoding_stage),
]

#: SQL can't express the fitted language model, the fingerprints or the merges.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``; an empty table gives an empty result."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = checkpointed(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
