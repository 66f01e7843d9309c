from __future__ import annotations

import pytest
from pyspark.sql import functions as F

#: Names the operators use themselves, as extra columns of the input.
CLASHING = (
    "_row id key lines dropped n_lines n_dropped position digest first_id rate draw draws copy "
    "order_key terms u spans clean base masked term token_ids n_tokens decoded code component_id "
    "root node held_out lang_pred score judged log_prob mean_log_prob kept n_bytes n_removed "
    "n_spans k1 k2 starts stops data name"
).split()


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, blanks, long texts, repeated rows and equal texts: (id, text, lang, source)."""
    shared = "The line that several documents hold."
    long = "\n".join(f"number {i} of many lines, +1 555 {i:07d}" for i in range(3000))
    return [
        (0, f"The first of them.\n{shared}\nEnd.", "en", "a"),
        (1, f"  {shared.upper()} \nsomething of its own here", "en", "a"),
        (2, None, "en", "b"),
        (3, "", "de", None),
        (4, " \t\n", None, "b"),
        (5, "12345 !!! 67890", "en", "c"),
        (6, long, "en", "a"),
        (7, long + "\nand one more line", "en", "a"),
        (8, "twice the same row", "en", "b"),
        (8, "twice the same row", "en", "b"),
        (9, "x" * 150_000, None, None),
        (None, "a row without an id and of its own", "en", "a"),
        (None, f"{shared}", None, "a"),
        (10, "née Ünal 日本語 😀 \u0000 ▁ mail a.b@c-d.org, 10.0.0.256 and 10.0.0.255", "fr", "c"),
        (11, "Das ist ein kurzer Text über die Sprache und ihre Wörter.", "de", "b"),
        (12, "twice the same row", "en", "c"),
    ]


@pytest.fixture(scope="session")
def odd_docs(spark, odd_rows):
    schema = "doc_id long, text string, lang string, source string"
    docs = spark.createDataFrame(odd_rows, schema).repartition(3)
    return docs.withColumn("n_chars", F.char_length("text").cast("long")).withColumns(
        {name: F.lit("clash") for name in CLASHING}
    )


@pytest.fixture(scope="session")
def no_docs(odd_docs):
    return odd_docs.limit(0)


@pytest.fixture(scope="session")
def given_docs(spark, sf_dir):
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


@pytest.fixture(scope="session")
def keeps_columns():
    def check(before, after, *results):
        names = [name for name in before.columns if name in after.columns]
        assert after.columns[: len(names)] == names
        assert len(set(after.columns)) == len(after.columns)
        assert set(results) <= set(after.columns)

    return check
