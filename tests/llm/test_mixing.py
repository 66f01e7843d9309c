"""Repetitions against draws in Python."""

import hashlib
import math
from collections import Counter

from pyspark.sql import functions as F

from tablework.llm.mixing import mix_sources


def poisson(mean, u):
    p = total = math.exp(-mean)
    k = 0
    while total <= u and k < 200:
        k += 1
        p *= mean / k
        total += p
    return k


def draw(key, number):
    return int(hashlib.md5(f"mix|{key}|{number}".encode()).hexdigest()[:13], 16) / 2**52


def test_counts_invert_the_distribution(given_docs):
    rows = given_docs.select("doc_id", "source").collect()
    sizes = Counter(row["source"] for row in rows)
    weights = {name: math.floor(math.sqrt(n) * 1000) for name, n in sizes.items()}
    rates = {name: w * len(rows) / (sum(weights.values()) * sizes[name]) for name, w in weights.items()}
    expected = {
        row["doc_id"]: poisson(rates[row["source"]], draw(row["doc_id"], 1)) for row in rows
    }
    got = Counter(row["doc_id"] for row in mix_sources(given_docs).collect())
    assert got == Counter({key: n for key, n in expected.items() if n})


def test_large_rates_are_sums_of_draws(spark):
    rare = spark.range(20).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("r").alias("source"))
    many = rare.sparkSession.range(100, 2100).select(
        F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("m").alias("source")
    )
    mixed = mix_sources(rare.unionByName(many), {"r": 1, "m": 1})
    n = mixed.groupBy("source").count().collect()
    counts = {row["source"]: row["count"] for row in n}
    assert abs(counts["r"] - 1010) < 5 * math.sqrt(1010) and abs(counts["m"] - 1010) < 5 * math.sqrt(1010)
    expected = sum(poisson(50.5 / 7, draw(key, i)) for key in range(20) for i in range(1, 8))
    assert counts["r"] == expected
    assert mixed.select("doc_id", "draw", "copy").distinct().count() == mixed.count()


def test_order_is_by_hash_and_stable(given_docs):
    mixed = mix_sources(given_docs).withColumn("part", F.spark_partition_id()).select("part", "order_key")
    parts = {}
    for part, key in mixed.collect():
        parts.setdefault(part, []).append(key)
    assert all(keys == sorted(keys) for keys in parts.values())


def test_odd_rows(odd_docs, keeps_columns):
    mixed = mix_sources(odd_docs, target_rows=2000)
    keeps_columns(odd_docs, mixed, "rate", "draw", "copy", "order_key")
    sources = {row["source"] for row in mixed.select("source").distinct().collect()}
    assert sources == {None, "a", "b", "c"}
    assert 1500 < mixed.count() < 2500
    twice = mixed.where("doc_id = 8").groupBy("draw", "copy").count().collect()
    assert {row["count"] for row in twice} == {2}


def test_unnamed_sources_get_nothing(given_docs, no_docs):
    assert mix_sources(given_docs, {"no such source": 1}).count() == 0
    assert mix_sources(no_docs).count() == 0
