"""Personal data against the patterns as Python's regular expressions read them."""

import math
import random
import re

from pyspark.sql import functions as F

from tablework.llm import queries, sanitize as module
from tablework.llm.sanitize import KINDS, base_spans, sanitize

PATTERNS = [
    r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    r"[0-9]([\x20-]?[0-9])+",
    r"\+[0-9][\x20().0-9-]+[0-9]",
]


def luhn(digits):
    total = 0
    for i, digit in enumerate(map(int, reversed(digits))):
        total += digit if i % 2 == 0 else digit * 2 - 9 if digit > 4 else digit * 2
    return total % 10 == 0


def expected(text):
    found = []
    for kind, pattern in enumerate(PATTERNS):
        for match in re.finditer(pattern, text or ""):
            value = match.group()
            digits = re.sub("[^0-9]", "", value)
            if (
                kind == 0
                or (kind == 1 and all(int(part) <= 255 for part in value.split(".")))
                or (kind == 2 and 12 <= len(digits) <= 19 and luhn(digits))
                or (kind == 3 and 9 <= len(digits) <= 15)
            ):
                found.append((match.start(), kind, match.end(), value))
    return sorted(found)


def test_base_spans(spark):
    texts = [
        "", "a@b.c_x@y.org", "a@b..c a@b.c.d. a@b", "1.2.3.4.5.6.7.8 256.1.1.1 000255.1.1.1",
        "4111 1111 1111 1111 4111-1111-1111-1111 4111  1111", "+1 (654) 555-4136 +123 ++1 234 567 890)",
        "x" * 50_000 + "@", "1 2 " * 5000, "a.b." * 5000 + "@x.y", "1" * 20_000, "a@b." + "c." * 5000 + "d",
        "a@b.co " * 300, "😀 é a@b.de \u0001 1\u00012 1.1.1.1",
    ]
    pick = random.Random(2)
    for letters in ("ab1 2.@-+_%()\n 4\u0001é😀", "0123456789 .-+("):
        texts += ["".join(pick.choice(letters) for _ in range(pick.randint(1, 80))) for _ in range(600)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(8)
    rows = df.select("id", base_spans(F.col("text")).alias("spans")).collect()
    got = {row["id"]: [(s["start"], s["kind"], s["stop"], s["value"]) for s in row["spans"]] for row in rows}
    assert [got[i] for i in range(len(texts))] == [expected(text) for text in texts]


def test_terms_that_give_an_entity_away(spark):
    rows = [
        (1, "Write to Wendelgard about it: w.k@corp.example.org today"),
        (2, "Again Wendelgard sent from w.k@corp.example.org the thing"),
        (3, "The thing about it today, sent again to nobody"),
        (4, "Nothing here either, write about today"),
        (5, "Only once beside Solitary: other@corp.example.org here"),
    ]
    found = {row["doc_id"]: row for row in sanitize(spark.createDataFrame(rows, "doc_id long, text string")).collect()}

    def terms(doc_id):
        return [span["value"] for span in found[doc_id]["spans"] if KINDS[span["kind"]] == "term"]

    assert [terms(i) for i in range(1, 6)] == [["Wendelgard"], ["Wendelgard"], [], [], []]
    assert found[1]["clean"] == "Write to  about it: [email] today"
    assert found[3]["clean"] == rows[2][1]


def test_a_lower_threshold_generalises(spark):
    rows = [(i, f"Amadeus wrote from a{0}@b.org now") for i in range(9)] + [(9, "Amadeus is here")]
    rows += [(i, f"text number {i}") for i in range(10, 30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    strict = sanitize(docs).where("doc_id = 9").first()
    loose = sanitize(docs, alpha=1.5).where("doc_id = 9").first()
    assert strict["clean"] == "Amadeus is here" and loose["clean"] == "[term] is here"


def test_odd_rows(odd_docs, keeps_columns, odd_rows):
    result = sanitize(odd_docs)
    keeps_columns(odd_docs, result, "spans", "clean")
    rows = result.select("doc_id", "text", "spans", "clean").collect()
    assert len(rows) == len(odd_rows)
    for row in rows:
        base = [tuple(span) for span in row["spans"] if span["kind"] < 4]
        assert base == expected(row["text"])


def test_no_rows(no_docs):
    assert sanitize(no_docs).count() == 0


def test_terms_count_by_document_not_by_distance(spark):
    """A header and a signature far apart hold both; beside each other only proposes the pair."""
    far = " and so on with words that stand everywhere in every text" * 4
    rows = [
        (1, f"Wendelgard: w.k@corp.example.org{far}"),
        (2, f"Wendelgard asked{far} w.k@corp.example.org"),
        (2, f"Wendelgard asked{far} w.k@corp.example.org"),
        (3, f"Nothing{far}"),
        (4, f"Nothing, again{far}"),
    ]
    found = sanitize(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    for row in found:
        terms = [span["value"] for span in row["spans"] if KINDS[span["kind"]] == "term"]
        assert terms == (["Wendelgard"] if row["doc_id"] < 3 else []), row["doc_id"]


def test_query_finds_short_names_and_nearly_certain_ones(spark, tmp_path):
    """Of names in every document of an address, one of two letters and one that strays once."""
    rows = [(i, f"Li and Amadeus wrote from a{0}@b.org, number {i} of them") for i in range(40)]
    rows += [(40, "Amadeus is here, number 40 of them")]
    rows += [(i, f"text number {i} of them") for i in range(41, 200)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    found = {row["doc_id"]: row["spans"] for row in queries.op6_personal_data(spark, str(tmp_path)).collect()}
    for i in range(40):
        assert "term:0:2" in found[i] and "term:7:14" in found[i]
    assert found[40] == "term:0:7"
    assert all(found[i] == "" for i in range(41, 200))


def test_chance_is_no_disclosure(spark):
    """Two of three documents with a word, among six, are not significant; all of two are certain."""
    rows = [(1, "Straying Certain a@b.org"), (2, "Straying Certain a@b.org"), (3, "Straying"), (4, "x"), (5, "y"), (6, "z")]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    clean = {row["doc_id"]: row["clean"] for row in sanitize(docs, alpha=2.0).collect()}
    assert clean[1] == "Straying  [email]" and clean[3] == "Straying"


def test_terms_are_broadcast_up_to_a_number_of_rows_and_of_bytes(spark, monkeypatch):
    held = spark.createDataFrame([(i, term) for i in range(3) for term in ("ab", "é" * 20, "c")], "id long, term string")
    pairs = spark.createDataFrame([("x", "ab"), ("y", "é" * 20), ("z", "ab")], "entity string, term string")

    def joined():
        found = module.among(held, pairs)
        assert sorted(row["term"] for row in found.collect()) == ["ab"] * 3 + ["é" * 20] * 3
        return "strategy=broadcast" in found._jdf.queryExecution().analyzed().toString()

    monkeypatch.setattr(module, "BROADCAST_BYTES", 42)
    assert joined()
    monkeypatch.setattr(module, "BROADCAST_BYTES", 41)
    assert not joined()
    monkeypatch.setattr(module, "BROADCAST_BYTES", 42)
    monkeypatch.setattr(module, "BROADCAST_TERMS", 1)
    assert not joined()
    assert module.among(held, pairs.limit(0)).count() == 0


def test_query_finds_terms_far_from_an_entity(spark, tmp_path):
    """The name never stands near the address, in none of the documents."""
    far = " and so on with words that stand everywhere in every text" * 40
    rows = [(i, f"Wendelgard asked{far} w.k@corp.example.org") for i in range(3)]
    rows += [(i, f"Nobody asked{far}") for i in range(3, 8)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for row in queries.op6_personal_data(spark, str(tmp_path)).collect():
        assert ("term:0:10" in row["spans"]) == (row["doc_id"] < 3), row["doc_id"]


def test_pairs_against_plain_counting(spark):
    """Texts with copies, words within addresses, and several entities, at a lenient threshold."""
    dice = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["ann", "bob"]
    mails = ["ann@x.org", "bob@y.org", "kim@z.org"]
    texts = []
    for _ in range(60):
        chosen = dice.choices(words, k=dice.randrange(2, 12)) + dice.sample(mails, dice.choice([0, 0, 1, 2]))
        texts += [" ".join(chosen)] * dice.choice([1, 1, 1, 3])
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(4)
    alpha, n = 1.4, len(texts)
    held = [set(re.findall(r"[a-z0-9]+", text)) for text in texts]
    expected = {}
    for mail in mails:
        having = [i for i, text in enumerate(texts) if mail in text.split()]
        outside = {word for i in having for word in texts[i].split() if "@" not in word}
        for word in outside:
            n_both, n_term = sum(word in held[i] for i in having), sum(word in own for own in held)
            pmi = math.log2(n_both * n / (n_term * len(having)))
            if n_both < 2 or pmi < math.log2(n / len(having)) / alpha - 1e-9:
                continue
            expected.setdefault(word, []).append((n_both, n_term, len(having)))

    def significant(n_both, n_term, n_entity):
        part = lambda seen, chance: seen * math.log(seen / chance) if seen else 0.0
        return n_both * n > n_term * n_entity and 2 * (
            part(n_both, n_term * n_entity / n)
            + part(n_term - n_both, n_term * (n - n_entity) / n)
            + part(n_entity - n_both, (n - n_term) * n_entity / n)
            + part(n - n_term - n_entity + n_both, (n - n_term) * (n - n_entity) / n)
        ) >= module.SIGNIFICANT

    expected = {
        word for word, pairs in expected.items()
        if any(pair[0] >= pair[1] or significant(*pair) for pair in pairs)
    }
    assert expected
    for row in sanitize(docs, alpha=alpha, reach=None).collect():
        terms = {span["value"] for span in row["spans"] if KINDS[span["kind"]] == "term"}
        outside = {word for word in row["text"].split() if "@" not in word}
        assert terms == outside & expected, row["doc_id"]
