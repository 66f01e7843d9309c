"""Find personal data, and terms that give it away, with DataFrame functions only.

Base spans are patterns with checks: e-mail and IP addresses, card and phone numbers. Each
distinct base value is a protected entity. The corpus says how much a term in a document with an entity
tells about it: with the pointwise mutual information PMI(entity; term) and the entity's own
information content IC(entity), a term discloses an entity if PMI >= IC / alpha. A term that also
stands without the entity must besides stand with it more often than chance explains, by a
likelihood-ratio test over all documents. Terms of any length are tested. Disclosing terms are
spans too; those that determine the entity are removed from the clean text, others are
generalised to their kind.

A pattern's matches come without their places. The stretches between matches come from splitting
by the same pattern, and the running lengths of both give the places. Separators that patterns
repeat over are first marked by a character of their own, so that no pattern needs a repeated
group, which Java matches by recursion and which long texts would overflow.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tablework.llm.columns import ROW, packed, unpacked
from tablework.workspace import checkpointed

KINDS = ["email", "ip", "card", "phone", "term"]
MARK, OTHER = "\u0001", "\u0002"
LOCAL = rf"A-Za-z0-9._%+{MARK}-"
LABEL = "A-Za-z0-9-"
#: A match starts where no longer one could, or right behind the match before it.
EMAIL = rf"(?:(?<![{LOCAL}])|\G)[{LOCAL}]++@[{LABEL}]++{MARK}[{LABEL}{MARK}]*+"
IP = r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++"
CARD = rf"[0-9{MARK}]{{2,}}"
PHONE = r"\+[0-9][ ().0-9-]+[0-9]"
INNER_DOT = rf"\.(?<=[{LABEL}]\.)(?=[{LABEL}])"
INNER_GAP = r"[ -](?<=[0-9][ -])(?=[0-9])"
WORD_CHARS = r"\p{L}\p{N}"
TERM = rf"[{WORD_CHARS}]+"

SPAN = "array<struct<start:int,kind:int,stop:int,value:string>>"
#: Code points on either side of an entity in which a term must stand once to be paired with it, unless
#: whole documents are asked for.
REACH = 80
#: Documents that must hold both a term and an entity before the estimate is trusted.
MIN_DOCS = 2
ALPHA = 1.0
#: Likelihood ratio (one degree of freedom, p = 0.001) by which a term that also stands without the
#: entity must differ from chance.
SIGNIFICANT = 10.83
#: Rows and UTF-8 bytes up to which chosen terms are broadcast; beyond either they are
#: joined by shuffle.
BROADCAST_TERMS, BROADCAST_BYTES = 200_000, 16_000_000


def matches(text: Column, pattern: Column, kind: int, original: Column) -> Column:
    """The pattern's matches in ``text`` as spans; values are cut from ``original``."""
    found = F.regexp_extract_all(text, pattern, F.lit(0))
    between = F.split(text, pattern, -1)
    start = F.struct(F.lit(0).alias("at"), F.array().cast(SPAN).alias("spans"))

    def add(acc: Column, pair: Column) -> Column:
        begin = acc["at"] + F.char_length(pair["gap"])
        stop = begin + F.char_length(pair["match"])
        span = F.struct(
            begin.alias("start"),
            F.lit(kind).alias("kind"),
            stop.alias("stop"),
            F.substring(original, begin + 1, stop - begin).alias("value"),
        )
        return F.struct(
            stop.alias("at"), F.concat(acc["spans"], F.array(span)).cast(SPAN).alias("spans")
        )

    pairs = F.zip_with(
        F.slice(between, F.lit(1), F.size(found)),
        found,
        lambda gap, match: F.struct(gap.alias("gap"), match.alias("match")),
    )
    spans = F.aggregate(pairs, start, add, lambda acc: acc["spans"])
    return F.when(F.size(found) > 0, spans).otherwise(F.array().cast(SPAN))


def digits_of(value: Column) -> Column:
    return F.regexp_replace(value, "[^0-9]", "")


def is_ip(value: Column) -> Column:
    def fits(part: Column) -> Column:
        short = F.ltrim(part, F.lit("0"))
        return F.when(
            F.char_length(short) <= 3, F.concat(F.lit("0"), short).cast("int") <= 255
        ).otherwise(False)

    return F.forall(F.split(value, r"\.", -1), fits)


def is_card(value: Column) -> Column:
    digits = F.reverse(digits_of(value))
    size = F.char_length(digits)

    def add(total: Column, i: Column) -> Column:
        digit = F.substring(digits, i + 1, F.lit(1)).cast("int")
        doubled = F.when(digit > 4, digit * 2 - 9).otherwise(digit * 2)
        return total + F.when(i % 2 == 1, doubled).otherwise(digit)

    checksum = F.aggregate(F.sequence(F.lit(0), size - 1), F.lit(0), add)
    return F.when((size >= 12) & (size <= 19), checksum % 10 == 0).otherwise(False)


def is_phone(value: Column) -> Column:
    size = F.char_length(digits_of(value))
    return (size >= 9) & (size <= 15)


def base_spans(text: Column) -> Column:
    """All base spans of a text, by start, then kind."""
    nothing = F.array().cast(SPAN)
    plain = F.translate(text, MARK, OTHER)
    dotted = F.regexp_replace(plain, INNER_DOT, MARK)
    joined = F.regexp_replace(plain, INNER_GAP, MARK)
    digits = text.rlike("[0-9]")
    email = F.when(text.contains("@"), matches(dotted, F.lit(EMAIL), 0, text)).otherwise(nothing)
    ip = F.filter(matches(plain, F.lit(IP), 1, text), lambda span: is_ip(span["value"]))
    card = F.filter(matches(joined, F.lit(CARD), 2, text), lambda span: is_card(span["value"]))
    phone = F.filter(matches(plain, F.lit(PHONE), 3, text), lambda span: is_phone(span["value"]))
    return F.array_sort(
        F.concat(
            email,
            F.when(digits, ip).otherwise(nothing),
            F.when(digits, card).otherwise(nothing),
            F.when(text.contains("+"), phone).otherwise(nothing),
        )
    )


def replaced(text: Column, spans: Column, substitute) -> Column:
    """The text with each span replaced; of overlapping spans the earlier covers its part."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def add(acc: Column, span: Column) -> Column:
        begin, stop = F.greatest(acc["at"], span["start"]), F.greatest(acc["at"], span["stop"])
        before = F.substring(text, acc["at"] + 1, begin - acc["at"])
        return F.struct(
            stop.alias("at"),
            F.concat(acc["out"], before, substitute(span, stop - begin)).alias("out"),
        )

    def finish(acc: Column) -> Column:
        rest = F.substring(text, acc["at"] + 1, F.char_length(text))
        return F.concat(acc["out"], rest)

    return F.when(F.size(spans) > 0, F.aggregate(spans, start, add, finish)).otherwise(text)


def words_of(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit(TERM), F.lit(0)))


def neighbours(masked: Column, span: Column, reach: int) -> Column:
    """The whole terms within reach of a span."""
    first = F.greatest(F.lit(0), span["start"] - reach)
    left = F.substring(masked, first + 1, span["start"] - first)
    right = F.substring(masked, span["stop"] + 1, F.lit(reach))
    left = F.when(first > 0, F.regexp_replace(left, rf"^[{WORD_CHARS}]+", "")).otherwise(left)
    right = F.when(
        F.char_length(right) == reach, F.regexp_replace(right, rf"[{WORD_CHARS}]+$", "")
    ).otherwise(right)
    return words_of(F.concat(left, F.lit(" "), right))


def entity_of(span: Column) -> Column:
    return F.concat_ws(":", span["kind"].cast("string"), F.lower(span["value"]))


def rendered(spans: Column) -> Column:
    names = F.array(*[F.lit(kind) for kind in KINDS])
    return F.array_join(
        F.transform(
            spans,
            lambda span: F.concat_ws(
                ":",
                F.get(names, span["kind"]),
                span["start"].cast("string"),
                span["stop"].cast("string"),
            ),
        ),
        ",",
    )


def disclosing_terms(
    rows: DataFrame, found: DataFrame, n_docs: int, alpha: float, min_docs: int, reach: int | None
) -> DataFrame:
    """``id, text_hash, term, certain`` where terms stand that disclose an entity.

    ``rows`` holds ``id, text`` of every document, ``found`` the spans of those that have any.
    Every term that stands outside the base spans of a document is paired with every entity of the
    document, however far apart; with ``reach`` only pairs stay that somewhere stand within so many
    code points. Whether a pair discloses is counted in documents: those that hold
    the term, the entity, and both, anywhere in the text. Equal texts are paired once, with the number
    of their rows. Terms go before that if too few of their documents hold any entity, and pairs go
    where they are made if they could not reach the threshold even if the rarer one never stood alone.
    """
    copies = checkpointed(
        found.select(
            "text_hash",
            "n_rows",
            F.array_distinct(F.transform("base", entity_of)).alias("entities"),
            "words",
            words_of(F.col("masked")).alias("outside"),
        )
        .groupBy("text_hash")
        .agg(
            F.sum("n_rows").alias("n_rows"),
            *[F.first(name).alias(name) for name in ("entities", "words", "outside")],
        ),
        "entities",
    )
    of_text = copies.select("text_hash", "n_rows", F.explode("entities").alias("entity"))
    entities = (
        of_text.groupBy("entity")
        .agg(F.sum("n_rows").alias("n_entity"))
        .where(F.col("n_entity") >= min_docs)
    )
    held = rows.select(
        "id", F.xxhash64("text").alias("text_hash"), F.explode(words_of(F.col("text"))).alias("term")
    )
    frequency = (
        held.groupBy("term").agg(F.count("*").alias("n_term")).where(F.col("n_term") >= min_docs)
    )
    n = F.lit(float(n_docs))
    content = F.log2(n / F.col("n_entity"))

    def reaches(n_both: Column) -> Column:
        pmi = F.log2(n_both * n / (F.col("n_term") * F.col("n_entity")))
        return (n_both >= min_docs) & (pmi >= content / alpha - 1e-9)

    def placed(words: Column, outside: bool) -> Column:
        return F.transform(words, lambda word: F.struct(word.alias("term"), F.lit(outside).alias("outside")))

    terms = copies.select(
        "text_hash",
        "n_rows",
        F.inline(
            F.concat(
                placed(F.array_intersect("words", "outside"), True),
                placed(F.array_except("words", "outside"), False),
            )
        ),
    )
    # No pair of a term holds it in more documents than those with any entity do, and none of a rarer
    # entity than ``min_docs`` counts.
    rarest = max(min_docs, 1)
    gain = max(0.0, (1 - 1 / alpha) * math.log2(max(n_docs, rarest) / rarest))
    candidates = checkpointed(
        terms.groupBy("term")
        .agg(F.sum("n_rows").alias("n_held"))
        .where(F.col("n_held") >= min_docs)
        .join(frequency, "term")
        .where(F.log2(F.col("n_held") / F.col("n_term")) + gain >= -1e-6),
        "candidates",
    )
    together = (
        among(terms.drop("n_rows"), candidates)
        .join(candidates, "term")
        .join(of_text.join(entities, "entity"), "text_hash")
        .where(reaches(F.least("n_held", "n_entity")))
        .groupBy("entity", "term", "n_term", "n_entity")
        .agg(F.sum("n_rows").alias("n_both"), F.max("outside").alias("outside"))
    )
    together = together.where("outside")
    if reach is not None:
        spans = found.select("masked", F.explode("base").alias("span"))
        near = spans.select(
            entity_of(F.col("span")).alias("entity"),
            F.explode(neighbours(F.col("masked"), F.col("span"), reach)).alias("term"),
        )
        together = together.join(near, ["entity", "term"], "left_semi")
    certain = F.col("n_both") >= F.col("n_term")
    disclosing = checkpointed(
        together.where(reaches(F.col("n_both")) & (certain | (likelihood_ratio(n) >= SIGNIFICANT)))
        .groupBy("term")
        .agg(F.max(certain).alias("certain")),
        "disclosing",
    )
    return among(held, disclosing).join(disclosing, "term").distinct()


def likelihood_ratio(n: Column) -> Column:
    """How far documents with the term and the entity are from chance; 0 if rarer than that."""
    n_both, n_term, n_entity = F.col("n_both"), F.col("n_term"), F.col("n_entity")

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, seen * F.log(seen / expected)).otherwise(0.0)

    total = (
        part(n_both, n_term * n_entity / n)
        + part(n_term - n_both, n_term * (n - n_entity) / n)
        + part(n_entity - n_both, (n - n_term) * n_entity / n)
        + part(n - n_term - n_entity + n_both, (n - n_term) * (n - n_entity) / n)
    )
    return F.when(n_both * n > n_term * n_entity, 2.0 * total).otherwise(0.0)


def among(held: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of ``held`` whose term is in ``pairs``."""
    terms = checkpointed(pairs.select("term").distinct(), "terms")
    size = terms.agg(
        F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("term")), F.lit(0)).alias("bytes")
    ).first()
    if size["n"] <= BROADCAST_TERMS and size["bytes"] <= BROADCAST_BYTES:
        terms = F.broadcast(terms)
    return held.join(terms, "term")


def sanitize(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    alpha: float = ALPHA,
    min_docs: int = MIN_DOCS,
    reach: int | None = REACH,
) -> DataFrame:
    """All columns of ``docs`` with ``spans`` (start, kind, stop, value; by start) and ``clean``.

    Kinds are numbered as in ``KINDS``; places are code points. Null texts count as empty.
    Rows count as documents each, repeated ones too; rows equal in id and text get the same
    result, and a null id is an id. In ``clean`` base spans give way to their kind in
    brackets, disclosing terms that determine an entity are removed and others are replaced by
    ``[term]``. With the strict ``alpha`` of 1 a term is a span only if it never occurs in a
    document without the entity, so documents without personal data stay as they are. A term must
    stand within ``reach`` code points of the entity in one document at least; with None all terms
    of a document are paired with all its entities. Columns named like a result are replaced. An empty table gives an empty one.
    """
    rows = packed(
        docs,
        id=F.col(f"`{id_col}`"),
        text=F.coalesce(F.col(f"`{text_col}`"), F.lit("")),
    )
    blank = lambda span, size: F.repeat(F.lit(" "), size)
    found = checkpointed(
        rows.select("id", "text", base_spans(F.col("text")).alias("base"))
        .where(F.size("base") > 0)
        .select(
            "id",
            F.xxhash64("text").alias("text_hash"),
            "base",
            replaced(F.col("text"), F.col("base"), blank).alias("masked"),
            words_of(F.col("text")).alias("words"),
        )
        .groupBy("id", "text_hash")
        .agg(
            F.count("*").alias("n_rows"),
            F.first("base").alias("base"),
            F.first("masked").alias("masked"),
            F.first("words").alias("words"),
        ),
        "base-spans",
    )
    disclosing = disclosing_terms(
        rows.select("id", "text"), found, docs.count(), alpha, min_docs, reach
    )
    hits = checkpointed(
        disclosing.groupBy(F.col("id").alias("hit_id"), F.col("text_hash").alias("hit_hash")).agg(
            F.array_sort(F.collect_set(F.struct("term", "certain"))).alias("terms")
        ),
        "hits",
    )
    is_hit = F.col("id").eqNullSafe(F.col("hit_id")) & (F.col("text_hash") == F.col("hit_hash"))
    masked = found.select("id", "text_hash", "base", "masked")
    # Written, so that their size is known and they are broadcast to the texts where it is small.
    others = checkpointed(
        hits.join(found, is_hit, "left_anti").select("hit_id", "hit_hash"), "others"
    )
    if not others.isEmpty():  # terms in texts without an entity: these texts are their own mask
        texts = rows.select("id", F.xxhash64("text").alias("text_hash"), "text")
        masked = masked.unionByName(
            texts.join(others, is_hit, "left_semi")
            .dropDuplicates(["id", "text_hash"])
            .select("id", "text_hash", F.array().cast(SPAN).alias("base"), F.col("text").alias("masked"))
        )
    names = F.transform("terms", lambda item: item["term"])
    pattern = F.concat(
        F.lit(f"(?<![{WORD_CHARS}])(?:"), F.array_join(names, "|"), F.lit(f")(?![{WORD_CHARS}])")
    )
    term_spans = matches(F.col("masked"), pattern, 4, F.col("masked"))
    # Spans are found before they meet all rows, so that of these only the id and a hash travel
    # unless the caller asks for more.
    marks = checkpointed(
        masked.join(hits, is_hit, "left").select(
            F.col("id").alias("mark_id"),
            F.col("text_hash").alias("mark_hash"),
            F.when(F.size("terms") > 0, F.array_sort(F.concat("base", term_spans)))
            .otherwise(F.col("base"))
            .alias("spans"),
            F.transform(F.filter("terms", lambda item: item["certain"]), lambda item: item["term"])
            .alias("certain"),
        ),
        "marks",
    )
    marked = rows.withColumn("text_hash", F.xxhash64("text")).join(
        marks,
        F.col("id").eqNullSafe(F.col("mark_id")) & (F.col("text_hash") == F.col("mark_hash")),
        "left",
    )
    spans = F.coalesce(F.col("spans"), F.array().cast(SPAN))

    def label(span: Column, size: Column) -> Column:
        kind = F.get(F.array(*[F.lit(f"[{kind}]") for kind in KINDS]), span["kind"])
        removed = (span["kind"] == 4) & F.array_contains("certain", span["value"])
        return F.when(removed | (size == 0), F.lit("")).otherwise(kind)

    return unpacked(
        marked.withColumn("spans", spans),
        docs.columns,
        spans=F.col("spans"),
        clean=replaced(F.col("text"), F.col("spans"), label),
    )


def n_of_kind(spans: Column, kind: str) -> Column:
    number = KINDS.index(kind)
    return F.size(F.filter(spans, lambda span: span["kind"] == number)).cast("long")


def base_only(spans: Column) -> Column:
    return F.filter(spans, lambda span: span["kind"] < 4)
