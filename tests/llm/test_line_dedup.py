"""Lines against a plain count in Python."""

from collections import defaultdict

from tablework.llm.line_dedup import drop_repeated_lines

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def key_of(line):
    return line.strip(" \t\n\x0b\x0c\r").translate(LOWER)


def expected(rows):
    holders = defaultdict(set)
    for doc_id, text in rows:
        for line in (text or "").split("\n"):
            if len(key_of(line)) >= 10:
                holders[key_of(line)].add(doc_id)

    def stays(doc_id, line):
        ids = holders.get(key_of(line), set())
        first = min((i for i in ids if i is not None), default=None)
        return len(ids) < 2 or (doc_id is not None and doc_id == first)

    result = []
    for doc_id, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line in lines if stays(doc_id, line)]
        result.append((doc_id, "\n".join(kept), len(lines), len(lines) - len(kept)))
    return sorted(result, key=str)


def got(docs):
    rows = drop_repeated_lines(docs).select("doc_id", "text", "n_lines", "n_dropped").collect()
    return sorted((tuple(row) for row in rows), key=str)


def test_odd_rows(odd_docs, odd_rows, keeps_columns):
    assert got(odd_docs) == expected([row[:2] for row in odd_rows])
    keeps_columns(odd_docs, drop_repeated_lines(odd_docs), "n_lines", "n_dropped")


def test_given_documents(given_docs):
    rows = [tuple(row) for row in given_docs.select("doc_id", "text").collect()]
    assert got(given_docs) == expected(rows)


def test_no_rows(no_docs):
    assert got(no_docs) == []
