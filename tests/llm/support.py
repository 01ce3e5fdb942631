"""Tables of awkward rows: nulls, empty and long texts, repeated rows, clashing extra columns."""

DOCS = "doc_id long, text string, lang string, source string, n_chars long, id long, score string, row string, copy int, found string"


def documents(spark, texts, ids=None, lang="en", source=None):
    rows = []
    for i, text in enumerate(texts):
        key = i if ids is None else ids[i]
        given = source[i] if source else f"s{i % 3}"
        rows.append((key, text, lang[i] if isinstance(lang, list) else lang, given, len(text or ""), -1, "x", "y", 9, "z"))
    return spark.createDataFrame(rows, DOCS)


def no_documents(spark):
    return spark.createDataFrame([], DOCS)


AWKWARD = [None, "", " ", "\n\t", "a", "a", "é😀 ß", "0 1 2", "x" * 100_000, "the cat " * 20_000]
