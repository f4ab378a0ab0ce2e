import pytest

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long, key string, h int"


@pytest.fixture(scope="session")
def documents(spark):
    """Documents from (doc_id, text[, source]); extra columns bear names the operators use inside."""

    def build(*rows):
        full = [
            (r[0], r[1], "en", r[2] if len(r) > 2 else "s0", len(r[1] or ""), "k", 1) for r in rows
        ]
        return spark.createDataFrame(full, COLUMNS)

    return build


#: nulls in any column, an empty text, blanks only, a repeated row, a long text
ODD = [
    (None, "no id at all here", None),
    (1, None, "s1"),
    (2, "", None),
    (3, " \t\n ", "s1"),
    (4, "one", "s1"),
    (5, "same words again", "s1"),
    (5, "same words again", "s1"),
    (6, "word " * 50_000, "s2"),
]
