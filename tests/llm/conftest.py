import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Makes a documents table of (doc_id, text) or (doc_id, text, lang) rows."""

    def make(rows, extra=""):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        return df.selectExpr("*", *([extra] if extra else []))

    return make


@pytest.fixture
def hard(documents):
    """Nulls, empty and long texts, ties, repeated rows, and columns whose names clash with those of operators."""
    long = "the quick brown fox jumps over it. " * 3000
    rows = [(None, "no id here"), (1, None), (2, ""), (3, long), (4, "tie"), (4, "tie"), (4, "other"), (5, "  \n\n ")]
    df = documents(rows)
    clash = "word length start piece row_id row_hash slot file first last line pos component_id _tie label "
    clash += "_found _kept _removed _mask _place _at _row_id _row_hash _key_row_id _key_row_hash kept removed doc at place found"
    clash = clash.split()
    return df.selectExpr("*", *[f"'x' as `{c}`" for c in clash])


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)
