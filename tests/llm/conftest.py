import pytest

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, score double, n long, key long"


@pytest.fixture
def documents(spark):
    """Documents from (doc_id, text[, lang]) with extra columns whose names clash with the operators' own."""

    def make(*rows):
        full = [(r[0], r[1], r[2] if len(r) > 2 else "en", None, len(r[1] or ""), 0.5, 7, 9) for r in rows]
        return spark.createDataFrame(full, SCHEMA)

    return make


def by_id(df, *columns):
    return {r["doc_id"]: tuple(r[c] for c in columns) for r in df.collect()}
