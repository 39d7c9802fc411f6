import pytest


@pytest.fixture(scope="session")
def docs_of(spark):
    """Builds a documents table from ``(doc_id, text)`` or ``(doc_id, text, source)`` tuples, with
    extra columns whose names clash with those the operators make."""

    def build(rows, *more):
        schema = "doc_id long, text string, lang string, source string, n_chars long, " + (
            "size string, key string, fingerprint int, ids int, row int, spans int, score string"
        )
        data = [
            (r[0], r[1], r[3] if len(r) > 3 else "en", r[2] if len(r) > 2 else "s", len(r[1] or ""))
            + ("x", "x", 1, 1, 1, 1, "x")
            for r in rows
        ]
        return spark.createDataFrame(data, schema)

    return build
