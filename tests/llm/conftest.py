import pytest

from sluiceway.llm.queries import prepared

DOC = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session")
def session(spark):
    """The shared session, its Python workers able to import the package."""
    return prepared(spark)


@pytest.fixture(scope="session")
def docs(session):
    """Builds documents with columns whose names clash with those that operators add or use inside."""

    def build(rows, extra=True):
        frame = session.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], DOC)
        if not extra:
            return frame
        clash = ["class_id", "n_tokens", "start", "length", "spans", "bin", "node", "bucket", "print", "words", "score", "held_out", "place", "n"]
        return frame.selectExpr("*", *(f"'x' AS {name}" for name in clash))

    return build


@pytest.fixture(scope="session")
def rows():
    """Rows of a frame as a sorted list of tuples."""
    return lambda df, *columns: sorted((tuple(r) for r in (df.select(*columns) if columns else df).collect()), key=repr)
