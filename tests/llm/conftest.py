import pytest

# Names that operators use themselves; a table may have columns of these names.
CLASHING = ("text_hash", "keep", "pass", "size", "taken", "bucket", "n_words", "kept", "component", "band", "start", "col")

LONG = "word " * 40_000 + "\n" + "a much longer line of text than twenty letters\n" * 50


@pytest.fixture
def documents(spark):
    """Build documents from texts, or ``(doc_id, text)`` pairs, with further columns of clashing names."""

    def build(texts, sources=None):
        rows = [t if isinstance(t, tuple) else (i, t) for i, t in enumerate(texts)]
        sources = sources or [None if i % 5 == 4 else f"s{i % 3}" for i in range(len(rows))]
        frame = spark.createDataFrame(
            [(i, t, "en", s, len(t or "")) for (i, t), s in zip(rows, sources)],
            "doc_id long, text string, lang string, source string, n_chars long",
        )
        return frame.selectExpr("*", *(f"-1 AS `{c}`" for c in CLASHING))

    return build


@pytest.fixture
def odd(documents):
    """Nulls in id and text, empty and very long texts, repeated rows and ids, ties."""
    line = "this very line is in many of the documents"
    return documents(
        [
            (1, None), (2, ""), (3, LONG), (None, line), (4, f"{line}\nown"), (5, f"{line}\nown"), (5, f"{line}\nown"),
            (6, f" {line.upper()}\t\nother\n\n"), (6, "a second text of the same id\n" + line), (7, " \n\t"), (None, None),
        ]
    )


@pytest.fixture
def no_documents(documents):
    return documents([(0, "")]).where("false")
