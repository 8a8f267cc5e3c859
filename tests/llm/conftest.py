import pytest

DOCUMENT = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def documents(spark):
    """Builds documents from (id, text) or (id, text, source)."""
    def build(*rows):
        full = [
            (row[0], row[1], "en", row[2] if len(row) > 2 else "a",
             None if row[1] is None else len(row[1]))
            for row in rows
        ]
        return spark.createDataFrame(full, DOCUMENT)

    return build


@pytest.fixture
def odd_documents(documents):
    """Nulls, empty and long texts, repeated rows, ties."""
    long_text = " ".join(f"word{i} tail{i % 13}" for i in range(60_000))
    return documents(
        (1, None), (2, ""), (3, " \n\t "), (4, "one"), (5, long_text, None),
        (6, "six words stand in this text"), (6, "six words stand in this text"),
        (None, "a text without an id at all"), (None, None, None), (7, "x" * 200_000),
        (8, "Ünïcödé wörds — and ünïcödé ÄÖ"), (9, "six words stand in this text"),
    )


@pytest.fixture
def clashing(spark):
    """A function that adds columns named like those the operators add."""
    from pyspark.sql import functions as F

    def add(df):
        names = (
            "doc", "n_words", "spans", "items", "fingerprint", "fp", "_row", "size", "shard",
            "shards", "_key", "_place", "host", "kept", "lines", "u", "v", "least", "a.b", "tick`s",
        )
        return df.withColumns({name: F.lit(f"own {name}") for name in names})

    return add
