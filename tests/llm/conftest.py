import pytest

#: Names that operators use inside; as extra columns they must not matter.
CLASHES = ["row", "no", "uid", "key", "digest", "line", "slot", "position", "score", "source_", "h", "text_", "first", "host", "n"]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, " + ", ".join(f"{c} string" for c in CLASHES)


@pytest.fixture(scope="session")
def documents(spark):
    """documents((doc_id, text, source), ...): a table with clashing extra columns."""

    def make(*rows):
        full = [(i, t, "en" if t else None, s, len(t) if t else None, *["x"] * len(CLASHES)) for i, t, s in rows]
        return spark.createDataFrame(full, SCHEMA).repartition(3)

    return make


PROSE = "the quick brown fox jumps over the lazy dog while seven wise owls watch from an old oak tree near the quiet river and wait for the moon to rise above the hills"


@pytest.fixture(scope="session")
def odd(documents):
    """Nulls, empty and very long texts, ties and repeated rows."""
    long = " ".join(f"word{i}" for i in range(60_000))
    return documents(
        (1, PROSE, "a"), (2, PROSE.upper(), "a"), (2, PROSE.upper(), "a"), (3, None, None), (4, "", "b"), (5, "  \n\n ", "b"), (6, "one two", "b"),
        (7, "one two", None), (None, PROSE, "a"), (None, None, None), (8, long, "a"), (9, long + " more", "c"), (10, "ÀÉ ß ﬁ\x1f x", "c"),
    )
