import pytest

from roadbed.llm.common import on_workers


@pytest.fixture(autouse=True, scope="session")
def workers(spark):
    on_workers(spark)


AWKWARD = [
    (1, "The quick brown fox jumps over the lazy dog while the band plays on and on.", "en"),
    (1, "The quick brown fox jumps over the lazy dog while the band plays on and on.", "en"),
    (2, None, "en"),
    (3, "", None),
    (4, "...---...\n\n \t", "de"),
    (5, "x" * 5000, None),
    (6, "Größe und Straße über die Brücke 日本語 𝒳 done.", "de"),
    (None, "A row without an id, and a line that is long enough to count here.", "en"),
    (8, "The quick brown fox jumps over the lazy dog while the bund plays on and on.", "en"),
    (9, "word " * 20000, "en"),
]
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars int, score string, fp string, word string"


@pytest.fixture(scope="session")
def awkward(spark):
    """Nulls, empty and long texts, repeated rows, and columns operators use inside."""
    return spark.createDataFrame([(*r, None, len(r[1] or ""), "s", "f", "w") for r in AWKWARD], SCHEMA).cache()


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)
