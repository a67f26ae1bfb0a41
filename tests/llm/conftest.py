import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).parent))

from llm_words import words  # noqa: E402

#: Names that the operators use inside, as extra columns of their inputs.
CLASHES = "node long, bucket long, k1 string, k2 string, row string, mix double, h long, rank int, shard int, found string"


@pytest.fixture(scope="session")
def odd_rows():
    """(doc_id, text, lang, source): nulls, empty, blank, tiny, very long, repeated rows and ids, ties."""
    long_text, passage = words(30_000, 1), words(60, 2)
    return [
        (1, None, "en", "a"),
        (2, "", None, None),
        (3, " \t\n ", "en", "b"),
        (4, "Hi there", "en", "a"),
        (4, "Hi there", "en", "a"),
        (5, "hi THERE", "fr", "b"),
        (None, "no id " + passage, "en", None),
        (None, "no id " + passage, "en", None),
        (6, long_text, "en", "c"),
        (7, long_text + " end", "en", "c"),
        (8, words(90, 3) + " " + passage + " " + words(40, 4), "en", "a"),
        (9, passage + " " + passage, "en", "a"),
        (9, "other text of the same id", "en", "a"),
        (10, "<|endoftext|> á ß Σ İ 漢字 x.. y's 12.5", None, "a"),
        (11, "ab" * 400, "en", "a"),
    ]


@pytest.fixture
def odd_docs(spark, odd_rows):
    extra = (7, 7, "x", "y", "z", 0.5, 9, 1, 2, "f")
    schema = f"doc_id long, text string, lang string, source string, {CLASHES}"
    return spark.createDataFrame([r + extra for r in odd_rows], schema).repartition(3)


@pytest.fixture
def no_docs(odd_docs):
    return odd_docs.limit(0)
