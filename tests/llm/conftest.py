import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[2]))

# Columns that clash with what operators add.
CLASHING = "n_words long, score double, kept boolean, tile long, length long, row long, terms string"


@pytest.fixture
def documents(spark):
    """A frame of documents from (id, text[, lang]) rows."""

    def make(*rows, clash: bool = False):
        data = [(r[0], r[1], r[2] if len(r) > 2 else "en", "s", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(data, "doc_id long, text string, lang string, source string, n_chars long")
        if clash:
            for field in CLASHING.split(", "):
                name, kind = field.split()
                df = df.selectExpr("*", f"cast(null as {kind}) as {name}")
        return df

    return make


@pytest.fixture
def hard_rows():
    """Nulls, empty, blank and very long texts, ties and repeated rows."""
    long = "lorem ipsum dolor sit amet " * 20_000
    return [
        (1, None, None), (2, "", "en"), (3, " \n\t ", None), (4, "one", "en"), (5, "one", "en"), (5, "one", "en"),
        (None, "a b c d e f g h i j k l", "en"), (None, None, None), (6, long, "fr"), (7, long + "x", "fr"), (8, "é" * 5_000, "de"),
    ]
