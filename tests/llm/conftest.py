from __future__ import annotations

import pytest

DOCUMENT = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """Texts as a documents table; an entry may also be (doc_id, text)."""

    def make(*texts, extra: str = ""):
        rows = []
        for n, entry in enumerate(texts):
            doc_id, text = entry if isinstance(entry, tuple) else (n, entry)
            rows.append((doc_id, text, "en", "a", None if text is None else len(text)))
        frame = spark.createDataFrame(rows, DOCUMENT)
        for name in extra.split():
            frame = frame.selectExpr("*", f"'x' AS {name}")
        return frame.repartition(3)

    return make


LONG = " ".join(f"word{n % 977} other{n % 13}" for n in range(60_000))
CLASHING = "row fp ids spans hits kept s signals_of_text row_of_table fp_of_text base_failed words_of_text label"
