from __future__ import annotations

import pytest

LONG = "lorem ipsum dolor sit amet " * 9000 + "end"
GOOD = "The quick brown fox jumps over the lazy dog near the river bank today.\nAnother line of plain prose stands here."


@pytest.fixture(scope="session")
def messy(spark):
    """Nulls in every column, empty, blank and very long texts, repeated rows,
    and extra columns named like what the operators use and return."""
    rows = [
        (1, GOOD, "en", "a"), (2, GOOD, "en", "a"), (2, GOOD, "en", "a"), (3, None, "en", None), (4, "", None, "b"),
        (5, " \t\n\x0b ", "en", "b"), (6, LONG, "en", "c"), (None, GOOD + " more words", None, None),
        (None, None, None, None), (7, "é日本 ñ 42 😀\n\n\n" + GOOD, "fr", "d"), (8, "1234 5678 %%%", "en", "d"),
        (9, "<|endoftext|> a  b\tc \\ </turn> ###", "en", "d"),
    ]
    extra = ", ".join(f"{c} string" for c in (
        "n_words", "kept", "score", "row", "body", "doc", "pos", "key", "fp", "root", "component_id", "spans", "b1",
        "form", "raw", "hash", "start", "ids", "salt", "part", "shard", "n_lines", "_kept", "lang_pred"))
    width = extra.count(",") + 1
    return spark.createDataFrame([(*r, *["x"] * width) for r in rows],
                                 f"doc_id long, text string, lang string, source string, {extra}")
