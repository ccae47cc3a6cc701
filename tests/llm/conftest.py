from __future__ import annotations

import pytest

from stakescore.llm.workers import prepare

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, ids string, page string, shard int"


@pytest.fixture(scope="session", autouse=True)
def prepared(spark):
    prepare(spark)


@pytest.fixture(scope="session")
def docs_of(spark):
    """Documents from (doc_id, text, lang, source), among columns whose names the operators use themselves."""

    def build(rows):
        filled = [tuple(r) + (None,) * (4 - len(r)) for r in rows]
        return spark.createDataFrame(
            [(i, t, lang, source, None if t is None else len(t), "x", "y", 7) for i, t, lang, source in filled], SCHEMA
        ).repartition(3)

    return build


ODD_TEXTS = [
    None, "", " ", "\n\n", "one", "One two", "a b c d", "A B C D", "word " * 5000, "x" * 20000, "¿Qué? Ñandú, él.",
    "tab\tand\rreturn\x0bfeed\x0c.", "line\nline\nother\n", "日本語 テキスト", "é ẞ İ ΣΑΣ", "\x1c\x1d odd \x85 space here",
    "<|endoftext|> is text", "don't we'll", "12 345 6.7", "😀😀 !!", "it's 'll", "nul​width",
]
