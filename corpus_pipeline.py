"""Corpus pipeline over ``documents``: stages built from ``tremor.llm`` operators.

Each stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame; its result
is written as Parquet and read again as the next stage's ``docs``. All stages
but the last return the columns of ``documents``.

Every stage takes rows with null columns, repeated rows and ids, texts of any
length (read whole) and further columns, which come back as they are; an empty
table gives no rows. What nulls, empty texts and ties give is said at each.
"""

from __future__ import annotations

import sys
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_ROOT = str(Path(__file__).resolve().parent)
if _ROOT not in sys.path:
    sys.path.insert(0, _ROOT)

from tremor.llm import decontaminate, langid, line_dedup, packing, registry, simhash  # noqa: E402
from tremor.llm.common import let_workers_import, stored, table  # noqa: E402


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; rejected ones go.

    Null and empty texts, and texts without a letter, are rejected. Repeated rows
    are judged alike; a null id takes no part in training, but is judged.
    """
    let_workers_import(spark)
    return langid.keep_identified(docs, langid.fit(docs))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without the lines that a document of smaller id has; ``n_chars`` follows.

    Null texts come back empty. Rows of one id are one document, rows with a null
    id together one behind all others.
    """
    cut = line_dedup.drop_repeated_lines(docs, counts=False)
    if "n_chars" in docs.columns:
        cut = cut.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return cut.select(*docs.columns)


def dedup_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one of smallest id.

    Null and empty texts are one group. Of rows with the same smallest id one
    stays; a null id is behind all others.
    """
    let_workers_import(spark)
    return simhash.keep_one_of_each(docs, shingle_words=4, radius=4)


def drop_benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item. Null and empty texts hold none."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the kept documents, packed into sequences. Null and empty texts
    are one end id; repeated rows are packed once each."""
    let_workers_import(spark)
    return packing.piece_digest(packing.pack_documents(docs, public_tokenizers.path(registry.TOKENIZER)))


STAGES = [
    ("language", identify_language),
    ("lines", dedup_lines),
    ("near-copies", dedup_near_copies),
    ("benchmark", drop_benchmark_leaks),
    ("packing", pack),
]

#: Language identification has no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the last stage's rows."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
