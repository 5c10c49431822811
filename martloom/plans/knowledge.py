"""Active documents and their retrieval chunks."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping

from pyspark.sql import DataFrame, functions as F

from martloom.functions.dates import as_date
from martloom.functions.text import word_count

Tables = Mapping[str, DataFrame]


def knowledge_index(t: Tables, as_of: dt.date) -> DataFrame:
    active = t["knowledge_documents"].where(F.col("status") == "Active")
    return active.select(
        F.col("doc_id").alias("document_id"), "title", F.col("doc_type").alias("document_type"), "topic", "content",
        as_date("effective_date").alias("effective_date"), "version", "status", F.lit(as_of).alias("indexed_at"),
    )


def document_chunks(t: Tables) -> DataFrame:
    """One chunk per document, holding its whole text."""
    return t["knowledge_index"].select(
        F.concat(F.col("document_id").cast("string"), F.lit("_001")).alias("chunk_id"),
        "document_id", "title", "document_type", "topic", F.col("content").alias("chunk_text"),
        word_count(F.col("content")).alias("word_count"), "indexed_at",
    )
