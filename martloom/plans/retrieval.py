"""Lexical retrieval for many questions at once.

A chunk answers a question when any of the question's terms occurs in its text,
title or topic, also inside a longer word. The answer is the first k such chunks
by document id. Only the first k chunks of any one word can be among them, so
each word keeps k postings and no question x chunk pairs are formed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from martloom.functions.text import TERM, search_terms
from martloom.operators.windows import first_per_group
from martloom.session import materialize

SHORTEST, LONGEST = 4, 8  # search terms have at least four characters
FIELDS = ("chunk_text", "title", "topic")


def _chunk_words(chunks: DataFrame, key: str, fields) -> DataFrame:
    """Distinct lower-cased words of every chunk."""
    words = [F.regexp_extract_all(F.lower(F.coalesce(f, F.lit(""))), F.lit(TERM), F.lit(0)) for f in fields]
    return chunks.select(F.col(key).alias("doc"), F.explode(F.array_distinct(F.flatten(F.array(*words)))).alias("word"))


def _postings(chunks: DataFrame, key: str, fields, k: int) -> DataFrame:
    """The first k documents of every word, and of the empty term, which matches everything."""
    words = _chunk_words(chunks, key, fields).where(F.length("word") >= SHORTEST)
    everything = chunks.select(F.col(key).alias("doc")).orderBy("doc").limit(k).select("doc", F.lit("").alias("word"))
    return first_per_group(words, ["word"], [F.col("doc").asc()], k).unionByName(everything)


def _term_words(terms: DataFrame, words: DataFrame) -> DataFrame:
    """(term, word) where the word contains the term.

    They meet on a shared piece: the first 4 to 8 characters of the term. Long
    pieces keep the groups small, and the expansion stays linear in the word.
    """
    word, size = F.col("word"), F.length("word")
    pieces = F.transform(
        F.sequence(F.lit(SHORTEST), F.least(F.lit(LONGEST), size)),
        lambda n: F.transform(F.sequence(F.lit(0), size - n), lambda i: F.substring(word, i + 1, n)),
    )
    by_piece = words.where(word != "").select("word", F.explode(F.array_distinct(F.flatten(pieces))).alias("piece"))
    asked = terms.where(F.col("term") != "").withColumn("piece", F.substring("term", 1, LONGEST))
    inside = asked.join(by_piece, "piece").where(word.contains(F.col("term"))).select("term", "word")
    return inside.unionByName(terms.where(F.col("term") == "").select("term", F.col("term").alias("word")))


def search(
    questions: DataFrame, chunks: DataFrame, k: int = 5, *, question_key: str = "question_id", text: str = "text",
    chunk_key: str = "document_id", fields=FIELDS,
) -> DataFrame:
    """(question, document, place) for the first k matching documents of every question.

    A question without any usable term gets the first k documents.
    """
    terms = search_terms(F.col(text))
    asked = questions.select(
        F.col(question_key).alias("question"),
        F.explode(F.when(F.size(terms) > 0, F.array_distinct(terms)).otherwise(F.array(F.lit("")))).alias("term"),
    )
    # the texts are read once: k postings per word are written and used twice
    postings = materialize(_postings(chunks, chunk_key, fields, k), "postings")
    pairs = _term_words(asked.select("term").distinct(), postings.select("word").distinct())
    per_term = first_per_group(pairs.join(postings, "word").select("term", "doc").distinct(), ["term"],
                               [F.col("doc").asc()], k)
    # k documents per term as one short list, so that a question gathers at most 8 lists
    lists = per_term.groupBy("term").agg(F.collect_list("doc").alias("docs"))
    found = asked.join(lists, "term").groupBy("question").agg(
        F.slice(F.array_sort(F.array_distinct(F.flatten(F.collect_list("docs")))), 1, k).alias("docs")
    )
    placed = found.select("question", F.posexplode("docs").alias("place", chunk_key))
    return placed.select(F.col("question").alias(question_key), chunk_key, (F.col("place") + 1).alias("place"))


def passages(matches: DataFrame, chunks: DataFrame, k: int = 3, *, chunk_key: str = "document_id") -> DataFrame:
    """The first k matches of every question with title, type, topic and text of the chunk."""
    found = chunks.select(chunk_key, "title", "document_type", "topic", "chunk_text")
    return matches.where(F.col("place") <= k).join(found, chunk_key)
