"""Text predicates and extractors, all inside the JVM."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce
from operator import or_

from pyspark.sql import Column, functions as F

# Patterns of the published formats.
TERM = "[A-Za-z0-9_]+"
CUSTOMER_ID = "(?i)C[0-9]{7}"
PERIOD = "([0-9]+)\\s*(day|week|month)"
DOCUMENT_ID = "DOC[0-9]+"
QUOTED = "'(?:''|[^'])*'"
FORBIDDEN_SQL = (
    "INSERT", "UPDATE", "DELETE", "MERGE", "DROP", "ALTER", "CREATE", "TRUNCATE", "GRANT", "REVOKE", "CALL",
    "EXECUTE", "COPY", "OPTIMIZE", "VACUUM",
)

_EDGE = r"[^\p{L}\p{N}_]"


def is_blank(c: Column) -> Column:
    return c.isNull() | (F.trim(c) == "")


def word_count(text: Column) -> Column:
    """Pieces between single spaces (empty pieces count)."""
    return F.size(F.split(text, " "))


def all_terms(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(TERM), F.lit(0))


def search_terms(text: Column, longer_than: int = 3, first: int = 8) -> Column:
    """The first few lower-cased words longer than `longer_than`, in text order."""
    words = F.filter(all_terms(text), lambda w: F.length(w) > longer_than)
    return F.transform(F.slice(words, 1, first), F.lower)


def contains_any(text: Column, phrases: Sequence[str]) -> Column:
    return reduce(or_, [text.contains(p) for p in phrases])


def first_phrase(text: Column, phrases: Sequence[str]) -> Column:
    """The first listed phrase that occurs, else NULL."""
    return F.coalesce(*[F.when(text.contains(p), p) for p in phrases])


def has_keyword(text: Column, keyword: str) -> Column:
    """Whole word, or any occurrence for a phrase with a space or hyphen."""
    if " " in keyword or "-" in keyword:
        return text.contains(keyword)
    return text.rlike(f"(^|{_EDGE}){re.escape(keyword)}({_EDGE}|$)")


def has_any_keyword(text: Column, keywords: Sequence[str]) -> Column:
    """One pass over the text for the single words, plus the phrases."""
    words = [k for k in keywords if " " not in k and "-" not in k]
    tests = [text.contains(k) for k in keywords if k not in words]
    if words:
        tests.append(text.rlike(f"(^|{_EDGE})({'|'.join(map(re.escape, words))})({_EDGE}|$)"))
    return reduce(or_, tests)


def customer_id_in(text: Column) -> Column:
    return F.upper(F.nullif(F.regexp_extract(text, CUSTOMER_ID, 0), F.lit("")))


def period_days(text: Column, default: int = 7) -> Column:
    """'3 weeks' -> 21; the default where no period is named."""
    n = F.regexp_extract(text, PERIOD, 1)
    unit = F.regexp_extract(text, PERIOD, 2)
    size = F.when(unit == "day", 1).when(unit == "week", 7).otherwise(30)
    return F.when(unit == "", F.lit(default)).otherwise(n.try_cast("int") * size)


def document_ids(text: Column) -> Column:
    return F.array_join(F.regexp_extract_all(text, F.lit(DOCUMENT_ID), F.lit(0)), ",")


def without_literals(sql: Column) -> Column:
    return F.regexp_replace(sql, QUOTED, "''")


def mentions_forbidden_sql(sql: Column) -> Column:
    return without_literals(sql).rlike(r"(?i)\b(" + "|".join(FORBIDDEN_SQL) + r")\b")


def preview(text: Column, n: int) -> Column:
    return F.substring(text, 1, n)


def dollars(amount: Column, digits: int = 2) -> Column:
    return F.concat(F.lit("$"), F.format_number(amount, digits))


def percent(share: Column) -> Column:
    return F.format_string("%.2f%%", share * 100)


def thousands(n: Column) -> Column:
    return F.format_number(n, 0)
