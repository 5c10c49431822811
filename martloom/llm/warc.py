"""WARC derivatives: metadata and plain-text conversion records made from responses.

Each derived record points back to its response (WARC-Refers-To), keeps the response's
target, date and digests, and has a digest of its own block. Everything is a column
expression on one response, so no step shuffles. Character references are decoded in Python.
"""

from __future__ import annotations

import html as markup
import re
from collections.abc import Iterator
from html.entities import html5

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from martloom.llm.common import let

#: Fixed value: the date of pages that carry none.
NO_DATE = "1970-01-01T00:00:00Z"
CRLF = "\r\n"

#: What may be a character reference: a number or a name, the last semicolon missing or not.
REFERENCE = re.compile(r"&(?:#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[A-Za-z][A-Za-z0-9]{0,31};?)")
# What is not closed is hidden to the end, so that no later beginning has to look for an end again.
HIDDEN = r"(?is)<!--.*?(?:-->|\z)|<script\b.*?(?:</script\s*>|\z)|<style\b.*?(?:</style\s*>|\z)|<head\b.*?(?:</head\s*>|\z)"
BREAKS = r"(?i)</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|section|article|header|footer|nav|body|html|pre|blockquote)\b[^>]*>"


def record_id(kind: str, key: Column) -> Column:
    """A record's name: the same for the same response and kind, in any run."""
    h = F.md5(F.concat(F.lit(f"{kind}:"), key))
    parts = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *parts), F.lit(">"))


def digest(block: Column) -> Column:
    return F.concat(F.lit("sha1:"), F.sha1(block.cast("binary")))


def _character(found: re.Match) -> str:
    text = markup.unescape(found.group())
    # a space that does not break is a space
    return " " + text[1:] if text.startswith("\xa0") else text


@F.arrow_udf(T.StringType())
def decoded(texts: pa.Array) -> pa.Array:
    """All of HTML's character references, named and numeric, read once."""
    return pa.array([t and REFERENCE.sub(_character, t) for t in texts.to_pylist()], pa.string())


def plain_text(html: Column) -> Column:
    """Visible text: hidden parts go, block tags break lines, other tags vanish, entities are read once."""
    text = let(F.regexp_replace(html, HIDDEN, " "), _without_tags)
    text = F.regexp_replace(decoded(text), r"[ \t\r]+", " ")
    return F.trim(F.regexp_replace(F.regexp_replace(text, r" ?\n ?", "\n"), r"\n+", "\n"), F.lit(" \n"))


def _without_tags(text: Column) -> Column:
    # Tags end at the last '>' or before. Up to there every '<' finds its '>', and nothing is looked at twice.
    rest = F.substring_index(text, ">", -1)
    tagged = F.substring(text, F.lit(1), F.length(text) - F.length(rest))
    return F.concat(F.regexp_replace(F.regexp_replace(tagged, BREAKS, "\n"), "<[^>]*>", ""), rest)


def title(html: Column) -> Column:
    """The text of the first title. If the first one has no end, no other has one, and the search is over."""
    return F.regexp_extract(html, r"(?is)<title[^>]*+(?:>(?:(.*?)</title|.*+)|\z)", 1)


def outlinks(html: Column) -> Column:
    """Anchors with a target, each read once up to its '>'."""
    anchors = F.regexp_extract_all(html, F.lit(r"(?i)<a\s[^>]*+"), 0)
    return F.size(F.filter(anchors, lambda a: F.contains(F.lower(a), F.lit("href"))))


def responses(pages: DataFrame, date: str = NO_DATE) -> DataFrame:
    """Response records from (page_id, url, html): key, id, uri, date, http headers, payload, digest.

    Null html is an empty payload, null url an empty target. Null ids are named by target and payload.
    """
    payload = F.coalesce(F.col("html"), F.lit(""))
    uri = F.coalesce(F.col("url"), F.lit(""))
    key = F.coalesce(F.col("page_id").cast("string"), F.concat(F.lit("-"), F.md5(F.concat(uri, F.lit(" "), payload))))
    headers = F.concat(
        F.lit(f"HTTP/1.1 200 OK{CRLF}Content-Type: text/html; charset=utf-8{CRLF}Content-Length: "),
        F.octet_length(payload).cast("string"),
        F.lit(CRLF),
    )
    return pages.select(
        "page_id", record_id("response", key).alias("record_id"), key.alias("key"), uri.alias("target_uri"),
        F.lit(date).alias("date"), headers.alias("http_headers"), payload.alias("payload"), digest(payload).alias("payload_digest"),
    )


def derivatives(found: DataFrame) -> DataFrame:
    """Two records for each response: metadata, then conversion, linked to it and to each other.

    Columns: page_id, type, record_id, refers_to, concurrent_to (the other record),
    target_uri, date, content_type, source_digest, source_headers, block, block_digest,
    length. A response without payload still gets both. Repeated responses repeat.
    """
    text = plain_text(F.col("payload"))
    own = found.withColumn("__text", text).withColumn(
        "__title", F.trim(title(F.col("payload")))
    )
    fields = F.concat(
        F.lit("title: "), F.regexp_replace("__title", r"\s+", " "),
        F.lit(f"{CRLF}outlinks: "), outlinks(F.col("payload")).cast("string"),
        F.lit(f"{CRLF}html-bytes: "), F.octet_length("payload").cast("string"),
        F.lit(f"{CRLF}text-bytes: "), F.octet_length("__text").cast("string"),
        F.lit(CRLF),
    )
    meta, conversion = record_id("metadata", F.col("key")), record_id("conversion", F.col("key"))

    def record(kind: str, name: Column, other: Column, content: str, block: Column) -> Column:
        return F.struct(
            F.lit(kind).alias("type"), name.alias("record_id"), other.alias("concurrent_to"),
            F.lit(content).alias("content_type"), block.alias("block"),
        )

    both = F.array(
        record("metadata", meta, conversion, "application/warc-fields", fields),
        record("conversion", conversion, meta, "text/plain", F.col("__text")),
    )
    r = F.col("r")
    return own.withColumn("r", F.explode(both)).select(
        "page_id", r["type"].alias("type"), r["record_id"].alias("record_id"), F.col("record_id").alias("refers_to"),
        r["concurrent_to"].alias("concurrent_to"), "target_uri", "date", r["content_type"].alias("content_type"),
        F.col("payload_digest").alias("source_digest"), F.col("http_headers").alias("source_headers"),
        r["block"].alias("block"), digest(r["block"]).alias("block_digest"),
        F.octet_length(r["block"]).cast("long").alias("length"),
    )


def as_bytes(records: DataFrame) -> DataFrame:
    """Each derived record in the form of the file format, as one string column `record`.

    The source's status line and headers follow as `WARC-Source-Status`, `WARC-Source-Content-Type` and so on.
    """
    source = F.regexp_replace(F.rtrim(F.col("source_headers"), F.lit(CRLF)), CRLF, f"{CRLF}WARC-Source-")
    lines = [
        ("WARC-Type", F.col("type")),
        ("WARC-Record-ID", F.col("record_id")),
        ("WARC-Date", F.col("date")),
        ("WARC-Target-URI", F.col("target_uri")),
        ("WARC-Refers-To", F.col("refers_to")),
        ("WARC-Concurrent-To", F.col("concurrent_to")),
        ("WARC-Source-Payload-Digest", F.col("source_digest")),
        ("WARC-Source-Status", source),
        ("WARC-Block-Digest", F.col("block_digest")),
        ("Content-Type", F.col("content_type")),
        ("Content-Length", F.col("length").cast("string")),
    ]
    head = F.concat(F.lit(f"WARC/1.1{CRLF}"), *[F.concat(F.lit(f"{n}: "), v, F.lit(CRLF)) for n, v in lines])
    return records.select("page_id", F.concat(head, F.lit(CRLF), F.col("block"), F.lit(CRLF * 2)).alias("record"))


def write(records: DataFrame, path: str) -> None:
    """A gzip-compressed file for each partition, records one after another."""
    as_bytes(records).select("record").write.option("lineSep", CRLF).option("compression", "gzip").text(path)


def parse(raw: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record in a file's bytes. Line ends between records are skipped."""
    at = 0
    while (at := raw.find(b"WARC/", at)) >= 0:
        end = raw.index(b"\r\n\r\n", at)
        headers = dict(line.split(": ", 1) for line in raw[at:end].decode().split(CRLF)[1:])
        length = int(headers["Content-Length"])
        yield headers, raw[end + 4 : end + 4 + length]
        at = end + 4 + length


def read(spark, path: str) -> DataFrame:
    """Records of all files in a folder: headers (map) and block. A file is read by one task, record after record."""
    import gzip

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.map_(pa.string(), pa.string())
        for batch in batches:
            for content in batch.column("content"):
                found = list(parse(gzip.decompress(content.as_py())))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([list(h.items()) for h, _ in found], kind), pa.array([b for _, b in found], pa.binary())],
                    ["headers", "block"],
                )

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(path).select("content")
    return files.mapInArrow(records, "headers map<string,string>, block binary")


_REFERENCE_SQL = REFERENCE.pattern


#: The derivatives in SQL, for the comparison with another engine.
def _quoted(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


def _entities() -> str:
    """Names and what they stand for, from the standard library's table."""
    return ", ".join(f"({_quoted(name)}, {_quoted(value)})" for name, value in sorted(html5.items()))


def _small_numbers() -> str:
    """Numeric references below 160, some of which stand for other characters."""
    return ", ".join(f"({n}, {_quoted(markup.unescape(f'&#{n};'))})" for n in range(160))


ORACLE = rf"""
WITH source AS (
  SELECT page_id, coalesce(url, '') AS target_uri, coalesce(html, '') AS payload,
         coalesce(page_id::VARCHAR, '-' || md5(coalesce(url, '') || ' ' || coalesce(html, ''))) AS key FROM pages),
visible AS (
  SELECT *, regexp_replace(regexp_replace(regexp_replace(payload,
    '<!--.*?(?:-->|$)|<script\b.*?(?:</script\s*>|$)|<style\b.*?(?:</style\s*>|$)|<head\b.*?(?:</head\s*>|$)', ' ', 'gis'),
    '</?(?:p|div|br|li|ul|ol|tr|table|h[1-6]|section|article|header|footer|nav|body|html|pre|blockquote)\b[^>]*>', chr(10), 'gi'),
    '<[^>]*>', '', 'g') AS bare FROM source),
numbered AS (SELECT *, row_number() OVER () AS rid FROM visible),
names(name, value) AS (VALUES {_entities()}),
small(n, value) AS (VALUES {_small_numbers()}),
cut AS (
  SELECT rid, unnest(gaps) AS gap, unnest(list_concat(ms, [''])) AS ref, unnest(range(len(gaps))) AS i
  FROM (SELECT rid, string_split_regex(bare, '{_REFERENCE_SQL}') AS gaps, regexp_extract_all(bare, '{_REFERENCE_SQL}') AS ms FROM numbered)),
refs AS (SELECT DISTINCT ref, rtrim(ref[3:], ';') AS body FROM cut WHERE ref <> ''),
numbers AS (
  SELECT ref, CASE WHEN length(digits) > 7 THEN 9999999 WHEN hex THEN ('0x0' || digits)::BIGINT ELSE ('0' || digits)::BIGINT END AS n
  FROM (SELECT ref, lower(body[1]) = 'x' AS hex, ltrim(CASE WHEN lower(body[1]) = 'x' THEN body[2:] ELSE body END, '0') AS digits
        FROM refs WHERE ref[2] = '#')),
meaning AS (
  SELECT ref, CASE WHEN n > 1114111 OR n BETWEEN 55296 AND 57343 THEN chr(65533) WHEN n < 160 THEN value
                   WHEN n BETWEEN 64976 AND 65007 OR n % 65536 >= 65534 THEN '' ELSE chr(n::INTEGER) END AS v
  FROM numbers LEFT JOIN small USING (n)
  UNION ALL
  SELECT ref, arg_max(value || ref[length(name) + 2:], length(name)) FROM refs JOIN names ON starts_with(ref[2:], name) GROUP BY ref),
read_once AS (
  SELECT n.*, joined.plain FROM numbered n JOIN (
    SELECT rid, string_agg(gap || CASE WHEN starts_with(v, chr(160)) THEN ' ' || v[2:] ELSE coalesce(v, ref) END, '' ORDER BY i) AS plain
    FROM cut LEFT JOIN meaning USING (ref) GROUP BY rid) joined USING (rid)),
texts AS (
  SELECT *, trim(regexp_replace(regexp_replace(regexp_replace(plain, '[ \t\r]+', ' ', 'g'), ' ?\n ?', chr(10), 'g'),
    '\n+', chr(10), 'g'), ' ' || chr(10)) AS text,
    trim(regexp_extract(payload, '<title[^>]*>(.*?)</title', 1, 'is')) AS title FROM read_once),
named AS (
  SELECT *, list_transform(['response', 'metadata', 'conversion'], lambda k: md5(k || ':' || key)) AS h FROM texts),
ids AS (
  SELECT *, list_transform(h, lambda x: '<urn:uuid:' || x[1:8] || '-' || x[9:12] || '-' || x[13:16] || '-' || x[17:20] || '-'
    || x[21:32] || '>') AS id,
    'title: ' || regexp_replace(title, '\s+', ' ', 'g') || chr(13) || chr(10) || 'outlinks: '
    || len(regexp_extract_all(payload, '<a\s[^>]*href', 0, 'i')) || chr(13) || chr(10) || 'html-bytes: ' || strlen(payload)
    || chr(13) || chr(10) || 'text-bytes: ' || strlen(text) || chr(13) || chr(10) AS fields FROM named),
records AS (
  SELECT *, unnest([{{'type': 'metadata', 'record_id': id[2], 'concurrent_to': id[3],
                     'content_type': 'application/warc-fields', 'block': fields}},
                    {{'type': 'conversion', 'record_id': id[3], 'concurrent_to': id[2],
                     'content_type': 'text/plain', 'block': text}}]) AS r FROM ids)
SELECT page_id, r.type AS type, r.record_id AS record_id, id[1] AS refers_to, r.concurrent_to AS concurrent_to, target_uri,
  '1970-01-01T00:00:00Z' AS date, r.content_type AS content_type, 'sha1:' || sha1(payload) AS source_digest,
  'HTTP/1.1 200 OK' || chr(13) || chr(10) || 'Content-Type: text/html; charset=utf-8' || chr(13) || chr(10)
  || 'Content-Length: ' || strlen(payload) || chr(13) || chr(10) AS source_headers,
  r.block AS block, 'sha1:' || sha1(r.block) AS block_digest, strlen(r.block)::BIGINT AS length
FROM records
"""
