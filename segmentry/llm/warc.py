"""Derived web-archive records: for each response a metadata record and a plain-text conversion.

Both point to the response they come from (``WARC-Refers-To``, its URI and date) and to each other
(``WARC-Concurrent-To``), carry the source's headers and digests along, and have digests of their own. Record ids follow
from the content, so a repeated run writes the same records. Files are WARC/1.1, written by Spark's text writer with
the record separator as line end, so they can go to any store; they are read back by their content lengths.

Defined results: a null page is an empty response; a null URI is the empty string; repeated rows give equal
records, read back as one; an empty table gives no records; other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

MARKUP = r"(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<[^>]*>"
SPACE = "[\\x20\\x09-\\x0D]+"
ENTITIES = [("&lt;", "<"), ("&gt;", ">"), ("&quot;", '"'), ("&#39;", "'"), ("&nbsp;", " "), ("&amp;", "&")]
RECORDS_PER_FILE = 2000
LINE = "\r\n"
HTTP_HEADERS = {"Content-Type": "text/html; charset=utf-8"}
DATE = "2024-01-01T00:00:00Z"


def urn(*parts: Column) -> Column:
    """A record id from the parts' digest."""
    h = F.md5(F.concat_ws("\n", *parts).cast("binary"))
    cut = [F.substring(h, a, n) for a, n in ((1, 8), (9, 4), (13, 4), (17, 4), (21, 12))]
    return F.concat(F.lit("<urn:uuid:"), F.concat_ws("-", *cut), F.lit(">"))


def digest(text: Column) -> Column:
    return F.concat(F.lit("sha256:"), F.sha2(text.cast("binary"), 256))


def plain_text(html: Column) -> Column:
    out = F.regexp_replace(html, MARKUP, " ")
    for entity, char in ENTITIES:
        out = F.replace(out, F.lit(entity), F.lit(char))
    return F.btrim(F.regexp_replace(out, SPACE, " "), F.lit(" "))


def responses(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """Pages as response records: ``record_id``, ``uri``, ``date``, ``headers``, ``payload``."""
    uri, html = F.coalesce(F.col(url_col), F.lit("")), F.coalesce(F.col(html_col), F.lit(""))
    headers = F.map_from_entries(F.array(*(F.struct(F.lit(k), F.lit(v)) for k, v in HTTP_HEADERS.items())))
    return pages.select(
        F.col(id_col).alias("page_id"), urn(F.lit("response"), uri, html).alias("record_id"), uri.alias("uri"),
        F.lit(DATE).alias("date"), headers.alias("headers"), html.alias("payload"),
    )


def derived(records: DataFrame) -> DataFrame:
    """A metadata and a conversion record, as text without the separator, for each response: column ``record``."""
    payload = records.select("*", plain_text(F.col("payload")).alias("_plain"), digest(F.col("payload")).alias("_source"))
    meta_id, text_id = urn(F.lit("metadata"), F.col("record_id")), urn(F.lit("conversion"), F.col("record_id"))
    named = payload.select("*", meta_id.alias("_meta"), text_id.alias("_conv"))
    source = F.array_join(F.transform(F.array_sort(F.map_entries("headers")), lambda h: F.concat(F.lit("http-"), F.lower(h["key"]), F.lit(": "), h["value"], F.lit(LINE))), "")
    fields = F.concat(source, F.lit("source-digest: "), F.col("_source"), F.lit(LINE), F.lit("source-bytes: "), F.octet_length("payload").cast("string"), F.lit(LINE))

    def record(kind: str, own: Column, other: Column, content: str, block: Column) -> Column:
        lines = [
            ("WARC-Type", F.lit(kind)), ("WARC-Record-ID", own), ("WARC-Date", F.col("date")), ("WARC-Target-URI", F.regexp_replace("uri", "[\\r\\n]", "")),
            ("WARC-Refers-To", F.col("record_id")), ("WARC-Refers-To-Target-URI", F.regexp_replace("uri", "[\\r\\n]", "")), ("WARC-Refers-To-Date", F.col("date")),
            ("WARC-Concurrent-To", other), ("WARC-Source-Payload-Digest", F.col("_source")), ("WARC-Block-Digest", digest(block)),
            ("Content-Type", F.lit(content)), ("Content-Length", F.octet_length(block).cast("string")),
        ]
        head = F.concat(F.lit("WARC/1.1" + LINE), *(F.concat(F.lit(f"{name}: "), value, F.lit(LINE)) for name, value in lines))
        return F.concat(head, F.lit(LINE), block)

    both = F.array(
        record("metadata", F.col("_meta"), F.col("_conv"), "application/warc-fields", F.col("_fields")),
        record("conversion", F.col("_conv"), F.col("_meta"), "text/plain; charset=utf-8", F.col("_plain")),
    )
    return named.withColumn("_fields", fields).select(F.explode(both).alias("record"))


def write_warc(records: DataFrame, path: str) -> None:
    """Files of at most ``RECORDS_PER_FILE`` records."""
    records.select("record").write.mode("error").option("lineSep", LINE * 2).option("maxRecordsPerFile", RECORDS_PER_FILE).text(path)


READ_SCHEMA = "warc_type string, record_id string, refers_to string, uri string, concurrent_to string, source_digest string, block_digest string, content string"


def parsed(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of a file."""
    at = 0
    while (start := data.find(b"WARC/1.1\r\n", at)) >= 0:
        stop = data.index(b"\r\n\r\n", start)
        lines = data[start:stop].decode("utf-8").split("\r\n")[1:]
        headers = dict(line.split(": ", 1) if ": " in line else (line.rstrip(":"), "") for line in lines)
        size = int(headers["Content-Length"])
        yield headers, data[stop + 4 : stop + 4 + size]
        at = stop + 4 + size


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = [x.split()[0] for x in READ_SCHEMA.split(", ")]
    keys = ["WARC-Type", "WARC-Record-ID", "WARC-Refers-To", "WARC-Target-URI", "WARC-Concurrent-To", "WARC-Source-Payload-Digest", "WARC-Block-Digest"]
    for batch in batches:
        for content in batch.column(0):
            rows = [[h.get(k) for k in keys] + [b.decode("utf-8")] for h, b in parsed(content.as_py())]
            columns = zip(*rows, strict=True) if rows else [[]] * len(names)
            yield pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()) for c in columns], names)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).select("content").mapInArrow(_read, READ_SCHEMA)
