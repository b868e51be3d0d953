"""Review normalisation, review features, text cleaning, deduplication, requests."""

from __future__ import annotations

from pyspark.sql import functions as F

from segmentry import fixed_values as fv
from segmentry import schemas
from segmentry.functions import text as tx
from segmentry.operators import reviews as op
from segmentry.plans.inputs import MESSAGES_SQL, REVIEWS_SQL, messages, reviews, table, texts
from segmentry.plans.registry import query
from segmentry.session import scratch_path
from segmentry.sources import reviews as src
from segmentry.sources import tables

# White space as a character class of the comparison engine, which keeps the original patterns.
SPACES = r"\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
NOT_SPACE = f"[^{SPACES}]"
URLS = f"https?://{NOT_SPACE}+|www\\.{NOT_SPACE}+"
EMAILS = f"{NOT_SPACE}+@{NOT_SPACE}+\\.{NOT_SPACE}+"


def clean_sql(column: str) -> str:
    out = f"nfc_normalize(coalesce({column}, ''))"
    for pattern in (fv.HTML_TAG, URLS, EMAILS, f"[{SPACES}]+"):
        out = f"regexp_replace({out}, '{pattern}', ' ', 'g')"
    return f"trim({out})"


def count_sql(column: str, pattern: str) -> str:
    return f"len(regexp_extract_all({column}, '{pattern}'))"


STRIP_CHARS = "||".join(f"chr({ord(c)})" for c in tx.SPACE_CHARS)

# Source-style raw reviews: other column names, ids and ratings missing or broken in some rows.
RAW_SQL = """raw AS (
  SELECT CASE WHEN doc_id % 17 = 0 THEN NULL WHEN doc_id % 19 = 0 THEN '' ELSE concat('R', doc_id) END AS review_id,
    CASE WHEN doc_id % 23 = 0 THEN 'Too short.' ELSE concat('  ', text, chr(160), ' ') END AS review_body,
    CASE WHEN doc_id % 13 = 0 THEN NULL WHEN doc_id % 29 = 0 THEN 'x' WHEN doc_id % 31 = 0 THEN '4.7' ELSE CAST(1 + doc_id % 5 AS VARCHAR) END AS star_rating,
    CAST(doc_id % 200 AS VARCHAR) AS product_id, CAST(doc_id % 500 AS VARCHAR) AS customer_id, '2015-08-31' AS review_date
  FROM documents)"""


def raw_reviews(spark, sf):
    doc = F.col("doc_id")
    return texts(spark, sf, "documents", "doc_id").select(
        F.when(doc % 17 == 0, None).when(doc % 19 == 0, "").otherwise(F.concat(F.lit("R"), doc)).alias("review_id"),
        F.when(doc % 23 == 0, "Too short.")
        .otherwise(F.concat(F.lit("  "), "text", F.lit("\xa0 ")))
        .alias("review_body"),
        F.when(doc % 13 == 0, None)
        .when(doc % 29 == 0, "x")
        .when(doc % 31 == 0, "4.7")
        .otherwise((1 + doc % 5).cast("string"))
        .alias("star_rating"),
        (doc % 200).cast("string").alias("product_id"),
        (doc % 500).cast("string").alias("customer_id"),
        F.lit("2015-08-31").alias("review_date"),
    )


NORMAL_SQL = f"""normal AS (
  SELECT review_id AS id, trim(review_body, {STRIP_CHARS}) AS text,
    coalesce(CAST(trunc(TRY_CAST(star_rating AS DOUBLE)) AS INT), 0) AS rating, product_id, customer_id, review_date AS "timestamp"
  FROM raw WHERE review_id IS NOT NULL AND review_id <> '' AND review_body IS NOT NULL AND length(review_body) >= 20)"""


@query(f"WITH {RAW_SQL}, {NORMAL_SQL} SELECT * FROM normal")
def review_normalize(spark, sf):
    return src.normalize(raw_reviews(spark, sf)).select(*schemas.REVIEW.fieldNames())


@query(
    """SELECT count(*) FILTER (doc_id % 13 = 0) AS missing, count(*) FILTER (doc_id % 13 <> 0 AND doc_id % 29 = 0) AS unreadable FROM documents"""
)
def bad_ratings(spark, sf):
    return src.bad_ratings(raw_reviews(spark, sf))


def _read_back(spark, sf, suffix, multi_line=False):
    path = scratch_path(spark, "reviews") + suffix
    tables.write_json(raw_reviews(spark, sf), path)
    return src.load_all(spark, path).select(*schemas.REVIEW.fieldNames())


@query(f"WITH {RAW_SQL}, {NORMAL_SQL} SELECT * FROM normal")
def json_scan(spark, sf):
    """Raw reviews written as JSON lines, scanned back with the fixed schema and normalised."""
    return _read_back(spark, sf, ".jsonl")


@query(f"WITH {RAW_SQL}, {NORMAL_SQL} SELECT * FROM normal")
def parquet_scan(spark, sf):
    path = scratch_path(spark, "reviews")
    raw_reviews(spark, sf).write.parquet(path)
    return src.normalize(src.read_parquet(spark, path)).select(*schemas.REVIEW.fieldNames())


@query(
    """WITH numbered AS (SELECT doc_id, row_number() OVER (ORDER BY doc_id) AS rn, count(*) OVER () AS n FROM documents)
    SELECT doc_id, CAST((rn - 1) // 64 AS BIGINT) AS batch_index, CAST(least(((rn - 1) // 64 + 1) * 64, n) AS BIGINT) AS total_records FROM numbered"""
)
def batched_read(spark, sf):
    return src.with_batches(table(spark, sf, "documents").select("doc_id"), "doc_id", 64)


@query(
    """SELECT DISTINCT url AS path FROM pages WHERE url NOT IN (SELECT url FROM pages WHERE contains(html, 'lang="de"'))"""
)
def unseen_paths(spark, sf):
    """Page addresses as input paths; the German pages were recorded by an earlier run."""
    pages = table(spark, sf, "pages").select("html", F.col("url").alias("path"))
    return src.unseen_paths(pages, pages.where(F.contains("html", F.lit('lang="de"'))))


WORDS = "[\\p{L}\\p{N}_]+"
POSITIVE = "['" + "','".join(fv.POSITIVE_WORDS) + "']"
NEGATIVE = "['" + "','".join(fv.NEGATIVE_WORDS) + "']"
LEXICON_SQL = f"""lexicon AS (
  SELECT id, len(list_intersect(words, {POSITIVE})) AS p, len(list_intersect(words, {NEGATIVE})) AS n
  FROM (SELECT id, list_distinct(regexp_extract_all(lower(text), '{WORDS}')) AS words FROM reviews)),
sentiment AS (SELECT id, CASE WHEN p + n > 0 THEN round_even((p - n) / (p + n) * 1000, 0) / 1000 ELSE 0.0 END AS sentiment_proxy FROM lexicon)"""


@query(
    f"""WITH {REVIEWS_SQL}, {LEXICON_SQL}
    SELECT r.id, CAST(length(text) AS INT) AS text_length, CAST({count_sql('text', NOT_SPACE + '+')} AS INT) AS word_count,
      CAST(contains(text, '!') AS INT) AS has_exclamation, CAST(contains(text, '?') AS INT) AS has_question,
      CAST(rating >= 4 AS INT) AS is_positive, CAST(rating <= 2 AS INT) AS is_negative, sentiment_proxy
    FROM reviews r JOIN sentiment s ON r.id = s.id"""
)
def review_features(spark, sf):
    return op.with_review_features(reviews(spark, sf)).drop("text", "rating", "product_id", "customer_id", "lang")


@query(
    f"""WITH {REVIEWS_SQL}, {LEXICON_SQL} SELECT sentiment_proxy, count(*) AS reviews FROM sentiment GROUP BY 1"""
)
def sentiment_proxy(spark, sf):
    scored = reviews(spark, sf).select(tx.sentiment_proxy(F.col("text")).alias("sentiment_proxy"))
    return scored.groupBy("sentiment_proxy").agg(F.count(F.lit(1)).alias("reviews"))


@query(f"SELECT doc_id, {clean_sql('text')} AS clean FROM documents")
def text_clean(spark, sf):
    return op.with_clean_text(texts(spark, sf, "documents", "doc_id")).select("doc_id", "clean")


@query(f"SELECT page_id, {clean_sql('html')} AS clean FROM pages")
def page_clean(spark, sf):
    return op.with_clean_text(texts(spark, sf, "pages", "page_id"), "html").select("page_id", "clean")


@query(
    f"""SELECT page_id, trim(regexp_replace(concat(url, ' ', regexp_replace(nfc_normalize(html), '{fv.HTML_TAG}', ' ', 'g')), '[{SPACES}]+', ' ', 'g')) AS kept,
      {clean_sql("concat(url, ' ', html)")} AS removed FROM pages"""
)
def address_options(spark, sf):
    """Addresses kept and removed: the page's own address is put in front of its text."""
    text = F.concat_ws(" ", "url", "html")
    return texts(spark, sf, "pages", "page_id").select(
        "page_id",
        tx.clean_text(text, remove_urls=False, remove_emails=False).alias("kept"),
        tx.clean_text(text).alias("removed"),
    )


@query(f"SELECT doc_id, substr({clean_sql('text')}, 1, 3072) AS clean FROM documents")
def text_truncate(spark, sf):
    """The cleaner's own length limit, the one place where a text is cut; everything else reads whole texts."""
    return op.with_clean_text(texts(spark, sf, "documents", "doc_id"), max_chars=tx.truncation_limit()).select("doc_id", "clean")


@query(f"SELECT doc_id, CAST(length({clean_sql('text')}) >= 200 AS INT) AS is_valid FROM documents")
def text_valid(spark, sf):
    clean = op.with_clean_text(texts(spark, sf, "documents", "doc_id"))
    return clean.select("doc_id", tx.is_long_enough(F.col("clean"), 200).cast("int").alias("is_valid"))


@query(f"SELECT doc_id, sha256({clean_sql('text')}) AS fingerprint FROM documents")
def text_fingerprint(spark, sf):
    clean = op.with_clean_text(texts(spark, sf, "documents", "doc_id"))
    return clean.select("doc_id", tx.fingerprint(F.col("clean")).alias("fingerprint"))


CLEAN_SQL = f"cleaned AS (SELECT doc_id, {clean_sql('text')} AS clean FROM documents)"


@query(f"WITH {CLEAN_SQL} SELECT min(doc_id) AS doc_id, sha256(clean) AS fingerprint FROM cleaned GROUP BY clean")
def text_dedup(spark, sf):
    clean = op.with_clean_text(texts(spark, sf, "documents", "doc_id")).select("doc_id", "clean")
    return op.deduplicate(clean, "clean", "doc_id").select("doc_id", "fingerprint")


@query(
    f"""WITH {CLEAN_SQL} SELECT min(doc_id) AS doc_id, clean FROM cleaned
    WHERE length({clean_sql('clean')}) >= 10 GROUP BY clean"""
)
def batch_clean(spark, sf):
    return op.batch_clean(texts(spark, sf, "documents", "doc_id"), "doc_id", drop_duplicates=True)


TAG_SQL = f"""{CLEAN_SQL},
tags AS (SELECT doc_id, CASE WHEN length(clean) < 200 THEN 'filtered'
  WHEN row_number() OVER (PARTITION BY length(clean) < 200, clean ORDER BY doc_id) = 1 THEN 'valid' ELSE 'duplicate' END AS reason FROM cleaned)"""


@query(f"WITH {TAG_SQL} SELECT doc_id, reason FROM tags")
def preprocess_tags(spark, sf):
    return op.tagged(texts(spark, sf, "documents", "doc_id"), "doc_id", min_length=200).select("doc_id", "reason")


@query(
    f"""WITH {TAG_SQL} SELECT count(*) AS total, count(*) FILTER (reason = 'filtered') AS filtered,
    count(*) FILTER (reason = 'duplicate') AS duplicates, count(*) FILTER (reason = 'valid') AS valid FROM tags"""
)
def preprocess_counts(spark, sf):
    return op.preprocess_counts(texts(spark, sf, "documents", "doc_id"), min_length=200)


@query("SELECT doc_id, lang, n_chars FROM documents WHERE lang = 'en'")
def language_filter(spark, sf):
    return op.in_language(texts(spark, sf, "documents", "doc_id")).select("doc_id", "lang", "n_chars")


REASON_SQL = """CASE WHEN record_id IS NULL THEN 'missing record_id' WHEN length(text) < 1 THEN 'empty text'
  WHEN length(text) > 10000 THEN 'text too long' END"""


@query(f"WITH {MESSAGES_SQL} SELECT row_id, record_id FROM messages WHERE {REASON_SQL} IS NULL")
def request_validation(spark, sf):
    return op.validate_requests(messages(spark, sf))[0].select("row_id", "record_id")


@query(f"WITH {MESSAGES_SQL} SELECT row_id, {REASON_SQL} AS reason FROM messages WHERE {REASON_SQL} IS NOT NULL")
def request_rejections(spark, sf):
    return op.validate_requests(messages(spark, sf))[1].select("row_id", "reason")
