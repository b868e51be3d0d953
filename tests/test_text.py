from __future__ import annotations

import hashlib
import re
import unicodedata

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from segmentry.functions import text as tx
from segmentry.operators import reviews as op
from segmentry.sources import reviews as src


def python_clean(text, urls=True, emails=True):
    """The definition, in plain Python."""
    if not text:
        return ""
    text = re.sub(r"<[^>]+>", " ", unicodedata.normalize("NFC", text))
    if urls:
        text = re.sub(r"https?://\S+|www\.\S+", " ", text)
    if emails:
        text = re.sub(r"\S+@\S+\.\S+", " ", text)
    return re.sub(r"\s+", " ", text).strip()


def cleaned(spark, texts, **options):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    return [r["c"] for r in df.select("i", tx.clean_text(F.col("t"), **options).alias("c")).orderBy("i").collect()]


CASES = [
    "<p>Great <b>product</b>!</p>",
    "See https://example.com/x?y=1 and www.example.org now",
    "write to a.b@example.com, please",
    "Hello    world\n\n\tthere",
    "Café été Å",
    "non\xa0breaking em\x1cfile　wide",
    "@home a@b @c.d x@y.z@w.v. a@.b",
    "1 < 2 and 3 > 2 <<a>b>",
    "", "   ", None, "<>", "a@b", "http://", "x@y.z",
    "ends with ", "​zero width stays", "mixed@\nline.break",
]


def test_cleaning_cases(spark):
    assert cleaned(spark, CASES) == [python_clean(t) for t in CASES]
    assert cleaned(spark, CASES, remove_urls=False, remove_emails=False) == [python_clean(t, False, False) for t in CASES]
    assert cleaned(spark, ["Hello    world\n\n\tthere"]) == ["Hello world there"]


alphabet = st.sampled_from(list("ab @.<>/:wht ps\n\t\xa0 \x1c\x85ȩ́Å가\U0001f600"))


@settings(max_examples=5, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet, max_size=30), min_size=200, max_size=200))
def test_cleaning_equals_its_definition(spark, texts):
    assert cleaned(spark, texts) == [python_clean(t) for t in texts]


def test_truncation_keeps_whole_texts_unless_asked(spark):
    long = "word " * 2000
    whole, cut = cleaned(spark, [long])[0], cleaned(spark, [long], max_chars=tx.truncation_limit())[0]
    assert len(whole) == len(long.strip())
    assert cut == whole[:3072]


def test_word_count_and_sentiment(spark):
    texts = ["", "  ", "one", " two\xa0words ", "Great great LOVE!", "great and terrible", "greatest loves", "awful, useless.", None]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", tx.word_count(F.col("t")).alias("n"), tx.sentiment_proxy(F.col("t")).alias("s")).orderBy("i").collect()
    assert [r["n"] for r in rows] == [len((t or "").split()) for t in texts]
    assert [r["s"] for r in rows] == [0.0, 0.0, 0.0, 0.0, 1.0, 0.0, 0.0, -1.0, 0.0]


def test_sentiment_rounding(spark):
    df = spark.createDataFrame([("great love awful",), ("great broken awful worst useless terrible",)], "t string")
    assert [r[0] for r in df.select(tx.sentiment_proxy(F.col("t"))).collect()] == [0.333, -0.667]


def test_review_features(spark):
    df = spark.createDataFrame([("a", "I love it! Great?", 5), ("b", "The worst.", 1), ("c", None, None)], "id string, text string, rating int")
    a, b, c = op.with_review_features(df).orderBy("id").collect()
    assert (a["text_length"], a["word_count"], a["has_exclamation"], a["has_question"]) == (17, 4, 1, 1)
    assert a["sentiment_proxy"] > 0 > b["sentiment_proxy"]
    assert (a["is_positive"], a["is_negative"], b["is_positive"], b["is_negative"]) == (1, 0, 0, 1)
    assert (c["text_length"], c["word_count"], c["is_positive"], c["is_negative"]) == (0, 0, 0, 0)
    plain = op.with_review_features(df.drop("rating")).first()
    assert (plain["is_positive"], plain["is_negative"]) == (0, 0)


def test_fingerprint_and_length(spark):
    df = spark.createDataFrame([("same  text",), ("same text",)], "t string")
    prints = {r[0] for r in df.select(tx.clean_text(F.col("t")).alias("c")).select(tx.fingerprint(F.col("c"))).collect()}
    assert prints == {hashlib.sha256(b"same text").hexdigest()}
    assert len(prints.pop()) == 64


def test_batch_clean_keeps_row_ids(spark):
    texts = ["A long enough text", "short", "", "Another long enough text"]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    assert sorted(r["i"] for r in op.batch_clean(df, "i").collect()) == [0, 3]
    assert op.batch_clean(df, "i", filter_invalid=False).count() == 4
    doubled = spark.createDataFrame([(0, "The same long text"), (1, "The  same long text"), (2, "A different text")], "i int, text string")
    assert sorted(r["i"] for r in op.batch_clean(doubled, "i", drop_duplicates=True).collect()) == [0, 2]


def test_tags_with_a_hot_text(spark):
    rows = [(i, "one text in a third of all rows" if i % 3 == 0 else f"text number {i} of the table") for i in range(3000)]
    rows += [(3000, "tiny")]
    df = spark.createDataFrame(rows, "i int, text string")
    counts = {r["reason"]: r["count"] for r in op.tagged(df, "i").groupBy("reason").count().collect()}
    assert counts == {"valid": 2001, "duplicate": 999, "filtered": 1}
    row = op.preprocess_counts(df).first()
    assert (row["total"], row["filtered"], row["duplicates"], row["valid"]) == (3001, 1, 999, 2001)
    kept = op.tagged(df, "i").where("reason = 'valid'").agg(F.min("i"), F.count_if(F.col("i") % 3 == 0)).first()
    assert tuple(kept) == (0, 1)


def test_first_wins_is_cut_before_the_shuffle(spark):
    df = spark.range(100).select(F.col("id"), (F.col("id") % 3).cast("string").alias("clean"))
    plan = op.deduplicate(df, "clean", "id")._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan and plan.index("Final") < plan.index("Exchange") < plan.index("Partial")


def test_cleaning_runs_once_per_row(spark, sf):
    df = op.with_clean_text(spark.read.parquet(f"{sf}/documents.parquet")).where(F.length("clean") >= 10)
    plan = df.select("doc_id", tx.fingerprint(F.col("clean")), "clean")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("java_method") == 1


@pytest.mark.parametrize("suffix", ["reviews.jsonl", "reviews.json"])
def test_json_files(spark, tmp_path, sample_reviews, suffix):
    import json

    target = tmp_path / suffix
    lines = "\n".join(json.dumps(r) for r in sample_reviews) + "\n\n"
    target.write_text(lines if suffix.endswith("jsonl") else json.dumps(sample_reviews))
    rows = src.load_all(spark, str(target)).collect()
    assert len(rows) == 100
    assert rows[0]["source_file"].endswith(suffix)
    assert sorted(r["rating"] for r in rows)[0] == 1
    assert src.load_all(spark, str(target), min_chars=100).count() == 0


def test_missing_file_raises(spark):
    from pyspark.errors import AnalysisException

    with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
        src.load_all(spark, "/tmp/no/such/file.jsonl")


def test_normalisation(spark):
    raw = spark.createDataFrame(
        [
            ("r1", None, "  Great product overall! ", "5"),
            ("r2", None, "Hi", "4"),
            ("", None, "A text that is long enough", "4"),
            (None, "old", "A text that is long enough", "4.7"),
            ("r5", "old", "A text that is long enough", "x"),
            ("r6", None, None, "1"),
            ("r7", None, " " * 25, None),
        ],
        "review_id string, id string, review_body string, star_rating string",
    )
    rows = {r["id"]: r for r in src.normalize(raw).collect()}
    assert set(rows) == {"r1", "old", "r5", "r7"}
    assert rows["r1"]["text"] == "Great product overall!"
    assert (rows["r1"]["rating"], rows["old"]["rating"], rows["r5"]["rating"], rows["r7"]["rating"]) == (5, 4, 0, 0)
    assert rows["r7"]["text"] == ""
    bad = src.bad_ratings(raw).first()
    assert (bad["missing"], bad["unreadable"]) == (1, 1)


def test_batches(spark):
    df = spark.range(0, 250).select((F.col("id") * 7).alias("i")).repartition(8)
    out = src.with_batches(df, "i", 100).collect()
    sizes = {}
    for r in out:
        sizes.setdefault((r["batch_index"], r["total_records"]), []).append(r["i"])
    assert {k: len(v) for k, v in sizes.items()} == {(0, 100): 100, (1, 200): 100, (2, 250): 50}
    assert max(sizes[(0, 100)]) < min(sizes[(1, 200)])


def test_request_validation(spark):
    rows = [("a", "fine"), (None, "no id"), ("b", ""), ("c", None), ("d", "x" * 10_000), ("e", "x" * 10_001)]
    ok, rejected = op.validate_requests(spark.createDataFrame(rows, "record_id string, text string"))
    assert sorted(r["record_id"] for r in ok.collect()) == ["a", "d"]
    assert sorted((r["record_id"] or "", r["reason"]) for r in rejected.collect()) == [
        ("", "missing record_id"), ("b", "empty text"), ("c", "empty text"), ("e", "text too long"),
    ]
