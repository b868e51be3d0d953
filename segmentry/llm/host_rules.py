"""Quality rules judged by host.

Every document is measured against rules of its own. The failures of each host (the source) are added up, the
host's failure rate is shrunk towards the mean of all hosts by a beta prior fitted to their rates, and a host
whose shrunk rate is high is rejected; its verdict is joined back to its documents. A host with few documents
stays near the mean, so one bad page does not decide it.

Defined results: null, empty and blank texts have no words and fail; a null source is a host of its own; with
one host, or equal rates, the prior is as heavy as ``PRIOR_ROWS`` documents; repeated rows count each; an empty
table gives no rows; other columns are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.session import checkpointed

SPACE = "[\\x20\\x09-\\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50
REPEAT_PERCENT = 50
WINDOW = 3
# Shrunk failure rates above this reject a host.
HOST_LIMIT = 0.8
PRIOR_ROWS = 10.0


def _without(text: Column, chars: str) -> Column:
    return F.length(F.translate(text, chars, ""))


def repeated_windows(words: Column) -> Column:
    """Start places (from 0, ascending) of the 3-word windows that occur twice or more."""
    grams = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - (WINDOW - 1), F.lit(0))),
        lambda w, i: F.struct(F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)).alias("h"), i.alias("i")),
    )
    return F.sort_array(grams)


def measured(docs: DataFrame, text_col: str, *keep: Column) -> DataFrame:
    """The rule figures of every whole text, without a shuffle."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE_CHARS))
    rows = docs.select(text.alias("_text"), F.when(trimmed == "", F.array().cast("array<string>")).otherwise(F.split(trimmed, SPACE + "+")).alias("_words"), *keep)
    names = [c for c in rows.columns if c not in ("_text", "_words")]
    rows = rows.withColumn("_grams", repeated_windows(F.col("_words")))
    same = lambda a, b: F.coalesce(a["h"] == b["h"], F.lit(False))
    repeated = F.filter(
        F.transform(
            "_grams",
            lambda g, i: F.when(same(g, F.get("_grams", i - 1)) | same(g, F.get("_grams", i + 1)), g["i"]).otherwise(-1),
        ),
        lambda i: i >= 0,
    )
    rows = rows.withColumn("_starts", F.sort_array(repeated))
    # Words under overlapping windows count once: a window adds what lies before the next one.
    nothing = F.struct(F.lit(0).cast("bigint").alias("n"), F.lit(-WINDOW).alias("last"))
    under = F.aggregate(
        "_starts",
        nothing,
        lambda seen, i: F.struct((seen["n"] + F.least(F.lit(WINDOW), i - seen["last"])).alias("n"), i.alias("last")),
        lambda seen: seen["n"],
    )
    lines = F.filter(F.split("_text", "\n"), lambda x: F.btrim(x, F.lit(SPACE_CHARS)) != "")
    return rows.select(
        *names,
        F.size("_words").cast("bigint").alias("n_words"),
        _without(F.col("_text"), SPACE_CHARS).cast("bigint").alias("word_chars"),
        (F.length("_text") - _without(F.col("_text"), SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size(lines) - F.size(F.array_distinct(lines))).cast("bigint").alias("n_dup_lines"),
        under.alias("n_repeat_words"),
    )


def host_verdicts(rows: DataFrame, limit: float = HOST_LIMIT) -> DataFrame:
    """``_host``, documents, failures, shrunk rate and verdict of each host, from rows of ``_host``, ``base_failed``."""
    hosts = rows.groupBy("_host").agg(F.count(F.lit(1)).alias("_docs"), F.sum(F.col("base_failed").cast("bigint")).alias("_failed"))
    rate = F.col("_failed") / F.col("_docs")
    # Method of moments over the hosts' rates; one row.
    mean, var = hosts.agg(F.avg(rate), F.var_pop(rate)).first()
    weight = PRIOR_ROWS
    if mean is not None and var and 0 < mean < 1:
        weight = max(mean * (1 - mean) / var - 1, PRIOR_ROWS)
    alpha = (mean or 0.0) * weight
    shrunk = (F.col("_failed") + F.lit(alpha)) / (F.col("_docs") + F.lit(weight))
    return hosts.withColumn("host_rate", shrunk).withColumn("host_kept", F.col("host_rate") <= limit)


def judge(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source", limit: float = HOST_LIMIT) -> DataFrame:
    """Figures, ``base_failed``, ``host_rate`` and ``kept`` of every row."""
    rows = measured(docs, text_col, F.col(id_col).alias("doc_id"), F.col(host_col).alias("_host"))
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_PERCENT * F.col("n_words"))
    rows = checkpointed(rows.withColumn("base_failed", failed))
    hosts = host_verdicts(rows, limit).select(F.col("_host").alias("_name"), "host_rate", "host_kept")
    return rows.join(hosts, F.col("_host").eqNullSafe(F.col("_name"))).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "host_rate",
        (~F.col("base_failed") & F.col("host_kept")).alias("kept"),
    )
