"""The queries of this folder and the SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from segmentry.llm import chat, decontamination, host_rules, language, licenses, manifest, mixing, near_dups, secret_scan, substrings, token_files, warc, whitening
from segmentry.session import scratch_path

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def add(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return add


def documents(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/documents.parquet")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


OP1_SQL = """
WITH RECURSIVE w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
  FROM documents),
s AS (
  SELECT doc_id, CASE WHEN len(words) = 0 THEN [] WHEN len(words) = 1 THEN [words[1]]
    ELSE list_distinct(list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1])) END AS sh
  FROM w),
sized AS (SELECT doc_id, CAST(len(sh) AS BIGINT) AS n, sh FROM s),
e AS (SELECT doc_id, n, unnest(sh) AS g FROM sized),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM e a JOIN e b ON a.g = b.g AND a.doc_id <> b.doc_id AND a.n * 5 >= b.n * 4 AND b.n * 5 >= a.n * 4
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach(x, y) AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x),
least AS (SELECT x, min(y) AS m FROM reach GROUP BY x)
SELECT doc_id, n AS n_shingles, least(doc_id, coalesce(m, doc_id)) AS component_id, doc_id = least(doc_id, coalesce(m, doc_id)) AS kept
FROM sized LEFT JOIN least ON x = doc_id"""


@query(OP1_SQL)
def op1_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    found = near_dups.near_duplicates(documents(spark, sf), shingle_words=2, percent=80)
    return found.select("doc_id", "n_shingles", "component_id", "kept")


@query()
def op2_license_scan(spark: SparkSession, sf: str) -> DataFrame:
    return licenses.scan(documents(spark, sf))


@query()
def op3_decontamination(spark: SparkSession, sf: str) -> DataFrame:
    return decontamination.find_leaks(documents(spark, sf), spark.read.parquet(f"{sf}/benchmark.parquet"))


OP4_SQL = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]' UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
e AS (
  SELECT *, regexp_replace(role, '<(\\*)(\|(?:turn|text|more|end)\|>)', '<\\\1\2', 'g') AS r,
    regexp_replace(text, '<(\\*)(\|(?:turn|text|more|end)\|>)', '<\\\1\2', 'g') AS t,
    lag(role) OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS before FROM c)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(t) + CASE WHEN before IS NULL THEN length(r) + 16 WHEN before = role THEN 8 ELSE length(r) + 23 END) + 7 AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id"""


@query(OP4_SQL)
def op4_chat_format(spark: SparkSession, sf: str) -> DataFrame:
    own = "</s>[INST] ok [/INST]"
    turns = spark.read.parquet(f"{sf}/conversations.parquet").select("conv_id", "turn", "role", "text")
    more = spark.createDataFrame([(-7, 0, "user", own), (-7, 1, "assistant", own)], turns.schema)
    done = chat.format_conversations(turns.unionByName(more))
    read = done.select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"),
        chat.loss_text(F.col("formatted"), F.col("loss")).alias("learned"),
    )
    lines = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return read.select(
        "conv_id", F.size("turns").cast("bigint").alias("n_turns"), F.sha2(lines.cast("binary"), 256).alias("turns_sha256"),
        F.length("learned").cast("bigint").alias("loss_chars"), F.sha2(F.col("learned").cast("binary"), 256).alias("loss_sha256"),
        F.length("formatted").cast("bigint").alias("formatted_chars"),
    )


@query()
def op5_language_id(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf)
    model = language.train(docs)
    held = docs.withColumn("held_out", language.held_out())
    return language.predict(held, model, keep=("doc_id", "held_out"))


OP6_SQL = r"""
WITH p AS (SELECT page_id, coalesce(url, '') AS uri, coalesce(html, '') AS html FROM pages),
r AS (
  SELECT *, md5('response' || chr(10) || uri || chr(10) || html) AS h,
    trim(regexp_replace(replace(replace(replace(replace(replace(replace(
      regexp_replace(html, '(?is)<!--.*?-->|<script\b.*?</script\s*>|<style\b.*?</style\s*>|<[^>]*>', ' ', 'g'),
      '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&nbsp;', ' '), '&amp;', '&'), '[\x20\x09-\x0D]+', ' ', 'g'), ' ') AS plain
  FROM p)
SELECT page_id, uri AS target_uri, concat('<urn:uuid:', h[1:8], '-', h[9:12], '-', h[13:16], '-', h[17:20], '-', h[21:32], '>') AS refers_to,
  concat('sha256:', sha256(html)) AS source_digest, concat('sha256:', sha256(plain)) AS text_digest,
  CAST(length(plain) AS BIGINT) AS text_chars, true AS linked,
  concat('http-content-type: text/html; charset=utf-8', chr(13), chr(10), 'source-digest: sha256:', sha256(html), chr(13), chr(10),
    'source-bytes: ', strlen(html), chr(13), chr(10)) AS metadata
FROM r"""


@query(OP6_SQL)
def op6_warc_derivatives(spark: SparkSession, sf: str) -> DataFrame:
    """Writes the derived records of all pages and reads them back from the files."""
    source = warc.responses(spark.read.parquet(f"{sf}/pages.parquet"))
    path = scratch_path(spark, "warc")
    warc.write_warc(warc.derived(source), path)
    read = warc.read_warc(spark, path)
    # Narrow columns only: one metadata and one conversion record of each response.
    narrow = read.select(
        "warc_type", "record_id", "refers_to", "concurrent_to", "source_digest", "block_digest", "uri",
        F.length("content").cast("bigint").alias("chars"), F.when(F.col("warc_type") == "metadata", F.col("content")).alias("fields"),
        (warc.digest(F.col("content")) == F.col("block_digest")).alias("intact"),
    )
    kind = lambda k, c: F.max(F.when(F.col("warc_type") == k, F.col(c)))
    pairs = narrow.groupBy("refers_to", "uri", "source_digest").agg(
        kind("conversion", "block_digest").alias("text_digest"), kind("conversion", "chars").alias("text_chars"),
        (F.min("intact") & kind("conversion", "record_id").eqNullSafe(kind("metadata", "concurrent_to"))
         & kind("metadata", "record_id").eqNullSafe(kind("conversion", "concurrent_to"))).alias("linked"),
        kind("metadata", "fields").alias("metadata"),
    )
    pages = source.select("page_id", "record_id")
    return pages.join(pairs, pages["record_id"] == pairs["refers_to"]).select(
        "page_id", F.col("uri").alias("target_uri"), "refers_to", "source_digest", "text_digest", "text_chars", "linked", "metadata"
    )


OP7_SQL = """
WITH w AS (
  SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words FROM documents),
g AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS gram FROM (SELECT doc_id, words, unnest(range(1, len(words) - 11)) AS i FROM w)),
f AS (SELECT gram, min(doc_id) AS first_doc FROM g GROUP BY gram),
gone AS (
  SELECT DISTINCT doc_id, i + j AS pos FROM g JOIN f USING (gram), range(13) r(j) WHERE first_doc < doc_id),
gone_list AS (SELECT doc_id, list(pos) AS places FROM gone GROUP BY doc_id),
kept AS (
  SELECT doc_id, words, CASE WHEN places IS NULL THEN words ELSE list_filter(words, lambda x, i: NOT list_contains(places, i)) END AS kept
  FROM w LEFT JOIN gone_list USING (doc_id))
SELECT doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - len(kept) AS BIGINT) AS n_removed,
  sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM kept"""


@query(OP7_SQL)
def op7_repeated_passages(spark: SparkSession, sf: str) -> DataFrame:
    return substrings.remove_repeats(documents(spark, sf), with_text=False).drop("kept_text")


@query()
def op8_token_files(spark: SparkSession, sf: str) -> DataFrame:
    path = scratch_path(spark, "tokens")
    token_files.write_token_files(documents(spark, sf), path, tokenizer_path())
    return token_files.read_digests(spark, path)


OP9_SQL = r"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, source, coalesce(text, '') AS text FROM documents),
w AS (SELECT *, list_filter(regexp_split_to_array(text, '[\x20\x09-\x0D]+'), lambda x: x <> '') AS words FROM d),
g AS (
  SELECT rid, i, array_to_string(words[i:i + 2], ' ') AS gram FROM (SELECT rid, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
twice AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, gram) AS n FROM g) WHERE n > 1),
rep AS (SELECT rid, count(DISTINCT i + j) AS n FROM twice, range(3) r(j) GROUP BY rid),
f AS (
  SELECT doc_id, source, CAST(len(words) AS BIGINT) AS n_words,
    CAST(list_sum(list_transform(words, lambda x: length(x))) AS BIGINT) AS wc,
    CAST(length(text) - length(translate(text, '#*$%&|<>', '')) AS BIGINT) AS n_symbols,
    list_filter(string_split(text, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, coalesce(n, 0) AS n_repeat_words
  FROM w LEFT JOIN rep USING (rid)),
b AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM f),
h AS (SELECT source, count(*) AS docs, count(*) FILTER (base_failed) AS failed FROM b GROUP BY source),
m AS (SELECT avg(failed / docs) AS mean, var_pop(failed / docs) AS var FROM h),
p AS (SELECT mean, CASE WHEN var > 0 AND mean > 0 AND mean < 1 THEN greatest(mean * (1 - mean) / var - 1, 10) ELSE 10 END AS weight FROM m),
v AS (SELECT source, (failed + mean * weight) / (docs + weight) <= 0.8 AS good FROM h, p)
SELECT doc_id, n_words, coalesce(wc, 0) AS word_chars, n_symbols, CAST(len(lines) - len(list_distinct(lines)) AS BIGINT) AS n_dup_lines,
  n_repeat_words, base_failed, NOT base_failed AND good AS kept
FROM b JOIN v ON b.source IS NOT DISTINCT FROM v.source"""


@query(OP9_SQL)
def op9_host_rules(spark: SparkSession, sf: str) -> DataFrame:
    return host_rules.judge(documents(spark, sf)).drop("host_rate")


@query()
def op10_mix_sources(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix(documents(spark, sf)).select(
        "doc_id", "size", "source_size", "target", "taken", F.col("source").alias("source"), "times"
    )


@query()
def op11_whitening(spark: SparkSession, sf: str) -> DataFrame:
    return whitening.whiten(spark.read.parquet(f"{sf}/embeddings.parquet"))


@query()
def op12_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    found = secret_scan.scan(documents(spark, sf))
    base = F.filter("secrets", lambda x: x["kind"] != "random")
    number = lambda kind: F.size(F.filter("secrets", lambda x: x["kind"] == kind)).cast("bigint").alias(f"n_{kind}")
    line = lambda spans: F.array_join(F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"])), ",")
    return found.select(
        "doc_id", number("assign"), number("access"), number("hex"), number("random"),
        F.sha2(line(base).cast("binary"), 256).alias("base_sha256"), line(F.col("secrets")).alias("spans"),
    )


# Trees of up to 16^5 leaves a source and 16^3 sources.
def op13_sql(leaf_levels: int = 5, source_levels: int = 3) -> str:
    field = lambda x: f"coalesce(strlen(CAST({x} AS VARCHAR)) || ':' || {x}, '-')"
    leaf = lambda text: f"sha256({' || '.join(field(c) for c in ('doc_id', 'source', 'lang', 'n_chars', text))})"
    low = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
    bits = "flatten(list_transform(range(1, length(i) + 1), lambda k: [CAST(ascii(i[k]) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))"
    crc = f"xor(list_reduce(list_concat([4294967295], {bits}), lambda c, b: xor(xor(c, b) >> 1, 3988292384 * (xor(c, b) & 1))), 4294967295)"
    parts = [
        "d AS (SELECT row_number() OVER () AS rid, CAST(doc_id AS VARCHAR) AS i, * FROM documents)",
        f"l AS (SELECT rid, doc_id, source, {leaf('text')} AS leaf, CASE WHEN {crc} % 5 = 0 THEN {leaf(low)} END AS changed FROM d)",
        "src AS (SELECT source, row_number() OVER (ORDER BY source NULLS FIRST) - 1 AS s FROM (SELECT DISTINCT source FROM documents))",
        "a AS (SELECT l.*, s, row_number() OVER (PARTITION BY s ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM l JOIN src ON l.source IS NOT DISTINCT FROM src.source)",
        "n0 AS (SELECT s, pos AS p, leaf AS digest FROM a)",
    ]
    joins, siblings = [], []

    def tree(name: str, levels: int, place: str) -> None:
        for k in range(levels):
            others = lambda frame: f"coalesce(string_agg(digest, '') OVER (PARTITION BY s, p // 16 ORDER BY p ROWS BETWEEN {frame}), '')"
            parts.append(
                f"{name}p{k} AS (SELECT s, p, digest, count(*) OVER (PARTITION BY s) > 1 AS more, "
                f"{others('UNBOUNDED PRECEDING AND 1 PRECEDING')} AS l, {others('1 FOLLOWING AND UNBOUNDED FOLLOWING')} AS r FROM {name}n{k})"
            )
            parts.append(
                f"{name}n{k + 1} AS (SELECT s, p // 16 AS p, CASE WHEN more THEN sha256(string_agg(digest, '' ORDER BY p)) ELSE min(digest) END AS digest "
                f"FROM {name}p{k} GROUP BY s, p // 16, more)"
            )
            t, on = f"{name}t{k}", "a.s" if not name else "0"
            joins.append(f"JOIN {name}p{k} {t} ON {t}.s = {on} AND {t}.p = {place} // {16**k}")
            siblings.append(f"{t}.l || {t}.r")

    tree("", leaf_levels, "pos")
    parts.append(f"topn0 AS (SELECT 0 AS s, s AS p, digest FROM n{leaf_levels})")
    tree("top", source_levels, "a.s")
    # Each level's fold is a column of its own, so that the expression does not double from level to level.
    steps, at = [], "coalesce(changed, leaf)"
    names = [f"t{k}" for k in range(leaf_levels)] + [f"topt{k}" for k in range(source_levels)]
    for t in names:
        steps.append(f"CASE WHEN {t}.more THEN sha256({t}.l || {at} || {t}.r) ELSE {at} END AS f_{t}")
        at = f"f_{t}"
    return (
        "WITH " + ",\n".join(parts) + f"\nSELECT doc_id, leaf, u.digest AS subroot, w.digest AS root, sha256({' || '.join(siblings)}) AS proof_sha256, "
        + ", ".join(steps) + f", {at} AS folded_root, folded_root = root AS verified FROM a " + " ".join(joins)
        + f" JOIN n{leaf_levels} u ON u.s = a.s, topn{source_levels} w"
    )


@query(f"SELECT doc_id, leaf, subroot, root, proof_sha256, folded_root, verified FROM ({op13_sql()})")
def op13_merkle_manifest(spark: SparkSession, sf: str) -> DataFrame:
    return manifest.prove(documents(spark, sf), tampered=manifest.lower_cased())
