"""Near-duplicate documents by HyperMinHash.

Documents with the same set of word shingles form one class. For each class a sketch of ``bands * rows``
buckets is kept: every shingle falls into one bucket, the bucket keeps its smallest hash as a leading-zero count
(6 bits) and the 10 bits behind the leading one, and an empty bucket borrows from the occupied bucket that
stands first in an order of its own. Bands of registers are hashed; classes with an equal band are candidates.

Candidates are compared without making all pairs of a bucket:
1. every class is compared with the smallest class of each of its buckets;
2. what is confirmed is joined to components. Classes of buckets that then still hold several components are
   joined by their rarest shingles, as many as a similar pair must share (``_pairs_across``), and pairs in
   different components are compared in rounds, the nearest pairs of each component first; what is confirmed
   contracts components, and pairs inside one are dropped. A bucket of a thousand copies is one component by then.
So every similar pair that a band finds is either compared or known to be connected.

A comparison first estimates the similarity from the sketches, corrected for registers that agree by chance,
and drops pairs that are far below; the rest is confirmed on the full sets of shingles of the whole texts.
A pair at a similarity of exactly 0.8 is missed by all of 32 bands of 5 with a chance of 3 in a million.

Defined results: a text with fewer words than a shingle is one shingle; null, empty and blank texts have none,
are linked with nothing and kept. Repeated rows are copies of each other. A null id is never the id of a
component that has another id. Other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from segmentry.llm.hashing import WordHashes, mixed, row_hash, windows, words_of
from segmentry.operators.components import connected_components
from segmentry.session import checkpointed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BANDS = 32
ROWS = 5
ZERO_BITS, MANTISSA_BITS = 6, 10
# Estimates so far below the limit are not confirmed; more than seven standard deviations at 160 registers.
MARGIN = 0.25
# Parities that travel with each shingle, and those that are compared for each pair that is left.
PARITY_BITS = 256
SIGN_BITS = 2048
# Up to so many links and open pairs (three binary ids and two numbers each) are counted and handled in one task.
TASK_ROWS = 200_000
# The pairs for a component grow by this factor from round to round.
ROUND_FACTOR = 8
SHINGLE_WORDS = 5
PERCENT = 80


def shingle_hashes(words: list[bytes], size: int, memory: WordHashes) -> np.ndarray:
    """Sorted distinct hashes of all shingles."""
    if not words:
        return np.empty(0, np.uint64)
    return np.unique(windows(memory.of(words), min(size, len(words))))


def bucket_order(k: int) -> np.ndarray:
    """For each bucket a fixed order of all buckets."""
    grid = np.arange(k * k, dtype=np.uint64).reshape(k, k)
    return mixed(grid + np.uint64(0x5BD1E995))


def registers(hashes: np.ndarray, k: int, order: np.ndarray) -> np.ndarray:
    """k registers of 16 bits of a non-empty set."""
    bucket = ((hashes >> np.uint64(32)) * np.uint64(k)) >> np.uint64(32)
    least = np.full(k, np.iinfo(np.uint64).max, np.uint64)
    np.minimum.at(least, bucket.astype(np.int64), mixed(hashes + np.uint64(1)))
    used = np.zeros(k, bool)
    used[bucket.astype(np.int64)] = True
    if not used.all():
        full, empty = np.flatnonzero(used), np.flatnonzero(~used)
        least[empty] = least[full[order[np.ix_(empty, full)].argmin(1)]]
    fraction, exponent = np.frexp(least.astype(np.float64))
    zeros = np.minimum(64 - exponent, (1 << ZERO_BITS) - 1)
    mantissa = np.minimum(((fraction - 0.5) * (2 << MANTISSA_BITS)).astype(np.int64), (1 << MANTISSA_BITS) - 1)
    return (zeros << MANTISSA_BITS | mantissa).astype(np.uint16)


def band_keys(regs: np.ndarray, bands: int, rows: int) -> np.ndarray:
    """Keys of all bands of (n, bands * rows) registers, as signed integers."""
    grid = regs.reshape(len(regs), bands, rows).astype(np.uint64)
    out = np.broadcast_to(np.arange(1, bands + 1, dtype=np.uint64), grid.shape[:2]).copy()
    for r in range(rows):
        out = mixed(out * np.uint64(0x9E3779B97F4A7C15) + grid[:, :, r])
    return out.view(np.int64)


def chance_of_agreement(n: np.ndarray, m: np.ndarray, k: int) -> np.ndarray:
    """The chance that registers of disjoint sets of n and m shingles agree."""
    a, b = np.maximum(n / k, 1.0)[:, None], np.maximum(m / k, 1.0)[:, None]
    low = np.exp2(-np.arange(1, 1 << ZERO_BITS, dtype=float))[None, :]
    cell = low / (1 << MANTISSA_BITS)
    inside = np.exp(-(a + b) * low) - np.exp(-(a + b) * 2 * low)
    return np.minimum((cell * a * b / (a + b) * inside).sum(1), 0.5)


def estimated(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray) -> np.ndarray:
    """Similarity from two (pairs, k) arrays of registers, chance agreement taken out."""
    k = x.shape[1]
    chance = chance_of_agreement(n, m, k)
    return ((x == y).mean(1) - chance) / (1 - chance)


def _sketches(size: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory, order = WordHashes(), bucket_order(k)
        for batch in batches:
            counts, nodes, regs = [], [], []
            for text in batch.column("_text"):
                found = shingle_hashes(words_of(text.as_py(), lower=True), size, memory)
                counts.append(len(found))
                nodes.append(xxhash.xxh3_128_digest(found.tobytes()) if len(found) else None)
                regs.append(registers(found, k, order).tobytes() if len(found) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("_id"), batch.column("_hash"), pa.array(counts, pa.int64()), pa.array(nodes, pa.binary()), pa.array(regs, pa.binary())],
                ["_id", "_hash", "_n", "_node", "_regs"],
            )

    return run


def _bands(bands: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in (batch.slice(i, 2000) for i in range(0, batch.num_rows, 2000)):
                regs = np.frombuffer(b"".join(part.column("_regs").to_pylist()), np.uint16).reshape(part.num_rows, -1)
                keys = band_keys(regs, bands, rows).reshape(-1)
                nodes = part.column("_node").take(pa.array(np.repeat(np.arange(part.num_rows), bands)))
                yield pa.RecordBatch.from_arrays([pa.array(keys), nodes], ["_key", "_node"])

    return run


def _likely(limit: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                side = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(batch.num_rows, -1)  # noqa: B023, E731
                n, m = np.asarray(batch.column("_n_a"), float), np.asarray(batch.column("_n_b"), float)
                good = estimated(side("_regs_a"), side("_regs_b"), n, m) >= limit
                yield batch.select(["_a", "_b"]).filter(pa.array(good))

    return run


def shingle_set(text: str, size: int) -> set:
    words = words_of(text, lower=True)
    size = min(size, len(words))
    return set(zip(*(words[i:] for i in range(size)), strict=False)) if words else set()


def _confirmed(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, set()
        for batch in batches:
            good = []
            for a, ta, tb in zip(batch.column("_a").to_pylist(), batch.column("_text_a"), batch.column("_text_b"), strict=True):
                if a != last:
                    last, own = a, shingle_set(ta.as_py(), size)
                other = shingle_set(tb.as_py(), size)
                common = len(own & other)
                good.append(100 * common >= percent * (len(own) + len(other) - common))
            yield batch.select(["_a", "_b"]).filter(pa.array(good, pa.bool_()))

    return run


def _texts(nodes: DataFrame, classes: DataFrame, docs: DataFrame) -> DataFrame:
    """``_node`` and the whole text of one document of each class; its id and text hash lead to it."""
    places = classes.join(nodes, "_node").select("_node", F.col("_first.id").alias("_id"), F.col("_first.hash").alias("_hash"))
    same = docs["_id"].eqNullSafe(places["_id"]) & (docs["_hash"] == places["_hash"])
    return checkpointed(docs.join(places, same).select("_node", "_text").dropDuplicates(["_node"]))


def _likely_pairs(pairs: DataFrame, classes: DataFrame, limit: float) -> DataFrame:
    """The pairs (_a, _b) whose sketches do not rule them out."""
    side = lambda c: classes.select(*(F.col(f"_{x}").alias(f"_{c}" if x == "node" else f"_{x}_{c}") for x in ("node", "n", "regs")))
    known = pairs.join(side("b"), "_b").join(side("a"), "_a")
    known = known.select("_a", "_b", "_n_a", "_n_b", "_regs_a", "_regs_b")
    return known.mapInArrow(_likely(limit), "_a binary, _b binary")


def _confirm(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """The pairs (_a, _b) whose full sets are similar."""
    side = lambda c: texts.select(F.col("_node").alias(f"_{c}"), F.col("_text").alias(f"_text_{c}"))
    both = pairs.join(side("b"), "_b").join(side("a"), "_a")
    return both.select("_a", "_b", "_text_a", "_text_b").mapInArrow(_confirmed(size, percent), "_a binary, _b binary")


def _nodes(pairs: DataFrame) -> DataFrame:
    return pairs.select(F.col("_a").alias("_node")).unionByName(pairs.select(F.col("_b").alias("_node"))).distinct()


def parity_bits(hashes: np.ndarray, bits: int) -> np.ndarray:
    """For each of ``bits`` places, packed to bytes, whether an odd number of hashes falls there.

    Two sets differ in at least as many elements as their parities differ in bits.
    """
    odd = np.bincount((hashes % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8))


def parities(hashes: np.ndarray) -> list[int]:
    """``PARITY_BITS`` parities as signed words of 64."""
    return parity_bits(hashes, PARITY_BITS).view(np.int64).tolist()


def _shingles(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for batch in batches:
            for i, text in enumerate(batch.column("_text")):
                found = shingle_hashes(words_of(text.as_py(), lower=True), size, memory)
                many = pa.array(np.full(len(found), i))
                same = pa.array(np.full(len(found), len(found), np.int64))
                # Once for each text; the window that ranks its shingles gives it to all of them.
                odd = pa.array([parities(found), *[None] * (len(found) - 1)], pa.list_(pa.int64()))
                columns = [batch.column("_node").take(many), batch.column("_root").take(many), same, pa.array(found.view(np.int64)), odd]
                yield pa.RecordBatch.from_arrays(columns, ["_node", "_root", "_n", "_g", "_odd"])

    return run


def _signs(size: int):
    """Parities of ``SIGN_BITS`` places for each text, as bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory = WordHashes()
        for batch in batches:
            counts, signs = [], []
            for text in batch.column("_text"):
                found = shingle_hashes(words_of(text.as_py(), lower=True), size, memory)
                counts.append(len(found))
                signs.append(parity_bits(found, SIGN_BITS).tobytes())
            yield pa.RecordBatch.from_arrays(
                [batch.column("_node"), pa.array(counts, pa.int64()), pa.array(signs, pa.binary())], ["_node", "_n", "_signs"]
            )

    return run


def _near(percent: int):
    """Pairs whose parities leave room for enough common shingles, with the number of parities that differ."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                side = lambda c: np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint64).reshape(batch.num_rows, -1)  # noqa: B023, E731
                both = np.asarray(batch.column("_n_a"), np.int64) + np.asarray(batch.column("_n_b"), np.int64)
                apart = np.bitwise_count(side("_signs_a") ^ side("_signs_b")).sum(1, dtype=np.int64)
                good = apart <= both - 2 * -(-percent * both // (100 + percent))
                kept = batch.select(["_a", "_b", "_root_a", "_root_b"]).append_column("_apart", pa.array(apart))
                yield kept.filter(pa.array(good))

    return run


def _pairs_across(members: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame:
    """All pairs (_a, _b) of ``members`` in different components (_root_a, _root_b) that can be similar.

    Shingles are put in one order, rarest among the members first. Sets of n and m shingles that are similar
    share at least t = percent * (n + m) / (100 + percent), so their first n - t + 1 and m - t + 1 in that
    order meet. A copy that differs from all others in too many words starts with shingles of its own and
    meets nobody, which is what keeps large groups of copies from being compared pair by pair. Pairs that meet go on only if their parities leave room for t common shingles, which no similar pair fails.
    """
    rows = members.join(texts, "_node").select("_node", "_root", "_text")
    shingles = rows.mapInArrow(_shingles(size), "_node binary, _root binary, _n bigint, _g bigint, _odd array<bigint>")
    often = shingles.groupBy("_g").agg(F.count(F.lit(1)).alias("_df")).where("_df > 1")
    ranked = shingles.join(often, "_g", "left").withColumns({
        "_rank": F.row_number().over(Window.partitionBy("_node").orderBy(F.coalesce("_df", F.lit(1)), "_g")),
        "_odd": F.max("_odd").over(Window.partitionBy("_node")),
    })
    # A shingle of one member takes its place in the order but meets nobody.
    first = ranked.where((100 * F.col("_rank") <= (100 - percent) * F.col("_n") + 100) & F.col("_df").isNotNull())
    first = checkpointed(first.select("_g", "_node", "_root", "_n", "_rank", "_odd"))
    # Of a shingle's components the one with most members is paired with all others, so that what is paired inside
    # one component and thrown away is never more than what is paired across.
    groups = first.groupBy("_g", "_root").agg(F.count(F.lit(1)).alias("_c"))
    mains = groups.groupBy("_g").agg(F.max(F.struct("_c", "_root"))["_root"].alias("_main"), F.count(F.lit(1)).alias("_roots"))
    first = checkpointed(first.join(mains.where("_roots > 1").drop("_roots"), "_g").withColumn("_main", F.col("_root") == F.col("_main")))
    side = lambda c: first.select("_g", *(F.col(f"_{x}").alias(f"_{x}_{c}") for x in ("node", "root", "n", "rank", "odd", "main")))
    a, b = side("a").where("NOT _main_a"), side("b")
    common = F.ceil(F.lit(percent) * (F.col("_n_a") + F.col("_n_b")) / F.lit(100 + percent))
    apart = sum(F.bit_count(F.col("_odd_a")[i].bitwiseXOR(F.col("_odd_b")[i])) for i in range(PARITY_BITS // 64))
    meet = (
        (a["_g"] == b["_g"]) & (F.col("_main_b") | (F.col("_root_a") < F.col("_root_b")))
        & (F.col("_rank_a") <= F.col("_n_a") - common + 1) & (F.col("_rank_b") <= F.col("_n_b") - common + 1)
        & (100 * F.least("_n_a", "_n_b") >= percent * F.greatest("_n_a", "_n_b"))
        & (apart <= F.col("_n_a") + F.col("_n_b") - 2 * common)
    )
    x, y = (F.struct(F.col(f"_node_{c}").alias("node"), F.col(f"_root_{c}").alias("root")) for c in "ab")
    ordered = a.join(b, meet).select(F.least(x, y).alias("_x"), F.greatest(x, y).alias("_y")).distinct()
    pairs = _narrow(ordered.select(
        F.col("_x.node").alias("_a"), F.col("_y.node").alias("_b"), F.col("_x.root").alias("_root_a"), F.col("_y.root").alias("_root_b")
    ))
    # Now a text's parities over more places, carried by pairs instead of by shingles.
    asked = texts.join(_nodes(pairs), "_node", "left_semi")
    signs = checkpointed(asked.mapInArrow(_signs(size), "_node binary, _n bigint, _signs binary"))
    sign = lambda c: signs.select(*(F.col(f"_{x}").alias(f"_{c}" if x == "node" else f"_{x}_{c}") for x in ("node", "n", "signs")))
    signed = pairs.join(sign("b"), "_b").join(sign("a"), "_a").select("_a", "_b", "_root_a", "_root_b", "_n_a", "_n_b", "_signs_a", "_signs_b")
    return signed.mapInArrow(_near(percent), "_a binary, _b binary, _root_a binary, _root_b binary, _apart bigint")


def _narrow(rows: DataFrame) -> DataFrame:
    """``rows`` checkpointed; few rows in one partition, so that what follows needs no exchange."""
    kept = checkpointed(rows)
    return kept.coalesce(1) if kept.count() <= TASK_ROWS else kept


def _links_across(pairs: DataFrame, texts: DataFrame, size: int, percent: int) -> DataFrame | None:
    """Similar pairs (_a, _b) that connect all components that ``pairs`` can connect; None if there are none.

    In each round every component has its nearest open pairs confirmed, what is confirmed contracts components, and
    pairs whose ends have met are dropped. The number of pairs for a component grows with the rounds by
    ``ROUND_FACTOR``, so the rounds are few and every pair is either confirmed, refused, or known to be connected.
    """
    open_, share, links = _narrow(pairs), 1, None
    while not open_.isEmpty():
        ends = open_.select(F.col("_root_a").alias("_end"), "_a", "_b", "_apart")
        ends = ends.unionByName(open_.select(F.col("_root_b").alias("_end"), "_a", "_b", "_apart"))
        place = F.row_number().over(Window.partitionBy("_end").orderBy("_apart", "_a", "_b"))
        asked = _narrow(ends.withColumn("_place", place).where(F.col("_place") <= share).select("_a", "_b").distinct())
        good = _narrow(_confirm(asked, texts.join(_nodes(asked), "_node", "left_semi"), size, percent))
        left = open_.join(asked, ["_a", "_b"], "left_anti")
        if not good.isEmpty():
            links = good if links is None else links.unionByName(good)
            met = open_.join(good, ["_a", "_b"], "left_semi").select("_root_a", "_root_b").distinct()
            roots = _narrow(connected_components(met, "_root_a", "_root_b", TASK_ROWS))
            for end in ("_root_a", "_root_b"):
                now = roots.select(F.col("node").alias(end), F.col("root").alias("_now"))
                left = left.join(now, end, "left").withColumn(end, F.coalesce("_now", end)).drop("_now")
            left = left.where("_root_a != _root_b")
        open_, share = _narrow(left.select("_a", "_b", "_root_a", "_root_b", "_apart")), share * ROUND_FACTOR
    return links


def _components(links: DataFrame) -> DataFrame:
    """``_node`` and ``_root`` for the classes with a link."""
    found = connected_components(links, "_a", "_b", TASK_ROWS)
    return found.select(F.col("node").alias("_node"), F.col("root").alias("_root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = SHINGLE_WORDS,
                    percent: int = PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """For every row ``doc_id``, ``n_shingles``, ``component_id``, ``kept``, ``text_hash`` and ``first_hash``.

    ``first_hash`` is the hash of the text that stands for the component: of several rows with the
    component's id, those with this hash.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    docs = docs.select(F.col(id_col).alias("_id"), text.alias("_text"), F.xxhash64(text).alias("_hash"))
    kind = docs.schema["_id"].dataType.simpleString()
    sketches = checkpointed(
        docs.mapInArrow(_sketches(shingle_words, bands * rows), f"_id {kind}, _hash bigint, _n bigint, _node binary, _regs binary")
    )
    first = F.struct(F.col("_id").isNull().alias("none"), F.col("_id").alias("id"), F.col("_hash").alias("hash"))
    classes = checkpointed(
        sketches.where("_node IS NOT NULL").groupBy("_node")
        .agg(F.min(first).alias("_first"), F.first("_n").alias("_n"), F.first("_regs").alias("_regs"))
    )

    banded = classes.select("_node", "_regs").mapInArrow(_bands(bands, rows), "_key bigint, _node binary")
    shared = banded.groupBy("_key").agg(F.min("_node").alias("_hub"), F.count(F.lit(1)).alias("_c")).where("_c > 1")
    stars = checkpointed(banded.join(shared.select("_key", "_hub", "_c"), "_key"))
    spokes = stars.where("_node != _hub").select(F.col("_hub").alias("_a"), F.col("_node").alias("_b")).distinct()
    likely = checkpointed(_likely_pairs(spokes, classes, percent / 100 - MARGIN))
    # One pass over the texts serves both comparisons.
    wanted = _nodes(likely).unionByName(stars.where("_c > 2").select("_node")).distinct()
    texts = _texts(wanted, classes, docs)
    links = checkpointed(_confirm(likely, texts, shingle_words, percent))
    roots = checkpointed(_components(links))

    # Buckets of three or more that hold several components; the smallest class was compared with all.
    open_ = stars.where("_c > 2").join(roots, "_node", "left").withColumn("_root", F.coalesce("_root", "_node"))
    several = open_.groupBy("_key").agg(F.min("_root").alias("_low"), F.max("_root").alias("_high")).where("_low != _high")
    members = checkpointed(open_.where("_node != _hub").join(several.select("_key"), "_key", "left_semi").select("_node", "_root").distinct())
    if not members.isEmpty():
        more = _links_across(_pairs_across(members, texts, shingle_words, percent), texts, shingle_words, percent)
        if more is not None:
            roots = checkpointed(_components(links.unionByName(more)))

    known = classes.select("_node", "_first").join(roots, "_node", "left").withColumn("_root", F.coalesce("_root", "_node"))
    heads = known.groupBy("_root").agg(F.min("_first").alias("_head"))
    found = known.join(heads, "_root").select("_node", "_head")
    out = sketches.select("_id", "_hash", "_n", "_node").join(found, "_node", "left")
    own: Column = F.when(F.col("_node").isNull(), F.col("_id")).otherwise(F.col("_head.id"))
    return out.select(
        F.col("_id").alias("doc_id"), F.col("_n").alias("n_shingles"), own.alias("component_id"),
        F.col("_id").eqNullSafe(own).alias("kept"), F.col("_hash").alias("text_hash"),
        F.coalesce(F.col("_head.hash"), F.col("_hash")).alias("first_hash"),
    )


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One whole row of each component; rows without words all stay.

    Of several rows with the id and text that stay, the one whose columns have the smallest hash is taken, so the
    choice does not depend on how rows are dealt out; columns that cannot be hashed (maps) do not count.
    """
    found = near_duplicates(docs, id_col, text_col, **options)
    stay = found.where(F.col("kept") & (F.col("text_hash") == F.col("first_hash")))
    stay = stay.groupBy(F.col("doc_id").alias("__llm_id"), F.col("text_hash").alias("__llm_own")).agg(F.max("n_shingles").alias("__llm_n"))
    hashed = docs.withColumn("__llm_hash", F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))))
    joined = hashed.join(stay, F.col(id_col).eqNullSafe(F.col("__llm_id")) & (F.col("__llm_hash") == F.col("__llm_own")))
    # Rows without words stay, any number of them; otherwise one of the rows that are alike.
    place = F.row_number().over(Window.partitionBy(id_col, "__llm_hash").orderBy(row_hash(docs)))
    return joined.withColumn("__llm_place", place).where("__llm_n = 0 OR __llm_place = 1").select(*docs.columns)
