"""Training texts that hold benchmark items, also edited ones.

The score of a text and an item is that of their best local alignment by Smith-Waterman over words (match 2,
mismatch and gap -1) as a share of a perfect copy's; a text holds the item if that reaches ``least_share``.

Nothing is given up to get there. An alignment of m matches and e edits has at most e + 1 runs of matches, so at
least m - e - 1 of the item's two-word runs stand in it, and its matches lie within e diagonals. With 2m - e >= S and
m <= n words, that is S - n - 1 runs within 2n - S diagonals (where S <= n + 1, at least S / 2 words). Only where a
text has so many seeds of an item that near to each other is the passage around them compared with it: first by
the words they have in common, m, which raises the number of runs needed, then by alignment. How often a seed
occurs elsewhere plays no part.

Items are sent to the tasks in blocks of at most ``BLOCK_CHARS`` characters; more items mean more passes over the
documents, not a larger broadcast. Long texts are read in overlapping pieces.

Words are lower-cased and freed of ASCII punctuation. Defined results: null, empty and blank texts match nothing,
nor do items without words; repeated rows are judged alike; an empty benchmark matches nothing; other columns are
not read.
"""

from __future__ import annotations

import sys
from collections import Counter
from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from segmentry.llm.hashing import WordHashes, windows

cloudpickle.register_pickle_by_value(sys.modules[__name__])

SHORT_ITEM = 8
LIMIT = 0.6
BLOCK_CHARS = 16 << 20
FILTER_BITS = 22
SCORES_KEPT = 50_000
PIECE_WORDS = 1 << 13
PUNCTUATION = b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"
TO_BLANK = bytes.maketrans(PUNCTUATION, b" " * len(PUNCTUATION))


def plain_words(text: str | None) -> list[bytes]:
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(TO_BLANK).split()


def local_score(a: np.ndarray, b: np.ndarray) -> tuple[int, int]:
    """The best local alignment score of two word sequences, and where it ends in ``b``."""
    steps = np.arange(len(b) + 1)
    row, best, end = np.zeros(len(b) + 1, np.int64), 0, 0
    for x in a:
        step = np.maximum(row[:-1] + np.where(b == x, 2, -1), row[1:] - 1)
        new = np.concatenate([[0], np.maximum(step, 0)])
        row = np.maximum.accumulate(new + steps) - steps  # gaps in a
        top = int(row.argmax())
        if row[top] > best:
            best, end = int(row[top]), top
    return best, end


def least_share(words: int, limit: float) -> float:
    """The least score of an item of so many words: from 1 for one word down to ``limit`` for ``SHORT_ITEM``."""
    return limit if words >= SHORT_ITEM else 1 - (1 - limit) * (words - 1) / (SHORT_ITEM - 1)


class Items:
    """A block of items with their seeds in sorted order."""

    def __init__(self, names: list, words: list[np.ndarray], limit: float):
        self.names, self.words = names, words
        n = np.array([len(w) for w in words], np.int64)
        self.least = np.array([max(1, ceil(least_share(len(w), limit) * 2 * len(w))) for w in words], np.int64)
        self.slack = np.maximum(2 * n - self.least, 0)  # edits of an alignment that reaches the least score
        self.longest = int((n + self.slack).max(initial=0))
        size = np.where(self.least - n - 1 >= 1, 2, 1)
        self.needed = np.where(size == 2, self.least - n - 1, -(-self.least // 2))
        self.sizes = sorted(set(size[n > 0].tolist()))
        memory = [(windows(w, int(size[i])), i) for i, w in enumerate(words) if len(w)]
        seeds = np.concatenate([h for h, _ in memory]) if memory else np.empty(0, np.uint64)
        item = np.concatenate([np.full(len(h), i) for h, i in memory]) if memory else np.empty(0, np.int64)
        place = np.concatenate([np.arange(len(h)) for h, _ in memory]) if memory else np.empty(0, np.int64)
        order = np.argsort(seeds, kind="stable")
        seeds, self.item, self.place = seeds[order], item[order], place[order]
        self.distinct, self.first, self.count = np.unique(seeds, return_index=True, return_counts=True)
        self.filter = np.zeros(1 << FILTER_BITS, bool)
        self.filter[(self.distinct >> np.uint64(64 - FILTER_BITS)).astype(np.int64)] = True

    def hits(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Places in a text, and the number of the distinct seed at each."""
        places, which = [np.empty(0, np.int64)], [np.empty(0, np.int64)]
        for size in self.sizes:
            own = windows(hashes, size)
            maybe = np.flatnonzero(self.filter[(own >> np.uint64(64 - FILTER_BITS)).astype(np.int64)])
            at = np.minimum(np.searchsorted(self.distinct, own[maybe]), len(self.distinct) - 1)
            sure = self.distinct[at] == own[maybe]
            places.append(maybe[sure])
            which.append(at[sure])
        return np.concatenate(places), np.concatenate(which)


def load_items(rows: list[tuple], limit: float) -> Items:
    memory = WordHashes()
    return Items([r[0] for r in rows], [memory.of(plain_words(r[1])) for r in rows], limit)


def passages(items: Items, hashes: np.ndarray) -> Iterator[tuple[int, int, int, int]]:
    """(item, from, to, number of seeds) of the passages that have seeds enough; each alignment to be found is in one."""
    places, which = items.hits(hashes)
    count = items.count[which]
    own = np.repeat(items.first[which], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    item, diagonal = items.item[own], np.repeat(places, count) - items.place[own]
    enough = np.bincount(item, minlength=len(items.words)) >= items.needed
    item, diagonal = item[enough[item]], diagonal[enough[item]]
    order = np.lexsort((diagonal, item))
    item, diagonal = item[order], diagonal[order]
    slack, last = items.slack[item], np.arange(len(item)) + items.needed[item] - 1
    there = np.minimum(last, len(item) - 1)
    near = (last < len(item)) & (item[there] == item) & (diagonal[there] - diagonal <= slack)
    starts = np.flatnonzero(near)
    if not len(starts):
        return
    i, d, s = item[starts], diagonal[starts], slack[starts]
    cut = np.flatnonzero((np.diff(i) != 0) | (np.diff(d) > s[1:]))
    for a, b in zip([0, *(cut + 1).tolist()], [*cut.tolist(), len(starts) - 1], strict=True):
        low, high = int(d[a] - s[a]), int(d[b] + s[b])
        begin = np.searchsorted(item, i[a])
        seeds = diagonal[begin : np.searchsorted(item, i[a], "right")]
        n = np.searchsorted(seeds, high, "right") - np.searchsorted(seeds, low)
        yield int(i[a]), max(0, low), high + len(items.words[i[a]]), int(n)


def aligned(items: Items, i: int, passage: np.ndarray, seeds: int) -> tuple[float, int] | None:
    """Score and end of the best alignment, if it reaches the item's least score."""
    words, least = items.words[i], int(items.least[i])
    have, want = Counter(passage.tolist()), Counter(words.tolist())
    common = sum(min(n, have[w]) for w, n in want.items())
    if 2 * common < least or seeds < least - common - 1:
        return None
    score, stop = local_score(words, passage)
    return (score / (2 * len(words)), stop) if score >= least else None


def matches(items: Items, hashes: np.ndarray, known: dict) -> list[tuple[int, float, int]]:
    """(item, best score, word at which the copy ends) of the items that a text holds."""
    found: dict[int, tuple[float, int]] = {}
    # Any alignment lies whole in one of the pieces.
    step = max(PIECE_WORDS, items.longest)
    for start in range(0, max(1, len(hashes) - items.longest), step):
        piece = hashes[start : start + step + items.longest]
        for i, low, high, seeds in passages(items, piece):
            passage = piece[low:high]
            key = (i, seeds, passage.tobytes())
            if key not in known:
                if len(known) >= SCORES_KEPT:
                    known.clear()
                known[key] = aligned(items, i, passage, seeds)
            if known[key] and known[key][0] > found.get(i, (0, 0))[0]:
                found[i] = (known[key][0], start + low + known[key][1])
    return [(i, score, stop) for i, (score, stop) in found.items()]


def _find(ref, limit: float, text_at: int, keep_clean: bool, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        items, memory, known = load_items(ref.value, limit), WordHashes(), {}
        for batch in batches:
            rows, found = [], []
            for row, text in enumerate(batch.column(text_at)):
                for match in matches(items, memory.of(plain_words(text.as_py())), known):
                    rows.append(row)
                    found.append(match)
            if keep_clean:
                clean = np.ones(batch.num_rows, bool)
                clean[rows] = False
                yield batch.filter(pa.array(clean))
            elif rows:
                extra = [
                    pa.array([items.names[i] for i, _, _ in found], pa.int64()),
                    pa.array([s for _, s, _ in found], pa.float64()),
                    pa.array([e for _, _, e in found], pa.int64()),
                ]
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows)), *extra], names)

    return run


def _blocks(benchmark: DataFrame, item_col: str, text_col: str):
    """The items, a bounded block at a time."""
    rows = benchmark.select(F.col(item_col).cast("bigint").alias("_item"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    chars = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    n = -(-chars // BLOCK_CHARS)
    for block in range(n):
        own = rows.where(F.pmod(F.xxhash64("_item", "_text"), F.lit(n)) == block).distinct().collect()
        yield [tuple(r) for r in own]


def find_leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", limit: float = LIMIT) -> DataFrame:
    """``doc_id``, ``item_id``, ``score`` and ``end_word`` for every document and item it holds a copy of."""
    names = ["doc_id", "item_id", "score", "end_word"]
    schema = f"doc_id {docs.schema[id_col].dataType.simpleString()}, item_id bigint, score double, end_word bigint"
    out = docs.sparkSession.createDataFrame([], schema)
    rows = docs.select(F.col(id_col).alias("doc_id"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    for items in _blocks(benchmark, item_col, item_text_col):
        ref = docs.sparkSession.sparkContext.broadcast(items)
        out = out.unionByName(rows.mapInArrow(_find(ref, limit, 1, False, names), schema))
    return out


def drop_leaks(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
               limit: float = LIMIT) -> DataFrame:
    """The documents that hold no item, all columns."""
    out = docs
    for items in _blocks(benchmark, item_col, item_text_col):
        ref = docs.sparkSession.sparkContext.broadcast(items)
        out = out.mapInArrow(_find(ref, limit, docs.columns.index(text_col), True, []), docs.schema)
    return out
