"""Token ids of documents in word-aligned Simple-8b blocks.

A block holds whole documents. Its ids are packed into 64-bit words: the four top bits select how many ids
of how many bits follow. An id of more than 60 bits becomes an escape: the word names its place in the
block's list of escapes, so that no word depends on the one before it and a block is decoded with a few
vector operations. Each block lists its documents, their id counts, and the word at which every
``IDS_PER_OFFSET``-th id starts, so that a reader can begin in the middle.

Blocks are rows of Parquet files, the only container all executors can write to any store; ``part`` and
``block`` give their order. Defined results: a null or empty text has the end id alone; rows with a null id
come first; repeated rows are written as often as they occur; other columns are not read.
"""

from __future__ import annotations

import re
import struct
import sys
import types
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext, cloudpickle
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Selector s packs COUNTS[s] ids of BITS[s] bits; selector 0 is the escape.
COUNTS = np.array([1, 60, 30, 20, 15, 12, 10, 8, 7, 6, 5, 4, 3, 2, 1], np.int64)
BITS = np.array([0, 1, 2, 3, 4, 5, 6, 7, 8, 10, 12, 15, 20, 30, 60], np.int64)
IDS_PER_BLOCK = 1 << 16
IDS_PER_OFFSET = 4096
# A worker process remembers the ids of twice so many words and of twice so many other pieces, over all tasks that it
# runs (together about 60 MB).
WORDS_KEPT = 100_000
PIECES_KEPT = 20_000
PIECE_CHARS_KEPT = 64
# Texts are cut into pieces so many bytes at a time.
BYTES_AT_ONCE = 500_000
# Apostrophes are left out: some tokenizers join them with the letters around them.
PUNCTUATION = "!\"#$%&()*+,-./:;=?@[]^_`{}~"

BLOCK_SCHEMA = (
    "part int, block int, doc_ids array<bigint>, n_tokens array<bigint>, n_ids bigint, words binary,"
    " word_offsets array<bigint>, escapes array<bigint>"
)


def _bit_lengths(values: np.ndarray) -> np.ndarray:
    exact = np.frexp(np.minimum(values, np.uint64(1 << 52)).astype(np.float64))[1]
    wide = np.where(values < np.uint64(1 << 60), 60, 64)
    return np.where(values < np.uint64(1 << 52), exact, wide).astype(np.int8)


def pack(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Words, the index of the first id in each word, and the escaped ids of a uint64 array."""
    n = len(values)
    lengths = _bit_lengths(values)
    selectors = np.zeros(n, np.uint8)
    widest, width = lengths, 1  # the widest of the next ``width`` ids; no count is more than twice the one before
    for s in range(len(COUNTS) - 1, 0, -1):  # the selector of most ids is tried last and wins
        count = int(COUNTS[s])
        if n < count:
            break
        more = count - width
        widest, width = np.maximum(widest[: n - count + 1], widest[more : more + n - count + 1]), count
        np.putmask(selectors[: n - count + 1], widest <= BITS[s], s)
    steps = COUNTS[selectors].astype(np.uint8).tobytes()
    starts, at = [], 0
    while at < n:
        starts.append(at)
        at += steps[at]
    starts = np.array(starts, np.int64)
    chosen = selectors[starts] if n else selectors
    words = chosen.astype(np.uint64) << np.uint64(60)
    for s in range(1, len(COUNTS)):
        rows = np.flatnonzero(chosen == s)
        if len(rows):
            lanes = np.arange(COUNTS[s])
            group = values[starts[rows][:, None] + lanes]
            words[rows] |= np.bitwise_or.reduce(group << (lanes * BITS[s]).astype(np.uint64), axis=1)
    escaped = np.flatnonzero(chosen == 0)
    words[escaped] = np.arange(len(escaped), dtype=np.uint64)
    return words, starts, values[starts[escaped]]


def unpack(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    """The ids of a block, all words at once."""
    chosen = (words >> np.uint64(60)).astype(np.int64)
    ends = np.cumsum(COUNTS[chosen])
    out = np.empty(int(ends[-1]) if len(ends) else 0, np.uint64)
    first = ends - COUNTS[chosen]
    for s in range(1, len(COUNTS)):
        rows = np.flatnonzero(chosen == s)
        if len(rows):
            lanes = np.arange(COUNTS[s])
            mask = np.uint64((1 << int(BITS[s])) - 1)
            out[first[rows][:, None] + lanes] = (words[rows][:, None] >> (lanes * BITS[s]).astype(np.uint64)) & mask
    rows = np.flatnonzero(chosen == 0)
    out[first[rows]] = escapes[words[rows].astype(np.int64)]
    return out


class Recent(dict):
    """Values made on demand. Of those beyond ``most``, the ones asked for again since the last time it was full stay."""

    def __init__(self, make: Callable[[str], bytes], most: int):
        super().__init__()
        self.make, self.most, self.before = make, most, {}

    def __missing__(self, key: str) -> bytes:
        value = self.before.get(key) or self.make(key)
        if len(key) <= PIECE_CHARS_KEPT:
            if len(self) >= self.most:
                self.before = dict(self)
                self.clear()
            self[key] = value
        return value


def _strings(texts: pa.Array) -> list[str]:
    return texts.to_numpy(zero_copy_only=False).tolist()  # several times as fast as to_pylist


class PieceIds:
    """The ids of each piece of text between blanks and line ends, as little-endian 32-bit integers.

    Words never span white space in a tokenizer that drops it, so a text's ids are those of its pieces. For
    tokenizers that lower-case, cut between letters and other characters and write bytes as characters, a
    piece of Latin letters with ASCII punctuation behind it has the ids of the lower-case word and of the
    punctuation; the word goes straight to the BPE model. Every other piece is encoded as it is. Of the texts
    encoded together, every different word and piece is looked up once.
    """

    def __init__(self, tokenizer):
        self.tokenizer, self.model = tokenizer, tokenizer.model
        self.letters = self._letters()
        # For words of few ids; made here, as they cannot be sent to a worker.
        self.packers = [struct.Struct(f"<{n}I").pack for n in range(16)]
        self.words, self.pieces = Recent(self._word, WORDS_KEPT), Recent(self._encode, PIECES_KEPT)
        letters = "".join(map(chr, self.letters or ()))
        # Words are lower-cased before they are looked up.
        self.ascii_as_is = bool(letters) and all(self.letters.get(c) == chr(c) for c in range(ord("a"), ord("z") + 1))
        self.plain = f"^(?P<word>[{letters}]+)(?P<behind>[{re.escape(PUNCTUATION)}]*)$" if letters else None

    def _letters(self) -> dict[int, str] | None:
        """What the model sees for each Latin letter; None if the tokenizer does not work as above."""
        table = {}
        try:
            for c in map(chr, range(0x250)):
                if c.isalpha():
                    lower = self.tokenizer.normalizer.normalize_str(c)
                    cut = self.tokenizer.pre_tokenizer.pre_tokenize_str(lower)
                    if len(lower) == 1 and len(cut) == 1:
                        table[ord(c)] = cut[0][0]
            pairs = [("aZ", "az"), ("éÄ", "éä")]
            normal = all(self.tokenizer.normalizer.normalize_str(a) == b for a, b in pairs)
            cut = [x for x, _ in self.tokenizer.pre_tokenizer.pre_tokenize_str("ab,.b!")]
        except (AttributeError, ValueError):
            return None
        return table if normal and cut == ["ab", ",.", "b", "!"] else None

    def _encode(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, "<u4").tobytes()

    def _word(self, word: str) -> bytes:
        seen = word if self.ascii_as_is and word.isascii() else word.translate(self.letters)
        ids = [t.id for t in self.model.tokenize(seen)]
        return self.packers[len(ids)](*ids) if len(ids) < len(self.packers) else struct.pack(f"<{len(ids)}I", *ids)

    def _values(self, pieces: pa.Array) -> tuple[list[bytes], np.ndarray]:
        """Ids of words and other pieces, and for each of the (different) pieces the places of the two that make it up."""
        if self.plain is None:
            return [b"", *map(self.pieces.__getitem__, _strings(pieces))], np.stack([np.arange(len(pieces)) + 1, np.zeros(len(pieces), np.int64)], axis=1).astype(np.int32)
        cut = pc.extract_regex(pieces, self.plain)
        plain = np.asarray(cut.is_valid())
        words, behind = (x.dictionary_encode() for x in cut.filter(pa.array(plain)).flatten())
        # The tokenizer lower-cases, so this changes no ids.
        lower = pc.ascii_lower(words.dictionary).dictionary_encode()
        values = [b"", *map(self.words.__getitem__, _strings(lower.dictionary))]
        places = np.zeros((len(pieces), 2), np.int32)
        places[plain, 0] = 1 + np.asarray(lower.indices)[np.asarray(words.indices)]
        places[plain, 1] = len(values) + np.asarray(behind.indices)
        values += map(self.pieces.__getitem__, _strings(behind.dictionary))
        others = pieces.filter(pa.array(~plain))
        places[~plain, 0] = len(values) + np.arange(len(others))
        values += map(self.pieces.__getitem__, _strings(others))
        return values, places

    def of_texts(self, texts: pa.Array, end: bytes) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, ``end`` behind each, and how many each text has."""
        lists = pc.split_pattern(pc.replace_substring(texts, "\n", " "), " ")
        coded = lists.flatten().dictionary_encode()
        values, places = self._values(coded.dictionary)
        values.append(end)
        lengths = np.fromiter(map(len, values), np.int32, len(values)) // 4
        pool, first = np.frombuffer(b"".join(values), "<u4"), np.cumsum(lengths) - lengths
        # Both parts of each piece, and the end behind the last piece of each text.
        ends = 2 * np.cumsum(np.asarray(pc.list_value_length(lists), np.int64))
        parts = np.insert(places[np.asarray(coded.indices)].ravel(), ends, len(values) - 1)
        n = lengths[parts]
        after = np.cumsum(n, dtype=np.int64)
        at = np.repeat(first[parts] - after + n, n)
        at += np.arange(len(at))
        return pool[at], np.diff(after[ends + np.arange(len(ends))], prepend=0)

    def of(self, text: str, end: bytes) -> np.ndarray:
        return self.of_texts(pa.array([text]), end)[0]


def _runs(texts: pa.Array) -> Iterator[pa.Array]:
    """Consecutive texts of about ``BYTES_AT_ONCE`` bytes together, at least one."""
    before, start = np.cumsum(np.asarray(pc.binary_length(texts), np.int64)), 0
    while start < len(texts):
        done = before[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(before, done + BYTES_AT_ONCE, "right")))
        yield texts.slice(start, stop - start)
        start = stop


# Blanks and line ends before, between and behind words, digits, punctuation and other scripts.
PROBES = (" ab", "ab  cd ", "ab\n\ncd", "\nA b. 12 34", "été  日本 語 \n", "x - y", "it 's ok", " ", "\n")


def drops_white_space(tokenizer) -> bool:
    """Whether a text's ids are those of its pieces between blanks and line ends, on texts that would show it."""
    ids = lambda t: tokenizer.encode(t, add_special_tokens=False).ids
    return all(ids(t) == [i for piece in t.replace("\n", " ").split(" ") for i in ids(piece)] for t in PROBES)


def piece_ids(tokenizer_path: str) -> PieceIds:
    """The worker's own memory for a tokenizer; a module of that name keeps it from task to task."""
    from tokenizers import Tokenizer

    kept = vars(sys.modules.setdefault("_segmentry_worker", types.ModuleType("_segmentry_worker")))
    if tokenizer_path not in kept:
        tokenizer = Tokenizer.from_file(tokenizer_path)
        if not drops_white_space(tokenizer):
            raise ValueError(f"{tokenizer_path}: white space is part of this tokenizer's ids, so pieces have other ids than texts")
        kept[tokenizer_path] = PieceIds(tokenizer)
    return kept[tokenizer_path]


def _blocks(tokenizer_path: str, end_id: int, ids_per_block: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = piece_ids(tokenizer_path)
        end = np.array([end_id], "<u4").tobytes()
        part, block = TaskContext.get().partitionId(), 0
        names, counts, ids, held = [], [], [], 0

        def flush() -> pa.RecordBatch:
            values = np.concatenate(ids).astype(np.uint64)
            words, starts, escapes = pack(values)
            offsets = np.searchsorted(starts, np.arange(0, len(values), IDS_PER_OFFSET), "right") - 1
            row = {
                "part": part, "block": block, "doc_ids": list(names), "n_tokens": list(counts), "n_ids": len(values),
                "words": words.astype("<u8").tobytes(), "word_offsets": offsets.tolist(),
                "escapes": escapes.astype(np.int64).tolist(),
            }
            return pa.RecordBatch.from_pylist([row], schema=ARROW_BLOCK)

        for batch in batches:
            doc_ids, row = batch.column(0).to_pylist(), 0
            for texts in _runs(batch.column(1)):
                found, lengths = pieces.of_texts(texts, end)
                ends, start = np.cumsum(lengths), 0
                while start < len(texts):
                    before = int(ends[start - 1]) if start else 0
                    # The block ends with the document that fills it.
                    stop = min(int(np.searchsorted(ends, before + ids_per_block - held)) + 1, len(texts))
                    names.extend(doc_ids[row + start : row + stop])
                    counts.extend(lengths[start:stop].tolist())
                    ids.append(found[before : int(ends[stop - 1])])
                    held += len(ids[-1])
                    start = stop
                    if held >= ids_per_block:
                        yield flush()
                        block += 1
                        names, counts, ids, held = [], [], [], 0
                row += len(texts)
        if names:
            yield flush()

    return run


ARROW_BLOCK = pa.schema(
    [
        ("part", pa.int32()), ("block", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("n_tokens", pa.list_(pa.int64())),
        ("n_ids", pa.int64()), ("words", pa.binary()), ("word_offsets", pa.list_(pa.int64())), ("escapes", pa.list_(pa.int64())),
    ]
)


def write_token_files(
    docs: DataFrame,
    path: str,
    tokenizer_path: str,
    end_id: int = 1,
    id_col: str = "doc_id",
    text_col: str = "text",
    ids_per_block: int = IDS_PER_BLOCK,
) -> None:
    """Encodes every whole text, appends ``end_id``, and writes the blocks in ascending id order.

    ``tokenizer_path`` names a file of the tokenizers library that every executor can read; its tokenizer
    must drop white space; one that does not is refused by an error.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), text.alias("_text"))
    # The text's hash lets a range boundary fall between rows of one id.
    rows = rows.withColumn("_tie", F.xxhash64("_text"))
    ordered = rows.repartitionByRange("_id", "_tie").sortWithinPartitions("_id", "_tie").select("_id", "_text")
    blocks = ordered.mapInArrow(_blocks(tokenizer_path, end_id, ids_per_block), BLOCK_SCHEMA)
    blocks.write.mode("error").option("compression", "zstd").parquet(path)


def _decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(np.frombuffer(row["words"], "<u8"), np.array(row["escapes"], np.int64).astype(np.uint64))
            ends = np.cumsum(np.array(row["n_tokens"], np.int64))
            raw, starts = ids.astype("<u4"), ends - np.array(row["n_tokens"], np.int64)
            crcs = [zlib.crc32(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
            k = len(crcs)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([row["part"]] * k, pa.int32()),
                    pa.array([row["block"]] * k, pa.int32()),
                    pa.array(row["doc_ids"], pa.int64()),
                    pa.array(starts, pa.int64()),
                    pa.array(row["n_tokens"], pa.int64()),
                    pa.array(crcs, pa.int64()),
                ],
                ["part", "block", "doc_id", "_in_block", "n_tokens", "ids_crc32"],
            )


def block_starts(blocks: DataFrame) -> DataFrame:
    """``part``, ``block`` and the number of ids in all blocks before it."""
    sizes = blocks.select("part", "block", "n_ids")
    parts = sizes.groupBy("part").agg(F.sum("n_ids").alias("_ids"))
    # One row for each writing task, so this order by itself stays small.
    before = F.sum("_ids").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("_base"))
    inside = F.sum("n_ids").over(Window.partitionBy("part").orderBy("block").rowsBetween(Window.unboundedPreceding, -1))
    return sizes.withColumn("_before", F.coalesce(inside, F.lit(0))).join(parts, "part").select(
        "part", "block", (F.col("_base") + F.col("_before")).alias("_first")
    )


def read_digests(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id``, ``start`` (ids before it), ``n_tokens`` and ``ids_crc32``, decoded from the files."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    rows = blocks.select("part", "block", "doc_ids", "n_tokens", "words", "escapes").mapInArrow(
        _decoded, "part int, block int, doc_id bigint, _in_block bigint, n_tokens bigint, ids_crc32 bigint"
    )
    return rows.join(block_starts(blocks), ["part", "block"]).select(
        "doc_id", (F.col("_first") + F.col("_in_block")).alias("start"), "n_tokens", "ids_crc32"
    )


def _ids(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            ids = unpack(np.frombuffer(row["words"], "<u8"), np.array(row["escapes"], np.int64).astype(np.uint64))
            offsets = np.concatenate([[0], np.cumsum(np.array(row["n_tokens"], np.int64))]).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(ids.astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(row["doc_ids"], pa.int64()), lists], ["doc_id", "ids"])


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """``doc_id`` and its ids."""
    blocks = spark.read.schema(BLOCK_SCHEMA).parquet(path)
    return blocks.select("doc_ids", "n_tokens", "words", "escapes").mapInArrow(_ids, "doc_id bigint, ids array<bigint>")
