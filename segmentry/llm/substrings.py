"""Removal of passages that repeat across documents, behind a count-min prefilter.

A window is ``size`` consecutive words. A word is removed if a window over it also starts in a document with a
smaller id.

Documents are dealt into chunks by a hash. In every chunk a sketch counts, in ``DEPTH`` rows of cells, the
windows of its documents. Sketches are sent as blocks of cells; the task that owns a block adds the blocks of all
chunks and answers each chunk with a bit per cell that it filled: whether the total is two or more. A total is
never below a window's true count, so a window whose bit is clear in any row occurs in one document only. Only
the windows that all rows call repeated are grouped exactly, by 96-bit hashes, as one row for each window
and chunk, which gives the smallest id of each. The chunks then cut their texts.

The text is dealt to its chunks once: the three steps that read it share that exchange. The number of cells
follows the number of words, and no task or broadcast holds more than one block or chunk, whatever the size of
the table. A window in a third of all documents is one row for each chunk.

Defined results: null, empty and blank texts have no words, and the hash of the empty text; a text shorter than
a window loses nothing. Documents with one id do not remove from each other; a null id counts as larger
than any other. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from segmentry.llm.hashing import WordHashes, mixed, windows, words_of

cloudpickle.register_pickle_by_value(sys.modules[__name__])

WINDOW_WORDS = 13
# One row of many cells errs as rarely as several rows of few, for fewer bytes sent.
DEPTH = 1
CELLS_PER_WORD = 64
BLOCK_CELLS = 1 << 24
CHUNK_CHARS = 8 << 20
CHARS_PER_WORD = 5
NO_ID = np.iinfo(np.int64).max


def _documents(table: pa.Table, size: int, memory: WordHashes, words: bool = False):
    """Id and window hashes (and words) of each document of a chunk."""
    for doc_id, text in zip(table.column("_id").to_pylist(), table.column("_text"), strict=False):
        found = words_of(text.as_py())
        hashes = memory.of(found) if len(found) >= size else np.empty(0, np.uint64)
        yield (NO_ID if doc_id is None else doc_id), hashes, found if words else None


def cells(hashes: np.ndarray, row: int, n_cells: int) -> np.ndarray:
    """The cell of each window in one row of the sketch."""
    own = mixed(hashes + np.uint64(0xA24BAED4963EE407 * (row + 1) & 0xFFFFFFFFFFFFFFFF))
    return (own % np.uint64(n_cells)).astype(np.int64)


def chunk_cells(windows_of_docs: list[np.ndarray], row: int, n_cells: int) -> tuple[np.ndarray, np.ndarray]:
    """The cells a chunk fills in one row, ascending, and whether it fills them more than once."""
    all_cells = [cells(w, row, n_cells) for w in windows_of_docs if len(w)]
    found, n = np.unique(np.concatenate(all_cells) if all_cells else np.empty(0, np.int64), return_counts=True)
    return found, n > 1


def _sketch(size: int, n_cells: int):
    block_type = pa.schema([("_row", pa.int32()), ("_block", pa.int64()), ("_chunk", pa.int64()), ("_low", pa.binary()), ("_many", pa.binary())])

    def run(table: pa.Table) -> pa.Table:
        memory, chunk = WordHashes(), table.column("_chunk")[0].as_py()
        each = [np.unique(windows(h, size)) for _, h, _ in _documents(table, size, memory)]
        rows = []
        for row in range(DEPTH):
            found, many = chunk_cells(each, row, n_cells)
            cuts = np.searchsorted(found, np.arange(0, n_cells + BLOCK_CELLS, BLOCK_CELLS))
            for block, (a, b) in enumerate(zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)):
                if a < b:
                    low = found[a:b] - block * BLOCK_CELLS
                    rows.append((row, block, chunk, _coded(low), np.packbits(many[a:b]).tobytes()))
        return pa.Table.from_pylist([dict(zip(block_type.names, r, strict=True)) for r in rows], schema=block_type)

    return run


def _coded(ascending: np.ndarray) -> bytes:
    """Gaps between ascending numbers, 16 bits each, 65535 for a gap to be continued; wide gaps as 32-bit numbers."""
    gaps = np.diff(ascending, prepend=-1) - 1
    whole, rest = np.divmod(gaps, 65535)
    if whole.sum() > len(gaps):
        return b"w" + ascending.astype("<u4").tobytes()
    out = np.full(len(gaps) + int(whole.sum()), 65535, "<u2")
    out[np.cumsum(whole + 1) - 1] = rest
    return b"g" + out.tobytes()


def _decoded(data: bytes) -> np.ndarray:
    if data[:1] == b"w":
        return np.frombuffer(data, "<u4", offset=1).astype(np.int64)
    gaps = np.frombuffer(data, "<u2", offset=1).astype(np.int64)
    ends = gaps != 65535
    return np.cumsum(gaps + ends)[ends] - 1


def _merge():
    def run(table: pa.Table) -> pa.Table:
        # Added in slices of the chunks, so that a block's task holds two counts a cell and no list of all.
        once, more = np.zeros(BLOCK_CELLS, bool), np.zeros(BLOCK_CELLS, bool)
        for low, many in zip(table.column("_low"), table.column("_many"), strict=True):
            at = _decoded(low.as_py())
            own = np.unpackbits(np.frombuffer(many.as_py(), np.uint8), count=len(at)).astype(bool)
            more[at] |= once[at] | own
            once[at] = True
        answers = [np.packbits(more[_decoded(low.as_py())]).tobytes() for low in table.column("_low")]
        lengths = [len(_decoded(low.as_py())) for low in table.column("_low")]
        return pa.Table.from_arrays(
            [table.column("_chunk"), table.column("_row"), table.column("_block"), pa.array(lengths, pa.int64()), pa.array(answers, pa.binary())],
            ["_chunk", "_row", "_block", "_n", "_bits"],
        )

    return run


def short(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(32)).astype(np.uint32).view(np.int32)


def _repeated(size: int, n_cells: int):
    kinds = pa.schema([("_h1", pa.int64()), ("_h2", pa.int32()), ("_chunk", pa.int64()), ("_least", pa.int64()), ("_several", pa.bool_())])

    def run(docs: pa.Table, answers: pa.Table) -> pa.Table:
        empty = kinds.empty_table()
        if not docs.num_rows or not answers.num_rows:
            return empty
        memory, chunk = WordHashes(), docs.column("_chunk")[0].as_py()
        ids, each, other = [], [], []
        for doc_id, hashes, _ in _documents(docs, size, memory):
            found, first = np.unique(windows(hashes, size), return_index=True)
            if len(found):
                ids.append(np.full(len(found), doc_id, np.int64))
                each.append(found)
                other.append(short(windows(hashes, size, 1)[first]))
        if not ids:
            return empty
        ids, h1, h2 = np.concatenate(ids), np.concatenate(each), np.concatenate(other)
        answers = answers.to_pandas().sort_values(["_row", "_block"])
        good = np.ones(len(h1), bool)
        for row, bits in answers.groupby("_row"):
            found, _ = chunk_cells(each, row, n_cells)
            flags = np.concatenate([np.unpackbits(np.frombuffer(b, np.uint8), count=n) for b, n in zip(bits["_bits"], bits["_n"], strict=True)])
            good &= flags.astype(bool)[np.searchsorted(found, cells(h1, row, n_cells))]
        ids, h1, h2 = ids[good], h1[good], h2[good]
        order = np.lexsort((ids, h2, h1))
        ids, h1, h2 = ids[order], h1[order], h2[order]
        if not len(ids):
            return empty
        new = np.flatnonzero(np.concatenate([[True], (h1[1:] != h1[:-1]) | (h2[1:] != h2[:-1])]))
        last = np.concatenate([new[1:], [len(ids)]]) - 1
        # A window of one document here may still stand in another chunk.
        columns = [h1[new].view(np.int64), h2[new], np.full(len(new), chunk), ids[new], ids[last] > ids[new]]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds.types, strict=True)], schema=kinds)

    return run


def covered(starts: np.ndarray, n_words: int, size: int) -> np.ndarray:
    """Which words lie in a window that starts at one of ``starts``."""
    edges = np.zeros(n_words + 1, np.int64)
    np.add.at(edges, starts, 1)
    np.add.at(edges, starts + size, -1)
    return np.cumsum(edges[:-1]) > 0


def _cut(size: int, with_text: bool):
    def run(docs: pa.Table, firsts: pa.Table) -> pa.Table:
        memory = WordHashes()
        h1 = np.asarray(firsts.column("_h1")).view(np.uint64)
        h2 = np.asarray(firsts.column("_h2"))
        least = np.asarray(firsts.column("_least"))
        order = np.argsort(h1, kind="stable")
        h1, h2, least = h1[order], h2[order], least[order]
        total, removed, digests, kept_texts = [], [], [], []
        for doc_id, hashes, words in _documents(docs, size, memory, words=True):
            own = windows(hashes, size)
            kept = words
            if len(own) and len(h1):
                at = np.minimum(np.searchsorted(h1, own), len(h1) - 1)
                hit = np.flatnonzero(h1[at] == own)
                if len(hit):
                    second = short(windows(hashes, size, 1)[hit])
                    hit = hit[(h2[at[hit]] == second) & (least[at[hit]] < doc_id)]
                if len(hit):
                    gone = covered(hit, len(words), size)
                    kept = [w for w, g in zip(words, gone.tolist(), strict=True) if not g]
            text = b" ".join(kept)
            total.append(len(words))
            removed.append(len(words) - len(kept))
            digests.append(hashlib.sha256(text).hexdigest())
            kept_texts.append(text.decode("utf-8", "surrogatepass") if with_text else None)
        return pa.table(
            [docs.column("_id"), pa.array(total, pa.int64()), pa.array(removed, pa.int64()), pa.array(digests, pa.string()), pa.array(kept_texts, pa.string())],
            names=["doc_id", "n_words", "n_removed", "kept_sha256", "kept_text"],
        )

    return run


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = WINDOW_WORDS,
                   with_text: bool = True) -> DataFrame:
    """``doc_id``, ``n_words``, ``n_removed``, ``kept_sha256`` and ``kept_text`` (words joined by a blank) of every row."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(F.col(id_col).cast("bigint").alias("_id"), text.alias("_text"))
    chars = rows.agg(F.sum(F.octet_length("_text"))).first()[0] or 0
    chunks = max(1, -(-chars // CHUNK_CHARS), docs.sparkSession.sparkContext.defaultParallelism)
    n_cells = max(BLOCK_CELLS, chars // CHARS_PER_WORD * CELLS_PER_WORD)
    rows = rows.withColumn("_chunk", F.pmod(F.xxhash64("_id", "_text"), F.lit(chunks)))
    by_chunk = rows.groupBy("_chunk")
    sketches = by_chunk.applyInArrow(
        _sketch(size, n_cells), "_row int, _block bigint, _chunk bigint, _low binary, _many binary"
    )
    answers = sketches.groupBy("_row", "_block").applyInArrow(
        _merge(), "_chunk bigint, _row int, _block bigint, _n bigint, _bits binary"
    )
    repeated = by_chunk.cogroup(answers.groupBy("_chunk")).applyInArrow(
        _repeated(size, n_cells), "_h1 bigint, _h2 int, _chunk bigint, _least bigint, _several boolean"
    )
    # At most one row for each chunk in a window's group.
    least = F.min("_least").over(Window.partitionBy("_h1", "_h2"))
    firsts = repeated.withColumn("_first", least).where("_several OR _least > _first").select("_chunk", "_h1", "_h2", F.col("_first").alias("_least"))
    return by_chunk.cogroup(firsts.groupBy("_chunk")).applyInArrow(
        _cut(size, with_text), "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, kept_text string"
    )
