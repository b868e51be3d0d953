"""Language by prediction by partial matching over bytes.

For every language a tree of byte contexts of up to three bytes is counted on a bounded sample of labelled
rows and then frozen. The code length of a byte follows the tree: in the longest context the language has
seen, a byte seen there costs log2((n + d) / count), any other byte costs an escape, log2((n + d) / d), and
is coded in the next shorter context (n: bytes seen, d: different bytes seen); below the empty context every
byte costs 8 bits. A text gets the language that codes it in the fewest bits.

The frozen trees become one table: the longest context that any language knows, times byte, gives the exact
code length in each language, so a text is scored with a few vector lookups per byte. Where that table would have more
than ``TABLE_CELLS`` cells, the trees stay as they were counted, an entry for each context or byte that a language has
seen, and the code lengths of the different runs of four bytes in a text are put together from them. Nothing is cut.

Defined results: a null text, or one without a letter, is ``und`` with score 0, and so is every text if no
labelled row can be learned from. Equal code lengths go to the smaller language name. The score is the
share of the chosen language when languages are weighed by 2 to the minus code length. Repeated rows are
judged alike; other columns are not read.
"""

from __future__ import annotations

import sys
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Rows learned from for each language, whole texts: those with the smallest hashed ids.
SAMPLE_ROWS = 400
# The table holds so many code lengths at most; larger ones are not built.
TABLE_CELLS = 8_000_000
CELLS_PER_STEP = 1 << 20  # code lengths at once: bytes of texts times languages
UNKNOWN = "und"
ORDERS = 4  # contexts of 0 to 3 bytes
BEFORE = ord("\n")  # what stands before a text


@dataclass
class Model:
    languages: list[str]
    symbols: np.ndarray  # byte -> symbol; 0 for a byte that was never seen
    states: np.ndarray  # last three symbols -> longest known context
    bits: np.ndarray  # context * side + symbol -> code length in each language
    side: int  # number of symbols
    trees: tuple | None = None  # escapes by context and code lengths by context and byte, where there is no table


def held_out(id_col: str = "doc_id") -> Column:
    """Documents whose label is never learned from; false for a null id."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 4 == 2, F.lit(False))


def has_letter(text_col: str = "text") -> Column:
    return F.coalesce(F.col(text_col).rlike(r"\p{L}"), F.lit(False))


def _sample(labelled: DataFrame, rows: int) -> DataFrame:
    """At most ``rows`` rows of each language, the same in every run."""
    labelled = labelled.withColumn("_h", F.xxhash64("_id", F.lit(17)))
    narrow = labelled.select("_lang", "_id", "_h").distinct()
    order = Window.partitionBy("_lang").orderBy("_h", "_id")
    chosen = narrow.withColumn("_r", F.row_number().over(order)).where(F.col("_r") <= rows).select("_lang", "_id", "_h")
    # At most ``rows`` rows of three narrow columns for each language.
    return labelled.join(F.broadcast(chosen), ["_lang", "_h", "_id"]).select("_lang", "_text")


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        langs = batch.column(0).to_pylist()
        texts = batch.column(1).to_pylist()
        for lang in sorted(set(langs)):
            keys = []
            for own, text in zip(langs, texts, strict=True):
                data = text.encode("utf-8", "surrogatepass") if own == lang else b""
                if data:
                    full = np.frombuffer(bytes([BEFORE]) * (ORDERS - 1) + data, np.uint8).astype(np.int64)
                    n = len(data)
                    key = np.zeros(n, np.int64)
                    for order in range(ORDERS):
                        first = ORDERS - 1 - order
                        key |= full[first : first + n] << (8 * order)
                        keys.append(key | order << 32)
            if keys:
                # Key: the byte lowest, the bytes before it above, the order on top.
                found, n = np.unique(np.concatenate(keys), return_counts=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(found)), pa.array(found), pa.array(n.astype(np.int64))], ["_lang", "_key", "_n"]
                )


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id",
          sample_rows: int = SAMPLE_ROWS, table_cells: int = TABLE_CELLS) -> Model:
    """Counts the trees on at most ``sample_rows`` rows of each language that are not held out."""
    labelled = docs.where(~held_out(id_col)).select(
        F.col(lang_col).alias("_lang"), F.col(id_col).alias("_id"), F.col(text_col).alias("_text")
    ).dropna(subset=["_lang", "_id", "_text"])
    counts = _sample(labelled, sample_rows).mapInArrow(_count, "_lang string, _key bigint, _n bigint")
    # Bounded by the sample: a row for each context and byte of it.
    table = counts.groupBy("_lang", "_key").agg(F.sum("_n").alias("_n")).toArrow()
    names = table["_lang"].combine_chunks().dictionary_encode()
    langs = np.array(names.dictionary.to_pylist(), str)[np.asarray(names.indices)]
    return freeze(langs, np.asarray(table["_key"]), np.asarray(table["_n"]), table_cells)


def _trees(names: np.ndarray, lang: np.ndarray, value: np.ndarray) -> tuple:
    """Distinct names in order, where the entries of each begin, and their languages and values."""
    order = np.lexsort((lang, names))
    known, first = np.unique(names[order], return_index=True)
    return known, np.append(first, len(names)), lang[order].astype(np.int32), value[order].astype(np.float32)


def freeze(langs: list[str] | np.ndarray, keys: np.ndarray, counts: np.ndarray, table_cells: int = TABLE_CELLS) -> Model:
    """Exact code lengths from counts of (order, context, byte) by language."""
    if not len(langs):
        return Model([], np.zeros(256, np.uint8), np.zeros(1, np.int32), np.zeros((1, 0), np.float32), 1)
    languages, lang = np.unique(np.asarray(langs, str), return_inverse=True)
    languages = languages.tolist()
    order, byte, context = keys >> 32, keys & 255, (keys & 0xFFFFFFFF) >> 8
    seen = np.unique(np.append(byte, BEFORE))
    a, many = len(seen) + 1, len(languages)
    names = order << 24 | context
    states, own = np.unique(names, return_inverse=True)
    if len(states) * a * many > table_cells:
        trees, where = np.unique(names * many + lang, return_inverse=True)
        total, kinds = np.bincount(where, counts), np.bincount(where)
        return Model(
            languages, np.arange(256, dtype=np.int32), np.zeros(1, np.int32), np.zeros((1, many), np.float32), 256,
            (_trees(trees // many, trees % many, np.log2((total + kinds) / kinds)),
             _trees(keys, lang, np.log2((total + kinds)[where] / counts))),
        )
    symbols = np.zeros(256, np.int32)
    symbols[seen] = np.arange(1, a)
    n = np.zeros((len(states), a, many), np.int32)
    n[own, symbols[byte], lang] = counts
    bits = np.empty((len(states), a, many), np.float32)
    lookup = np.zeros((a, a, a), np.int32)
    for o in range(ORDERS):
        rows = np.flatnonzero(states >> 24 == o)
        if not len(rows):
            continue
        c = states[rows] & 0xFFFFFF
        for some in np.array_split(np.arange(len(rows)), 1 + n[rows[0]].size * len(rows) // (1 << 19)):
            at = rows[some]
            if o == 0:
                shorter = np.full((len(at), a, many), 8.0)
            else:
                parent = np.searchsorted(states, (o - 1) << 24 | (c[some] & ((1 << 8 * (o - 1)) - 1)))
                shorter = bits[parent].astype(np.float64)
            total, kinds = n[at].sum(1, keepdims=True), (n[at] > 0).sum(1, keepdims=True)
            with np.errstate(divide="ignore", invalid="ignore"):
                found = np.log2((total + kinds) / n[at])
                other = np.log2((total + kinds) / kinds) + shorter
            bits[at] = np.where(total == 0, shorter, np.where(n[at] > 0, found, other))
        # Bytes before, nearest lowest in ``c``; nearest last in the lookup.
        s1, s2, s3 = (symbols[(c >> 8 * j) & 255] for j in range(3))
        if o == 0:
            lookup[:] = rows[0]
        elif o == 1:
            for r, x in zip(rows, s1, strict=True):
                lookup[:, :, x] = r
        elif o == 2:
            for r, x, y in zip(rows, s1, s2, strict=True):
                lookup[:, y, x] = r
        else:
            lookup[s3, s2, s1] = rows
    return Model(languages, symbols, lookup.reshape(-1), bits.reshape(len(states) * a, many), a)


def _costs(model: Model, keys: np.ndarray) -> np.ndarray:
    """Bits of bytes in every language from the trees; ``keys``: the byte lowest, the three before it above."""
    distinct, where = np.unique(keys, return_inverse=True)
    bits = np.full((len(distinct), len(model.languages)), 8.0)
    for o in range(ORDERS):
        escapes = o << 24 | (distinct >> 8) & ((1 << 8 * o) - 1)
        found = o << 32 | distinct & ((1 << 8 * (o + 1)) - 1)
        for names, (known, first, lang, value) in zip((escapes, found), model.trees, strict=True):
            at = np.minimum(np.searchsorted(known, names), len(known) - 1)
            rows = np.flatnonzero(known[at] == names)
            low = first[at[rows]]
            n = first[at[rows] + 1] - low
            own = np.repeat(low - np.cumsum(n) + n, n) + np.arange(n.sum())
            cell = np.repeat(rows, n), lang[own]
            bits[cell] = value[own] + (bits[cell] if names is escapes else 0)
    return bits.astype(np.float32)[where]


def code_lengths(model: Model, data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Bits of every text in every language; ``data`` holds the texts' bytes, text i from offsets[i] on."""
    side = model.side
    out = np.zeros((len(offsets) - 1, len(model.languages)))
    first, last = int(offsets[0]), int(offsets[-1])
    before = model.symbols[BEFORE]
    starts = offsets[:-1][np.diff(offsets) > 0]
    numbers = np.flatnonzero(np.diff(offsets) > 0)
    step = max(1, CELLS_PER_STEP // max(1, len(model.languages)))
    for low in range(first, last, step):
        high = min(low + step, last)
        back = min(ORDERS - 1, low - first)
        symbols = model.symbols[data[low - back : high]]
        symbols = np.concatenate([np.full(ORDERS - 1 - back, before, symbols.dtype), symbols])
        n = high - low
        near = [symbols[ORDERS - 1 - j : ORDERS - 1 - j + n].copy() for j in range(1, ORDERS)]
        lo, hi = np.searchsorted(starts, [low, high])
        for j in range(1, ORDERS):
            for k in range(j):  # the k-th byte of a text has only k bytes before it
                at = starts + k
                at = at[(at >= low) & (at < high)] - low
                # Beyond the end of a short text, this is a place as near to the start of a later one.
                near[j - 1][at] = before
        if model.trees:
            costs = _costs(model, ((near[2].astype(np.int64) << 8 | near[1]) << 8 | near[0]) << 8 | symbols[ORDERS - 1 :])
        else:
            context = (near[2] * side + near[1]) * side + near[0]
            costs = model.bits[model.states[context] * side + symbols[ORDERS - 1 :]]
        if lo == hi or starts[lo] > low:
            lo -= 1  # the text that began before this step
        cuts = np.maximum(starts[lo:hi] - low, 0)
        out[numbers[lo:hi]] += np.add.reduceat(costs, cuts, axis=0, dtype=np.float64)
    return out


def _predicted(model_ref, added: tuple[str, ...]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(*model_ref.value)
        for batch in batches:
            text = batch.column(0).cast(pa.large_binary())
            known = np.asarray(batch.column(1)).astype(bool)
            offsets = np.frombuffer(text.buffers()[1], np.int64, len(text) + 1, text.offset * 8)
            data = np.frombuffer(text.buffers()[2], np.uint8) if text.buffers()[2] else np.empty(0, np.uint8)
            names, score, gain = [UNKNOWN] * len(text), np.zeros(len(text)), np.zeros(len(text))
            if model.languages and len(text):
                bits = code_lengths(model, data, offsets)
                best = bits.argmin(1)
                share = 1 / np.exp2(bits.min(1, keepdims=True) - bits).sum(1)
                names = [model.languages[b] if k else UNKNOWN for b, k in zip(best.tolist(), known.tolist(), strict=True)]
                score = np.where(known, share, 0.0)
                gain = 8.0 * np.diff(offsets) - bits.min(1)
            found = [pa.array(names), pa.array(score), pa.array(gain)][: len(added)]
            yield pa.RecordBatch.from_arrays([*batch.columns[2:], *found], [*batch.schema.names[2:], *added])

    return run


def predict(docs: DataFrame, model: Model, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",),
            added: tuple[str, ...] = ("lang_pred", "score")) -> DataFrame:
    """The columns ``keep`` with the language and its score as ``added``; only the text decides.

    A third name in ``added`` gets the bits that the language saves against 8 a byte, the price under no model.
    """
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(text.alias("__llm_text"), has_letter(text_col).alias("__llm_known"), *keep)
    kinds = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.select(*keep).schema)
    ref = docs.sparkSession.sparkContext.broadcast(tuple(vars(model).values()))  # bounded by TABLE_CELLS or the sample
    more = ", ".join(f"`{a}` {kind}" for a, kind in zip(added, ("string", "double", "double")))
    return rows.mapInArrow(_predicted(ref, added), f"{kinds}, {more}")
