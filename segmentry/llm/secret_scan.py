"""Secrets in texts: known forms, and strings that a battery of randomness tests cannot tell from chance.

Known forms are an assignment to a name such as ``password``, an access key id and a long run of hex digits. Beside
them, every long token is a candidate. From its characters the narrowest encoding is inferred (hex, base32, letters,
letters and digits, base64 ...). Three tests ask whether its symbols are drawn evenly and independently from that
alphabet: chi-squared of the symbol counts, runs above and below the middle of the alphabet, and serial correlation of
neighbours. A token that fails one of them is not random.

Ordinary words can pass the tests when they are short, so passing is not enough. For a token that passes, the chance
is computed that ordinary text of the same length would look as even: the moments of the chi-squared figure follow
from the length and from the shares of the symbols in all text of the table outside the candidates. These chances
go through a weighted Benjamini-Hochberg step over all candidates of the table. Weights grow with the length, up to
``LONGEST_WEIGHED``, and average 1, so long tokens, where the tests have power, get more of the allowed error than
short ones. The step reads a table of counts by length and chance only.

Defined results: spans are counted in code points, end exclusive, over the whole match; null and empty texts have
none; only ASCII letters count as letters of a pattern; very long texts are read whole; decimal numbers are no
candidates (ids, dates and prices are numbers); a token of both ``+/`` and ``-_`` is tried piece by piece; a random
token inside a known form is not listed again; repeated rows each count; an empty table gives no rows.
"""

from __future__ import annotations

import math
import re
import sys
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from segmentry.session import checkpointed

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Fixed patterns of the known forms.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
MIN_ASSIGNED, MIN_ACCESS, MIN_HEX = 8, 16, 32
KINDS = ("assign", "access", "hex", "random")

MIN_TOKEN = 16
# A token is not random if a test of the battery would reject it so rarely by chance.
REJECT = 0.001
# Share of ordinary tokens allowed among those reported as random.
FALSE_SHARE = 0.01
LONGEST_WEIGHED = 64
# Chances are counted in steps of an eighth of a power of two, rounded up, down to 2 ** -1000.
STEPS, LEAST_POWER = 8, 1000

LOWER, UPPER, DIGITS = "abcdefghijklmnopqrstuvwxyz", "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "0123456789"
# Narrowest first; symbols in their usual order.
ENCODINGS = (
    ("hex", DIGITS + "abcdef"),
    ("HEX", DIGITS + "ABCDEF"),
    ("lower", LOWER),
    ("upper", UPPER),
    ("base32", UPPER + "234567"),
    ("base36", DIGITS + LOWER),
    ("BASE36", DIGITS + UPPER),
    ("base62", UPPER + LOWER + DIGITS),
    ("base64", UPPER + LOWER + DIGITS + "+/"),
    ("base64url", UPPER + LOWER + DIGITS + "-_"),
)
SPAN = "array<struct<start:bigint,rank:int,end:bigint,kind:string>>"
CANDIDATES = "array<struct<start:bigint,end:bigint,encoding:int,symbols:bigint,chi:double,passed:boolean>>"


def collision_moments(n: int, shares: np.ndarray) -> tuple[float, float]:
    """Mean and variance of the chi-squared figure against even shares for ``n`` symbols drawn with ``shares``."""
    size, s2, s3 = len(shares), float((shares**2).sum()), float((shares**3).sum())
    mean = size / n * (n * (n - 1) * s2 + n) - n
    pairs = 2 * n * (n - 1) * (s2 - s2 * s2) + 4 * n * (n - 1) * (n - 2) * (s3 - s2 * s2)
    return mean, (size / n) ** 2 * max(pairs, 0.0)


def _cube_root_score(x: float, mean: float, variance: float) -> float:
    """About standard normal for a figure of this mean and variance whose law is close to a gamma law."""
    if mean <= 0 or variance <= 0:
        return 0.0
    spread = variance / (9 * mean * mean)
    return ((max(x, 0.0) / mean) ** (1 / 3) - (1 - spread)) / math.sqrt(spread)


def lower_tail(x: float, n: int, shares: np.ndarray) -> float:
    """Chance that ordinary text of ``n`` symbols is as even as ``x`` or more so."""
    return 0.5 * math.erfc(-_cube_root_score(x, *collision_moments(n, shares)) / math.sqrt(2))


def chi_figure(symbols: np.ndarray, size: int) -> float:
    counts = np.bincount(symbols, minlength=size)
    return float(size / len(symbols) * (counts.astype(np.float64) ** 2).sum() - len(symbols))


def battery(symbols: np.ndarray, size: int) -> tuple[float, float, float]:
    """Chances of the three tests if the symbols are even and independent: chi-squared, runs, serial correlation."""
    n = len(symbols)
    even = 0.5 * math.erfc(_cube_root_score(chi_figure(symbols, size), *collision_moments(n, np.full(size, 1 / size))) / math.sqrt(2))
    high = symbols * 2 >= size
    a = int(high.sum())
    b = n - a
    if a == 0 or b == 0:
        runs = 2.0 ** (1 - n)
    else:
        expected = 2 * a * b / n + 1
        variance = (expected - 1) * (expected - 2) / (n - 1)
        seen = 1 + int((high[1:] != high[:-1]).sum())
        runs = math.erfc(abs(seen - expected) / math.sqrt(2 * variance)) if variance > 0 else 1.0
    centred = symbols - symbols.mean()
    power = float((centred**2).sum())
    serial = math.erfc(abs(float((centred[1:] * centred[:-1]).sum()) / power * math.sqrt(n) + 1 / math.sqrt(n)) / math.sqrt(2)) if power else 0.0
    return even, runs, serial


_ALPHABETS = [frozenset(a) for _, a in ENCODINGS]
_TOKEN = re.compile(r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{%d,}={0,2}" % MIN_TOKEN)
_PIECE = re.compile(r"[A-Za-z0-9]{%d,}" % MIN_TOKEN)
_ASSIGN, _ACCESS, _HEX = re.compile(ASSIGN, re.I | re.A), re.compile(ACCESS), re.compile(HEX)
_NAMES = ("passw", "secret", "token", "api")


def encoding_of(token: str) -> int | None:
    """Place in ENCODINGS of the narrowest one that holds the token; None for numbers and mixtures."""
    used = set(token)
    if used <= set(DIGITS):
        return None
    return next((i for i, alphabet in enumerate(_ALPHABETS) if used <= alphabet), None)


def known_forms(text: str) -> list[tuple[int, int, int, str]]:
    """start, rank, end, kind of the known forms: leftmost and non-overlapping for each kind."""
    found = []
    folded = text.lower()
    if any(name in folded for name in _NAMES):
        found = [(m.start(), 0, m.end(), "assign") for m in _ASSIGN.finditer(text) if len(m[2]) >= MIN_ASSIGNED]
    # Both other forms are made of characters of one token, and longer than the shortest token.
    for m in _TOKEN.finditer(text):
        token, at = m[0], m.start()
        for rank, pattern, least, kind in ((1, _ACCESS, MIN_ACCESS, "access"), (2, _HEX, MIN_HEX, "hex")):
            found += [(at + k.start(), rank, at + k.end(), kind) for k in pattern.finditer(token) if k.end() - k.start() >= least]
    return sorted(found)


def candidates(text: str) -> list[tuple[int, int, int, int, float, bool]]:
    """start, end, encoding, symbols, chi-squared figure and whether all tests passed, of every long token."""
    out = []
    for m in _TOKEN.finditer(text):
        body = m[0].rstrip("=")
        kind = encoding_of(body)
        pieces = [(m.start(), m.end(), body, kind)]
        if kind is None:
            pieces = [(m.start() + k.start(), m.start() + k.end(), k[0], encoding_of(k[0])) for k in _PIECE.finditer(body)]
        for start, end, token, kind in pieces:
            if kind is None:
                continue
            alphabet = ENCODINGS[kind][1]
            symbols = np.fromiter(map(alphabet.index, token), np.int64, len(token))
            passed = min(battery(symbols, len(alphabet))) * 3 >= REJECT
            out.append((start, end, kind, len(token), chi_figure(symbols, len(alphabet)), passed))
    return out


def _first_pass(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Known forms and candidates of each text; at the end of the task one row of byte counts outside candidates."""
    counts = np.zeros(256, np.int64)
    for batch in batches:
        known, tokens = [], []
        for text in batch.column("_text").to_pylist():
            long = len(text) >= MIN_TOKEN
            known.append(known_forms(text) if long or ":" in text or "=" in text else [])
            tokens.append(candidates(text) if long and max(map(len, text.split()), default=0) >= MIN_TOKEN else [])
            counts += np.bincount(np.frombuffer(text.encode("utf-8", "surrogatepass"), np.uint8), minlength=256)
            for start, end, *_ in tokens[-1]:
                counts -= np.bincount(np.frombuffer(text[start:end].encode(), np.uint8), minlength=256)
        rest = [batch.column(i) for i, name in enumerate(batch.schema.names) if name != "_text"]
        yield _row(batch, rest, known, tokens, [None] * batch.num_rows)
    if counts.any():
        nothing = [pa.nulls(1, batch.schema.field(name).type) for name in batch.schema.names if name != "_text"]
        yield _row(batch, nothing, [None], [None], [counts.tolist()])


def _row(batch: pa.RecordBatch, rest: list, known: list, tokens: list, counts: list) -> pa.RecordBatch:
    span = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("kind", pa.string())]))
    token = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("encoding", pa.int32()), ("symbols", pa.int64()), ("chi", pa.float64()), ("passed", pa.bool_())]))
    dicts = lambda rows, kind: pa.array([None if r is None else [dict(zip([f.name for f in kind.value_type], x)) for x in r] for r in rows], kind)
    names = [name for name in batch.schema.names if name != "_text"]
    columns = [*rest, dicts(known, span), dicts(tokens, token), pa.array(counts, pa.list_(pa.int64()))]
    return pa.RecordBatch.from_arrays(columns, [*names, "_known", "_tokens", "_counts"])


def symbol_shares(byte_counts: np.ndarray) -> list[np.ndarray]:
    """Shares of each encoding's symbols in ordinary text, each seen once more than it was."""
    out = []
    for _, alphabet in ENCODINGS:
        seen = byte_counts[[ord(c) for c in alphabet]] + 1.0
        out.append(seen / seen.sum())
    return out


def chance_step(encoding: int, symbols: int, chi: float, passed: bool, shares: list[np.ndarray]) -> int:
    """The chance that ordinary text is so even, as a step; 0 (chance 1) where a test failed."""
    p = lower_tail(chi, symbols, shares[encoding]) if passed else 1.0
    return min(STEPS * LEAST_POWER, int(-math.log2(p) * STEPS)) if p > 0 else STEPS * LEAST_POWER


def weighed(step: int, symbols: int, mean: float) -> float:
    """The chance of a step divided by the weight of a length."""
    return 2.0 ** (-step / STEPS) * mean / min(symbols, LONGEST_WEIGHED)


def weighted_cut(counts: list[tuple[int, int, int]], false_share: float = FALSE_SHARE) -> tuple[float, float]:
    """Mean length and the largest chance by weight that the step-up rule accepts (-1: none).

    ``counts``: length up to LONGEST_WEIGHED, step of the chance, number of candidates.
    """
    total = sum(c for _, _, c in counts)
    if not total:
        return 1.0, -1.0
    mean = sum(n * c for n, _, c in counts) / total
    ordered = sorted((weighed(step, n, mean), c) for n, step, c in counts)
    cut, below = -1.0, 0
    for i, (value, c) in enumerate(ordered):
        below += c
        if i + 1 < len(ordered) and ordered[i + 1][0] == value:
            continue
        if value <= false_share * below / total:
            cut = value
    return mean, cut


def scan(docs: DataFrame, text_col: str = "text", keep: tuple[str, ...] = ("doc_id",), false_share: float = FALSE_SHARE) -> DataFrame:
    """The ``keep`` columns of every row and ``secrets``: start, rank, end, kind of its spans in order.

    The texts are read once. What reaches the driver are 256 byte counts and a table of counts by length and chance.
    """
    text = F.coalesce(F.col(text_col), F.lit("")).alias("_text")
    rows = docs.select(*[F.col(c).alias(f"_keep{i}") for i, c in enumerate(keep)], text)
    fields = [f for f in rows.schema.fields if f.name != "_text"]
    added = T._parse_datatype_string(f"_known {SPAN}, _tokens {CANDIDATES}, _counts array<bigint>")
    schema = T.StructType([*[T.StructField(f.name, f.dataType, True) for f in fields], *added.fields])
    first = checkpointed(rows.mapInArrow(_first_pass, schema))

    summed = first.where("_counts IS NOT NULL").select(F.posexplode("_counts").alias("byte", "n")).groupBy("byte").agg(F.sum("n").alias("n"))
    byte_counts = np.zeros(256)
    for r in summed.collect():  # 256 rows
        byte_counts[r["byte"]] = r["n"]
    shares = symbol_shares(byte_counts)

    texts = first.where("_counts IS NULL").drop("_counts")
    tokens = texts.select(F.explode("_tokens").alias("t")).select("t.*")

    @F.arrow_udf(T.IntegerType())
    def step(encoding: pa.Array, symbols: pa.Array, chi: pa.Array, passed: pa.Array) -> pa.Array:
        rows = zip(encoding.to_pylist(), symbols.to_pylist(), chi.to_pylist(), passed.to_pylist())
        return pa.array([chance_step(*row, shares) for row in rows], pa.int32())

    length = F.least(F.col("symbols"), F.lit(LONGEST_WEIGHED)).cast("int")
    table = tokens.groupBy(length.alias("n"), step("encoding", "symbols", "chi", "passed").alias("step")).count()
    # Bounded by the lengths weighed and the steps, whatever the number of candidates.
    mean, cut = weighted_cut([tuple(r) for r in table.collect()], false_share)

    kind = pa.list_(pa.struct([("start", pa.int64()), ("rank", pa.int32()), ("end", pa.int64()), ("kind", pa.string())]))
    random_rank = KINDS.index("random")

    @F.arrow_udf(T._parse_datatype_string(SPAN))
    def decide(known: pa.Array, tokens: pa.Array) -> pa.Array:
        out = []
        for spans, found in zip(known.to_pylist(), tokens.to_pylist()):
            more = []
            for t in found:
                step = chance_step(t["encoding"], t["symbols"], t["chi"], t["passed"], shares)
                if not t["passed"] or weighed(step, t["symbols"], mean) > cut:
                    continue
                if not any(s["start"] <= t["start"] and t["end"] <= s["end"] for s in spans):
                    more.append({"start": t["start"], "rank": random_rank, "end": t["end"], "kind": KINDS[random_rank]})
            out.append(sorted([*spans, *more], key=lambda s: (s["start"], s["rank"])) if more else spans)
        return pa.array(out, kind)

    return texts.select(*[F.col(f"_keep{i}").alias(c) for i, c in enumerate(keep)], decide("_known", "_tokens").alias("secrets"))
