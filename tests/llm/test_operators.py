"""Every operator against a plain reading of its definition, with nulls, empty and long texts, ties and repeated rows."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

import corpus_pipeline
from segmentry.llm import chat, decontamination, host_rules, language, licenses, mixing, near_dups, queries, substrings, token_files, warc

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, _text string, score string"
rng = random.Random(5)
VOCABULARY = ["".join(rng.choices("abcdefghij", k=rng.randint(2, 7))) for _ in range(400)]


def prose(n, seed):
    return " ".join(random.Random(seed).choices(VOCABULARY, k=n))


def edited(text, share, seed):
    r = random.Random(seed)
    return " ".join(w if r.random() > share else "new" + str(r.random())[2:6] for w in text.split(" "))


def rows():
    long = prose(20_000, 1)
    base = [prose(120, k) for k in range(12)]
    out = [(k, t, "xx" if k % 2 else "yy", f"s{k % 3}") for k, t in enumerate(base)]
    out += [(100 + k, edited(base[0], 0.03 * k, k), "xx", "s0") for k in range(1, 8)]  # a chain of copies
    out += [(200, base[1], "xx", "s1"), (201, base[1].upper(), "xx", None), (202, long, "yy", "s2"), (203, long + " end", "yy", "s2")]
    out += [(300, None, None, None), (301, "", "xx", "s1"), (302, " \n\t", "xx", "s1"), (303, "One", None, "s2"), (304, "one", "xx", "s2")]
    out += [(2, base[2], "yy", "s2"), (None, base[3] + " x", "xx", "s0"), (305, "... 12 !", "yy", "s0"), (306, "Ünder the MIT-License é", "xx", "s0")]
    out += [(307, base[4] + "\n" + base[4] + "\n" + " ".join(base[5].split()[:40]), "yy", "s1")]
    return [(i, t, lang, s, None if t is None else len(t), "clash", "clash") for i, t, lang, s in out]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


def words(text, lower=False):
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


@pytest.mark.parametrize("size", [2, 5])
def test_near_duplicates(docs, nothing, size):
    def shingles(text):
        w = words(text, lower=True)
        return {tuple(w[i : i + size]) for i in range(max(1, len(w) - size + 1))} if w else set()

    given = rows()
    sets = [shingles(r[1]) for r in given]
    group = list(range(len(given)))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if a and b and 100 * len(a & b) >= 80 * len(a | b):
                x, y = group[i], group[j]
                group = [y if g == x else g for g in group]
    least = {}
    for g, r in zip(group, given, strict=True):
        if r[0] is not None:
            least[g] = min(least.get(g, r[0]), r[0])
    want = sorted((str(r[0]), len(s), str(least.get(g)), r[0] == least.get(g)) for r, s, g in zip(given, sets, group, strict=True))
    found = near_dups.near_duplicates(docs, shingle_words=size)
    got = sorted((str(r.doc_id), r.n_shingles, str(r.component_id), r.kept) for r in found.collect())
    assert got == want
    assert near_dups.near_duplicates(nothing, shingle_words=size).count() == 0
    if size == 5:
        kept = near_dups.drop_near_duplicates(docs)
        assert kept.columns == docs.columns
        assert kept.count() == len({g for g, s in zip(group, sets, strict=True) if s}) + sum(not s for s in sets)
        assert {r._text for r in kept.collect()} == {"clash"}


def test_pairs_across_components_are_found_without_their_hub(spark):
    """A bucket's smallest class is like none of two others that are like each other."""
    a = prose(100, 50)
    texts = [(b"1", b"1", edited(a, 0.4, 1)), (b"2", b"2", a), (b"3", b"3", edited(a, 0.02, 3)), (b"4", b"4", prose(100, 51))]
    frame = spark.createDataFrame(texts, "_node binary, _root binary, _text string")
    found = near_dups._pairs_across(frame.drop("_text"), frame.drop("_root"), 2, 80).collect()
    assert (b"2", b"3") in {(bytes(r[0]), bytes(r[1])) for r in found}


def test_rounds_connect_what_all_pairs_connect(spark, monkeypatch):
    """Chains of copies and texts just below the limit: components by rounds are those of all similar pairs."""
    monkeypatch.setattr(near_dups, "ROUND_FACTOR", 2)
    texts = []
    for family in range(4):
        base = prose(120, 300 + family)
        for i in range(12):
            texts.append(edited(base, 0.02 + 0.015 * (i % 6), 40 * family + i))
    nodes = [b"%03d" % i for i in range(len(texts))]
    frame = spark.createDataFrame([(n, n, t) for n, t in zip(nodes, texts, strict=True)], "_node binary, _root binary, _text string")
    held = frame.drop("_root").persist()
    links = near_dups._links_across(near_dups._pairs_across(frame.drop("_text"), held, 2, 80), held, 2, 80)
    sets = [near_dups.shingle_set(t, 2) for t in texts]
    similar = lambda i, j: 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])

    def labels(pairs):
        up = list(range(len(texts)))
        for i, j in sorted(pairs) * len(texts):
            up[i] = up[j] = min(up[i], up[j])
        return up

    found = {(int(bytes(r[0])), int(bytes(r[1]))) for r in links.collect()}
    every = {(i, j) for i in range(len(texts)) for j in range(i) if similar(i, j)}
    assert all(similar(i, j) for i, j in found)
    assert labels(found) == labels(every) and len(every) > len(found)


def test_picks_do_not_depend_on_partitions(spark):
    """Rows of one id and text that differ in other columns: the same one stays, the same ones are mixed."""
    rows = [(7, "a b c d e f", "s", i) for i in range(5)] + [(8, "g h i j k l m n o", "t", 9)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string, mark int")
    dealt = [docs.coalesce(1), docs.repartition(7, "mark"), docs.orderBy(docs["mark"].desc())]
    kept = [sorted(r.mark for r in near_dups.drop_near_duplicates(d).collect()) for d in dealt]
    assert kept[0] == kept[1] == kept[2] and len(kept[0]) == 2
    taken = [sorted(r.mark for r in mixing.mixed_rows(d).collect()) for d in dealt]
    assert taken[0] == taken[1] == taken[2]


def test_budgets_are_met_as_nearly_as_any_subset_meets_them():
    r = random.Random(5)
    for case in range(1500):
        lengths = np.array(sorted(r.sample(range(1, 40), r.randint(1, 6))), np.int64)
        counts = np.array([r.randint(1, 60 if case % 3 == 0 else 4) for _ in lengths], np.int64)
        budget, sums = r.randint(1, int((lengths * counts).sum())), 1
        for length, count in zip(lengths.tolist(), counts.tolist(), strict=True):
            for _ in range(count):
                sums |= sums << length
        take = mixing.fit(lengths, counts, budget)
        assert (take >= 0).all() and (take <= counts).all()
        assert int((lengths * take).sum()) == (sums & ((1 << (budget + 1)) - 1)).bit_length() - 1, (lengths, counts, budget)
    large = mixing.fit(np.array([80_000, 80_001, 90_000]), np.array([2, 2, 2]), 160_001)
    assert int((large * [80_000, 80_001, 90_000]).sum()) == 160_001


def test_tokenizers_that_keep_white_space_are_refused():
    path = queries.tokenizer_path()
    assert token_files.piece_ids(path).tokenizer is not None
    with pytest.raises(ValueError, match="white space"):
        token_files.piece_ids(path.replace("word_bpe_49k", "byte_bpe_50k"))


def test_sketch_estimates_similarity():
    order = near_dups.bucket_order(160)
    r = np.random.default_rng(1)
    for n in (4, 60, 3000):
        common, own = r.integers(0, 2**63, n).astype(np.uint64), r.integers(0, 2**63, n // 4).astype(np.uint64)
        x = near_dups.registers(common, 160, order)
        y = near_dups.registers(np.concatenate([common, own]), 160, order)
        guess = near_dups.estimated(x[None], y[None], np.array([n]), np.array([n + n // 4]))[0]
        assert abs(guess - 0.8) < 0.2


def brute_removed(given, size):
    first = {}
    for i, t, *_ in given:
        w = words(t)
        for k in range(len(w) - size + 1):
            key = tuple(w[k : k + size])
            first[key] = min(first.get(key, float("inf")), float("inf") if i is None else i)
    out = []
    for i, t, *_ in given:
        w, gone = words(t), set()
        for k in range(len(w) - size + 1):
            if first[tuple(w[k : k + size])] < (float("inf") if i is None else i):
                gone.update(range(k, k + size))
        kept = b" ".join(x for k, x in enumerate(w) if k not in gone)
        out.append((str(i), len(w), len(gone), hashlib.sha256(kept).hexdigest(), kept.decode()))
    return sorted(out)


def test_repeated_passages(docs, nothing):
    found = substrings.remove_repeats(docs)
    got = sorted((str(r.doc_id), r.n_words, r.n_removed, r.kept_sha256, r.kept_text) for r in found.collect())
    assert got == brute_removed(rows(), 13)
    assert any(r[2] for r in got)
    assert substrings.remove_repeats(nothing).count() == 0


def test_sketch_codes_keep_every_cell():
    r = np.random.default_rng(2)
    for high in (50, 70_000, 1 << 24):
        cells = np.unique(r.integers(0, high, 40))
        assert (substrings._decoded(substrings._coded(cells)) == cells).all()


def test_simple8b_round_trip():
    r = np.random.default_rng(3)
    edges = np.array([0, 1, (1 << 60) - 1, 1 << 60, (1 << 64) - 1, 5], np.uint64)
    for values in (np.empty(0, np.uint64), edges, *(r.integers(0, 1 << b, 3000).astype(np.uint64) for b in (1, 7, 16, 31, 62))):
        packed, _, escapes = token_files.pack(values)
        assert (token_files.unpack(packed, escapes) == values).all()


def test_token_files(spark, docs, nothing, path):
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    token_files.write_token_files(docs, path, queries.tokenizer_path(), ids_per_block=500)
    want, at = [], 0
    for i, t, *_ in sorted(rows(), key=lambda r: -1 if r[0] is None else r[0]):
        ids = np.array(tokenizer.encode(t or "", add_special_tokens=False).ids + [1], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = token_files.read_digests(spark, path).orderBy("start").collect()
    assert [tuple(r) for r in got] == want
    assert sum(len(r.ids) for r in token_files.read_ids(spark, path).collect()) == at
    token_files.write_token_files(nothing, path + "-none", queries.tokenizer_path())
    assert token_files.read_digests(spark, path + "-none").count() == 0


@pytest.mark.parametrize("text", ["É'S don't it's. ", "a\tb  c\n", "Straße, ÀÉ123 x9.y", "<|endoftext|>x.", "ﬁ ΣΑΣ. İI, ǅ.", "日本語, 12", " "])
def test_pieces_have_the_ids_of_the_text(text):
    tokenizer = Tokenizer.from_file(queries.tokenizer_path())
    assert token_files.PieceIds(tokenizer).of(text, b"").tolist() == tokenizer.encode(text, add_special_tokens=False).ids


def test_frequent_words_stay_remembered_and_blocks_stay_whole(monkeypatch):
    monkeypatch.setattr(token_files, "WORDS_KEPT", 50)
    monkeypatch.setattr(token_files, "BYTES_AT_ONCE", 400)
    tokenizer, met = Tokenizer.from_file(queries.tokenizer_path()), []
    word = token_files.PieceIds._word
    monkeypatch.setattr(token_files.PieceIds, "_word", lambda self, w: (met.append(w), word(self, w))[1])
    pieces = token_files.PieceIds(tokenizer)
    rare = ["".join(chr(97 + i // 26**j % 26) for j in range(4)) for i in range(2000)]
    texts = [f"Often {' '.join(rare[i : i + 40])}, often! 7\n" for i in range(0, 2000, 40)] + ["", "x" * 900]
    found = [pieces.of_texts(run, b"\1\0\0\0") for run in token_files._runs(pa.array(texts))]
    assert len(found) > 20 and sum(w.lower() == "often" for w in met) == 1
    assert len(pieces.words) <= 50 and len(pieces.words.before) <= 50
    want = [tokenizer.encode(t, add_special_tokens=False).ids + [1] for t in texts]
    assert np.concatenate([ids for ids, _ in found]).tolist() == sum(want, [])
    assert np.concatenate([n for _, n in found]).tolist() == [len(ids) for ids in want]


def test_code_lengths_follow_the_trees():
    counts = {}
    for lang, text in (("a", b"abab abc"), ("b", b"bcbc bcd")):
        data = b"\n\n\n" + text
        for at in range(3, len(data)):
            for order in range(4):
                key = (lang, order, data[at - order : at], data[at])
                counts[key] = counts.get(key, 0) + 1
    keys = [o << 32 | int.from_bytes(c, "big") << 8 | s for _, o, c, s in counts]
    model = language.freeze([k[0] for k in counts], np.array(keys), np.array(list(counts.values())))

    def cost(lang, history, symbol, order):
        if order < 0:
            return 8.0
        own = {k[3]: n for k, n in counts.items() if k[:3] == (lang, order, history[len(history) - order :])}
        if not own:
            return cost(lang, history, symbol, order - 1)
        total = sum(own.values()) + len(own)
        return np.log2(total / own[symbol]) if symbol in own else np.log2(total / len(own)) + cost(lang, history, symbol, order - 1)

    texts = [b"abc", b"", b"b", b"xbc d", b"a"]
    data = np.frombuffer(b"".join(texts), np.uint8)
    got = language.code_lengths(model, data, np.concatenate([[0], np.cumsum([len(t) for t in texts])]))
    for t, bits in zip(texts, got, strict=True):
        for lang, value in zip(model.languages, bits, strict=True):
            full = b"\n\n\n" + t
            assert value == pytest.approx(sum(cost(lang, full[:i], full[i], 3) for i in range(3, len(full))), rel=1e-4, abs=1e-4)


def test_no_context_is_cut_for_many_languages():
    """Twenty languages over the same bytes with an order of their own: the table would be too large."""
    r = np.random.default_rng(8)
    langs, keys, counts, texts = [], [], [], []
    for k in range(20):
        shift = {c: r.permutation(60)[:4] for c in range(60)}
        at, out = [0], []
        for _ in range(12_000 if k else 1200):  # one language with few rows
            at.append(int(shift[at[-1]][r.integers(4)]))
        data = np.array(at[1:]) + 65
        full = np.concatenate([[10, 10, 10], data])
        own = Counter()
        for o in range(4):
            own.update((o << 32 | sum(full[3 - j : len(full) - j].astype(np.int64) << 8 * j for j in range(o + 1))).tolist())
        out = [1] + [int(shift[1][0])]
        while len(out) < 200:
            out.append(int(shift[out[-1]][r.integers(4)]))
        texts.append(bytes(65 + x for x in out))
        langs += [f"l{k:02d}"] * len(own)
        keys += list(own)
        counts += list(own.values())
    given = langs, np.array(keys), np.array(counts)
    data, offsets = np.frombuffer(b"".join(texts) + b"\xff~", np.uint8), np.append(np.arange(21) * 200, 4002)
    model, full = language.freeze(*given), language.freeze(*given, table_cells=10**9)
    assert model.trees and not full.trees
    got, want = (language.code_lengths(m, data, offsets) for m in (model, full))
    assert got == pytest.approx(want, rel=1e-4)
    assert got[:20].argmin(1).tolist() == list(range(20))
    assert sum(x.nbytes for part in model.trees for x in part) < 40 * len(keys)


def test_language_id(spark, sf, docs, nothing):
    found = queries.op5_language_id(spark, sf)
    truth = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang")
    held = found.join(truth, "doc_id").where("held_out")
    assert held.where("lang = lang_pred").count() > 0.95 * held.count()
    own = {str(r.doc_id): r for r in language.predict(docs, language.train(docs)).collect()}
    assert all(own[k].lang_pred == "und" and own[k].score == 0 for k in ("300", "301", "302", "305"))
    assert own["0"].lang_pred in ("xx", "yy")
    assert {r.lang_pred for r in language.predict(docs, language.train(nothing)).collect()} == {"und"}
    assert language.predict(nothing, language.train(nothing)).count() == 0


def test_targets_and_budgets():
    assert mixing.targets({"a": 100, "b": 100, "c": 100, None: 0}) == pytest.approx({"a": 187.5, "b": 75.0, "c": 37.5, None: 0.0})
    assert mixing.targets({"a": 10, "b": 500}) == {"a": 30.0, "b": 480.0}
    lengths, counts = np.array([3, 5, 9]), np.array([2, 2, 4])
    reach = {3 * a + 5 * b + 9 * c for a in range(3) for b in range(3) for c in range(5)}
    for budget in range(0, 53):
        take = mixing.knapsack(lengths, counts, budget)
        assert (take <= counts).all() and int((take * lengths).sum()) == max(s for s in reach if s <= budget)
    many = mixing.fit(np.array([7, 11, 1000]), np.array([10**6, 10**6, 10**6]), 123_456_789)
    assert int((many * np.array([7, 11, 1000])).sum()) == 123_456_789


def test_mix(docs, nothing):
    found = mixing.mix(docs).collect()
    sizes = sorted((str(r[0]), len(words(r[1]))) for r in rows())
    assert sorted((str(r.doc_id), r["size"]) for r in found) == sizes
    assert all(r.taken % max(r["size"], 1) == 0 and r.taken <= 3 * r["size"] for r in found)
    for source in {r.source for r in found}:
        own = [r for r in found if r.source == source]
        assert sum(r["size"] for r in own) == own[0].source_size
        assert sum(r.taken for r in own) <= own[0].target + 1
    again = mixing.mix(docs.repartition(5)).collect()
    assert Counter((r.doc_id, r.taken) for r in again) == Counter((r.doc_id, r.taken) for r in found)
    mixed = mixing.mixed_rows(docs)
    assert mixed.columns == docs.columns and mixed.count() == sum(r.times for r in found)
    assert mixing.mix(nothing).count() == 0 and mixing.mixed_rows(nothing).count() == 0


def test_alignment_score():
    def slow(a, b):
        table, best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)], 0
        for i in range(1, len(a) + 1):
            for j in range(1, len(b) + 1):
                step = table[i - 1][j - 1] + (2 if a[i - 1] == b[j - 1] else -1)
                table[i][j] = max(0, step, table[i - 1][j] - 1, table[i][j - 1] - 1)
                best = max(best, table[i][j])
        return best

    r = np.random.default_rng(4)
    for _ in range(50):
        a, b = r.integers(0, 4, r.integers(1, 9)), r.integers(0, 4, r.integers(1, 14))
        assert decontamination.local_score(a, b)[0] == slow(a.tolist(), b.tolist())


def test_decontamination(spark, docs, nothing):
    item = prose(40, 900)
    changed = item.split()
    changed[10], changed[20] = "other", "words"
    del changed[30]
    texts = [(1, prose(50, 901) + " " + item.upper() + ". " + prose(50, 902)), (2, prose(60, 903) + " " + " ".join(changed)),
             (3, prose(100, 904)), (4, None), (5, ""), (6, item), (6, item), (7, "Tiny item here")]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    bench = spark.createDataFrame([(9, item), (8, None), (7, ""), (6, "tiny item"), (9, item)], "item_id bigint, text string")
    found = sorted((r.doc_id, r.item_id) for r in decontamination.find_leaks(frame, bench).collect())
    assert found == [(1, 9), (2, 9), (6, 9), (6, 9), (7, 6)]
    assert sorted(r.doc_id for r in decontamination.drop_leaks(frame, bench).collect()) == [3, 4, 5]
    assert decontamination.drop_leaks(docs, bench).columns == docs.columns
    assert decontamination.find_leaks(frame, bench.limit(0)).count() == 0
    assert decontamination.find_leaks(nothing, bench).count() == 0


@pytest.mark.parametrize("copies", [1, 2, 1000])
def test_an_edited_copy_is_found_however_often_it_stands(spark, copies):
    item = prose(40, 910)
    changed = " ".join(f"new{k}" if k % 5 == 4 else w for k, w in enumerate(item.split()))
    texts = [(k, f"{prose(20, k)} {changed} {prose(20, 5000 + k)}") for k in range(copies)] + [(-1, prose(80, 911))]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    bench = spark.createDataFrame([(9, item)], "item_id bigint, text string")
    found = decontamination.find_leaks(frame, bench).collect()
    assert sorted((r.doc_id, r.item_id) for r in found) == [(k, 9) for k in range(copies)]
    assert min(r.score for r in found) >= 0.7


def test_every_text_that_reaches_the_limit_is_found(monkeypatch):
    """Against the alignment of every item with every whole text; few different words, so that seeds are common."""
    monkeypatch.setattr(decontamination, "PIECE_WORDS", 50)
    r = random.Random(12)
    items = [(k, " ".join(r.choices(VOCABULARY[:60], k=n))) for k, n in enumerate([8, 9, 10, 11, 12, 15, 23, 40, 59] * 2)]
    texts = []
    for _, item in items:
        w = item.split()
        for edits in range(0, len(w) + 1, 1 + len(w) // 9):
            own = list(w)
            for _ in range(edits):
                k = r.randrange(len(own))
                own[k : k + 1] = r.choice([["x"], [], [own[k], "y"], [own[k], *r.choices(VOCABULARY[:60], k=3)]]) if len(own) > 1 else own
            texts.append(" ".join(r.choices(VOCABULARY[:60], k=70) + own + r.choices(VOCABULARY[:60], k=30)))
        texts += [" ".join(x + " z" * (k % 2) for k, x in enumerate(w)), " ".join(w[: len(w) // 2] + ["z"] * (len(w) // 2) + w[len(w) // 2 :])]
    loaded, known, hashes = decontamination.load_items(items, 0.6), {}, decontamination.WordHashes()
    reached = 0
    for text in texts:
        words = hashes.of(decontamination.plain_words(text))
        want = {}
        for i, own in enumerate(loaded.words):
            score = decontamination.local_score(own, words)[0]
            if score >= 0.6 * 2 * len(own):
                want[i] = score / (2 * len(own))
        assert {i: score for i, score, _ in decontamination.matches(loaded, words, known)} == want
        reached += len(want)
    assert len(items) < reached < len(texts) * len(items) // 4


def test_short_items_and_inserted_words(spark):
    seven, long = "my dog ate seven warm apple pies", prose(20, 920)
    texts = [(1, "so my dog ate nine warm apple pies today"), (2, "so my dog ate nine cold apple pies today"), (3, "warm apple pies"),
             (4, " ".join(w + " oh" * (k % 2) for k, w in enumerate(long.split()))), (5, "apple"), (6, "pie apple")]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string")
    bench = spark.createDataFrame([(7, seven), (20, long), (1, "pie"), (2, "apple tart")], "item_id bigint, text string")
    found = {(r.doc_id, r.item_id): r.score for r in decontamination.find_leaks(frame, bench).collect()}
    assert found == {(1, 7): pytest.approx(11 / 14), (4, 20): pytest.approx((2 * 20 - 9) / 40), (6, 1): 1.0}
    assert [decontamination.least_share(n, 0.6) for n in (1, 8, 50)] == [1.0, 0.6, 0.6]
    # One changed word inside, at an end.
    assert [n for n in range(2, 9) if 1 - 1.5 / n >= decontamination.least_share(n, 0.6)] == [6, 7, 8]
    assert [n for n in range(2, 9) if 1 - 1 / n >= decontamination.least_share(n, 0.6)] == [5, 6, 7, 8]


def test_licenses(spark, nothing):
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy of this fine software and associated documentation files"
    texts = [(1, "Released under the MIT License, under the mit license"), (2, "é under-the mit.license"), (3, "Apache License Version 2 CC BY NC cc by nc"),
             (4, None), (5, ""), (6, "under the MITÉ license"), (7, mit), (1, "Released under the MIT License, under the mit license"), (None, "cc by nc")]
    frame = spark.createDataFrame(texts, "doc_id bigint, text string").withColumn("labels", F.lit("clash"))
    phrases = {"mit": "under the mit license", "apache-2": "apache license version 2", "cc-by-nc": "cc by nc"}
    for r in licenses.scan(frame).collect():
        text = next(t for i, t in texts if i == r.doc_id) or ""
        w = re.findall(licenses.WORD, re.sub("[A-Z]", lambda m: m[0].lower(), text))
        at = [(k, label) for label, p in phrases.items() for k in range(len(w)) if w[k : k + len(p.split())] == p.split()]
        want = (len(w), len(at), min(at)[0] if at else None, max(at)[0] if at else None, ",".join(sorted({x for _, x in at})))
        assert (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) == want
        assert set(filter(None, r.base_labels.split(","))) <= set(r.labels.split(",")) and 0 <= r.score <= 1
        if r.doc_id == 7:
            assert r.labels == "mit" and r.n_base == 0
    assert licenses.scan(frame).count() == len(texts) and licenses.scan(nothing).count() == 0


def test_chat(spark):
    own = "</s>[INST] ok [/INST]"
    turns = [(1, 0, "user", "a <|turn|> b"), (1, 1, "user", "<\\|text|>"), (1, 2, "assistant", "x<|end|>"), (1, 3, "assistant", "y"), (1, 3, "assistant", "y"),
             (2, 0, "assistant", None), (3, None, None, "z"), (3, 1, "assistant", "<\\\\|more|>\n"), (None, 0, "user", "q"), (-7, 0, "user", own), (-7, 1, "assistant", own)]
    frame = spark.createDataFrame(turns, "conv_id bigint, turn bigint, role string, text string").withColumn("formatted", F.lit(1))
    done = chat.format_conversations(frame)
    read = done.select("conv_id", chat.read_turns(F.col("formatted")).alias("t"), chat.loss_text(F.col("formatted"), F.col("loss")).alias("l"), "formatted")
    for r in read.collect():
        mine = sorted((t for t in turns if t[0] == r.conv_id), key=lambda t: (-1 if t[1] is None else t[1], t[2] or "", t[3] or ""))
        assert [(t.role, t.text) for t in r.t] == [(t[2] or "", t[3] or "") for t in mine]
        assert r.l == "".join(t[3] or "" for t in mine if t[2] == "assistant")
        if r.conv_id == 1:
            assert r.formatted.count("<|turn|>") == 2 and r.formatted.count("<|more|>") == 3
    assert chat.format_conversations(frame.limit(0)).count() == 0


def test_host_rules(docs, nothing):
    def figures(text):
        w = re.findall("[^\x20\x09-\x0d]+", text or "")
        grams = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        under = {i + j for i in range(len(w) - 2) if grams[tuple(w[i : i + 3])] > 1 for j in range(3)}
        lines = [x for x in (text or "").split("\n") if re.search("[^\x20\x09-\x0d]", x)]
        symbols = sum(c in "#*$%&|<>" for c in text or "")
        return len(w), sum(map(len, w)), symbols, len(lines) - len(set(lines)), len(under)

    got = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in host_rules.judge(docs).collect())
    assert got == sorted((str(r[0]), *figures(r[1])) for r in rows())
    for r in host_rules.judge(docs).collect():
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words) and not (r.base_failed and r.kept)
    assert host_rules.judge(nothing).count() == 0


def test_a_bad_host_loses_its_other_documents(spark):
    hosts = [("bad", k < 99) for k in range(100)] + [(f"h{k}", False) for k in range(20) for _ in range(10)] + [("one", True), (None, False)]
    frame = spark.createDataFrame(hosts, "_host string, base_failed boolean")
    verdict = {r["_host"]: r.host_kept for r in host_rules.host_verdicts(frame).collect()}
    assert verdict["bad"] is False and verdict["one"] is True and verdict[None] is True and verdict["h3"] is True


def test_warc(spark, path):
    pages = [(1, "http://a/?q=1", "<html><script>x<b></script><p>Tom &amp; <b>Ann</b>&nbsp;&lt;3</p></html>"), (2, None, None), (3, "u", ""), (3, "u", ""), (None, "v", "é WARC/1.1\r\n\r\nWARC-Type: x")]
    frame = spark.createDataFrame(pages, "page_id bigint, url string, html string").withColumn("payload", F.lit("clash"))
    warc.write_warc(warc.derived(warc.responses(frame)), path)
    read = warc.read_warc(spark, path).collect()
    assert Counter(r.warc_type for r in read) == {"metadata": 5, "conversion": 5}
    text = {r.uri: r.content for r in read if r.warc_type == "conversion"}
    assert text["http://a/?q=1"] == "Tom & Ann <3" and text[""] == "" and text["v"] == "é WARC/1.1 WARC-Type: x"
    for r in read:
        assert r.block_digest == "sha256:" + hashlib.sha256(r.content.encode()).hexdigest()
        other = [x for x in read if x.record_id == r.concurrent_to]
        assert other and all(x.refers_to == r.refers_to and x.warc_type != r.warc_type for x in other)
        if r.warc_type == "metadata":
            assert "http-content-type: text/html" in r.content and r.source_digest in r.content


def test_pipeline(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "documents.parquet"))
    item = prose(120, 7)
    spark.createDataFrame([(1, " ".join(item.split()[5:60]))], "item_id bigint, text string").write.parquet(str(tmp_path / "benchmark.parquet"))
    kept = docs
    for _, stage in corpus_pipeline.STAGES[:-1]:
        kept = stage(spark, kept, str(tmp_path))
        assert kept.columns == docs.columns
        kept = spark.createDataFrame(kept.collect(), docs.schema)
    ids = Counter(r.doc_id for r in kept.collect())
    assert not {7, 300, 301, 302, 305} & set(ids)
    out = corpus_pipeline.run(spark, str(tmp_path)).orderBy("start").collect()
    assert Counter(r.doc_id for r in out) == ids
    starts = [r.start for r in out]
    assert starts == [0, *np.cumsum([r.n_tokens for r in out])[:-1].tolist()]


def test_pipeline_keeps_what_the_languages_explain(spark, docs):
    foreign = [(900, "東京は日本の首都であり、世界でも最大級の都市です。" * 5), (901, "Ж"), (902, prose(3, 77)), (903, prose(300, 78)), (904, "12 345")]
    more = spark.createDataFrame([(i, t, None, "s0", len(t), "clash", "clash") for i, t in foreign], SCHEMA)
    kept = corpus_pipeline.known_language(spark, docs.unionByName(more), "")
    ids = {r.doc_id for r in kept.collect()}
    assert {901, 902, 903, *range(12), *range(101, 108)} <= ids and not {900, 904, 300, 301, 302, 305} & ids
    unlabelled = docs.withColumn("lang", F.lit(None).cast("string"))
    kept = corpus_pipeline.known_language(spark, unlabelled, "")
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(r[0]) for r in rows() if re.search("[^\\W\\d_]", r[1] or ""))


def test_parities_never_rule_out_a_similar_pair():
    rng = np.random.default_rng(3)
    for size in (1, 40, 400, 9000):
        a = np.unique(rng.integers(0, 1 << 63, size).astype(np.uint64))
        b = np.unique(np.concatenate([a[size // 9 :], rng.integers(0, 1 << 63, size // 9 + 1).astype(np.uint64)]))
        differ = sum((x ^ y).bit_count() for x, y in zip(*([v % (1 << 64) for v in near_dups.parities(s)] for s in (a, b)), strict=True))
        assert differ <= len(np.setxor1d(a, b))
