"""The Merkle manifest against trees and proofs made by plain recursion."""

from __future__ import annotations

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from segmentry.llm import manifest, queries
from segmentry.session import scratch_path

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, s string, leaf string, at string, path string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf_of(row, lower=False):
    text = row[1]
    if lower and text is not None:
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
    fields = [row[0], row[3], row[2], row[4], text]
    return h(*["-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields])


def up(nodes):
    """All levels from the nodes to the single one."""
    levels = [nodes]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i : i + 16]) for i in range(0, len(below), 16)])
    return levels


def way(levels, at):
    """Left and right siblings of a node, level by level."""
    out = []
    for nodes in levels[:-1]:
        start = at // 16 * 16
        run = nodes[start : start + 16]
        out.append(("".join(run[: at - start]), "".join(run[at - start + 1 :])))
        at //= 16
    return out


def expected(rows):
    by_source = {}
    for row in rows:
        by_source.setdefault(row[3], []).append(row)
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        inside = sorted(by_source[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf_of(r)))
        trees[s] = (inside, up([leaf_of(r) for r in inside]))
    top = up([trees[s][1][-1][0] for s in names])
    out = []
    for k, s in enumerate(names):
        inside, levels = trees[s]
        for i, row in enumerate(inside):
            proof = way(levels, i) + way(top, k)
            changed = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            at = leaf_of(row, lower=changed)
            for left, right in proof:
                at = h(left, at, right)
            siblings = h(*[left + right for left, right in proof])
            out.append((row[0], leaf_of(row), levels[-1][0], top[-1][0], siblings, at, at == top[-1][0]))
    return sorted(out, key=str)


def many():
    """A hot source of several levels, sources of one leaf and of 17, nulls, repeated rows, a very long text."""
    clash = ("a", "b", "c", "d")
    rows = [(7 * i % 5003, f"Text {i}", "xx", "hot", i, *clash) for i in range(300)]
    rows += [(i, "UPPER é" if i % 2 else None, None, "seventeen", None, *clash) for i in range(17)]
    rows += [(3, "same", "xx", "copies", 4, *clash)] * 40 + [(None, "no id", "xx", "copies", 5, *clash)] * 2
    rows += [(1, "lone", "yy", None, 4, *clash), (2, "", "yy", "", 0, *clash), (5, "A" * 300_000, "yy", "Ünder", 300_000, *clash)]
    return rows + [(10_000 + k, "x", "zz", f"host{k}", 1, *clash) for k in range(20)]


COLUMNS = ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]


def found(df):
    return sorted([tuple(r) for r in df.select(*COLUMNS).collect()], key=str)


@pytest.mark.parametrize("rows", [many(), many()[-1:], many()[:16], many()[:17], many()[300:303]], ids=["all", "one", "16", "17", "three"])
def test_proofs_equal_plain_recursion(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert found(manifest.prove(docs, manifest.lower_cased())) == expected(rows)


def test_nothing(spark):
    assert manifest.prove(spark.createDataFrame([], SCHEMA), manifest.lower_cased()).count() == 0


def test_some_requests_and_stored_records(spark):
    """A few requests get the same proofs as all, and every stored digest is that of its children."""
    docs = spark.createDataFrame(many(), SCHEMA).repartition(3)
    tree = manifest.build(docs, scratch_path(spark, "manifest"))
    wrong = tree.records.where(F.col("digest") != F.sha2(F.array_join("children", "").cast("binary"), 256))
    assert wrong.count() == 0 and tree.records.count() > 20
    asked = tree.leaves.where("doc_id % 50 = 3").select("s", "levels", "rank", "doc_id", "leaf")
    got = manifest.descend(tree, asked)
    folded = got.withColumn("end", manifest.folded(F.col("leaf"), F.col("path")))
    assert folded.count() == asked.count() > 3
    assert {r["end"] for r in folded.collect()} == {tree.root}


def test_query(spark, sf):
    docs = [tuple(r) + ("", "", "", "") for r in spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text", "lang", "source", "n_chars").collect()]
    assert found(queries.QUERIES["op13_merkle_manifest"](spark, sf)) == expected(docs)
