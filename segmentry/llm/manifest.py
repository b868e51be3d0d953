"""Merkle manifest of a data set: a content-addressed tree, proofs by descent from the root, and their check.

Every row becomes a leaf digest. Within each source the leaves in order of their ids, and then the sources' own
roots in order of the source, are hashed together sixteen at a time until one digest is left. What is stored are
records ``digest -> children`` and the place of every leaf, not the proofs.

A proof is found by descent. A request knows the rank of its source and of its leaf; written to base 16, these ranks
are the way from the root. At each step the record of the digest reached so far is looked up, the child that the
next digit selects is entered, and the children not selected are kept as the path segment of that step; the
segments in reverse order are the proof. Requests whose next digits are the same go down together as one row, so a
step handles a sixteenth of the rows of the step below it, and the leaves themselves are moved once.

Defined results: null fields hash as ``-``, an empty text as ``0:``; a null source comes first and a null id first
within its source; rows of one source and id are ordered by their leaf digests, so repeated rows have neighbouring
places and each its own proof; very long texts are hashed whole where they lie and never shuffled; a lone leaf is its
source's root, a lone source's root the whole root; an empty table has no rows and no root; other columns are not read.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from segmentry.functions.ordering import row_numbers
from segmentry.session import checkpointed, scratch_path

FANOUT = 16
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
# Path tables of so many rows at most are copied to the tasks instead of being shuffled.
BROADCAST_ROWS = 10_000
SEGMENTS = "array<struct<left:string,right:string>>"


def digest(*parts: Column) -> Column:
    """Lower-case hex SHA-256 of the parts put together."""
    return F.sha2(F.concat(*parts).cast("binary"), 256)


def leaf_digest(*fields: Column) -> Column:
    """The digest of a row: each field as its length in bytes, a colon and its text, or ``-`` for null."""
    text = [f.cast("string") for f in fields]
    return digest(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in text])


@dataclass
class Manifest:
    """Written tables of one data set.

    ``leaves``: source, its rank, id, leaf, the leaf's rank, and the columns carried along. ``sources``: rank, source,
    number of leaves, number of levels above them, subroot. ``records``: digest, children.
    """

    leaves: DataFrame
    sources: DataFrame
    records: DataFrame
    root: str | None
    top_levels: int


def _levels(n: Column) -> Column:
    """How often ``n`` nodes are hashed sixteen at a time until one is left."""
    deep, most = F.lit(0), 1
    for level in range(1, 17):
        deep, most = F.when(n > most, F.lit(level)).otherwise(deep), most * FANOUT
    return deep


def _parents(nodes: DataFrame, tree: list[str]) -> DataFrame:
    """One level up: rows of ``tree``, ``at``, ``digest`` and ``children``, in order of the nodes' places."""
    grouped = nodes.groupBy(*tree, F.shiftright("at", 4).alias("at")).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("at", "digest"))), lambda c: c["digest"]).alias("children")
    )
    return grouped.withColumn("digest", digest(F.array_join("children", "")))


def build(docs: DataFrame, path: str, leaf: Column | None = None, id_col: str = "doc_id", source_col: str = "source", **carried: Column) -> Manifest:
    """Hashes the rows and writes the tree's records and the leaves' places under ``path``.

    ``carried`` columns, functions of the input, travel with the leaves.
    """
    spark = docs.sparkSession
    leaf = leaf_digest(*[F.col(c) for c in FIELDS]) if leaf is None else leaf
    hashed = docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("doc_id"), leaf.alias("leaf"), *[c.alias(n) for n, c in carried.items()])
    # Only digests and ids from here on. The texts are read once.
    hashed = checkpointed(hashed)
    placed = row_numbers(hashed, ["doc_id", "leaf"], "_rank", by=["source"])
    counts = checkpointed(hashed.groupBy("source").agg(F.count(F.lit(1)).alias("n_leaves")))
    ranked = row_numbers(counts, ["source"], "_rank").withColumn("s", F.col("_rank") - 1).drop("_rank")
    sources = checkpointed(ranked.withColumn("levels", _levels(F.col("n_leaves"))))
    n_sources, deepest = sources.agg(F.count(F.lit(1)), F.coalesce(F.max("levels"), F.lit(0))).first()
    few = F.broadcast(sources) if n_sources <= BROADCAST_ROWS else sources
    with_source = placed.join(few.select(F.col("source").alias("_source"), "s", "levels"), F.col("source").eqNullSafe(F.col("_source")))
    with_source.select("source", "s", "levels", "doc_id", "leaf", (F.col("_rank") - 1).alias("rank"), *carried).write.parquet(f"{path}/leaves")
    leaves = spark.read.parquet(f"{path}/leaves")

    # Upwards. A tree that has come to one node stays out of the next level.
    nodes, done = leaves.select("s", "levels", F.col("rank").alias("at"), F.col("leaf").alias("digest")), []
    for level in range(deepest):
        done.append(nodes.where(F.col("levels") == level).select("s", "digest"))
        step = f"{path}/records/tree=leaves/level={level + 1}"
        _parents(nodes.where(F.col("levels") > level), ["s", "levels"]).write.parquet(step)
        nodes = spark.read.parquet(step).select("s", "levels", "at", "digest")
    done.append(nodes.select("s", "digest"))
    subroots = done[0]
    for more in done[1:]:
        subroots = subroots.unionByName(more)
    sources.join(subroots, "s").select("s", "source", "n_leaves", "levels", F.col("digest").alias("subroot")).write.parquet(f"{path}/sources")
    known = spark.read.parquet(f"{path}/sources")

    nodes, top_levels = known.select(F.col("s").alias("at"), F.col("subroot").alias("digest")), 0
    while FANOUT**top_levels < n_sources:
        top_levels += 1
        step = f"{path}/records/tree=sources/level={top_levels}"
        _parents(nodes, []).write.parquet(step)
        nodes = spark.read.parquet(step).select("at", "digest")
    root = nodes.select("digest").first()
    schema = "digest string, children array<string>, tree string, level int"
    grown = deepest or top_levels  # else there is no record at all
    records = spark.read.schema(schema).parquet(f"{path}/records") if grown else spark.createDataFrame([], schema)
    return Manifest(leaves, known, records, root[0] if root else None, top_levels)


def _lookup(manifest: Manifest, tree: str, level: int) -> DataFrame:
    """Digest and children of one level. The same content under another parent is the same record."""
    at = (F.col("tree") == tree) & (F.col("level") == level)
    return manifest.records.where(at).select(F.col("digest").alias("_digest"), "children").dropDuplicates(["_digest"])


def _step(front: DataFrame, records: DataFrame, keep: list[str]) -> DataFrame:
    """Enters every child of the digests reached; what lies to the left and right of it joins the path."""
    found = front.join(records, F.col("digest") == F.col("_digest"))
    opened = found.select(*keep, "at", "path", "children", F.posexplode("children").alias("digit", "_child"))
    return opened.select(
        *keep,
        (F.shiftleft("at", 4) + F.col("digit")).alias("at"),
        F.col("_child").alias("digest"),
        F.concat("path", F.array(_segment(F.col("children"), F.col("digit")))).alias("path"),
    )


def _segment(children: Column, digit: Column) -> Column:
    """The children before and after the selected one."""
    left = F.array_join(F.slice(children, F.lit(1), digit), "")
    right = F.array_join(F.slice(children, digit + 2, F.lit(FANOUT)), "")
    return F.struct(left.alias("left"), right.alias("right"))


def descend(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """Adds ``path``: per request the segments from its leaf up to the root, each with a left and a right part.

    ``requests``: rows of ``manifest.leaves``, all or some, with any further columns.
    """
    spark = requests.sparkSession
    # Requests of one parent travel as one row of at most sixteen places (and as many copies as were asked for).
    whole = [c for c in requests.columns if c not in ("s", "levels")]
    grouped = checkpointed(
        requests.groupBy("s", "levels", F.shiftright("rank", 4).alias("at")).agg(F.collect_list(F.struct(*whole)).alias("asking"))
    )
    wanted = grouped.select("s", "levels", "at")

    front = spark.createDataFrame([(0, manifest.root)], "at long, digest string").withColumn("path", F.array().cast(SEGMENTS))
    for level in range(manifest.top_levels, 0, -1):
        front = _step(front, _lookup(manifest, "sources", level), [])
        asked = wanted.select(F.shiftright("s", 4 * (level - 1)).alias("at")).distinct()
        front = checkpointed(front.join(asked, "at", "left_semi"))
    tops = front.select(F.col("at").alias("s"), "digest", "path").join(manifest.sources.select("s", "levels"), "s")
    tops = checkpointed(tops.withColumn("at", F.lit(0).cast("long")))

    deepest = tops.agg(F.coalesce(F.max("levels"), F.lit(0))).first()[0]
    trees = lambda level: tops.where(F.col("levels") == level).select("s", "at", "digest", "path")
    front = trees(deepest)
    for level in range(deepest, 1, -1):
        asked = wanted.where(F.col("levels") >= level).select("s", F.shiftright("at", 4 * (level - 2)).alias("at")).distinct()
        below = _step(front, _lookup(manifest, "leaves", level), ["s"]).join(asked, ["s", "at"], "left_semi")
        front = checkpointed(below).unionByName(trees(level - 1))

    # The last step opens the requests themselves, so that the long paths are not copied before they are used.
    parents = front.join(_lookup(manifest, "leaves", 1), F.col("digest") == F.col("_digest")) if deepest else front.limit(0).withColumn("children", F.array().cast("array<string>"))
    lone = trees(0).withColumn("children", F.lit(None).cast("array<string>"))
    met = parents.select("s", "at", "path", "children").unionByName(lone.select("s", "at", "path", "children")).join(grouped, ["s", "at"])
    opened = met.select("s", "path", "children", F.explode("asking").alias("_r"))
    digit = F.col("_r.rank").bitwiseAND(F.lit(FANOUT - 1)).cast("int")
    last = F.when(F.col("children").isNull(), F.array().cast(SEGMENTS)).otherwise(F.array(_segment(F.col("children"), digit)))
    return opened.select("s", *[F.col(f"_r.{c}").alias(c) for c in whole], F.reverse(F.concat("path", last)).alias("path"))


def proof_digest(path: Column) -> Column:
    """The digest of all siblings, from the leaf up."""
    return digest(F.array_join(F.transform(path, lambda p: F.concat(p["left"], p["right"])), ""))


def folded(leaf: Column, path: Column) -> Column:
    """The root that a leaf and its siblings lead to."""
    return F.aggregate(path, leaf, lambda at, p: digest(p["left"], at, p["right"]))


def prove(docs: DataFrame, tampered: Column | None = None, path: str | None = None) -> DataFrame:
    """Every row's leaf, subroot, root and proof, and the root recomputed from its leaf after tampering.

    ``tampered``: the leaf digest of the changed row, a function of the input; null where nothing was changed.
    """
    changed = F.lit(None).cast("string") if tampered is None else tampered
    manifest = build(docs, path or scratch_path(docs.sparkSession, "manifest"), tampered=changed)
    found = descend(manifest, manifest.leaves.select("s", "levels", "rank", "doc_id", "leaf", "tampered"))
    subroots = manifest.sources.select("s", "subroot")
    if manifest.sources.count() <= BROADCAST_ROWS:
        subroots = F.broadcast(subroots)
    root = F.lit(manifest.root)
    return found.join(subroots, "s").select(
        "doc_id", "leaf", "subroot", root.alias("root"), proof_digest(F.col("path")).alias("proof_sha256"),
        folded(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"),
    ).withColumn("verified", F.coalesce(F.col("folded_root") == root, F.lit(False)))


def lower_cased(every: int = 5) -> Column:
    """The leaf of rows whose id's crc32 is a multiple of ``every``, with A-Z in their text made lower-case; else null."""
    lowered = F.translate("text", UPPER, LOWER)
    fields = [lowered if c == "text" else F.col(c) for c in FIELDS]
    chosen = F.crc32(F.col("doc_id").cast("string").cast("binary")) % every == 0
    return F.when(chosen, leaf_digest(*fields))
