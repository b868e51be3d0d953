from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from segmentry.functions.matrix import dot, euclidean
from segmentry.functions.ordering import exact_quantiles, global_row_number, row_numbers, running_sum, tasks_for
from segmentry.operators import clustering, components, density, predict, search, vectors as vec
from segmentry.sources import tables


def named(matrix, prefix="r"):
    return [(f"{prefix}{i:03d}", [float(x) for x in v]) for i, v in enumerate(matrix)]


# Global order ------------------------------------------------------------------------------


@pytest.mark.parametrize("tasks", [1, 20])
def test_running_sum_and_row_number(spark, tasks):
    rng = np.random.default_rng(1)
    values = np.unique(np.round(rng.exponential(10, 500), 2))
    rows = [(g, float(v), int(i)) for g in "ab" for i, v in enumerate(values)]
    df = spark.createDataFrame(rows, "g string, v double, n long").repartition(5)
    got = running_sum(df, "v", ["n"], by=["g"], tasks=tasks).where("g = 'b'").orderBy("v").collect()
    assert [r["cum_n"] for r in got] == list(np.cumsum(np.arange(len(values))))
    assert {r["all_n"] for r in got} == {int(np.arange(len(values)).sum())}
    numbered = global_row_number(df.where("g = 'a'"), "v", "rn", tasks).orderBy("v").collect()
    assert [r["rn"] for r in numbered] == list(range(1, len(values) + 1))


@pytest.mark.parametrize("tasks", [1, 7])
def test_exact_quantiles(spark, tasks):
    rng = np.random.default_rng(2)
    a, b = np.round(rng.normal(0, 1, 997), 1), rng.normal(5, 2, 10)  # many repeats; few values
    rows = [("a", float(x)) for x in a] + [("b", float(x)) for x in b] + [("b", None)]
    df = spark.createDataFrame(rows, "g string, v double")
    wanted = {"p0": 0.0, "p37": 0.37, "p50": 0.5, "p95": 0.95, "p100": 1.0}
    got = {r["g"]: r for r in exact_quantiles(df, "v", wanted, by=["g"], tasks=tasks).collect()}
    for g, values in (("a", a), ("b", b)):
        for name, p in wanted.items():
            assert got[g][name] == pytest.approx(np.quantile(values, p), abs=1e-12)


@pytest.mark.parametrize("tasks", [1, 3, 40])
def test_row_numbers_in_groups(spark, tasks):
    """One group holds most rows; names and keys may be null, and a batch ends inside a group."""
    rows = [("hot", i, None) for i in range(900)] + [(None, i, "x") for i in range(30)] + [("é", None, "y"), ("z", 5, "q")]
    df = spark.createDataFrame(rows, "g string, k int, _part string").drop("_part").repartition(7)
    got = {(r["g"], r["k"]): r["rn"] for r in row_numbers(df, ["k"], "rn", by=["g"], tasks=tasks).collect()}
    assert len(got) == len(rows)
    assert all(got["hot", i] == i + 1 for i in range(900)) and all(got[None, i] == i + 1 for i in range(30))
    assert got["é", None] == 1 and got["z", 5] == 1
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "13")
    try:
        sums = running_sum(df.withColumn("n", F.col("k").cast("double")), "k", ["k", "n"], by=["g"], tasks=tasks)
        seen = {(r["g"], r["k"]): (r["cum_k"], r["cum_n"], r["all_k"]) for r in sums.collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    assert all(seen["hot", i] == (i * (i + 1) // 2, i * (i + 1) / 2, 899 * 450) for i in range(900))
    assert seen["é", None] == (0, 0.0, 0) and seen["z", 5] == (5, 5.0, 5) and seen[None, 29] == (435, 435.0, 435)


def test_ranges_grow_with_the_rows(spark):
    few = spark.sparkContext.defaultParallelism
    assert tasks_for(spark.range(10)) == few
    assert tasks_for(spark.range(1000), rows_per_task=10) == 100


# Vectors -----------------------------------------------------------------------------------


def test_normalise_keeps_zero_vectors(spark):
    df = spark.createDataFrame([("a", [3.0, 4.0]), ("z", [0.0, 0.0])], "record_id string, embedding array<double>")
    got = {r["record_id"]: r["embedding"] for r in vec.l2_normalize(df, element="float64").collect()}
    assert got == {"a": [0.6, 0.8], "z": [0.0, 0.0]}


def test_row_wise_products(spark):
    df = spark.createDataFrame([([1.0, 2.0], [3.0, -1.0])], "a array<double>, b array<double>")
    assert df.select(dot(F.col("a"), F.col("b"))).first()[0] == 1.0
    assert df.select(euclidean(F.col("a"), F.col("b"))).first()[0] == pytest.approx(13**0.5)


def test_append_checks_the_dimension(spark, path):
    df = spark.createDataFrame([("a", [1.0, 2.0]), ("b", [1.0])], "record_id string, embedding array<float>")
    with pytest.raises(Exception, match="dimension"):
        vec.append_vectors(df, path, dim=2)
    vec.append_vectors(df.where("record_id = 'a'"), path, dim=2)
    vec.append_vectors(df.where("record_id = 'a'"), path, dim=2)
    assert spark.read.parquet(path).count() == 2


def test_hash_embedding(spark):
    from pyspark.ml.feature import HashingTF

    texts = [("1", "Good good product"), ("2", None), ("3", "good  GOOD <b>product</b>")]
    out = {r["record_id"]: r for r in vec.embed_reviews(spark.createDataFrame(texts, "id string, text string")).collect()}
    a, empty, c = (np.array(out[i]["embedding"]) for i in "123")
    assert len(a) == 384 and not empty.any() and (a == c).all()
    place = HashingTF(numFeatures=384).indexOf
    expected = np.zeros(384)
    expected[place("good")], expected[place("product")] = 2, 1
    assert a == pytest.approx(expected / 5**0.5, abs=1e-6)
    assert out["1"]["model_name"] == vec.HASH_MODEL[0]


def test_any_encoder_gets_bounded_batches(spark):
    def make():
        def encode(texts):
            assert len(texts) <= 4
            return [[float(len(t)), 1.0] for t in texts]

        return encode

    df = spark.createDataFrame([(str(i), "x" * i if i else None) for i in range(30)], "id string, clean string").coalesce(1)
    got = {r["id"]: r["embedding"] for r in vec.model_embed(df, make, batch=4).collect()}
    assert got == {str(i): [float(i), 1.0] for i in range(30)}


def test_embedding_is_idempotent_and_versioned(spark, path):
    docs = spark.createDataFrame([(str(i), f"text number {i}") for i in range(20)], "id string, text string")
    vec.embed_new(spark, docs.where("id < '15'"), path)
    first = {r["record_id"]: r["created_at"] for r in tables.read_keyed(spark, path).collect()}
    for _ in range(2):
        vec.embed_new(spark, docs, path)
    stored = {r["record_id"]: r["created_at"] for r in tables.read_keyed(spark, path).collect()}
    assert len(stored) == 20 and all(stored[i] == t for i, t in first.items())
    vec.embed_new(spark, docs, path, model=("hashing-tf", "2"))
    assert tables.read_keyed(spark, path).groupBy("model_version").count().count() == 2
    assert tables.read_keyed(spark, path).count() == 40
    assert vec.of_model(tables.read_keyed(spark, path)).count() == 20


def test_first_record_counts_not_the_smallest_text(spark):
    rows = spark.createDataFrame([("a", "z", 2), ("a", "b", 1), ("b", "q", 5), ("a", "c", 0)], "id string, text string, n int").coalesce(1)
    assert {r["id"]: r["text"] for r in vec.first_records(rows, "id").collect()} == {"a": "z", "b": "q"}
    assert {r["id"]: r["text"] for r in vec.first_records(rows, "id", "n").collect()} == {"a": "c", "b": "q"}


# Search ------------------------------------------------------------------------------------


def brute(queries, store, k):
    scores = np.round(queries @ store.T, 9)
    return {
        f"q{i:03d}": [f"r{j:03d}" for j in sorted(range(len(store)), key=lambda j: (-row[j], j))[:k]]
        for i, row in enumerate(scores)
    }


# The three ways: few queries, small store, both sides in blocks.
@pytest.mark.parametrize("limit, block", [(10**8, 10**8), (8 * 16 * 201, 10**8), (1, 8 * 16 * 60)])
def test_exact_search(spark, unit_vectors, vectors, limit, block):
    rng = np.random.default_rng(3)
    wanted = np.concatenate([rng.normal(0, 1, (205, 16)), unit_vectors[:3]])
    queries = spark.createDataFrame(named(wanted, "q"), "record_id string, embedding array<double>").repartition(3)
    store = vectors.unionByName(vectors.limit(0)).repartition(4)
    found = search.exact_top_k(queries, store, "record_id", "record_id", k=5, limit_bytes=limit, block_bytes=block)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append(r["record_id"])
    assert got == brute(wanted, unit_vectors, 5)


def test_search_finds_itself_and_breaks_ties_by_id(spark):
    store = spark.createDataFrame(named([[1, 0], [0, 1], [1, 0], [1, 0]]), "record_id string, embedding array<double>").repartition(3)
    found = search.exact_top_k(store, store, "record_id", "record_id", k=10)
    rows = {(r["query_id"], r["rank"]): r["record_id"] for r in found.collect()}
    assert [rows["r002", i] for i in (1, 2, 3, 4)] == ["r000", "r002", "r003", "r001"]
    assert len(rows) == 16  # all of a small store, no more
    assert search.exact_top_k(store.limit(0), store, "record_id", "record_id").count() == 0


def test_search_with_hot_copies(spark, unit_vectors):
    """A third of the store is one record repeated; blocks must keep every copy."""
    matrix = np.concatenate([unit_vectors[:40], np.repeat(unit_vectors[:1], 20, axis=0)])
    rows = named(matrix[:40]) + [("r000", [float(x) for x in unit_vectors[0]])] * 20
    store = spark.createDataFrame(rows, "record_id string, embedding array<double>").repartition(4)
    queries = store.where("record_id = 'r000'").limit(1)
    found = search.exact_top_k(queries, store, "record_id", "record_id", k=25, limit_bytes=1, block_bytes=8 * 16 * 20)
    assert sum(r["record_id"] == "r000" for r in found.collect()) == 21


def test_approximate_search_with_all_cells_is_exact(spark, unit_vectors, vectors, path):
    centers = search.build_cells(vectors, path, cells=8)
    cells = spark.read.parquet(path)
    exact = search.exact_top_k(vectors, vectors, "record_id", "record_id", k=5)
    everything = search.approximate_top_k(vectors, cells, centers, "record_id", "record_id", k=5, probes=8)
    key = ["query_id", "rank", "record_id"]
    assert everything.select(*key).exceptAll(exact.select(*key)).count() == 0
    some = search.approximate_top_k(vectors, cells, centers, "record_id", "record_id", k=5, probes=2)
    hits = some.join(exact, ["query_id", "record_id"]).count()
    assert hits >= 0.7 * exact.count()
    # More queries than the limit visit the same cells.
    blocks = search.approximate_top_k(
        vectors, cells, centers, "record_id", "record_id", k=5, probes=2, limit_bytes=1, block_bytes=8 * 16 * 7
    )
    assert sorted(map(tuple, blocks.select(*key).collect())) == sorted(map(tuple, some.select(*key).collect()))


def test_approximate_search_goes_on_until_it_finds_nine_in_ten(spark, path):
    # Vectors without any groups: the nearest lie in many cells.
    x = np.random.default_rng(3).normal(0, 1, (2000, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    store = spark.createDataFrame([(f"r{i}", v.tolist()) for i, v in enumerate(x)], "record_id string, embedding array<double>").repartition(4)
    asked = store.where(F.col("record_id").isin([f"r{i}" for i in range(0, 2000, 50)]))
    centers = search.build_cells(store, path, cells=20)
    cells = spark.read.parquet(path)
    exact = {(r.query_id, r.record_id) for r in search.exact_top_k(asked, store, "record_id", "record_id").collect()}
    share = lambda **o: sum((r.query_id, r.record_id) in exact for r in search.approximate_top_k(asked, cells, centers, "record_id", "record_id", probes=2, **o).collect()) / len(exact)
    assert share() < 0.9 <= share(least_recall=0.9)
    # Fewer cells than measured do not reach it.
    fewest = search.probes_for_recall(asked, cells, centers, "record_id", "record_id")
    below = search.approximate_top_k(asked, cells, centers, "record_id", "record_id", probes=fewest - 1).collect()
    assert 2 < fewest < 20 and sum((r.query_id, r.record_id) in exact for r in below) / len(exact) < 0.9


# Quality -----------------------------------------------------------------------------------


def labelled(spark, matrix, labels):
    rows = [(*r, int(l)) for r, l in zip(named(matrix), labels)]
    return spark.createDataFrame(rows, "record_id string, embedding array<double>, segment_id int")


def brute_silhouette(x, labels):
    unit = x / np.linalg.norm(x, axis=1, keepdims=True)
    d, total = 1 - unit @ unit.T, []
    for i, own in enumerate(labels):
        mates = (labels == own) & (np.arange(len(labels)) != i)
        if not mates.any():
            total.append(0.0)
            continue
        a = d[i, mates].mean()
        b = min(d[i, labels == o].mean() for o in set(labels) - {own})
        total.append((b - a) / max(a, b))
    return float(np.mean(total))


def brute_davies_bouldin(x, labels):
    ids = sorted(set(labels))
    c = [x[labels == i].mean(axis=0) for i in ids]
    s = [np.linalg.norm(x[labels == i] - c[n], axis=1).mean() for n, i in enumerate(ids)]
    return float(np.mean([max((s[i] + s[j]) / np.linalg.norm(c[i] - c[j]) for j in range(len(ids)) if j != i) for i in range(len(ids))]))


@pytest.mark.parametrize("k", [5, 40])
def test_bounded_search_is_exact_and_skips_cells(spark, unit_vectors, vectors, path, k):
    centers = search.build_cells(vectors, path, cells=12)
    asked = vectors.where("record_id < 'r060'")
    out = search.bounded_top_k(asked, spark.read.parquet(path), centers, "record_id", "record_id", k=k)
    exact = search.exact_top_k(asked, vectors, "record_id", "record_id", k=k)
    rows = lambda df: {(r["query_id"], r["rank"], r["record_id"]) for r in df.collect()}
    assert rows(out.found) == rows(exact)
    # Three tight groups: the cells of the other groups are never opened.
    assert 0 < out.compared < 0.75
    # More asked for than there are records, and nothing asked.
    assert search.bounded_top_k(asked.limit(2), spark.read.parquet(path), centers, "record_id", "record_id", k=500).found.count() == 400
    assert search.bounded_top_k(asked.limit(0), spark.read.parquet(path), centers, "record_id", "record_id", k=5).found.count() == 0


@pytest.mark.parametrize("limit", [10**8, 1])
def test_quality_figures(spark, unit_vectors, limit):
    labels = np.array([0] * 60 + [1] * 60 + [2] * 60 + [-1] * 19 + [3])
    df = labelled(spark, unit_vectors, labels)
    keep = labels != -1
    assert clustering.silhouette(df) == pytest.approx(brute_silhouette(unit_vectors[keep], labels[keep]), abs=1e-9)
    got = clustering.davies_bouldin(df, limit_bytes=limit).first()[0]
    assert got == pytest.approx(brute_davies_bouldin(unit_vectors[keep], labels[keep]), abs=1e-9)


@pytest.mark.parametrize("labels", [[-1] * 200, [0] * 200])
def test_fewer_than_two_segments(spark, unit_vectors, labels):
    df = labelled(spark, unit_vectors, labels)
    assert clustering.silhouette(df) == 0.0
    assert clustering.davies_bouldin(df).first()[0] == 0.0
    assert clustering.noise_share(df).first()["noise_fraction"] == (1.0 if labels[0] == -1 else 0.0)


def test_centroids_and_sizes(spark, unit_vectors):
    labels = np.array([0] * 60 + [1] * 60 + [-1] * 80)
    df = labelled(spark, unit_vectors, labels)
    got = {r["segment_id"]: r for r in clustering.centroids(df).collect()}
    for i in (0, 1):
        mean = unit_vectors[labels == i].mean(axis=0)
        assert got[i]["centroid"] == pytest.approx(mean / np.linalg.norm(mean))
        assert got[i]["size"] == 60
    assert set(got) == {0, 1}
    assert [tuple(r) for r in clustering.segment_sizes(df, 3).orderBy("segment_id").collect()] == [(0, 60), (1, 60), (2, 0)]


# Clustering --------------------------------------------------------------------------------


def test_kmeans_finds_the_groups(spark, vectors, path):
    run = clustering.run_kmeans(vectors.limit(180), k=3, starts=3)
    clustering.save_run(run, path, "x")
    rows = run.labels.collect()
    groups = [{r["segment_id"] for r in rows if lo <= int(r["record_id"][1:]) < lo + 60} for lo in (0, 60, 120)]
    assert all(len(g) == 1 for g in groups) and len(set.union(*groups)) == 3
    summary = spark.read.parquet(f"{path}/summary").first()
    assert (summary["algorithm"], summary["n_segments"], summary["noise_fraction"]) == ("kmeans", 3, 0.0)
    assert 0.5 < summary["silhouette"] <= 1
    assert len(run.centroids.first()["centroid"]) == 16  # original space
    assert spark.read.parquet(f"{path}/labels").where("run_id = 'x'").count() == 180


def test_ten_starts_in_one_pass(spark):
    """All starts together cost what each costs alone, and the best is no worse than Spark's own K-Means."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector

    rng = np.random.default_rng(12)
    x = np.concatenate([rng.normal(c, 0.4, (60, 5)) for c in rng.normal(0, 1.5, (7, 5))])
    df = spark.createDataFrame([([float(v) for v in row],) for row in x], "v array<double>").repartition(3).cache()
    together = clustering.fit_kmeans(df, 7, "v", seed=3, starts=4)
    passes = clustering.fit_kmeans(df, 7, "v", seed=3, starts=4, max_iter=12, task_cells=0)
    assert passes.costs == pytest.approx(clustering.fit_kmeans(df, 7, "v", seed=3, starts=4, max_iter=12).costs, rel=1e-9)
    alone = [clustering.fit_kmeans(df, 7, "v", seed=3 + s, starts=1).cost for s in range(4)]
    assert together.costs == pytest.approx(alone, rel=1e-9) and together.cost == pytest.approx(min(alone))
    labels = clustering.with_nearest_centre(df, together.centres, "v").collect()
    assert sum(((np.array(r["v"]) - together.centres[r["segment_id"]]) ** 2).sum() for r in labels) == pytest.approx(together.cost)
    theirs = min(
        KMeans(k=7, seed=s, maxIter=300, tol=1e-6, featuresCol="f").fit(df.select(array_to_vector("v").alias("f"))).summary.trainingCost for s in range(4)
    )
    assert together.cost <= theirs * 1.02
    # Fewer different rows than centres, and none.
    few = spark.createDataFrame([([1.0],), ([1.0],), ([2.0],)], "v array<double>")
    assert clustering.fit_kmeans(few, 4, "v", starts=2).cost == 0.0
    assert clustering.fit_kmeans(few.limit(0), 2, "v", starts=2).cost == 0.0


def test_holdout(spark, vectors):
    row = clustering.holdout_evaluation(vectors.limit(180), k=3).first()
    assert -1 <= row["silhouette"] <= 1 and row["davies_bouldin"] > 0


def brute_density(x, eps, min_samples, min_size):
    d = np.sqrt(((x[:, None] - x[None]) ** 2).sum(axis=2))
    near = d <= eps
    core = near.sum(axis=1) - 1 >= min_samples
    label, groups = np.full(len(x), -1), []
    for i in np.flatnonzero(core):
        if label[i] >= 0:
            continue
        stack, label[i] = [i], len(groups)
        members = []
        while stack:
            j = stack.pop()
            members.append(j)
            for m in np.flatnonzero(near[j] & core & (label < 0)):
                label[m] = len(groups)
                stack.append(m)
        groups.append(members)
    return {frozenset(g) for g in groups if len(g) >= min_size}


@pytest.mark.parametrize("block_rows, pivots, eps", [(4096, 1, 0.2), (64, 1, 0.3), (48, 6, 0.2), (4096, 12, 0.3)])
def test_density_segments(spark, unit_vectors, block_rows, pivots, eps):
    x = np.concatenate([unit_vectors, np.repeat(unit_vectors[:1], 90, axis=0)])  # a third are copies
    df = spark.createDataFrame(named(x), "record_id string, embedding array<double>").repartition(4)
    out = density.density_segments(df, "record_id", eps, 10, 20, block_rows=block_rows, pivots=pivots)
    got, noise = {}, 0
    for r in out.collect():
        if r["segment_id"] == -1:
            noise += 1
        else:
            got.setdefault(r["segment_id"], set()).add(int(r["record_id"][1:]))
    expected = brute_density(x, eps, 10, 20)
    assert {frozenset(g) for g in got.values()} == expected
    assert noise == len(x) - sum(len(g) for g in expected)
    assert sorted(got) == list(range(len(expected)))


def test_core_distances(spark, unit_vectors, vectors):
    d = np.sqrt(((unit_vectors[:, None] - unit_vectors[None]) ** 2).sum(axis=2))
    expected = np.sort(d, axis=1)[:, 5]
    got = {r["record_id"]: r["core_distance"] for r in density.core_distances(vectors, "record_id", min_samples=5).collect()}
    assert [got[f"r{i:03d}"] for i in range(len(expected))] == pytest.approx(list(expected), abs=1e-4)
    assert density.core_distances(vectors.limit(4), "record_id", min_samples=5).count() == 0
    eps = density.eps_at_quantile(vectors, "record_id", 0.5, min_samples=5)
    assert eps == pytest.approx(np.quantile(expected, 0.5), abs=1e-4)


def test_components_of_a_long_chain_and_a_star(spark):
    chain = [(f"c{i:03d}", f"c{i + 1:03d}") for i in range(64)]
    star = [("hub", f"s{i:03d}") for i in range(50)]
    alone = [("solo", "solo")]
    got = components.connected_components(spark.createDataFrame(chain + star + alone, "a string, b string"), "a", "b")
    roots = {r["node"]: r["root"] for r in got.collect()}
    assert len(roots) == 65 + 51 + 1
    assert {roots[n] for n in roots if n[0] == "c"} == {"c000"}
    assert {roots[n] for n in roots if n == "hub" or n[:2] == "s0"} == {"hub"}
    assert roots["solo"] == "solo"


# Prediction --------------------------------------------------------------------------------


@pytest.mark.parametrize("limit", [10**8, 1])
def test_nearest_centroid(spark, limit):
    centres = spark.createDataFrame([(0, [1.0, 0.0]), (10, [0.0, 1.0]), (2, [1.0, 0.0])], "segment_id int, centroid array<double>")
    points = spark.createDataFrame([("a", [0.9, 0.1]), ("b", [0.0, 1.0]), ("c", [-1.0, 0.0])], "record_id string, embedding array<float>")
    got = {r["record_id"]: (r["segment_id"], round(r["similarity"], 6)) for r in predict.nearest_centroid(points, centres, limit_bytes=limit).collect()}
    assert got == {"a": (0, 0.9), "b": (10, 1.0), "c": (10, 0.0)}


def test_prediction(spark):
    texts = spark.createDataFrame([("g", "great great product"), ("b", "broken on arrival")], "id string, text string")
    centres = vec.embed_reviews(texts).select(F.when(F.col("record_id") == "g", 0).otherwise(9).alias("segment_id"), F.col("embedding").cast("array<double>").alias("centroid"))
    requests = spark.createDataFrame([("1", "A GREAT, <i>great</i> thing"), ("2", "it is broken"), ("3", "")], "id string, text string")
    got = {r["record_id"]: r for r in predict.predict_segments(requests, centres).collect()}
    assert (got["1"]["segment_id"], got["1"]["segment_label"]) == (0, "price_sensitive_shoppers")
    assert (got["2"]["segment_id"], got["2"]["segment_label"]) == (9, "segment_9")
    assert got["3"]["confidence"] == 0.5
    assert all(0 <= r["confidence"] <= 1 for r in got.values())


def test_words_are_runs_of_letters_digits_and_underscores(spark):
    from segmentry.functions import text as tx

    texts = [None, "", " .,", "One, two", "-a_1-É9 ß", "x", "日本 𝒳𝟙 ok!", "\n b\t"]
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(tx.words(F.col("t")).alias("w")).collect()
    assert [r.w for r in rows] == [[], [], [], ["one", "two"], ["a_1", "é9", "ß"], ["x"], ["日本", "𝒳𝟙", "ok"], ["b"]]


def test_prediction_queries_embed_each_text_once(spark, sf, monkeypatch):
    from segmentry.plans import vector_queries

    met, make = [], vec.embed_reviews
    for module in (vec, predict):
        monkeypatch.setattr(module, "embed_reviews", lambda *a, **o: (met.append(1), make(*a, **o))[1])
    found = vector_queries.predict_segment(spark, sf)
    docs = vector_queries.texts(spark, sf, "documents", "doc_id").select(F.col("doc_id").alias("id"), "text")
    assert len(met) == 1 and found.count() == docs.count()
    # The same segments as by embedding the texts again.
    centres = vector_queries._language_centroids(vector_queries._embedded_documents(spark, sf))
    again = predict.predict_segments(docs, centres).select("record_id", "segment_id")
    assert again.exceptAll(found.select("record_id", "segment_id")).count() == 0


def test_nothing_to_order_and_nothing_dense(spark, vectors):
    empty = spark.createDataFrame([], "g string, v double")
    assert exact_quantiles(empty, "v", {"p": 0.5}, by=["g"]).count() == 0
    assert global_row_number(empty, "v", "rn").count() == 0
    noise = density.density_segments(vectors, "record_id", 1e-6, 10, 20)
    assert {tuple(r) for r in noise.groupBy("segment_id").count().collect()} == {(-1, 200)}
    assert density.density_segments(vectors.limit(0), "record_id", 0.1).count() == 0


def test_nearest_centroid_in_blocks_keeps_null_and_repeated_ids(spark):
    rows = [(None, [1.0, 0.0]), ("a", [1.0, 0.0]), ("a", [0.0, 1.0]), ("b", [0.6, 0.8])]
    frame = spark.createDataFrame(rows, "record_id string, embedding array<double>")
    centres = spark.createDataFrame([(0, [1.0, 0.0]), (1, [0.0, 1.0])], "segment_id int, centroid array<double>")
    few, blocks = (predict.nearest_centroid(frame, centres, limit_bytes=n) for n in (1 << 20, 1))
    key = lambda df: sorted(map(str, df.select("record_id", "segment_id", "similarity").collect()))
    assert key(few) == key(blocks) and len(key(blocks)) == 4


def test_nearest_centroid_in_blocks_keeps_negative_ids(spark):
    rows = [("a", [1.0, 0.0]), ("b", [0.0, 1.0]), ("c", [-1.0, 0.0])]
    frame = spark.createDataFrame(rows, "record_id string, embedding array<double>")
    ids = [(-1, [1.0, 0.0]), (-20, [0.0, 1.0]), (3, [0.0, 1.0]), (2_000_000_000, [-1.0, 0.0]), (-2_000_000_000, [-1.0, 0.0]), (7, [1.0, 0.0])]
    centres = spark.createDataFrame(ids, "segment_id int, centroid array<double>")
    for limit in (1 << 20, 1):
        found = predict.nearest_centroid(frame, centres, limit_bytes=limit)
        assert found.schema["segment_id"].dataType.simpleString() == "int"
        assert {r["record_id"]: r["segment_id"] for r in found.collect()} == {"a": -1, "b": -20, "c": -2_000_000_000}
