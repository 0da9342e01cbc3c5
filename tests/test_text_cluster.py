import numpy as np

from tessera.operators import cluster, text


def test_idf_two_docs(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "b")], "doc_id long, text string")
    toks = text.doc_tokens(docs)
    idf = {r["token"]: r["idf"] for r in text.term_idf(toks, text.doc_count(docs)).collect()}
    assert abs(idf["a"] - 0.405465) < 1e-6 and idf["b"] == 0.0
    idf2 = {r["token"]: r["idf"] for r in text.term_idf(toks, 2, min_doc_freq=2).collect()}
    assert idf2["a"] == 0.0


def test_doc_tokens_whole_text(spark):
    long_text = " ".join(["w"] * 20000 + ["z"])
    docs = spark.createDataFrame([(1, long_text)], "doc_id long, text string")
    got = {r["token"]: r["n"] for r in text.doc_tokens(docs).collect()}
    assert got == {"w": 20000, "z": 1}


def _points(spark, arr):
    return spark.createDataFrame([(i, [float(x) for x in v]) for i, v in enumerate(arr)],
                                 "id long, v array<double>")


def test_nearest_ties_go_to_lowest_cluster(spark):
    pts = _points(spark, [[0.0, 0.0], [1.0, 0.0]])
    a = cluster.assign_nearest(pts, [(1, [0.5, 1.0]), (2, [0.5, -1.0])])
    assert {r["id"]: r["cluster_id"] for r in a.collect()} == {0: 1, 1: 1}


def test_lloyd_matches_numpy(spark):
    rng = np.random.default_rng(1)
    arr = np.vstack([rng.normal(c, 0.5, size=(40, 3)) for c in (0, 4, 8)])
    pts = _points(spark, arr)
    assigned, cents = cluster.lloyd_kmeans(pts, [0, 40, 80], iterations=4)
    c = arr[[0, 40, 80]].copy()
    for _ in range(4):
        lab = ((arr[:, None, :] - c[None]) ** 2).sum(-1).argmin(1)
        c = np.vstack([arr[lab == k].mean(0) if (lab == k).any() else c[k] for k in range(3)])
    lab = ((arr[:, None, :] - c[None]) ** 2).sum(-1).argmin(1)
    got = {r["id"]: r["cluster_id"] for r in assigned.collect()}
    assert all(got[i] == lab[i] + 1 for i in range(len(arr)))
    err = {r["cluster_id"]: r for r in cluster.cluster_errors(assigned, 3).collect()}
    wsse = cluster.wsse(assigned).first()["wsse"]
    assert abs(sum(r["error"] ** 2 for r in err.values()) - wsse) < 1e-6
    assert sum(r["size"] for r in err.values()) == len(arr)


def test_empty_cluster_reported_with_zero(spark):
    pts = _points(spark, [[0.0], [0.1]])
    a = cluster.assign_nearest(pts, [(1, [0.0]), (2, [100.0])])
    sizes = {r["cluster_id"]: r["size"] for r in cluster.cluster_sizes(a, 2).collect()}
    assert sizes == {1: 2, 2: 0}


def test_cluster_terms_rank_and_ties(spark):
    toks = spark.createDataFrame([(1, "x", 3), (1, "y", 3), (1, "z", 1), (2, "x", 1)],
                                 "doc_id long, token string, n long")
    dc = spark.createDataFrame([(1, 1), (2, 1)], "doc_id long, cluster_id int")
    top = [r["term"] for r in cluster.cluster_terms(dc, toks, 2).orderBy("rank").collect()]
    rare = [r["term"] for r in cluster.cluster_terms(dc, toks, 2, descending=False).orderBy("rank").collect()]
    assert top == ["x", "y"] and rare == ["z", "y"]


def test_library_report_error_matches_model_cost(spark):
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(
        ["a b c", "a b", "b c d", "x y", "x y z", "y z", "a x"])], "doc_id long, text string")
    feats = text.hashed_features(docs, num_features=64).select("doc_id", "features")
    model, pred = cluster.library_clusters(feats, "kmeans", 2, 10)
    rep = cluster.library_report(pred, model.clusterCenters(), text.doc_tokens(docs), 2)
    total = sum(r["error"] ** 2 for r in rep.collect())
    assert abs(total - model.summary.trainingCost) < 1e-6


def test_pick_seeds_distinct_and_stable(spark):
    df = spark.createDataFrame([(i % 40,) for i in range(200)], "doc_id long").repartition(7)
    a = cluster.pick_seeds(df, "doc_id", 5, seed=1)
    b = cluster.pick_seeds(df.repartition(3), "doc_id", 5, seed=1)
    assert a == b and len(set(a)) == 5 and cluster.pick_seeds(df, "doc_id", 5, seed=2) != a


def test_absent_seeds_raise(spark):
    import pytest
    docs = spark.createDataFrame([(0, "a b"), (1, "b c")], "doc_id long, text string")
    entries = text.term_vectors(text.doc_tokens(docs))
    with pytest.raises(ValueError, match="99"):
        cluster.sparse_lloyd(docs, entries, [0, 99], 1)
    with pytest.raises(ValueError, match="7"):
        cluster.lloyd_kmeans(_points(spark, [[0.0], [1.0]]), [0, 7], 1)


def _full_steps(x, seeds, steps):
    """Lloyd's steps with every distance."""
    c = x[seeds].copy()
    for _ in range(steps):
        lab = ((x[:, None, :] - c[None]) ** 2).sum(-1).argmin(1)
        c = np.vstack([x[lab == j].mean(0) if (lab == j).any() else c[j] for j in range(len(seeds))])
    return ((x[:, None, :] - c[None]) ** 2).sum(-1).argmin(1), c


def test_sparse_lloyd_with_bounds_matches_full_steps(spark):
    rng = np.random.default_rng(6)
    x = np.vstack([rng.normal(m, 1.0, size=(60, 8)) * (rng.random((60, 8)) < 0.6) for m in (0, 3, 6, 3)])
    x[5] = 0                                     # a document without terms
    rows = [(i, f"t{j}", float(x[i, j])) for i in range(len(x)) for j in range(8) if x[i, j]]
    entries = spark.createDataFrame(rows, "doc_id long, term string, val double")
    docs = spark.range(len(x)).withColumnRenamed("id", "doc_id")
    seeds, trace = [0, 70, 130, 131], []
    for steps in (1, 3, 25):
        trace.clear()
        got, centers = cluster.sparse_lloyd(docs, entries, seeds, steps, trace=trace)
        lab, c = _full_steps(x, seeds, steps)
        assert {r["doc_id"]: r["cluster_id"] - 1 for r in got.collect()} == dict(enumerate(lab.tolist()))
        dense = np.zeros_like(c)
        for r in centers.collect():
            dense[r["cluster_id"] - 1, int(r["term"][1:])] = r["c"]
        assert np.abs(dense - c).max() < 1e-9
    assert trace[0][0] == len(x) and trace[-1][0] < len(x) / 3 and trace[-1][1] == 0


def test_sparse_lloyd_empty_cluster_keeps_its_center(spark):
    # the third seed equals the second: ties go to the lower id, so it gets no document at first
    table = [(0, "a", 1.0), (1, "b", 2.0), (2, "b", 2.0), (3, "a", 1.2), (4, "b", 2.5)]
    docs = spark.range(5).withColumnRenamed("id", "doc_id")
    entries = spark.createDataFrame(table, "doc_id long, term string, val double")
    got, centers = cluster.sparse_lloyd(docs, entries, [0, 1, 2], 5)
    lab, c = _full_steps(np.array([[1, 0], [0, 2], [0, 2], [1.2, 0], [0, 2.5]]), [0, 1, 2], 5)
    assert [r["cluster_id"] - 1 for r in got.orderBy("doc_id").collect()] == lab.tolist()
    assert {(r["cluster_id"], r["term"]): round(r["c"], 9) for r in centers.collect()} == {
        (j + 1, t): round(float(c[j, d]), 9) for j in range(3) for d, t in enumerate("ab") if c[j, d]}
