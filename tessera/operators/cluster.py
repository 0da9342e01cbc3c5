"""Clustering: nearest-centroid assignment and Lloyd K-means on dense
points and on sparse term vectors, ``pyspark.ml`` K-means / bisecting
K-means on hashed text features, and the per-cluster report (size,
error, WSSE, terms).

Cluster ids are 1-based as in the reports. Dense centroids are K x dim
numbers set by the parameters, not by the data; they go to every task as
one value, so assigning a point moves no point. Sparse centers over an exact
vocabulary grow with the data and stay distributed (see below).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.functions.vectors import sqdist
from tessera.operators import bisecting_ml
from tessera.operators.blocks import lay_out, members_table, products
from tessera.session import release_files


def pick_seeds(df: DataFrame, id_col: str, k: int, seed: int = 42) -> list:
    """``k`` distinct ids in a pseudo-random order fixed by ``seed``
    (the ids ordered by ``xxhash64(id, seed)``): a top-k, so only k ids
    reach the driver."""
    order = F.xxhash64(F.col(id_col), F.lit(seed))
    return [r[0] for r in df.select(id_col).distinct().orderBy(order, F.col(id_col)).limit(k).collect()]


def seed_points(points: DataFrame, seed_ids: Sequence[int]) -> DataFrame:
    """``(cluster_id, id, v)``: the seed points, cluster id = position of
    the seed in ``seed_ids`` + 1."""
    pos = F.array_position(F.array(*[F.lit(i) for i in seed_ids]), F.col("id")).cast("int")
    return points.filter(F.col("id").isin(list(seed_ids))).select(
        pos.alias("cluster_id"), "id", "v")


def require_seeds(found, seed_ids: Sequence) -> None:
    """Raise unless every seed id was found."""
    missing = sorted(set(seed_ids) - set(found))
    if missing:
        raise ValueError(f"seed ids not in the data: {missing}")


def assign_nearest(points: DataFrame, centroids: Sequence[tuple[int, Sequence[float]]]) -> DataFrame:
    """``(id, v, cluster_id, dist2)``: nearest centroid, the lowest cluster
    id winning ties. The K centroids travel as one value."""
    row = [([(int(cid), [float(x) for x in vec]) for cid, vec in centroids],)]
    cents = points.sparkSession.createDataFrame(row, "_cents array<struct<cid:int,c:array<double>>>")
    # one value of K x dim numbers, set by the parameters
    best = F.array_min(F.transform(
        "_cents", lambda s: F.struct(sqdist(F.col("v"), s["c"]).alias("d"), s["cid"].alias("cid"))))
    return points.withColumn("_cents", cents.scalar()).select("id", "v", best.alias("_b")).select(
        "id", "v", F.col("_b.cid").alias("cluster_id"), F.col("_b.d").alias("dist2"))


def centroid_means(assigned: DataFrame) -> DataFrame:
    """``(cluster_id, dim, value)``: per-dimension mean of each cluster, by
    the vector mean of ``ml``'s summarizer (one vector per cluster and task
    is shuffled)."""
    return _vector_means(assigned).select("cluster_id", F.posexplode(vector_to_array("m")).alias("dim", "value"))


def _vector_means(assigned: DataFrame) -> DataFrame:
    from pyspark.ml.stat import Summarizer

    return assigned.groupBy("cluster_id").agg(Summarizer.mean(array_to_vector("v")).alias("m"))


def lloyd_kmeans(points: DataFrame, seed_ids: Sequence[int], iterations: int):
    """Lloyd's algorithm from explicit seeds for a fixed number of steps.

    Each step assigns every point to its nearest centroid and moves the
    centroids to the means (an empty cluster keeps its centroid); the
    returned assignment is to the final centroids. A step that moves no
    centroid ends the loop: the remaining ones would not either. Returns
    ``(assignment, centroids)`` where ``centroids`` maps cluster id to its
    vector (K x dim values on the driver). Seed ids that are not in the data
    raise.
    """
    points = points.persist()
    seeds = seed_points(points, seed_ids).collect()
    require_seeds([r["id"] for r in seeds], seed_ids)
    cents = {r["cluster_id"]: list(r["v"]) for r in seeds}
    for _ in range(iterations):
        moved = dict(cents)
        for r in _vector_means(assign_nearest(points, sorted(cents.items()))).collect():
            moved[r["cluster_id"]] = r["m"].toArray().tolist()
        if moved == cents:
            break
        cents = moved
    out = assign_nearest(points, sorted(cents.items())).checkpoint()
    points.unpersist()
    return out, cents


def cluster_sizes(assigned: DataFrame, k: int) -> DataFrame:
    """``(cluster_id, size)`` for clusters 1..k, empty ones as 0."""
    spark = assigned.sparkSession
    ids = spark.range(1, k + 1).select(F.col("id").cast("int").alias("cluster_id"))
    sizes = assigned.groupBy("cluster_id").agg(F.count(F.lit(1)).alias("size"))
    return ids.join(sizes, "cluster_id", "left").select(
        "cluster_id", F.coalesce("size", F.lit(0)).alias("size"))


def cluster_errors(assigned: DataFrame, k: int) -> DataFrame:
    """``(cluster_id, size, error)``; error = sqrt of the cluster's sum
    of squared distances, so WSSE = sum of error^2."""
    spark = assigned.sparkSession
    ids = spark.range(1, k + 1).select(F.col("id").cast("int").alias("cluster_id"))
    agg = assigned.groupBy("cluster_id").agg(
        F.count(F.lit(1)).alias("size"), F.sum("dist2").alias("sse"))
    return ids.join(agg, "cluster_id", "left").select(
        "cluster_id",
        F.coalesce("size", F.lit(0)).alias("size"),
        F.sqrt(F.coalesce("sse", F.lit(0.0))).alias("error"),
    )


def wsse(assigned: DataFrame) -> DataFrame:
    return assigned.agg(F.sum("dist2").alias("wsse"))


def cluster_terms(doc_clusters: DataFrame, tokens: DataFrame, k: int = 10,
                  descending: bool = True) -> DataFrame:
    """``(cluster_id, rank, term, cnt)``: the k most (or least) frequent
    terms of each cluster, ties broken by term.

    ``tokens`` is ``(doc_id, token, n)``; with a column ``cluster_id`` it is taken as
    joined with ``doc_clusters`` already, so that no token is sent to its document's
    cluster. The ``row_number <= k`` filter
    is planned as a group limit applied before the shuffle, so each task
    forwards at most k rows per cluster.
    """
    if "cluster_id" not in tokens.columns:
        tokens = tokens.join(doc_clusters.select("doc_id", "cluster_id"), "doc_id")
    counts = tokens.groupBy("cluster_id", F.col("token").alias("term")).agg(F.sum("n").alias("cnt"))
    order = F.col("cnt").desc() if descending else F.col("cnt").asc()
    w = Window.partitionBy("cluster_id").orderBy(order, F.col("term").asc())
    return (
        counts.withColumn("rank", F.row_number().over(w))
        .filter(F.col("rank") <= k)
        .select("cluster_id", "rank", "term", F.col("cnt").cast("bigint").alias("cnt"))
    )


# ------------------------------------------------------ library models

def library_clusters(features: DataFrame, algorithm: str, k: int, max_iter: int, seed: int = 42):
    """Fit ``ml`` KMeans (``"kmeans"``) or its bisecting K-means (``"bisecting"``, in
    blocks of documents: :mod:`tessera.operators.bisecting_ml`) on ``features``; return
    ``(model, predictions)`` with 1-based ``cluster_id``."""
    from pyspark.ml.clustering import KMeans

    if algorithm == "kmeans":
        model = KMeans(k=k, maxIter=max_iter, seed=seed, initMode="k-means||",
                       featuresCol="features", predictionCol="pred").fit(features)
    elif algorithm == "bisecting":
        model = bisecting_ml.fit(features, k, max_iter, seed)
    else:
        raise ValueError(algorithm)
    # The model's predict closure carries K dense centers; run it in one
    # stage and keep the result, so later stages of the report do not
    # ship the centers again.
    pred = library_assign(model, features).select("doc_id", "features", "cluster_id").checkpoint()
    return model, pred


def library_assign(model, features: DataFrame) -> DataFrame:
    """``features`` with the 1-based ``cluster_id`` of each row by a fitted model, so that
    tokens of the same rows need no join (``text.tokens_from_words``, ``beside``)."""
    return model.transform(features).withColumn("cluster_id", (F.col("pred") + 1).cast("int")).drop("pred")


def library_report(pred: DataFrame, centers, tokens: DataFrame, k: int,
                   n_terms: int = 10, descending: bool = True) -> DataFrame:
    """Per-cluster ``(cluster_id, size, error, terms)`` of a fitted model.

    ``pred``: ``(doc_id, features, cluster_id)``; ``centers``: the
    model's K centers. Each document's distance is
    ||x||^2 + ||c||^2 - 2 x.c over its non-zero entries, computed on the
    executors: a cluster's entries are summed by dimension first, so the sums and not
    the entries meet the centers' non-zero values through a join. ``tokens`` as in
    :func:`cluster_terms`.
    """
    import numpy as np
    import pandas as pd
    from tessera.functions.vectors import sparse_entries

    spark = pred.sparkSession
    rows = []
    for cid, c in enumerate(centers, 1):
        c = np.asarray(c.toArray() if hasattr(c, "toArray") else c, dtype=float)
        at = np.flatnonzero(c)
        rows.append(pd.DataFrame({"cluster_id": np.full(len(at), cid, np.int32), "idx": at.astype(np.int32), "c": c[at]}))
    table = spark.createDataFrame(pd.concat(rows), "cluster_id int, idx int, c double")
    norms = table.groupBy("cluster_id").agg(F.sum(F.col("c") * F.col("c")).alias("cc"))
    entries = sparse_entries(pred.select("cluster_id", "features"), "features")
    totals = entries.groupBy("cluster_id", "idx").agg(
        F.sum("val").alias("val"), F.sum(F.col("val") * F.col("val")).alias("sq"))
    sums = totals.join(table, ["cluster_id", "idx"], "left").groupBy("cluster_id").agg(
        F.sum(F.col("sq") - 2 * F.col("val") * F.coalesce("c", F.lit(0.0))).alias("s"))
    errors = (
        cluster_sizes(pred, k).join(sums, "cluster_id", "left").join(norms, "cluster_id", "left")
        .select("cluster_id", F.sqrt(F.greatest(
            F.coalesce("s", F.lit(0.0)) + F.col("size") * F.coalesce("cc", F.lit(0.0)), F.lit(0.0))).alias("error"))
    )
    stats = cluster_sizes(pred, k).join(errors, "cluster_id", "left").select(
        "cluster_id", "size", F.coalesce("error", F.lit(0.0)).alias("error"))
    terms = cluster_terms(pred.select("doc_id", "cluster_id"), tokens, n_terms, descending)
    term_lists = terms.groupBy("cluster_id").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))),
                    lambda s: s["term"]).alias("terms"))
    return stats.join(term_lists, "cluster_id", "left")


def report_json(report: DataFrame, algorithm: str) -> DataFrame:
    """One row holding the nested report
    ``{algorithm, WSSE, Clusters: [{id, size, error, terms}]}``; the K
    cluster rows are gathered into it (K is a parameter)."""
    clusters = F.array_sort(F.collect_list(F.struct(
        F.col("cluster_id").alias("id"), "size", "error",
        F.coalesce("terms", F.array().cast("array<string>")).alias("terms"))))
    return report.agg(
        F.lit(algorithm).alias("algorithm"),
        F.sum(F.col("error") * F.col("error")).alias("WSSE"),
        clusters.alias("Clusters"),
    ).select(F.to_json(F.struct("algorithm", "WSSE", "Clusters")).alias("json"))


# ------------------------------------------------- sparse term vectors
#
# Documents as long-form vectors ``(doc_id, term, val)`` over the exact
# vocabulary. Centers are long-form too ``(cluster_id, term, c)``: the
# vocabulary grows with the data, so centers stay distributed; they are
# broadcast only after their bytes were summed, otherwise joined with hot terms
# salted.

#: Bytes of a row of centers beside its term and values.
CENTER_ROW = 64


def _row_bytes(dim: str) -> F.Column:
    return F.sum(F.lit(CENTER_ROW) + F.octet_length(F.col(dim).cast("string"))).cast("bigint")


def _center_stats(centers: DataFrame, dim: str) -> tuple[dict[int, float], int]:
    """Squared norm of each center and the bytes of all center rows without their
    values (one small aggregate, K rows to the driver)."""
    rows = centers.groupBy("cluster_id").agg(
        F.sum(F.col("c") * F.col("c")).alias("cn"), _row_bytes(dim).alias("m")).collect()
    return {r["cluster_id"]: float(r["cn"]) for r in rows}, sum(r["m"] for r in rows)


def _join_centers(entries: DataFrame, centers: DataFrame, dim: str, size: int, hot="auto") -> DataFrame:
    """``size``: bytes of the centers by :func:`_center_stats`; ``hot``: a function that
    gives the hot dimensions of these entries or more, asked only where they are needed."""
    from tessera.operators.skew import BROADCAST_MAX_BYTES, hot_keys, salted_join

    # a pivoted row holds its term and K doubles; there are at most size / CENTER_ROW rows
    if size + size // CENTER_ROW * 8 * (len(centers.columns) - 1) <= BROADCAST_MAX_BYTES:
        return entries.join(F.broadcast(centers), dim)
    return salted_join(centers, entries, dim, hot_keys(entries, dim) if isinstance(hot, str) else hot())


def doc_norms(docs: DataFrame, entries: DataFrame) -> DataFrame:
    """``(doc_id, xx)``: squared norm of every document (0 without terms)."""
    xx = entries.groupBy("doc_id").agg(F.sum(F.col("val") * F.col("val")).alias("xx"))
    return docs.select("doc_id").join(xx, "doc_id", "left").select(
        "doc_id", F.coalesce("xx", F.lit(0.0)).alias("xx"))


def sparse_assign(docs: DataFrame, entries: DataFrame, centers: DataFrame, k: int,
                  dim: str = "term", norms: DataFrame | None = None) -> DataFrame:
    """``(doc_id, cluster_id, dist2)``: nearest center by
    ||x||^2 + ||c||^2 - 2 x.c, lowest cluster id on ties. ``docs`` lists
    every document (``doc_id``), so documents without terms are placed
    too; ``norms`` (:func:`doc_norms`) may be passed in when reused.
    ``centers`` must be persisted or checkpointed.

    The K centers are pivoted to one row per dimension (K is a
    parameter), so each document entry meets one center row and yields
    all K products at once.
    """
    cn, size = _center_stats(centers, dim)
    cnorm = [float(cn.get(cid, 0.0)) for cid in range(1, k + 1)]
    if norms is None:
        norms = doc_norms(docs, entries)
    ids = list(range(1, k + 1))
    wide = centers.groupBy(dim).pivot("cluster_id", ids).agg(F.first("c"))
    wide = wide.select(dim, *[F.col(str(cid)).alias(f"_c{cid}") for cid in ids])
    dots = _join_centers(entries, wide, dim, size).groupBy("doc_id").agg(
        *[F.sum(F.col("val") * F.coalesce(F.col(f"_c{cid}"), F.lit(0.0))).alias(f"_xc{cid}")
          for cid in ids])
    cand = F.array(*[
        F.struct((F.col("xx") + F.lit(cnorm[cid - 1])
                  - 2 * F.coalesce(F.col(f"_xc{cid}"), F.lit(0.0))).alias("d"),
                 F.lit(cid).alias("cid"))
        for cid in ids])
    return (
        norms.join(dots, "doc_id", "left")
        .select("doc_id", F.array_min(cand).alias("_b"))
        .select("doc_id", F.col("_b.cid").alias("cluster_id"),
                F.greatest(F.col("_b.d"), F.lit(0.0)).alias("dist2"))
    )


def sparse_seed_centers(entries: DataFrame, seed_ids: Sequence[int], dim: str = "term") -> DataFrame:
    pos = F.array_position(F.array(*[F.lit(i) for i in seed_ids]), F.col("doc_id")).cast("int")
    return entries.filter(F.col("doc_id").isin(list(seed_ids))).select(
        pos.alias("cluster_id"), dim, F.col("val").alias("c"))


def _wide(centers: DataFrame, k: int, dim: str) -> DataFrame:
    """Centers as one row per dimension with the columns ``_c1`` to ``_ck``."""
    return centers.groupBy(dim).agg(*[
        F.sum(F.when(F.col("cluster_id") == cid, F.col("c"))).alias(f"_c{cid}") for cid in range(1, k + 1)])


#: Distances closer than this, relative to the document's length, are decided by the
#: centers themselves and not by bounds: rounding may be as large.
BOUND_MARGIN = 1e-6


def sparse_lloyd(docs: DataFrame, entries: DataFrame, seed_ids: Sequence[int], iterations: int,
                 dim: str = "term", trace: list | None = None):
    """Lloyd's algorithm on long-form sparse vectors from explicit seed
    documents. ``iterations=0`` gives the nearest-seed assignment.

    The entries are laid out in blocks of dimensions once
    (:mod:`tessera.operators.blocks`); a step sends labels and products, neither
    entries nor centers. Every document carries an upper bound of the distance to
    its center and a lower bound of that to any other. When the centers move, the
    bounds give way by as much as those can have moved: by the distances of the
    documents that came and went, over the cluster's size. A document whose bounds
    still decide stays where it is and meets no center. The result is that of full
    steps; ``trace``, when given, receives ``(documents compared, documents moved)``
    of each step. How far the centers moved is known within the step only, so products
    of some documents that the bounds then decide are made and not looked at.

    The state is checkpointed every step (short lineage, survives executor loss);
    once no document moves the remaining steps would change nothing and are left
    out. A cluster that lost all documents keeps its center: those it lost last stay
    its members. A document that ``docs`` lists repeatedly counts as often. Seed ids
    that are not in the data raise. Returns ``(assignment, centers)``, the centers as
    a lazy plan."""
    k = len(seed_ids)
    found = {r["doc_id"]: r["count"] for r in
             docs.filter(F.col("doc_id").isin(list(seed_ids))).groupBy("doc_id").count().collect()}
    require_seeds(found, seed_ids)
    if not iterations:
        norms = doc_norms(docs, entries).persist()
        centers = sparse_seed_centers(entries, seed_ids, dim).filter("c <> 0").checkpoint()
        out = sparse_assign(docs, entries, centers, k, dim, norms).checkpoint()
        norms.unpersist()
        return out, centers
    blocks = lay_out(entries, dim)
    seed = F.array_position(F.array(*[F.lit(i) for i in seed_ids]), F.col("doc_id")).cast("int") - 1
    state = members_table(docs, blocks).select(
        "doc_id", "w", "xx", "blocks", F.lit(None).cast("int").alias("before"),
        F.lit(float("inf")).alias("upper"), F.lit(0.0).alias("lower"), F.array().cast("array<int>").alias("olds"),
        F.when(seed >= 0, F.array(seed)).otherwise(F.array().cast("array<int>")).alias("members")).checkpoint()
    sizes, before, by = [float(found[i]) for i in seed_ids], None, None
    for _ in range(iterations):
        release_files(docs.sparkSession)
        sure = F.lit(False)
        if by:
            own, other = _bounds_give_way(by)
            sure = F.col("upper") + own + BOUND_MARGIN * (1 + F.sqrt("xx")) < F.col("lower") - other
        x, norms, kept = products(blocks, state.select(
            "doc_id", "w", "blocks", "members", "olds", F.when(~sure, F.lit(0)).alias("slot")), sizes, k, before)
        upper, lower, left_open = F.col("upper"), F.col("lower"), F.lit(True)
        if by:
            # by now it is known how far the centers moved
            own, other = _bounds_give_way([min(far, norms[k + c] ** 0.5 * (1 + 1e-9)) for c, far in enumerate(by)])
            upper, lower = upper + own, lower - other
            left_open = ~(upper + BOUND_MARGIN * (1 + F.sqrt("xx")) < lower)
        near = F.array_sort(_distances(norms[:k]))
        root = lambda d: F.sqrt(F.greatest(d, F.lit(0.0)))
        second = root(F.get("_b", F.lit(1))["d"]) if k > 1 else F.lit(float("inf"))
        seen = state.join(x, "doc_id", "left").withColumn("_b", F.when(left_open, near)).select(
            "doc_id", "w", "xx", "blocks", "members", "before",
            F.coalesce(F.get("_b", F.lit(0))["cid"], "before").alias("cluster_id"),
            F.when(F.col("_b").isNull(), upper).otherwise(root(F.get("_b", F.lit(0))["d"])).alias("upper"),
            F.when(F.col("_b").isNull(), lower).otherwise(second).alias("lower"),
            root(F.get(F.filter("_b", lambda b: b["cid"] == F.col("before")), F.lit(0))["d"]).alias("left"),
            left_open.alias("seen")).checkpoint()
        kept.unpersist()
        moved = ~F.col("before").eqNullSafe(F.col("cluster_id"))
        none = F.lit(0).cast("bigint")
        here = F.struct(F.col("cluster_id").alias("cid"), F.col("w").alias("n"), F.when(F.col("seen"), F.col("w")).otherwise(
            none).alias("seen"), F.when(moved, F.col("w")).otherwise(none).alias("moved"),
            F.when(moved, F.col("w") * F.col("upper")).otherwise(F.lit(0.0)).alias("far"))
        gone = F.when(moved & F.col("before").isNotNull(), F.struct(
            F.col("before").alias("cid"), none.alias("n"), none.alias("seen"), none.alias("moved"),
            (F.col("w") * F.col("left")).alias("far")))
        stats = {r["cid"]: r for r in seen.select(F.explode(F.array_compact(F.array(here, gone))).alias("_e")).select(
            "_e.*").groupBy("cid").agg(*[F.sum(c).alias(c) for c in ("n", "seen", "moved", "far")]).collect()}
        if trace is not None:
            trace.append((sum(r["seen"] for r in stats.values()), sum(r["moved"] for r in stats.values())))
        if not any(r["moved"] for r in stats.values()):
            break
        empty = [c for c in range(k) if c + 1 not in stats or not stats[c + 1]["n"]]
        before, sizes = sizes, [sizes[c] if c in empty else float(stats[c + 1]["n"]) for c in range(k)]
        # the center of a cluster moves by at most the distances to it of those that came and went, over its size
        by = [0.0 if c in empty else stats[c + 1]["far"] / sizes[c] * (1 + 1e-9) for c in range(k)]
        held = F.filter("members", lambda m: m.isin(empty)) if empty else F.array().cast("array<int>")
        state = seen.select("doc_id", "w", "xx", "blocks", F.col("cluster_id").alias("before"), "upper", "lower",
                            F.col("members").alias("olds"),
                            F.concat(F.array(F.col("cluster_id") - 1), held).alias("members"))
    x, norms, kept = products(blocks, state.select("doc_id", "w", "blocks", "members", F.lit(0).alias("slot")), sizes, k)
    out = state.select("doc_id", "w", "xx").join(x, "doc_id", "left").select(
        "doc_id", "w", F.array_min(_distances(norms)).alias("_b"))
    out = out.select("doc_id", F.col("_b.cid").alias("cluster_id"), F.greatest("_b.d", F.lit(0.0)).alias("dist2"),
                     F.explode(F.sequence(F.lit(1).cast("bigint"), "w")).alias("_n")).drop("_n").checkpoint()
    kept.unpersist()
    blocks.unpersist()
    size = F.get(F.array(*[F.lit(n) for n in sizes]), F.col("_c"))
    mine = state.select("doc_id", "w", F.explode("members").alias("_c"))
    centers = entries.join(mine, "doc_id").groupBy((F.col("_c") + 1).alias("cluster_id"), F.col(dim)).agg(
        (F.sum(F.col("val") * F.col("w")) / F.first(size)).alias("c")).filter("c <> 0")
    return out, centers


def _bounds_give_way(by: list[float]) -> tuple[F.Column, F.Column]:
    """How far the own center (``before``) of a document and any other can have moved."""
    table = lambda far: F.create_map(*[F.lit(v) for c, d in enumerate(far) for v in (c + 1, d)])[F.col("before")]
    return table(by), table([max([d for o, d in enumerate(by) if o != c], default=0.0) for c in range(len(by))])


def _distances(norms: list[float]) -> F.Column:
    """Squared distances and cluster ids from ``xx``, the products ``x`` and the norms of the centers."""
    return F.array(*[F.struct(
        (F.col("xx") + F.lit(float(n)) - 2 * F.coalesce(F.get("x", F.lit(c)), F.lit(0.0))).alias("d"),
        F.lit(c + 1).alias("cid")) for c, n in enumerate(norms)])
