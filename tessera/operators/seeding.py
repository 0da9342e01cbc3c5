"""Parallel seeding of K-means on long-form sparse vectors.

A few rounds of weighted sampling replace the k passes of one seed at a time:
in each round every document decides alone whether it becomes a candidate,
with a probability proportional to its squared distance to the nearest
candidate so far. The candidates, weighted by the documents nearest to them,
are then reduced to k seeds.

* The draw of a document is a hash of its id, the seed and the round
  (:func:`draw`), so the result is the same under any partitioning and in a
  rerun task.
* Distances are counted in whole units (a power of two, 2^-36 of the largest
  squared norm), so their sum has no order and copies are at distance 0.
* Ties: the candidate of the earlier round, then the smaller id.

The driver holds the candidates (``1 + rounds * factor * k`` expected, set by
the parameters and not by the data) and the distances between them, nothing
else. Documents without terms are vectors of zeros; fewer distinct vectors
than ``k`` give fewer seeds; an empty table gives none.
"""

from __future__ import annotations

import math
from functools import cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.operators.cluster import _center_stats, _join_centers, _wide, doc_norms, sparse_seed_centers
from tessera.operators.skew import hot_keys

#: Binary digits kept of a squared distance, from that of the largest squared norm.
DIGITS = 36


def draw(id_col: str, seed: int, turn: int) -> F.Column:
    """A number between 0 and 1 that id, seed and turn decide: 52 bits of their MD5."""
    key = F.concat_ws(":", F.lit(str(seed)), F.lit(str(turn)), F.col(id_col).cast("string"))
    return (F.conv(F.substring(F.md5(key), 1, 13), 16, 10).cast("double") + 0.5) / float(1 << 52)


def distance_unit(norms: DataFrame) -> float:
    """The power of two in which squared distances are counted."""
    top = norms.agg(F.max("xx")).first()[0]
    return 2.0 ** (math.ceil(math.log2(top)) - DIGITS) if top else 1.0


def _near(rest: DataFrame, entries: DataFrame, ids: list, unit: float, dim: str, hot) -> DataFrame:
    """``(doc_id, new, at)`` for the documents of ``rest`` (``doc_id, xx``): the squared
    distance to the nearest of the documents ``ids``, in units, and its place among them.

    The centers go to the entries, and only sums are sent by document; entries of
    documents outside ``rest`` are summed too, as picking them out would send them all."""
    centers = sparse_seed_centers(entries, ids, dim).checkpoint()
    norm, size = _center_stats(centers, dim)
    places = range(1, len(ids) + 1)
    dots = _join_centers(entries, _wide(centers, len(ids), dim), dim, size, hot).groupBy("doc_id").agg(*[
        F.sum(F.col("val") * F.coalesce(F.col(f"_c{i}"), F.lit(0.0))).alias(f"_x{i}") for i in places])
    best = F.array_min(F.array(*[F.struct(
        _units(F.col("xx") + F.lit(float(norm.get(i, 0.0))) - 2 * F.coalesce(F.col(f"_x{i}"), F.lit(0.0)), unit).alias("q"),
        F.lit(i).alias("i")) for i in places]))
    return rest.join(dots, "doc_id", "left").select("doc_id", best.alias("_b")).select(
        "doc_id", F.col("_b.q").alias("new"), F.col("_b.i").alias("at"))


def _units(d: F.Column, unit: float) -> F.Column:
    return F.floor(F.greatest(d, F.lit(0.0)) / unit + 0.5).cast("bigint")


def candidates(docs: DataFrame, entries: DataFrame, k: int, rounds: int = 3, factor: float = 2.0, seed: int = 42,
               dim: str = "term") -> tuple[list, DataFrame, float]:
    """Candidate ids in the order found, ``(doc_id, q, cand)`` with each document's squared
    distance in units to its nearest candidate and that one's place (from 0), and the unit.
    Further rounds follow while there are fewer than ``k`` and some distance is left."""
    norms = doc_norms(docs.select("doc_id").distinct(), entries).checkpoint()
    first = norms.orderBy(draw("doc_id", seed, 0), "doc_id").select("doc_id").first()
    if first is None:
        return [], norms.select("doc_id", F.lit(0).cast("bigint").alias("q"), F.lit(0).alias("cand")), 1.0
    unit, hot = distance_unit(norms), cache(lambda: hot_keys(entries, dim))
    found, fresh = [], [first[0]]
    state = norms.select("doc_id", "xx", F.lit(None).cast("bigint").alias("q"), F.lit(None).cast("int").alias("cand"))
    turn = 0
    while fresh:
        # a document at distance 0 stays where it is
        near = _near(state.filter("q is null or q > 0").select("doc_id", "xx"), entries, fresh, unit, dim, hot)
        closer = F.col("new") < F.coalesce("q", F.col("new") + 1)
        state = state.join(near, "doc_id", "left").select(
            "doc_id", "xx", F.when(closer, F.col("new")).otherwise(F.col("q")).alias("q"),
            F.when(closer, F.col("at") - 1 + len(found)).otherwise(F.col("cand")).alias("cand")).checkpoint()
        found += fresh
        total = int(state.agg(F.sum(F.col("q").cast("decimal(38,0)"))).first()[0])
        fresh, turn = [], turn + 1
        while total and not fresh and (turn <= rounds or len(found) < k):
            chosen = draw("doc_id", seed, turn) * F.lit(float(total)) < F.lit(float(factor * k)) * F.col("q")
            fresh = sorted(r[0] for r in state.filter(chosen).select("doc_id").collect())
            turn += not fresh
    return found, state.select("doc_id", "q", "cand"), unit


def _between(entries: DataFrame, ids: list, unit: float, dim: str) -> dict[tuple[int, int], int]:
    """Squared distances, in units, of the documents ``ids`` by their places (i < j)."""
    rows = sparse_seed_centers(entries, ids, dim).checkpoint()
    norm, _ = _center_stats(rows, dim)
    other = rows.select(F.col("cluster_id").alias("_j"), dim, F.col("c").alias("_d"))
    dots = rows.join(other, dim).filter(F.col("cluster_id") < F.col("_j")).groupBy("cluster_id", "_j").agg(
        F.sum(F.col("c") * F.col("_d")).alias("x")).collect()
    x = {(r["cluster_id"], r["_j"]): r["x"] for r in dots}
    n = len(ids)
    return {(i, j): math.floor(max(norm.get(i + 1, 0.0) + norm.get(j + 1, 0.0) - 2 * x.get((i + 1, j + 1), 0.0), 0.0)
                               / unit + 0.5) for i in range(n) for j in range(i + 1, n)}


def reduce_candidates(weights: dict[int, int], distance, draws, k: int) -> list[int]:
    """``k`` places of weighted candidates. Each step draws one with a probability
    proportional to weight times squared distance to those drawn before (weight alone at
    first) as a race: the smallest -ln(draw) / rate wins, then the smaller place.
    ``distance(i, j)`` gives squared distances, ``draws[step][i]`` numbers from 0 to 1."""
    far = dict.fromkeys(weights, 1)
    chosen: list[int] = []
    for step in range(k):
        able = [i for i in weights if far[i] > 0]
        if not able:
            break
        best = min(able, key=lambda i: (-math.log(draws[step][i]) / (float(weights[i]) * float(far[i])), i))
        chosen.append(best)
        for i in weights:
            d = 0 if i == best else distance(min(i, best), max(i, best))
            far[i] = d if step == 0 else min(far[i], d)
    return chosen


def parallel_seeds(docs: DataFrame, entries: DataFrame, k: int, rounds: int = 3, factor: float = 2.0, seed: int = 42,
                   dim: str = "term") -> list:
    """``k`` seed ids (fewer if there are fewer distinct vectors), in the order drawn, for
    :func:`tessera.operators.cluster.sparse_lloyd`."""
    if k < 1:
        raise ValueError("k must be at least 1")
    found, state, unit = candidates(docs, entries, k, rounds, factor, seed, dim)
    if not found:
        return []
    weights = {r["cand"]: r["n"] for r in state.groupBy("cand").agg(F.count(F.lit(1)).alias("n")).collect()}
    between = _between(entries, found, unit, dim)
    rows = state.filter(F.col("doc_id").isin(found)).select(
        "doc_id", F.array(*[draw("doc_id", seed, -step) for step in range(1, k + 1)]).alias("u")).collect()
    u = {r["doc_id"]: r["u"] for r in rows}
    draws = [{i: u[doc][step] for i, doc in enumerate(found)} for step in range(k)]
    return [found[i] for i in reduce_candidates(weights, lambda i, j: between[i, j], draws, k)]
