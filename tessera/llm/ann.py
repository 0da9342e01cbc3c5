"""Approximate nearest neighbours over balanced posting lists.

Nearness is the inner product. Vectors are mapped to one more dimension in
which the largest inner product is the smallest distance (the added component
fills every vector up to the largest norm), so the index can prune by distance.

* Centroids are fitted on a sample of at most ``SAMPLE`` vectors, the first by
  a hash of their values: k-means in which an overfull cluster is split by
  two-means until it holds at most its fair share times ``SLACK``. Their number
  grows with the corpus up to ``CENTROIDS``, so the centroids and the graph over
  them have a fixed bound and go to every task.
* The graph links each centroid to its nearest ones and to a few spread over
  the rest; it is searched best-first from fixed entry points, for all rows of
  a batch at once.
* Every vector is entered in the list of its nearest centroid and, near a
  border, in up to ``COPIES`` lists whose centroids are less than
  ``BORDER`` times as far and are not closer to one already taken.
* A query searches the lists of its nearest centroids whose distance is at most
  a ratio times the smallest, at least ``LEAST_LISTS`` of them and as many as
  hold ``k`` other vectors. The ratio and the number of centroids looked at are
  fitted in the run: of ``MEASURED`` queries, the first by a hash of their
  values, the exact neighbours among all vectors are found on the executors,
  and both are the least with which these queries reach ``RECALL``. With all
  lists every neighbour is found, so the fit always ends.

Lists and queries are packed in blocks of bounded size and joined by list, so a
large list is several pieces of work. Equal vectors are collapsed: of each only
the ``k + 1`` smallest ids can be among a query's ``k`` nearest, which is exact.

Vectors that are null, zero, or hold null or non-finite components take no
part; neither do vectors of another dimension than the most frequent one (of
equally frequent ones the smaller), with which no inner product exists. Null
``vec_id`` takes no part. Repeated rows count once. Ties go to the smaller
``vec_id``. An empty table gives an empty result. Only ``vec_id`` and
``embedding`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm.common import checkpointed

SAMPLE = 20_000
CENTROIDS = 4096
LIST_SIZE = 512           # vectors per centroid aimed at
SLACK = 2.0
COPIES = 4
BORDER = 1.15             # of squared distances: about 7 % farther
PROBES = 64               # nearest centroids looked at, at least
LEAST_LISTS = 4           # searched whatever their distance
MEASURED = 128            # queries whose exact neighbours are found
RECALL = 0.97             # of their neighbours, to be reached
DIRECT = 8                # centroids per one looked for, up to which all are compared
FOUND_ROWS = 1 << 19      # neighbours that a task gathers before it keeps each query's best
LINKS = 16
BLOCK = 512
SEED = 4


def clean_vectors(table: DataFrame) -> DataFrame:
    """``(vec_id, v)``: rows that take part, as arrays of doubles."""
    v = F.col("embedding").cast("array<double>")
    fine = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)
    rows = table.filter(F.col("vec_id").isNotNull()).select(F.col("vec_id").cast("long"), v.alias("v")).filter(fine)
    sizes = rows.groupBy(F.size("v").alias("n")).agg(F.count(F.lit(1)).alias("c"))
    top = sizes.orderBy(F.col("c").desc(), "n").first()
    return rows.filter(F.size("v") == (top.n if top else 0))


def two_means(x: np.ndarray) -> np.ndarray:
    """Balanced halves: the sides of the median along the main direction."""
    y = x - x.mean(axis=0)
    d = y[np.argmax((y * y).sum(axis=1))]
    for _ in range(8):
        d = y.T @ (y @ d)
        norm = np.linalg.norm(d)
        if not norm:
            break
        d = d / norm
    half = np.zeros(len(x), bool)
    half[np.argsort(y @ d, kind="stable")[len(x) // 2:]] = True
    return half


def balanced_centroids(x: np.ndarray, k: int) -> np.ndarray:
    """About ``k`` centroids of clusters of at most ``SLACK`` fair shares."""
    rng = np.random.default_rng(SEED)
    c = x[rng.choice(len(x), size=min(k, len(x)), replace=False)]
    for _ in range(8):
        near = nearest(x, c)
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        size = np.bincount(near, minlength=len(c))
        c = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], c)
    near, most, out = nearest(x, c), max(2, int(SLACK * len(x) / max(1, k))), []
    pieces = [np.flatnonzero(near == j) for j in range(len(c))]
    while pieces:
        rows = pieces.pop()
        if len(rows) > most:
            half = two_means(x[rows])
            pieces += [rows[half], rows[~half]]
        elif len(rows):
            out.append(x[rows].mean(axis=0))
    return np.array(out)


def nearest(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    out, square = np.empty(len(x), np.int64), (c * c).sum(axis=1)
    for i in range(0, len(x), 1024):
        out[i:i + 1024] = np.argmin(square - 2 * x[i:i + 1024] @ c.T, axis=1)
    return out


def centroid_graph(c: np.ndarray) -> np.ndarray:
    """Neighbour lists: the nearest centroids and some spread over all."""
    links = min(LINKS, max(1, len(c) - 1))
    square, out = (c * c).sum(axis=1), []
    for i in range(0, len(c), 1024):
        d = square - 2 * c[i:i + 1024] @ c.T
        d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
        out.append(np.argpartition(d, links - 1, axis=1)[:, :links])
    far = np.random.default_rng(SEED).integers(0, len(c), (len(c), 4))
    return np.concatenate([np.concatenate(out), far], axis=1)


def search_graph(x: np.ndarray, c: np.ndarray, graph: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """``(centroids, squared distances)`` of about the ``width`` nearest
    centroids of each row, nearest first: best-first search, in which the
    neighbours of every unvisited one of the best are visited together."""
    width = min(width, len(c))
    square = (c * c).sum(axis=1)
    entries = len(c) if len(c) <= DIRECT * width else 2 * width
    entry = np.linspace(0, len(c) - 1, entries).astype(np.int64)
    ids = np.broadcast_to(entry, (len(x), len(entry)))
    dist = square[ids] - 2 * x @ c[entry].T
    keep = np.argsort(dist, axis=1, kind="stable")[:, :width]
    ids, dist = np.take_along_axis(ids, keep, 1), np.take_along_axis(dist, keep, 1)
    seen = np.zeros((len(x), len(c)), bool)
    np.put_along_axis(seen, np.broadcast_to(entry, (len(x), len(entry))), True, 1)
    opened = np.zeros((len(x), len(c)), bool)
    while entries < len(c):       # else all are compared already
        fresh = ~np.take_along_axis(opened, ids, 1)
        active = np.flatnonzero(fresh.any(axis=1))
        if not len(active):
            break
        best = ids[active, np.argmax(fresh[active], axis=1)]      # nearest not yet opened
        opened[active, best] = True
        near = graph[best]
        value = square[near] - 2 * np.einsum("rd,rld->rl", x[active], c[near])
        value[seen[active[:, None], near]] = np.inf
        value[:, 1:][near[:, 1:] == near[:, :-1]] = np.inf
        seen[active[:, None], near] = True
        both = np.concatenate([ids[active], near], axis=1)
        value = np.concatenate([dist[active], value], axis=1)
        keep = np.argsort(value, axis=1, kind="stable")[:, :width]
        ids[active], dist[active] = np.take_along_axis(both, keep, 1), np.take_along_axis(value, keep, 1)
    dist = np.maximum(dist + (x * x).sum(axis=1)[:, None], 0)
    return ids, np.where(np.isfinite(dist), dist, np.inf)


def lists_of(ids: np.ndarray, dist: np.ndarray, c: np.ndarray) -> list[np.ndarray]:
    """Per vector its nearest list and those across a border: near enough, and
    not behind a list already taken."""
    out = []
    for own, d in zip(ids, dist):
        taken = [own[0]]
        for j, dj in zip(own[1:], d[1:]):
            if len(taken) == COPIES or dj > BORDER * d[0] + 1e-12:
                break
            if (((c[taken] - c[j]) ** 2).sum(axis=1) >= dj).all():
                taken.append(j)
        out.append(np.array(taken))
    return out


def searched(ids: np.ndarray, dist: np.ndarray, ratio: float, sizes: np.ndarray, enough: int) -> np.ndarray:
    """Which of a row's lists, nearest first, are searched: the first
    ``LEAST_LISTS``, those within the ratio, and those before which there are
    not ``enough`` vectors."""
    size = sizes[ids]
    return np.isfinite(dist) & ((dist <= ratio * dist[:, :1] + 1e-12) | (np.arange(dist.shape[1]) < LEAST_LISTS)
                                | (np.cumsum(size, axis=1) - size < enough))


def fitted(x: np.ndarray, row: np.ndarray, held: list, c: np.ndarray, graph: np.ndarray, probes: int) -> tuple[int, float]:
    """``(centroids to look at, ratio)`` with which the rows of ``x`` reach
    ``RECALL`` of their neighbours: neighbour ``j`` belongs to row ``row[j]``
    and is in the lists ``held[j]``. Twice as many centroids as the recall
    needs are looked at, so that the ratio decides."""
    width, met = probes, False
    while True:
        width = min(width, len(c))
        ids, dist = search_graph(x, c, graph, width)
        ratio = (dist + 1e-12) / (dist[:, :1] + 1e-12)
        ratio[:, :LEAST_LISTS] = 1
        need = np.array([np.min(ratio[r, np.isin(ids[r], lists)], initial=np.inf) for r, lists in zip(row, held)])
        least = int(np.ceil(RECALL * len(need)))
        reached = np.sort(need)[least - 1] if least else 1.0
        if width == len(c) or met and np.isfinite(reached):
            return width, float(reached) * (1 + 1e-9)
        width, met = 2 * width, bool(np.isfinite(reached))


def packed(column) -> np.ndarray:
    return np.stack(column.to_numpy(zero_copy_only=False)) if len(column) else np.zeros((0, 0))


def best_found(parts: list, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of ``(query, vector, score)`` each query's ``k`` best, a vector once: the
    others cannot be among its ``k`` nearest."""
    query, vector, score = (np.concatenate([p[j] for p in parts]) for j in range(3))
    order = np.lexsort((score, vector, query))          # of a vector's scores the largest comes last
    query, vector, score = query[order], vector[order], score[order]
    last = np.append((query[1:] != query[:-1]) | (vector[1:] != vector[:-1]), True)[:len(query)]
    query, vector, score = query[last], vector[last], score[last]
    order = np.lexsort((vector, -score, query))
    query, vector, score = query[order], vector[order], score[order]
    head = np.flatnonzero(np.append(True, query[1:] != query[:-1])[:len(query)])
    rank = np.arange(len(query)) - np.repeat(head, np.diff(np.append(head, len(query))))
    return query[rank < k], vector[rank < k], score[rank < k]


def measured_neighbours(lists: DataFrame, asking: np.ndarray, own: list[int], k: int) -> tuple[np.ndarray, list]:
    """``(row, lists)`` of the exact ``k`` neighbours among all vectors of each
    row of ``asking``, whose ids are ``own``: the row, and the lists that hold
    the neighbour. A task keeps the best of each row only."""
    most = (k + 1) * COPIES       # entries of k + 1 vectors

    def compare(batches):
        best = None
        for b in batches:
            members, at, v = packed(b.column("v")), b.column("list").to_numpy(), b.column("ids").to_pylist()
            for i in range(0, len(members), 4096):
                x = members[i:i + 4096]
                score = np.einsum("qd,xd->qx", asking, x)
                rep = np.array([ids[0] for ids in v[i:i + 4096]], np.int64)
                ids = np.empty(len(x), object)
                ids[:] = v[i:i + 4096]
                new = [(score[q], rep, at[i:i + 4096], ids) for q in range(len(asking))]
                best = [smallest(o, n) for o, n in zip(best or [None] * len(new), new)]
        for q, (score, _, at, ids) in enumerate(best or []):
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(score), q)), pa.array(score), pa.array(at),
                 pa.array(list(ids), pa.list_(pa.int64()))], ["row", "score", "list", "ids"])

    def smallest(old, new):
        if old is not None:
            new = tuple(np.concatenate(pair) for pair in zip(old, new))
        keep = np.lexsort((new[2], new[1], -new[0]))[:most]
        return tuple(x[keep] for x in new)

    found = lists.mapInArrow(compare, "row long, score double, list long, ids array<long>")
    near = found.select("row", "score", "list", F.explode("ids").alias("vec_id"))
    owner = F.element_at(F.array(*[F.lit(i) for i in own]), (F.col("row") + 1).cast("int"))
    once = near.filter(F.col("vec_id") != owner).groupBy("row", "vec_id").agg(
        F.max("score").alias("score"), F.collect_set("list").alias("lists"))
    rank = F.row_number().over(Window.partitionBy("row").orderBy(F.col("score").desc(), "vec_id"))
    top = once.withColumn("_n", rank).filter(F.col("_n") <= k).select("row", "lists").collect()
    return np.array([r.row for r in top], np.int64), [r.lists for r in top]


def search(table: DataFrame, is_query, k: int = 20, probes: int = PROBES) -> DataFrame:
    """``(query_id, rank, vec_id, score)``: of each row that ``is_query`` (a
    condition on ``vec_id``) selects the ``k`` nearest other rows found."""
    spark = table.sparkSession
    rows = checkpointed(clean_vectors(table).withColumn("_hash", F.xxhash64("v")))
    # of equal vectors the smallest ids; the limit is applied before the shuffle too
    order = F.row_number().over(Window.partitionBy("_hash", "v").orderBy("vec_id"))
    copies = (rows.distinct().withColumn("_n", order).filter(F.col("_n") <= k + 1)
              .groupBy("_hash", "v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")))
    distinct = checkpointed(copies.select(
        F.element_at("ids", 1).alias("rep"), "ids", "v",
        F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x).alias("square")))
    top = distinct.agg(F.count(F.lit(1)).alias("n"), F.max("square").alias("m")).first()
    empty = "query_id long, rank int, vec_id long, score double"
    if not top.n:
        return spark.createDataFrame([], empty)
    sample = distinct.orderBy(F.xxhash64("v"), "rep").limit(SAMPLE).select("v", "square").collect()
    base = np.array([r.v for r in sample])
    added = np.sqrt(np.maximum(top.m - np.array([r.square for r in sample]), 0))
    count = int(min(CENTROIDS, max(1, top.n // LIST_SIZE), len(base)))
    c = balanced_centroids(np.column_stack([base, added]), count)
    shared = spark.sparkContext.broadcast((c, centroid_graph(c)))     # bounded by CENTROIDS
    largest = top.m

    def enter(batches):
        c, graph = shared.value
        for b in batches:
            x = packed(b.column("v"))
            for i in range(0, len(x), 256):
                y = x[i:i + 256]
                y = np.column_stack([y, np.sqrt(np.maximum(largest - b.column("square").to_numpy()[i:i + 256], 0))])
                lists = lists_of(*search_graph(y, c, graph, 2 * COPIES), c)
                at = np.repeat(np.arange(i, i + len(y)), [len(x) for x in lists])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(lists)), b.column("ids").take(pa.array(at)), b.column("v").take(pa.array(at))],
                    ["list", "ids", "v"])

    lists = checkpointed(distinct.select("ids", "v", "square").mapInArrow(
        enter, "list long, ids array<long>, v array<double>"))
    queries = checkpointed(rows.filter(is_query).select("vec_id", "v").distinct())
    first = queries.orderBy(F.xxhash64("v"), "vec_id").limit(MEASURED).collect()
    if not first:
        return spark.createDataFrame([], empty)
    sizes = np.zeros(len(c), np.int64)
    for r in lists.groupBy("list").count().collect():                 # bounded by CENTROIDS
        sizes[r["list"]] = r["count"]
    asking = np.array([r.v for r in first])
    row, held = measured_neighbours(lists, asking, [r.vec_id for r in first], k)
    width, ratio = fitted(np.column_stack([asking, np.zeros(len(asking))]), row, held, *shared.value, probes)
    enough = (k + 1) * COPIES                                         # entries: k + 1 vectors or more

    def ask(batches):
        c, graph = shared.value
        for b in batches:
            x = packed(b.column("v"))
            for i in range(0, len(x), 256):
                y = np.column_stack([x[i:i + 256], np.zeros(len(x[i:i + 256]))])
                ids, dist = search_graph(y, c, graph, width)
                use = searched(ids, dist, ratio, sizes, enough)
                at = np.repeat(np.arange(i, i + len(y)), use.sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids[use]), b.column("vec_id").take(pa.array(at)), b.column("v").take(pa.array(at))],
                    ["list", "query_id", "v"])

    asked = checkpointed(queries.mapInArrow(ask, "list long, query_id long, v array<double>"))

    def blocks(df, ident, values):
        """Rows of one list in blocks of about ``BLOCK``."""
        size = df.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("_b"))
        return (df.join(size, "list").withColumn("_block", F.pmod(F.xxhash64(ident), F.col("_b")))
                .groupBy("list", "_block").agg(F.collect_list(F.struct(ident, "v")).alias(values)))

    pairs = blocks(lists, "ids", "members").join(blocks(asked, "query_id", "asking"), "list").select("members", "asking")

    def compare(batches):
        held, size = [], 0
        for b in batches:
            for r in range(len(b)):
                held.append(nearest_in(b.column(0)[r], b.column(1)[r]))
                size += len(held[-1][0])
                if size > FOUND_ROWS:
                    held = [best_found(held, k)]
                    size = len(held[0][0])
                    if size > FOUND_ROWS // 2:      # many queries: nothing to be gained by waiting
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["query_id", "vec_id", "score"])
                        held, size = [], 0
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in best_found(held, k)], ["query_id", "vec_id", "score"])

    def nearest_in(members, asking):
        members, asking = members.values, asking.values
        x, q = packed(members.field("v")), packed(asking.field("v"))
        score = np.einsum("qd,xd->qx", q, x)          # double precision, no blocked reordering by size
        ids, query = members.field("ids").to_pylist(), asking.field("query_id").to_numpy()
        take = min(k + 1, len(x))
        best = np.argpartition(-score, take - 1, axis=1)[:, :take]
        edge = np.take_along_axis(score, best, 1).min(axis=1)
        at, found, value = [], [], []
        for j in range(len(q)):
            for m in np.flatnonzero(score[j] >= edge[j]):
                own = [i for i in ids[m] if i != query[j]][:k]
                at += [query[j]] * len(own)
                found += own
                value += [score[j, m]] * len(own)
        return np.array(at, np.int64), np.array(found, np.int64), np.array(value, np.float64)

    found = pairs.mapInArrow(compare, "query_id long, vec_id long, score double")
    best = Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id")
    once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    return (once.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k)
            .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score"))
