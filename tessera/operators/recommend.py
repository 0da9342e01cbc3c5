"""Collaborative filtering: user-based Pearson CF and ALS.

Ratings are long-format ``(user, item, rating)``.

User-based CF (``pearson_*`` / ``cf_*``): the similarity of users u and
v is the Pearson correlation of their ratings over the items both
rated, centred on each user's mean over those common items. A test
pair (u, i) is predicted as

    mean_u + sum_v w(u,v) * (r(v,i) - mean(v|u)) / sum_v |w(u,v)|

over the raters v of i that share at least one item with u, with
``+0.01`` when the weights sum to zero; test pairs without any such
neighbour fall back to the user's mean, users without training ratings
to the global training mean.

Scale notes: pair statistics come from one item self-join restricted
on the left to users that occur in the test set. A rating meets the raters
of its item as one packed row, rows go to blocks of users, and a block expands
them, keeps the needed pairs and makes a few moments per pair (count, means,
central sums; NumPy), so a pair of users that no prediction needs is never a row.
The correlation comes from central moments; zero variance is tested by smallest =
largest rating, and a weight below ``ZERO_WEIGHT``, all that rounding can leave of an
exact zero, is zero. Ratings may be any finite doubles. A hot item multiplies its raters: both item-keyed joins
spread hot items over several tasks (:mod:`tessera.operators.skew`).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.functions.numeric import round_half_up, safe_div
from tessera.operators.skew import PAIR_THRESHOLD, grid_join, hot_keys, hot_keys_from_counts

ZERO_WEIGHT_OFFSET = 0.01

#: A correlation this small is rounding error of one that is zero.
ZERO_WEIGHT = 1e-12

#: Ratings of a block of the library's ALS.
ALS_BLOCK_ROWS = 2_500_000

#: Co-rated rows that a block of users expands at a time.
BLOCK_PAIRS = 2_000_000

#: Pairs that a task packs at a time, and raters of a row at most.
SHIPPED_PAIRS, LIST_ROWS = 1 << 21, 256


def user_rating_stats(train: DataFrame) -> DataFrame:
    """``(user, n, total, mean)`` over the training ratings."""
    return train.groupBy("user").agg(
        F.count(F.lit(1)).alias("n"), F.sum("rating").alias("total"), F.avg("rating").alias("mean"))


def with_test(train: DataFrame, test: DataFrame, include_test: bool) -> DataFrame:
    """Training set; ``include_test=True`` unions the test ratings in,
    as the reference's user-based job does."""
    return train.unionByName(test) if include_test else train


def hot_items(train: DataFrame, threshold: int | None = None) -> DataFrame | None:
    """Items with so many raters that their pairs must be spread out over a
    grid of tasks (``None`` when there are none)."""
    return hot_keys(train, "item", PAIR_THRESHOLD if threshold is None else threshold)


def corated_sums(train: DataFrame, test: DataFrame | None, hot="auto",
                 pairs: DataFrame | None = None) -> DataFrame:
    """Per pair (u, v), u a test user (any user if ``test`` is ``None``) and v != u:
    moments over the items both rated.

    ``(u, v, n, mean1, mean2, cov, var1, var2, flat)`` over the common items of
    1 = u's and 2 = v's ratings: means, covariance and variances (central moments, so large
    equal parts cost no digits), and ``flat`` where either user's ratings on them are all
    equal. Raters of a hot item are spread over several tasks
    (:mod:`tessera.operators.skew`), and so are the pairs of a user with very many.
    ``pairs`` (``u, v``, repeats allowed, or :func:`neighbour_lists`), when given, keeps only those pairs: a
    prediction needs weights only for pairs that meet as neighbours.
    """
    if isinstance(hot, str):
        hot = hot_items(train)
    left = train.select(F.col("user").alias("u"), "item", F.col("rating").cast("double").alias("r1"))
    if test is None:
        left = left.filter(F.col("u").isNotNull())
    else:
        left = left.join(test.select(F.col("user").alias("u")).distinct(), "u", "left_semi")
    kind = train.schema["user"].dataType.simpleString()
    # all pairs of a block stay, not the few that are asked for: smaller blocks
    n, heavy = _pair_blocks(train, BLOCK_PAIRS if pairs is not None else -(-BLOCK_PAIRS // 4))
    co, opened = _shipped(_in_blocks(grid_join(left, _packed_raters(train, hot), "item", hot), n, heavy).select(
        "block", "u", "r1", F.col("raters.v").alias("v"), F.col("raters.r").alias("r2")))
    shape = f"u {kind}, v {kind}, n long, " + ", ".join(f"{c} double" for c in MOMENTS)
    if pairs is None:
        sums = co.groupBy("block").applyInArrow(lambda rows: _block_sums(opened(rows), None), shape)
    else:
        if "raters" not in pairs.columns:
            pairs = pairs.select("u", F.array(F.struct("v")).alias("raters"))
        wanted, asked = _shipped(_in_blocks(pairs, n, heavy).select("block", "u", F.col("raters.v").alias("v")))
        sums = co.groupBy("block").cogroup(wanted.groupBy("block")).applyInArrow(
            lambda rows, wanted: _block_sums(opened(rows), asked(wanted)), shape)
    flat = (F.col("min1") == F.col("max1")) | (F.col("min2") == F.col("max2"))
    return sums.select("u", "v", "n", "mean1", "mean2", "cov", "var1", "var2", flat.alias("flat"))


MOMENTS = ("mean1", "mean2", "cov", "var1", "var2", "min1", "max1", "min2", "max2")


def _pair_blocks(train: DataFrame, most_pairs: int | None = None) -> tuple[int, DataFrame | None]:
    """Number of blocks for the co-rated rows, and ``(u, _buckets)`` of the users with more than
    ``most_pairs`` (``BLOCK_PAIRS``; ``None`` if none; asked only where the largest numbers of ratings allow it)."""
    limit = BLOCK_PAIRS if most_pairs is None else most_pairs
    counts = train.groupBy("item").agg(F.count(F.lit(1)).alias("_raters"))
    own = train.groupBy("user").agg(F.count(F.lit(1)).alias("_own")).agg(F.max("_own").alias("m"))
    total, most = counts.agg(F.sum(F.col("_raters").cast("double") * F.col("_raters")), F.max("_raters")).first()
    n = max(train.sparkSession.sparkContext.defaultParallelism, int(-(-(total or 0) // limit)))
    if (most or 0) * (own.first()["m"] or 0) <= limit:
        return n, None
    costs = train.join(counts, "item").groupBy(F.col("user").alias("u")).agg(F.sum("_raters").alias("_pairs"))
    return n, hot_keys_from_counts(costs, "u", "_pairs", limit)


def _in_blocks(rows: DataFrame, n: int, heavy: DataFrame | None) -> DataFrame:
    """``rows`` with their user's ``block``; the ``raters`` of a heavy user are cut into
    slices by ``v``, each in a block of its own."""
    if heavy is None:
        part = F.lit(0)
    else:
        rows = rows.join(heavy, "u", "left").withColumn(
            "_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_buckets", F.lit(1)) - 1)))
        rows = rows.withColumn("raters", F.when(F.col("_buckets").isNull(), F.col("raters")).otherwise(F.filter(
            "raters", lambda x: F.pmod(F.xxhash64(x["v"]), F.col("_buckets")) == F.col("_slice"))))
        part = F.col("_slice")
    return rows.withColumn("block", F.pmod(F.pmod(F.xxhash64("u"), F.lit(n)) + part, F.lit(n)).cast("int"))


def _packed_raters(train: DataFrame, hot: DataFrame | None) -> DataFrame:
    """``(item, raters)``: the ratings of an item as an array of ``(v, r)``; those of a hot
    item in as many arrays as it has buckets."""
    rows = train.filter(F.col("user").isNotNull())
    part = F.lit(0).cast("bigint")
    if hot is not None:
        rows = rows.join(hot, "item", "left")
        part = F.coalesce(F.pmod(F.xxhash64("user"), F.col("_buckets")), part)
    one = F.struct(F.col("user").alias("v"), F.col("rating").cast("double").alias("r"))
    lists = rows.groupBy("item", part.alias("_part")).agg(F.collect_list(one).alias("raters"))
    cut = F.transform(F.sequence(F.lit(1), F.size("raters"), F.lit(LIST_ROWS)), lambda i: F.slice("raters", i, LIST_ROWS))
    return lists.select("item", F.explode(cut).alias("raters"))


def _shipped(rows: DataFrame):
    """``rows`` (``block``, values and lists, the lists of a row equally long) packed for the way to their
    blocks, ``(block, rows)``: a task's rows of a block travel as one compressed value. And the
    function that opens an Arrow table of such rows."""
    from pyspark.sql.pandas.types import to_arrow_type
    import pyarrow as pa

    lists = {f.name: isinstance(f.dataType, T.ArrayType) for f in rows.schema if f.name != "block"}
    kinds = [to_arrow_type(f.dataType.elementType if lists[f.name] else f.dataType) for f in rows.schema if f.name in lists]
    schema = pa.schema([(c, pa.list_(kind) if lists[c] else kind) for c, kind in zip(lists, kinds)])

    def pack(table: pa.Table) -> bytes:
        import numpy as np

        columns = [table[c].combine_chunks() for c in lists]
        size = np.diff(next(x.offsets for x, many in zip(columns, lists.values()) if many).to_numpy())
        columns = [x.flatten() if many else x for x, many in zip(columns, lists.values())]
        if any(x.null_count or not (pa.types.is_integer(x.type) or pa.types.is_floating(x.type)) for x in columns):
            sink = pa.BufferOutputStream()
            with pa.ipc.new_stream(sink, schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                out.write_table(table.select(list(lists)).cast(schema))
            return b"\0" + sink.getvalue().to_pybytes()
        # the first bytes of all values, then the second ones: equal ones lie together
        planes = [np.ascontiguousarray(x.view(np.uint8).reshape(len(x), -1).T).tobytes()
                  for x in (size.astype(np.int32), *(x.to_numpy() for x in columns)) if len(x)]
        flat = b"".join(planes)
        return b"".join([b"\1", len(size).to_bytes(8, "little"), int(size.sum()).to_bytes(8, "little"),
                         len(flat).to_bytes(8, "little"), pa.Codec("zstd").compress(flat, asbytes=True)])

    def unpack(data: bytes) -> pa.Table:
        import numpy as np

        if data[:1] == b"\0":
            return pa.ipc.open_stream(data[1:]).read_all()
        n, m, length = (int.from_bytes(data[i:i + 8], "little") for i in (1, 9, 17))
        flat, at = np.frombuffer(pa.Codec("zstd").decompress(data[25:], length), np.uint8), 0
        found = []
        for count, kind in ((n, np.dtype(np.int32)), *((m if many else n, k.to_pandas_dtype()) for many, k in zip(lists.values(), kinds))):
            kind = np.dtype(kind)
            end = at + count * kind.itemsize
            found.append(np.ascontiguousarray(flat[at:end].reshape(kind.itemsize, count).T).view(kind).ravel())
            at = end
        offsets = pa.array(np.cumsum(np.append(0, found[0])).astype(np.int32))
        return pa.table([pa.ListArray.from_arrays(offsets, pa.array(x)) if many else pa.array(x)
                         for x, many in zip(found[1:], lists.values())], schema=schema)

    def run(batches):
        def send(held):
            import numpy as np

            table = pa.Table.from_batches(held)
            block = table["block"].to_numpy()
            order = np.argsort(block, kind="stable")
            table, block = table.take(pa.array(order)), block[order]
            starts = np.flatnonzero(np.diff(block, prepend=-1))
            sent = [pack(table.slice(a, b - a)) for a, b in zip(starts.tolist(), np.append(starts[1:], len(block)).tolist())]
            for i in range(0, len(sent), 1024):
                yield pa.RecordBatch.from_arrays([pa.array(block[starts[i:i + 1024]], pa.int32()),
                                                  pa.array(sent[i:i + 1024], pa.binary())], ["block", "rows"])

        held, pairs = [], 0
        for b in batches:
            if len(b):
                held.append(b)
                pairs += len(b) + len(b.column(b.schema.names.index("v")).flatten())
            if pairs > SHIPPED_PAIRS:
                yield from send(held)
                held, pairs = [], 0
        if held:
            yield from send(held)

    def opened(table: pa.Table) -> pa.Table:
        return pa.concat_tables([schema.empty_table(), *map(unpack, table["rows"].to_pylist())])

    return rows.mapInArrow(run, "block int, rows binary"), opened


def _block_sums(rows, wanted):
    """Moments of the pairs in ``rows`` ``(u, r1, v list, r2 list)`` that are among ``wanted``
    ``(u, v list)``, of all pairs if that is None. Arrow tables in and out."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    def out(u, v, columns):
        return pa.table([u, v] + columns, ["u", "v", "n", *MOMENTS])

    lists = rows["v"].combine_chunks()
    v = lists.flatten()
    if not len(v) or (wanted is not None and not len(wanted)):
        none = rows["u"].combine_chunks()[:0]
        return out(none, none, [pa.array([], pa.int64())] + [pa.array([], pa.float64())] * len(MOMENTS))
    us = rows["u"].combine_chunks().dictionary_encode()
    vs = v.dictionary_encode()
    codes = lambda x: x.to_numpy(zero_copy_only=False)
    at = codes(pc.list_parent_indices(lists))
    cu, cv = codes(us.indices).astype(np.int64)[at], codes(vs.indices).astype(np.int64)
    width = len(vs.dictionary)
    key = cu * width + cv
    same = codes(pc.fill_null(pc.index_in(us.dictionary, value_set=vs.dictionary), -1))
    keep = same[cu] != cv
    if wanted is not None:
        asked = wanted["v"].combine_chunks()
        wu = pc.index_in(wanted["u"].combine_chunks(), value_set=us.dictionary).take(pc.list_parent_indices(asked))
        wv = pc.index_in(asked.flatten(), value_set=vs.dictionary)
        met = codes(pc.and_(pc.is_valid(wu), pc.is_valid(wv)))
        pairs = np.sort(codes(pc.fill_null(wu, 0)).astype(np.int64)[met] * width + codes(pc.fill_null(wv, 0))[met])
        if not len(pairs):
            keep[:] = False
        else:
            # a table of hashes leaves few rows to look up
            place = lambda k: (k.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(40)
            marked = np.zeros(1 << 24, bool)
            marked[place(pairs)] = True
            keep = np.flatnonzero(keep & marked[place(key)])
            keep = keep[pairs[np.minimum(np.searchsorted(pairs, key[keep]), len(pairs) - 1)] == key[keep]]
    keep = np.flatnonzero(keep) if keep.dtype == bool else keep
    keep = keep[np.argsort(key[keep], kind="stable")]
    key = key[keep]
    starts = np.flatnonzero(np.diff(key, prepend=-1))
    n = np.diff(starts, append=len(key))
    pair = np.repeat(np.arange(len(starts)), n)

    def values(column, index):
        index = pa.array(index)
        return codes(pc.fill_null(column.take(index), 0.0)), codes(pc.is_valid(column.take(index)))

    def total(x, where):
        return np.add.reduceat(np.where(where, x, 0.0), starts) if len(starts) else np.zeros(0)

    def column(x, count):
        return pa.array(x, mask=count == 0)

    x, has_x = values(rows["r1"].combine_chunks(), at[keep])
    y, has_y = values(rows["r2"].combine_chunks().flatten(), keep)
    both = has_x & has_y
    found = {}
    with np.errstate(invalid="ignore", divide="ignore"):
        for name, z, has in (("1", x, has_x), ("2", y, has_y)):
            count = total(has, has)
            mean = total(z, has) / count
            found["mean" + name] = column(mean, count)
            found["var" + name] = column(total((z - mean[pair]) ** 2, has) / count, count)
            for end, ufunc, least in (("min", np.minimum, np.inf), ("max", np.maximum, -np.inf)):
                ends = ufunc.reduceat(np.where(has, z, least), starts) if len(starts) else np.zeros(0)
                found[end + name] = column(ends, count)
        count = total(both, both)
        mx, my = total(x, both) / count, total(y, both) / count
        found["cov"] = column(total((x - mx[pair]) * (y - my[pair]), both) / count, count)
    pu, pv = np.divmod(key[starts], width)
    return out(us.dictionary.take(pa.array(pu)), vs.dictionary.take(pa.array(pv)),
               [pa.array(n)] + [found[c] for c in MOMENTS])


def pair_stats(sums: DataFrame) -> DataFrame:
    """``(u, v, n, mean1, mean2, w)``: :func:`corated_sums` with the Pearson
    weight, which is 0 when either user's ratings on the common items are constant."""
    none = F.col("flat") | (F.col("var1") <= 0) | (F.col("var2") <= 0)
    w = F.when(none, F.lit(0.0)).otherwise(F.col("cov") / (F.sqrt("var1") * F.sqrt("var2")))
    return sums.select("u", "v", "n", "mean1", "mean2",
                       F.when(F.abs(w) < ZERO_WEIGHT, F.lit(0.0)).otherwise(w).alias("w"))


def neighbour_lists(train: DataFrame, test: DataFrame, hot="auto") -> DataFrame:
    """For every test pair (u, i) the raters of i, u perhaps among them: ``(u, item,
    raters)``, an array of ``(v, r)``; raters of hot items come in several arrays, spread
    over tasks (``hot``: from :func:`hot_items`, ``None`` for none, ``"auto"``)."""
    if isinstance(hot, str):
        hot = hot_items(train)
    t = test.select(F.col("user").alias("u"), "item").filter(F.col("u").isNotNull())
    return grid_join(t, _packed_raters(train, hot), "item", hot).select("u", "item", "raters")


def neighbours(train: DataFrame, test: DataFrame, hot="auto") -> DataFrame:
    """For every test pair (u, i): each other user v who rated i.
    ``(u, item, v, r)``: :func:`neighbour_lists` row by row."""
    return listed_neighbours(neighbour_lists(train, test, hot))


def listed_neighbours(lists: DataFrame, packed: bool = False) -> DataFrame:
    """``(u, item, v, r)`` of :func:`neighbour_lists`, without a user as its own neighbour;
    ``packed``: a row a list, ``v`` and ``r`` being arrays."""
    if packed:
        others = lists.select("u", "item", F.filter("raters", lambda x: x["v"] != F.col("u")).alias("_n"))
        return others.select("u", "item", F.col("_n.v").alias("v"), F.col("_n.r").alias("r"))
    return lists.select("u", "item", F.explode("raters").alias("_n")).select(
        "u", "item", F.col("_n.v").alias("v"), F.col("_n.r").alias("r")).filter(F.col("u") != F.col("v"))


def cf_offsets(nbrs: DataFrame, stats: DataFrame) -> DataFrame:
    """``(user, item, num, den)``: weighted mean-centred neighbour
    ratings and the sum of absolute weights, per test pair. ``nbrs``: :func:`listed_neighbours`,
    packed or not."""
    # far fewer pairs than neighbours: both go to blocks of users, where neighbours without a pair end
    spark = nbrs.sparkSession
    if not isinstance(nbrs.schema["v"].dataType, T.ArrayType):
        nbrs = nbrs.select("u", "item", F.array("v").alias("v"), F.array("r").alias("r"))
    counts = nbrs.groupBy("u").agg(F.sum(F.size("v")).alias("_rows")).persist()
    total = counts.agg(F.sum("_rows")).first()[0] or 0
    heavy = hot_keys_from_counts(counts, "u", "_rows", BLOCK_PAIRS)
    counts.unpersist()
    n = max(spark.sparkContext.defaultParallelism, -(-total // BLOCK_PAIRS))

    def dealt(rows: DataFrame, v: F.Column) -> DataFrame:
        part = F.lit(0) if heavy is None else F.coalesce(F.pmod(F.xxhash64(v), F.col("_buckets")), F.lit(0))
        return rows.withColumn("block", F.pmod(F.pmod(F.xxhash64("u"), F.lit(n)) + part, F.lit(n)).cast("int"))

    nbrs = nbrs.select("u", "item", "v", F.col("r").cast("array<double>").alias("r"))
    pairs = stats.select("u", "v", "mean2", "w").filter("u is not null and v is not null")
    if heavy is not None:     # the neighbours of a heavy user go one by one
        one = F.transform(F.arrays_zip("v", "r"), lambda x: F.struct(F.array(x["v"]).alias("v"), F.array(x["r"]).alias("r")))
        cut = F.when(F.col("_buckets").isNull(), F.array(F.struct("v", "r"))).otherwise(one)
        nbrs = nbrs.join(heavy, "u", "left").select("u", "item", "_buckets", F.inline(cut))
        pairs = pairs.join(heavy, "u", "left")
    rows, opened = _shipped(dealt(nbrs, F.get("v", F.lit(0))).select("block", "u", "item", "v", "r"))
    pairs = dealt(pairs, F.col("v"))
    kinds = {c: nbrs.schema[c].dataType.simpleString() for c in ("u", "item")}
    parts = rows.groupBy("block").cogroup(pairs.select("block", "u", "v", "mean2", "w").groupBy("block")).applyInArrow(
        lambda rows, pairs: _block_offsets(opened(rows), pairs),
        f"user {kinds['u']}, item {kinds['item']}, num double, den double")
    return parts.groupBy("user", "item").agg(F.sum("num").alias("num"), F.sum("den").alias("den"))


def _block_offsets(rows, pairs):
    """``(user, item, num, den)`` of the neighbours ``rows`` ``(u, item, v list, r list)`` that have a row of
    ``pairs`` ``(u, v, mean2, w)``. Arrow tables in and out."""
    import numpy as np
    import pyarrow as pa
    import pyarrow.compute as pc

    lists = rows["v"].combine_chunks()
    rows = pa.table([rows[c].combine_chunks().take(pc.list_parent_indices(lists)) for c in ("u", "item")]
                    + [lists.flatten(), rows["r"].combine_chunks().flatten()], ["u", "item", "v", "r"])
    us, vs = (pc.unique(pairs[c].combine_chunks()) for c in ("u", "v"))
    width = max(len(vs), 1)

    def keys(table):
        at = [pc.index_in(table[c].combine_chunks(), value_set=x) for c, x in (("u", us), ("v", vs))]
        known = pc.and_(*map(pc.is_valid, at)).to_numpy(zero_copy_only=False)
        u, v = (pc.fill_null(x, 0).to_numpy().astype(np.int64) for x in at)
        return np.where(known, u * width + v, -1)

    own, met = keys(pairs), keys(rows)
    order = np.argsort(own)
    place = np.searchsorted(own, met, sorter=order)
    found = np.flatnonzero((met >= 0) & (place < len(own)))
    found = found[own[order[place[found]]] == met[found]]
    match = order[place[found]]
    user, item = (rows[c].combine_chunks().take(pa.array(found)).dictionary_encode("encode") for c in ("u", "item"))
    code = lambda x: x.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    groups, group = np.unique(code(user) * max(len(item.dictionary), 1) + code(item), return_inverse=True)

    def values(column, at):
        column = column.combine_chunks().take(pa.array(at))
        return (pc.fill_null(column, 0.0).to_numpy(zero_copy_only=False),
                pc.is_valid(column).to_numpy(zero_copy_only=False))

    (r, has_r), (m, has_m), (w, has_w) = values(rows["r"], found), values(pairs["mean2"], match), values(pairs["w"], match)

    def total(x, where):
        some = np.bincount(group[where], minlength=len(groups))
        return pa.array(np.bincount(group[where], weights=x[where], minlength=len(groups)).astype(np.float64), mask=some == 0)

    with np.errstate(invalid="ignore"):
        num, den = total(w * (r - m), has_r & has_m & has_w), total(np.abs(w), has_w)
    at_user, at_item = np.divmod(groups, max(len(item.dictionary), 1))
    return pa.table([user.dictionary.take(pa.array(at_user)), item.dictionary.take(pa.array(at_item)), num, den],
                    ["user", "item", "num", "den"])


def cf_predictions(offsets: DataFrame, user_stats: DataFrame) -> DataFrame:
    """``(user, item, prediction)`` for pairs with neighbours."""
    return offsets.join(user_stats.select("user", "mean"), "user").select(
        "user", "item",
        (F.col("mean") + safe_div("num", "den", ZERO_WEIGHT_OFFSET)).alias("prediction"),
    )


def clamp_reference(x) -> F.Column:
    """The reference's output adjustment: <= 0 -> 0.2, >= 5 -> 4.0,
    otherwise x - 0.79."""
    # fixed values: 0, 0.2, 5, 4.0, 0.79
    x = F.col(x) if isinstance(x, str) else x
    return F.when(x <= 0, F.lit(0.2)).when(x >= 5, F.lit(4.0)).otherwise(x - F.lit(0.79))


def clamp_bounds(x, lo: float = 1.0, hi: float = 5.0) -> F.Column:
    """Clip to the rating scale [lo, hi]."""
    x = F.col(x) if isinstance(x, str) else x
    return F.greatest(F.lit(lo), F.least(F.lit(hi), x))


def cf_complete(test: DataFrame, offsets: DataFrame, user_stats: DataFrame,
                             clamp: str = "reference") -> DataFrame:
    """Every test pair with a prediction ``(user, item, rating, prediction)``:
    neighbours, else the user's training mean, else the global training mean;
    then clamped.

    Offsets exist only for users with training ratings, so
    ``mean + offset`` (neighbour prediction) or ``mean`` (fallback) needs
    the user means joined once, not once per step.
    """
    global_mean = user_stats.agg(F.sum("total") / F.sum("n")).scalar()
    pred = F.col("mean") + safe_div("num", "den", ZERO_WEIGHT_OFFSET)
    raw = F.when(F.col("num").isNotNull(), pred).otherwise(F.coalesce(F.col("mean"), global_mean))
    adjust = clamp_reference if clamp == "reference" else clamp_bounds
    # rounded at 1e-9 before the discontinuous clamp: a raw value that is
    # 0 or 5 in exact arithmetic must not flip with summation order
    return (
        test.join(offsets, ["user", "item"], "left")
        .join(user_stats.select("user", "mean"), "user", "left")
        .select("user", "item", "rating", adjust(round_half_up(raw, 9)).alias("prediction"))
    )


# ---------------------------------------------------------------- ALS

def als_fit(train_ids: DataFrame, rank: int = 20, max_iter: int = 20, reg: float = 0.3,
            seed: int = 42, blocks: int | None = None):
    """Explicit ALS on ``(user_id, item_id, rating)`` with int ids.

    Factor blocks default to the cluster's parallelism (one block per core), or more, of
    ``ALS_BLOCK_ROWS`` ratings each: a task holds the ratings of its block and the factors
    they meet. Item factors are checkpointed every iteration, upon which the fit drops the
    files of the shuffles before; none of this depends on how long it runs.
    """
    from pyspark.ml.recommendation import ALS

    if blocks is None:
        blocks = max(train_ids.sparkSession.sparkContext.defaultParallelism, -(-train_ids.count() // ALS_BLOCK_ROWS))
    als = ALS(rank=rank, maxIter=max_iter, regParam=reg, seed=seed,
              userCol="user_id", itemCol="item_id", ratingCol="rating",
              coldStartStrategy="drop", checkpointInterval=1,
              numUserBlocks=blocks, numItemBlocks=blocks)
    return als.fit(train_ids)
