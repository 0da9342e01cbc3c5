import math
import random
import re
from fractions import Fraction

from tessera.operators import evaluate, recommend
from tessera.operators.dictionary import dense_ids

SCHEMA = "user long, item long, rating double"


def _brute_cf(train, test):
    """Straight transcription of the prediction rule, for checking."""
    by_user = {}
    for u, i, r in train:
        by_user.setdefault(u, {})[i] = r
    means = {u: sum(d.values()) / len(d) for u, d in by_user.items()}
    out = {}
    for u, i, _ in test:
        if u not in by_user:
            continue
        num = den = 0.0
        found = False
        for v, dv in by_user.items():
            if v == u or i not in dv:
                continue
            common = set(by_user[u]) & set(dv)
            if not common:
                continue
            found = True
            m1 = sum(by_user[u][j] for j in common) / len(common)
            m2 = sum(dv[j] for j in common) / len(common)
            cov = sum((by_user[u][j] - m1) * (dv[j] - m2) for j in common)
            v1 = sum((by_user[u][j] - m1) ** 2 for j in common)
            v2 = sum((dv[j] - m2) ** 2 for j in common)
            w = 0.0 if v1 == 0 or v2 == 0 else float(cov) / (math.sqrt(v1) * math.sqrt(v2))
            num += w * float(dv[i] - m2)
            den += abs(w)
        if found:
            out[(u, i)] = float(means[u]) + (num / den if den != 0 else 0.01)
    return out


def test_cf_predictions_match_brute_force(spark):
    rnd = random.Random(11)
    rows = {(u, i): rnd.randint(1, 10) / 2 for u in range(25) for i in range(30) if rnd.random() < 0.35}
    data = [(u, i, r) for (u, i), r in rows.items()]
    test = [t for t in data if (t[0] * 31 + t[1]) % 5 == 0]
    train = [t for t in data if (t[0] * 31 + t[1]) % 5 != 0]
    tr = spark.createDataFrame(train, SCHEMA)
    te = spark.createDataFrame(test, SCHEMA)
    stats = recommend.pair_stats(recommend.corated_sums(tr, te))
    offs = recommend.cf_offsets(recommend.neighbours(tr, te), stats)
    preds = recommend.cf_predictions(offs, recommend.user_rating_stats(tr))
    got = {(r["user"], r["item"]): r["prediction"] for r in preds.collect()}
    want = _brute_cf(train, test)
    assert got.keys() == want.keys()
    for k in want:
        assert abs(got[k] - want[k]) < 1e-9


def test_zero_variance_weight_is_zero_and_bounded(spark):
    tr = spark.createDataFrame([(1, 1, 3.0), (1, 2, 3.0), (2, 1, 4.0), (2, 2, 5.0), (3, 1, 1.0), (3, 2, 5.0)], SCHEMA)
    te = spark.createDataFrame([(1, 9, 1.0), (2, 9, 1.0)], SCHEMA)
    w = {(r["u"], r["v"]): r["w"] for r in recommend.pair_stats(recommend.corated_sums(tr, te)).collect()}
    assert w[(1, 2)] == 0.0 and w[(1, 3)] == 0.0
    assert abs(w[(2, 3)] - 1.0) < 1e-12


def test_fine_ratings_are_not_rounded(spark):
    step = [(1, i, 1.0 + 1e-5 * i) for i in (1, 2, 3)] + [(2, i, 2.0 + 1e-5 * i) for i in (1, 2, 3)] + [
        (3, i, (4 - i) / 3) for i in (1, 2, 3)] + [(4, i, 1 / 3) for i in (1, 2, 3)] + [(5, 1, 0.1), (5, 2, 0.3), (5, 3, 0.1)]
    tr = spark.createDataFrame(step, SCHEMA)
    te = spark.createDataFrame([(u, 9, 1.0) for u in range(1, 6)], SCHEMA)
    rows = {(r["u"], r["v"]): r for r in recommend.pair_stats(recommend.corated_sums(tr, te)).collect()}
    assert abs(rows[1, 2]["w"] - 1) < 1e-9 and abs(rows[1, 3]["w"] + 1) < 1e-9 and rows[1, 4]["w"] == 0.0
    assert rows[5, 3]["w"] == 0.0                                  # an exact zero stays zero
    assert abs(rows[1, 2]["mean1"] - 1.00002) < 1e-12 and abs(rows[4, 1]["mean1"] - 1 / 3) < 1e-15


def test_cf_matches_brute_force_for_any_doubles(spark):
    rnd = random.Random(3)
    data = [(u, i, rnd.choice([1 / 3, 2 / 7, 1e-5, 4.99999, 1e6 + rnd.random(), rnd.random()])) for u in range(15) for i in range(20)
            if rnd.random() < 0.5]
    test = [t for t in data if (t[0] * 31 + t[1]) % 5 == 0]
    train = [t for t in data if (t[0] * 31 + t[1]) % 5 != 0]
    tr, te = spark.createDataFrame(train, SCHEMA), spark.createDataFrame(test, SCHEMA)
    offs = recommend.cf_offsets(recommend.neighbours(tr, te), recommend.pair_stats(recommend.corated_sums(tr, te)))
    got = {(r["user"], r["item"]): r["prediction"] for r in recommend.cf_predictions(offs, recommend.user_rating_stats(tr)).collect()}
    want = _brute_cf([(u, i, Fraction(r)) for u, i, r in train], test)       # exact sums
    assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-6 * max(1, abs(want[k])) for k in want)


def test_reference_clamp_edges(spark):
    df = spark.createDataFrame([(-1.0,), (0.0,), (0.5,), (4.99,), (5.0,)], "x double")
    got = [round(r[0], 6) for r in df.select(recommend.clamp_reference("x")).collect()]
    assert got == [0.2, 0.2, -0.29, 4.2, 4.0]


def test_error_histogram_edges(spark):
    df = spark.createDataFrame([(float(e), 0.0) for e in (0, 0.99, 1, 3.999, 4, 7)], "rating double, prediction double")
    got = {r["bucket"]: r["n"] for r in evaluate.error_histogram(df).collect()}
    assert got == {0: 2, 1: 1, 2: 0, 3: 1, 4: 2}
    r = evaluate.rmse(df).first()
    assert r["n"] == 6


def test_cf_complete_keeps_every_test_row(spark):
    tr = spark.createDataFrame([(1, 1, 4.0), (2, 1, 2.0), (2, 2, 3.0)], SCHEMA)
    te = spark.createDataFrame([(1, 2, 5.0), (9, 1, 3.0)], SCHEMA)  # user 9 is cold
    us = recommend.user_rating_stats(tr)
    offsets = spark.createDataFrame([], "user long, item long, num double, den double")
    out = {(r["user"], r["item"]): r["prediction"]
           for r in recommend.cf_complete(te, offsets, us).collect()}
    assert abs(out[(1, 2)] - (4 - 0.79)) < 1e-9          # user mean
    assert abs(out[(9, 1)] - (3 - 0.79)) < 1e-9          # global mean 9/3


def test_dense_ids_contiguous_sorted(spark):
    vals = random.Random(5).sample(range(10_000), 500)
    df = spark.createDataFrame([(v,) for v in vals] + [(vals[0],)], "k long").repartition(7)
    ids = dense_ids(df, "k", "kid").collect()
    got = sorted((r["k"], r["kid"]) for r in ids)
    assert [g[1] for g in got] == list(range(len(vals)))


def test_salted_join_equals_plain_join(spark):
    from tessera.operators.skew import hot_keys, salted_join

    rnd = random.Random(2)
    right = spark.createDataFrame([(rnd.choice([1, 1, 1, 2, 3]), i, rnd.random()) for i in range(300)],
                                  "k long, v long, x double")
    left = spark.createDataFrame([(rnd.choice([1, 2, 4]), i) for i in range(40)], "k long, u long")
    hot = hot_keys(right, "k", threshold=20)
    assert {r["k"] for r in hot.collect()} == {1, 2, 3} or {r["k"] for r in hot.collect()} >= {1}
    got = sorted(tuple(r) for r in salted_join(left, right, "k", hot).select("k", "u", "v", "x").collect())
    want = sorted(tuple(r) for r in left.join(right, "k").select("k", "u", "v", "x").collect())
    assert got == want


def test_ratings_with_halves_are_exact(spark):
    tr = spark.createDataFrame([(1, 1, 3.5), (1, 2, 4.0), (1, 3, 1.5), (2, 1, 2.5), (2, 2, 4.5), (2, 3, 1.0),
                                (2, 4, 4.5)], SCHEMA)
    te = spark.createDataFrame([(1, 4, 5.0)], SCHEMA)
    r = recommend.pair_stats(recommend.corated_sums(tr, te)).first()
    assert r["mean1"] == 3.0 and abs(r["w"] - 0.914811) < 1e-5
    assert {x["user"]: x["total"] for x in recommend.user_rating_stats(tr).collect()} == {1: 9.0, 2: 12.5}


def test_training_with_test_ratings(spark):
    tr, te = spark.createDataFrame([(1, 1, 3.5)], SCHEMA), spark.createDataFrame([(1, 2, 4.5)], SCHEMA)
    rows = recommend.user_rating_stats(recommend.with_test(tr, te, True)).collect()
    assert [(r["n"], r["total"], r["mean"]) for r in rows] == [(2, 8.0, 4.0)]


def test_pearson_bounded_and_symmetric(spark):
    for seed in range(3):
        rnd = random.Random(100 + seed)
        data = [(u, i, rnd.randint(1, 10) / 2) for u in range(15) for i in range(12) if rnd.random() < 0.5]
        r = spark.createDataFrame(data, SCHEMA)
        # every user is a test user, so both (u, v) and (v, u) are computed
        w = {(x["u"], x["v"]): x["w"]
             for x in recommend.pair_stats(recommend.corated_sums(r, r, None)).collect()}
        assert w and all(-1 - 1e-9 <= v <= 1 + 1e-9 for v in w.values())
        assert all(abs(w[(u, v)] - w[(v, u)]) < 1e-12 for (u, v) in w)


def test_pairs_are_made_in_blocks_and_heavy_users_are_cut(spark, monkeypatch):
    rnd = random.Random(9)
    rows = [(u, i, rnd.choice([0.5, 1 / 3, 4.0, None])) for u in range(20) for i in range(25) if u == 3 or rnd.random() < 0.3]
    rows += rows[:40]                                              # rated twice
    r = spark.createDataFrame(rows + [(None, 1, 2.0), (4, None, 2.0)], SCHEMA)
    want = {}
    for u, i, a in rows:
        for v, j, b in rows:
            if i == j and u != v:
                want.setdefault((u, v), []).append((a, b))
    pairs = spark.createDataFrame([p for p in want if sum(p) % 3] * 2 + [(3, 99), (None, 3)], "u long, v long")

    def check(pairs, keys):
        sums = recommend.corated_sums(r, r, None, pairs)
        plan = sums._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Join \[u#\d+L?, v#", plan)                # pairs are not rows of a join
        got = {(x["u"], x["v"]): x for x in sums.collect()}
        assert got.keys() == keys
        for k, x in got.items():
            a, b = ([z for z in side if z is not None] for side in zip(*want[k]))
            both = [(y, z) for y, z in want[k] if y is not None and z is not None]
            assert x["n"] == len(want[k])
            for name, side in (("1", a), ("2", b)):
                mean = sum(side) / len(side) if side else None
                assert (x["mean" + name] is None) == (not side)
                if side:
                    assert abs(x["mean" + name] - mean) < 1e-12
                    assert abs(x["var" + name] - sum((z - mean) ** 2 for z in side) / len(side)) < 1e-12
            if both:
                m1, m2 = (sum(s) / len(both) for s in zip(*both))
                assert abs(x["cov"] - sum((y - m1) * (z - m2) for y, z in both) / len(both)) < 1e-12
            else:
                assert x["cov"] is None

    wanted = {k for k in want if sum(k) % 3}
    check(None, set(want))
    check(pairs, wanted)
    monkeypatch.setattr(recommend, "BLOCK_PAIRS", 40)              # every user is heavy, most of all user 3
    n, heavy = recommend._pair_blocks(r)
    assert n > 20 and {x["u"]: x["_buckets"] for x in heavy.collect()}[3] > 3
    check(None, set(want))
    check(pairs, wanted)


def test_pair_means_has_every_pair_with_a_common_item(spark, tmp_path):
    from tessera.plans.catalog import QUERIES

    # user * 31 + item: a multiple of 5 is a test rating. Users 5 and 10 have a test item that no other rates, user 15 none.
    ratings = {(5, 1): 3, (5, 2): 8, (5, 5): 1, (10, 1): 12, (10, 2): 20, (10, 10): 1, (15, 2): 30, (20, 3): 1}
    orders = [(100 + n, u) for n, (u, _) in enumerate(ratings)]
    lines = [(100 + n, i, float(q)) for n, ((_, i), q) in enumerate(ratings.items())]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(str(tmp_path / "orders.parquet"))
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(
        str(tmp_path / "lineitem.parquet"))
    got = {tuple(r) for r in QUERIES["pair_means"](spark, str(tmp_path)).collect()}
    half = {(5, 10): (2, 0.75, 1.75), (5, 15): (1, 1.0, 3.0), (10, 15): (1, 2.0, 3.0)}
    assert got == {(*k, *x) for k, x in half.items()} | {(v, u, n, b, a) for (u, v), (n, a, b) in half.items()}


def test_offsets_are_made_in_blocks(spark, monkeypatch):
    rnd = random.Random(4)
    data = [(u, i, rnd.choice([0.5, 2.5, 4.0, None])) for u in range(14) for i in range(12) if rnd.random() < 0.6]
    train = spark.createDataFrame(data, SCHEMA)
    test = spark.createDataFrame([(u, i, 1.0) for u in range(16) for i in range(13)] + [(1, 1, 3.0), (2, None, 1.0)], SCHEMA)
    lists = recommend.neighbour_lists(train, test, None)
    nbrs = recommend.listed_neighbours(lists)
    stats = recommend.pair_stats(recommend.corated_sums(train, test, None, lists.select("u", "raters"))).checkpoint()
    want = {}
    weights = {(r["u"], r["v"]): r for r in stats.collect()}
    for x in nbrs.collect():
        if (x["u"], x["v"]) in weights:
            r = weights[x["u"], x["v"]]
            sums = want.setdefault((x["u"], x["item"]), [None, None])
            for k, parts in enumerate(((r["w"], x["r"], r["mean2"]), (r["w"],))):
                if None not in parts:
                    sums[k] = (sums[k] or 0.0) + (r["w"] * (x["r"] - r["mean2"]) if k == 0 else abs(r["w"]))
    for pairs, form in ((2_000_000, nbrs), (2_000_000, recommend.listed_neighbours(lists, packed=True)),
                        (10, recommend.listed_neighbours(lists, packed=True))):
        monkeypatch.setattr(recommend, "BLOCK_PAIRS", pairs)       # every user is heavy in the last round
        offsets = recommend.cf_offsets(form, stats)
        plan = offsets._jdf.queryExecution().executedPlan().toString()
        assert not re.search(r"Join \[u#\d+L?, v#", plan)                # no neighbour is a row of a join
        got = {(r["user"], r["item"]): (r["num"], r["den"]) for r in offsets.collect()}
        assert got.keys() == want.keys()
        for k, sums in want.items():
            for a, b in zip(got[k], sums):
                assert (a is None) == (b is None) and (a is None or abs(a - b) < 1e-9)


def test_packed_rows_are_opened_as_they_were(spark):
    rows = [(k % 3, f"u{k}", [f"v{j}" if j else None for j in range(k)], [float(j) for j in range(k)]) for k in range(7)]
    for kind, rows in (("string", rows), ("long", [(b, len(v), [j - 3 for j in range(len(v))], r) for b, _, v, r in rows])):
        df = spark.createDataFrame(rows, f"block int, u {kind}, v array<{kind}>, r array<double>")
        shipped, opened = recommend._shipped(df)
        got = [(b, *(x[c] for c in "uvr")) for t in [shipped.toArrow()] for b, one in zip(t["block"].to_pylist(), t["rows"])
               for x in opened(t.slice(0, 0).from_pydict({"rows": [one.as_py()]})).to_pylist()]
        assert sorted(got, key=str) == sorted(rows, key=str)


def test_als_blocks_grow_with_the_ratings(spark, monkeypatch):
    monkeypatch.setattr(recommend, "ALS_BLOCK_ROWS", 20)
    rows = spark.createDataFrame([(u, i, float((u + i) % 5)) for u in range(20) for i in range(8)],
                                 "user_id int, item_id int, rating double")
    model = recommend.als_fit(rows, rank=2, max_iter=2)
    assert model.userFactors.rdd.getNumPartitions() == 8 and model.transform(rows).count() == 160
