"""Hot keys: one key holding about a third of all rows. Salted joins must
give exactly the plain-join results."""

import random

from pyspark.sql import functions as F

from tessera.operators import recommend, text
from tessera.operators.skew import broadcast_if_small, grid_join, hot_keys, table_bytes

SCHEMA = "user long, item long, rating double"


def _skewed_ratings(spark):
    rnd = random.Random(4)
    rows = {}
    for u in range(60):
        rows[(u, 0)] = rnd.randint(1, 10) / 2            # item 0: every user (hot)
        for i in rnd.sample(range(1, 40), 3):
            rows[(u, i)] = rnd.randint(1, 10) / 2
    data = [(u, i, r) for (u, i), r in rows.items()]
    assert sum(1 for d in data if d[1] == 0) * 4 >= len(data)   # about a third
    return spark.createDataFrame(data, SCHEMA)


def test_cf_with_hot_item_matches_plain_join(spark):
    r = _skewed_ratings(spark)
    flag = (F.col("user") * 31 + F.col("item")) % 5 == 0
    train, test = r.filter(~flag), r.filter(flag)
    hot = recommend.hot_items(train, threshold=10)
    assert hot is not None and 0 in {x["item"] for x in hot.collect()}

    def offsets(h):
        nb = recommend.neighbours(train, test, h)
        stats = recommend.pair_stats(recommend.corated_sums(train, test, h, nb.select("u", "v").distinct()))
        return {(x["user"], x["item"]): (round(x["num"], 9), round(x["den"], 9))
                for x in recommend.cf_offsets(nb, stats).collect()}

    salted, plain = offsets(hot), offsets(None)
    assert salted == plain and len(plain) > 0
    s1 = recommend.corated_sums(train, test, hot).collect()
    s2 = recommend.corated_sums(train, test, None).collect()
    assert [[round(x, 9) if x is not None and x == x else None for x in r] for r in sorted(map(tuple, s1))] == [
        [round(x, 9) if x is not None and x == x else None for x in r] for r in sorted(map(tuple, s2))]


def test_tfidf_with_hot_token_matches(spark):
    docs = spark.createDataFrame([(i, "the " + f"w{i % 7} x{i % 3}") for i in range(90)],
                                 "doc_id long, text string")
    toks = text.doc_tokens(docs)
    a = text.term_tfidf(toks, 90, hot_threshold=5).collect()
    b = text.term_tfidf(toks, 90).collect()
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))


def test_hot_keys_and_size_checked_broadcast(spark):
    df = spark.createDataFrame([(i % 50,) for i in range(1000)] + [(7,)] * 2000, "k long")
    rows = hot_keys(df, "k", threshold=100).collect()
    assert [r["k"] for r in rows] == [7] and rows[0]["_buckets"] == 21
    assert hot_keys(df, "k", threshold=10_000) is None
    small = spark.range(10)
    assert broadcast_if_small(small, max_bytes=5) is small


def test_broadcasts_are_measured_in_bytes(spark):
    long = spark.createDataFrame([("x" * 5000, ["a" * 700, None], None), (None, None, 3)],
                                 "word string, items array<string>, n int")
    assert 5700 < table_bytes(long) < 6100
    assert broadcast_if_small(long, max_bytes=5000) is long and broadcast_if_small(long) is not long
    assert table_bytes(long.limit(0)) == 0
    nested = long.select("n", "word").withColumn("s", F.struct("word", "n"))     # text within a struct counts
    assert table_bytes(nested) > 10_000


def test_grid_join_bounds_the_pairs_of_a_task(spark):
    left = spark.createDataFrame([(0, i) for i in range(300)] + [(1, 5)], "k long, u long")
    right = spark.createDataFrame([(0, -i) for i in range(300)] + [(2, 5)], "k long, v long")
    hot = hot_keys(right, "k", threshold=50)
    joined = grid_join(left, right, "k", hot)
    assert joined.select("u", "v").distinct().count() == joined.count() == 300 * 300


def test_baskets_with_hot_basket(spark):
    from tessera.operators import itemsets, skew

    rows = [(0, f"i{j}") for j in range(120)] + [(b, f"i{b % 5}") for b in range(1, 200)]
    bi = spark.createDataFrame(rows, "basket_id long, item string")
    old = skew.DEFAULT_THRESHOLD
    try:
        skew.DEFAULT_THRESHOLD = 50
        out = itemsets.baskets(bi)
        assert "_salt" in out._jdf.queryExecution().analyzed().toString()   # salted path taken
        salted = sorted(map(tuple, out.collect()))
    finally:
        skew.DEFAULT_THRESHOLD = old
    plain = sorted(map(tuple, itemsets.baskets(bi).collect()))
    assert salted == plain and sum(1 for r in plain if r[0] == 0) == 120
