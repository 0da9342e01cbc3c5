import itertools
import random


from tessera.operators import itemsets


def _random_baskets(seed=7, n=150, items="abcdefg"):
    rnd = random.Random(seed)
    rows = []
    for b in range(n):
        k = rnd.randint(1, len(items))
        for it in rnd.sample(items, k):
            rows.append((b, it))
            if rnd.random() < 0.1:
                rows.append((b, f" {it} "))   # untrimmed duplicate
    return rows


def _brute(rows, s):
    baskets = {}
    for b, it in rows:
        baskets.setdefault(b, set()).add(it.strip())
    out = {}
    items = sorted(set().union(*baskets.values()))
    for k in range(1, len(items) + 1):
        for c in itertools.combinations(items, k):
            sup = sum(1 for v in baskets.values() if set(c) <= v)
            if sup >= s:
                out[",".join(c)] = sup
    return out


def _as_dict(df):
    return {",".join(r["items"]): r["support"] for r in df.collect()}


def test_level_wise_and_fpgrowth_match_brute_force(spark):
    rows = _random_baskets()
    s = 60
    bi = itemsets.clean_basket_items(spark.createDataFrame(rows, "basket_id long, item string"))
    expected = _brute(rows, s)
    assert _as_dict(itemsets.level_wise_itemsets(bi, s)) == expected
    lone = bi.union(spark.createDataFrame([(10_000 + i, f"lone{i}") for i in range(200)], bi.schema))
    assert _as_dict(itemsets.fpgrowth_itemsets(lone, s)) == expected   # baskets without a frequent item


def test_result_independent_of_partitioning(spark):
    rows = _random_baskets(seed=3)
    base = spark.createDataFrame(rows, "basket_id long, item string")
    results = []
    for p in (1, 2, 15):
        bi = itemsets.clean_basket_items(base.repartition(p))
        results.append(_as_dict(itemsets.level_wise_itemsets(bi, 50)))
    assert results[0] == results[1] == results[2]


def test_candidate_support_counts_containment(spark):
    bi = spark.createDataFrame([(1, "a"), (1, "b"), (2, "a"), (3, "b"), (3, "a"), (3, "c")],
                               "basket_id long, item string")
    cands = spark.createDataFrame([(["b", "a"],), (["a", "c"],), (["b", "d"],), (["a", "a", "b"],), ([],)], "items array<string>")
    got = _as_dict(itemsets.candidate_support(bi, cands))
    assert got == {"a,b": 2, "a,c": 1, "b,d": 0}
    assert itemsets.candidate_support(bi, cands.limit(0)).count() == 0
    assert _as_dict(itemsets.candidate_support(bi.limit(0), cands)) == {"a,b": 0, "a,c": 0, "b,d": 0}


def test_items_may_hold_commas(spark):
    bi = spark.createDataFrame([(k, x) for k, items in enumerate([["a,b", "c"], ["a,b", "c"], ["a", "b"]]) for x in items],
                               "basket_id long, item string")
    want = {(("a,b",), 2), (("c",), 2), (("a,b", "c"), 2)}
    found = itemsets.level_wise_itemsets(bi, 2)
    assert {(tuple(r["items"]), r["support"]) for r in found.collect()} == want
    assert {(tuple(r["items"]), r["support"]) for r in itemsets.fpgrowth_itemsets(bi, 2).collect()} == want
    more = found.select("items").unionByName(spark.createDataFrame([(["a", "b"],), (["a", "c"],)], "items array<string>"))
    got = {(tuple(r["items"]), r["support"]) for r in itemsets.candidate_support(bi, more).collect()}
    assert got == want | {(("a", "b"), 1), (("a", "c"), 0)}


def test_candidates_over_the_trie_match_brute_force(spark, monkeypatch):
    from tessera.operators import skew
    rows = _random_baskets(seed=5, n=80, items="abcdefgh")
    baskets = {}
    for b, it in rows:
        baskets.setdefault(b, set()).add(it.strip())
    bi = itemsets.clean_basket_items(spark.createDataFrame(rows, "basket_id long, item string"))
    sets = [list(c) for k in range(1, 7) for c in itertools.combinations("abcdefghz", k)][::3]
    want = {",".join(c): sum(set(c) <= v for v in baskets.values()) for c in sets}
    trace = []
    table = spark.createDataFrame([(c,) for c in sets], "items array<string>")
    assert _as_dict(itemsets.candidate_support(bi, table, trace)) == want and len(trace) == 6
    monkeypatch.setattr(skew, "DEFAULT_THRESHOLD", 20)       # hot items and hot nodes on every level
    assert _as_dict(itemsets.candidate_support(bi, table)) == want


def test_baskets_leave_the_trie_early(spark):
    bi = spark.createDataFrame([(b, x) for b in range(100) for x in (["u", "v", "w"] if b < 3 else ["v", "w"])],
                               "basket_id long, item string")
    trace = []
    got = _as_dict(itemsets.candidate_support(bi, spark.createDataFrame([(["u", "v", "w"],)], "items array<string>"), trace))
    assert got == {"u,v,w": 3} and trace == [3, 3, 3]     # the rarest item comes first


def test_son_candidates_hold_sets_below_the_support(spark):
    bi = itemsets.clean_basket_items(spark.createDataFrame(_random_baskets(), "basket_id long, item string"))
    frequent = itemsets.level_wise_itemsets(bi, 76)
    got = itemsets.candidate_support(bi, itemsets.son_candidates(bi, frequent, 40)).collect()
    support = {tuple(r["items"]): r["support"] for r in got}
    assert len(got) == len(support) and any(0 < n < 76 for k, n in support.items() if len(k) > 1)
    assert {tuple(r["items"]) for r in frequent.collect()} == {k for k, n in support.items() if n >= 76}


def test_report_lines_format(spark):
    fi = spark.createDataFrame([(1, ["b"], 5), (1, ["a"], 6), (2, ["a", "c"], 3), (2, ["a", "b"], 4)],
                               "size int, items array<string>, support long")
    lines = [tuple(r) for r in itemsets.itemset_report_lines(fi).orderBy("position").collect()]
    assert lines == [(0, 1, "(a)"), (1, 1, "(b)"), (2, 2, "(a,b)"), (3, 2, "(a,c)")]


def test_candidates_with_an_infrequent_subset_are_dropped(spark):
    pairs = spark.createDataFrame([(["a", "b"],), (["a", "c"],), (["b", "c"],), (["b", "d"],)], "items array<string>")
    assert [r[0] for r in itemsets.level_candidates(pairs, 3).collect()] == [["a", "b", "c"]]


def test_downward_closure(spark):
    for seed in (11, 12):
        rows = _random_baskets(seed=seed, n=120)
        bi = itemsets.clean_basket_items(spark.createDataFrame(rows, "basket_id long, item string"))
        found = _as_dict(itemsets.level_wise_itemsets(bi, 30))
        for items, sup in found.items():
            parts = items.split(",")
            for sub in itertools.combinations(parts, len(parts) - 1):
                if sub:
                    key = ",".join(sub)
                    assert key in found and found[key] >= sup
