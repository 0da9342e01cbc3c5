"""Operators against brute force and held-out labels, on the small tables."""

import collections

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from tessera.llm import common, decontamination, quality, sharding, simhash_dedup, suffix_array, toxicity
from tessera.llm.components import connected_components
from tessera.llm.queries import QUERIES

SF = "/root/testdata/sf0.01"


def smallest_capacity(weights, shards):
    """Plain search over the sorted groups."""
    def fits(c):
        used, room = 1, c
        for w in weights:
            if w > c:
                return False
            if w > room:
                used, room = used + 1, c
            room -= w
        return used <= shards
    low, high = max(weights), sum(weights)
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


@pytest.mark.parametrize("sizes", [[5] * 40, list(range(1, 300)), [900, 1, 1, 1, 2, 2, 800, 3], [7]])
def test_largest_shard_is_smallest_possible(spark, sizes):
    docs = spark.createDataFrame([(i, "a" * (n - 1) if n < 800 else str(i) * (n - 1)) for i, n in enumerate(sizes)],
                                 "doc_id long, text string")
    rows = docs.select(sharding.digest(F.col("text")).alias("d"), sharding.text_size(F.col("text")).alias("n")).collect()
    weights = collections.Counter()
    for r in rows:
        weights[r.d] += r.n
    got = collections.Counter()
    for r in sharding.assign_shards(docs, 6).collect():
        got[r.shard] += r.size
    assert max(got.values()) == smallest_capacity([weights[d] for d in sorted(weights)], 6)


def test_refined_summary_is_exact(spark, monkeypatch):
    monkeypatch.setattr(sharding, "SUMMARY", 8)
    monkeypatch.setattr(sharding, "FINER", 4)
    docs = common.table(spark, SF, "documents")
    weights = collections.Counter()
    for r in docs.select(sharding.digest(F.col("text")).alias("d"), sharding.text_size(F.col("text")).alias("n")).collect():
        weights[r.d] += r.n
    got = sharding.assign_shards(docs, 16).groupBy("shard").agg(F.sum("size").alias("n")).collect()
    assert max(r.n for r in got) == smallest_capacity([weights[d] for d in sorted(weights)], 16)
    assert min(r.n for r in got) > 0.9 * max(r.n for r in got)


def test_suffix_array_and_prefixes():
    rng = np.random.default_rng(1)
    for t in range(60):
        s = rng.integers(0, rng.integers(1, 6) + 1, rng.integers(1, 150)).astype(np.uint16)
        s = np.tile(s[:5], len(s))[:len(s)] if t % 3 == 0 else s
        sa = suffix_array.suffix_array(s)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: tuple(s[i:]))


def test_permuted_prefixes_against_a_plain_loop():
    rng = np.random.default_rng(2)
    for limit in (1, 7, 8, 9, 50):
        content = [bytes(rng.integers(0, 2, rng.integers(1, 90)).astype(np.uint8) * 255) for _ in range(9)]
        sizes = np.array([len(c) for c in content])
        data = np.frombuffer(b"\0".join(content), np.uint8)
        room = np.concatenate([np.append(np.arange(n, 0, -1), 0) for n in sizes])[:-1]
        sa = suffix_array.suffix_array(np.where(room == 0, 0, data.astype(np.uint16) + 1).astype(np.uint16))
        got = suffix_array.permuted_prefixes(data, room, sa, limit)
        for j, i in zip(sa[:-1], sa[1:]):
            a, b = data[i:i + room[i]], data[j:j + room[j]]
            n = min(len(a), len(b), limit)
            same = (a[:n] == b[:n])
            assert got[i] == (n if same.all() else same.argmin())
        assert got[sa[0]] == 0


@pytest.mark.parametrize("partitions", [1, 2])
def test_runs_of_equal_hash_are_told_apart_by_their_bytes(spark, partitions):
    """Two words whose hashes are equal for every odd base: the Thue-Morse string and its complement."""
    from tessera.llm import fm_index
    bits = [bin(k).count("1") % 2 for k in range(1024)]
    one, two = ("".join("ab"[b ^ flip] for b in bits) for flip in (0, 1))
    same = " ".join(["same"] * 12)
    docs = spark.createDataFrame([(1, f"{same} {one}"), (2, f"{same} {two}"), (3, f"{same} {two}")], "doc_id long, text string")
    got = {r.doc_id: r.n_removed for r in fm_index.dedup(docs.repartition(partitions)).collect()}
    assert got == {1: 0, 2: 0, 3: 13}


def test_hot_anchors_are_split_without_loss(spark, monkeypatch):
    from tessera.llm import repeats
    docs = common.table(spark, SF, "documents").filter("doc_id < 150")
    plain = collections.Counter(tuple(r)[:5] for r in suffix_array.dedup(docs).collect())
    monkeypatch.setattr(repeats, "HOT", 0)
    assert collections.Counter(tuple(r)[:5] for r in suffix_array.dedup(docs.repartition(4)).collect()) == plain


def test_anchors_of_many_run_bytes_are_split_in_few_batches(spark, monkeypatch):
    from tessera.llm import repeats
    rng = np.random.default_rng(3)

    def noise():
        return "".join(map(chr, rng.integers(97, 123, 70)))
    phrase = noise()
    docs = spark.createDataFrame([(i, noise() + phrase + noise()) for i in range(300)], "doc_id long, text string").repartition(2)
    plain = collections.Counter(tuple(r)[:5] for r in suffix_array.dedup(docs).collect())
    monkeypatch.setattr(repeats, "HOT", 5000)       # 300 runs of about 100 bytes, from two batches
    grain = repeats.Grain(False, 50, 20)
    told = repeats.shared_anchors(repeats.anchor_rows(repeats.row_key(docs), grain, 8), 8).collect()
    assert len(told) == 300 and all(r.hot for r in told)
    assert collections.Counter(tuple(r)[:5] for r in suffix_array.dedup(docs).collect()) == plain


def test_neighbours_recall(spark):
    rows = common.table(spark, SF, "embeddings").collect()
    ids, v = np.array([r.vec_id for r in rows]), np.array([r.embedding for r in rows], float)
    got = collections.defaultdict(dict)
    for r in QUERIES["op4_nearest_neighbours"](spark, SF).collect():
        got[r.query_id][r.vec_id] = r.score
    hit = total = 0
    for q in np.flatnonzero(ids % 20 == 0):
        score = v @ v[q]
        score[q] = -np.inf
        best = ids[np.lexsort((ids, -score))[:20]]
        hit, total = hit + len(set(best) & set(got[ids[q]])), total + 20
        assert all(abs(s - score[np.flatnonzero(ids == i)[0]]) < 1e-9 for i, s in got[ids[q]].items())
    assert hit / total >= 0.95


def test_neighbours_recall_when_a_query_searches_few_of_the_lists(spark, monkeypatch):
    from tessera.llm import ann
    monkeypatch.setattr(ann, "LIST_SIZE", 8)
    v = np.random.default_rng(7).normal(size=(4000, 24))
    table = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = collections.defaultdict(set)
    for r in ann.search(table, F.col("vec_id") % 20 == 0, 20).collect():
        got[r.query_id].add(r.vec_id)
    assert all(len(got[q]) == 20 for q in range(0, 4000, 20))
    score = v[::20] @ v.T
    score[np.arange(200), np.arange(0, 4000, 20)] = -np.inf
    best = np.argsort(-score, axis=1)[:, :20]
    assert np.mean([len(set(b) & got[20 * q]) / 20 for q, b in enumerate(best)]) >= 0.9


def test_distance_ratio_prunes_lists():
    from tessera.llm import ann
    rng = np.random.default_rng(8)
    c = np.repeat(rng.normal(size=(20, 8)) * 9, 10, axis=0) + rng.normal(size=(200, 8))
    x = c[::7] + rng.normal(size=(29, 8)) / 9
    graph = ann.centroid_graph(c)
    near = ann.nearest(x, c)
    width, ratio = ann.fitted(x, np.arange(29), [[j] for j in near], c, graph, ann.PROBES)
    ids, dist = ann.search_graph(x, c, graph, width)
    use = ann.searched(ids, dist, ratio, np.full(200, 50), 84)
    assert use.sum() < 29 * ann.PROBES / 2 and all(j in i[u] for j, i, u in zip(near, ids, use))
    few = ann.searched(ids, dist, ratio, np.full(200, 1), 84)       # small lists: enough of them are read
    assert (few.sum(axis=1) >= min(84, width)).all()


def grams_of(text):
    w = (text or "").lower().split()
    return w, [tuple(w[k:k + 5]) for k in range(len(w) - 4)]


def test_decontamination(spark):
    docs, items = common.table(spark, SF, "documents"), common.table(spark, SF, "benchmark")
    holders, parts = collections.defaultdict(set), {}
    for r in items.collect():
        w, g = grams_of(r.text)
        parts[r.item_id] = (len(g), collections.Counter(g))
        for x in g:
            holders[x].add(r.item_id)
    want = {}
    for r in docs.collect():
        _, g = grams_of(r.text)
        where = [i for i, x in enumerate(g) if x in holders]
        for item in {k for i in where for k in holders[g[i]]}:
            n, bag = parts[item]
            near = {s for i in where for s in range(max(0, i - n + 1), i + 1)}
            best = 0.0
            for s in near:
                own = collections.Counter(g[s:s + n])
                shared = sum((own & bag).values())
                best = max(best, shared / (sum(own.values()) + n - shared))
            if best >= 0.8:
                want[r.doc_id, item] = best
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.find_contamination(docs, items).collect()}
    assert want and got == want


def test_every_start_of_a_window_counts(spark):
    """An item A B, a text with B A: only a window at neither's own offset is similar."""
    a, b, x, y = ([f"{c}{k}" for k in range(n)] for c, n in (("a", 50), ("b", 50), ("x", 60), ("y", 60)))
    docs = spark.createDataFrame([(1, " ".join(x + b + a + y)), (2, " ".join(b + a)), (3, " ".join(x + b + y)),
                                  (4, " ".join(x + b[:40] + ["new"] + b[40:] + a + y)), (5, " ".join(b + a) + " z" * 300)],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(1, " ".join(a + b))], "item_id long, text string")
    got = {r.doc_id: (round(r.similarity, 2), r.start) for r in decontamination.find_contamination(docs, items).collect()}
    assert got[1] == (0.92, 60) and got[2] == (0.92, 0) and got[5] == (0.92, 0) and 3 not in got and got[4][0] >= 0.8


def test_starts_of_windows_against_a_plain_loop(spark):
    rng = np.random.default_rng(4)
    cases = []
    for k in range(200):
        size, m = int(rng.integers(1, 40)), int(rng.integers(1, 20))
        cases.append((k, size, m, sorted(rng.choice(size, rng.integers(1, size + 1), replace=False).tolist())))
    needed, starts = decontamination.window_starts(0.5)
    table = spark.createDataFrame(cases, "k int, _size int, _m int, _hits array<int>").withColumn("_needed", needed)
    got = {r.k: sorted(r.s) for r in table.filter(F.size("_hits") >= F.col("_needed")).select("k", starts.alias("s")).collect()}
    for k, size, m, hits in cases:
        w = min(size, m)
        want = [x for x in range(size - w + 1) if (s := sum(x <= h < x + w for h in hits)) and s / (m + w - s) >= 0.5 - 1e-9]
        assert got.get(k, []) == want


def test_radius_is_all_that_the_index_guarantees(spark):
    assert decontamination.RADIUS == 23
    empty = spark.createDataFrame([], "doc_id long, item_id long, text string")
    with pytest.raises(ValueError):
        decontamination.contaminated_windows(empty, empty, radius=decontamination.RADIUS + 1)


def test_short_items_are_found(spark):
    docs = spark.createDataFrame([(1, "The answer is  FORTY two today"), (2, "forty"), (3, "the answer"), (4, None), (5, "")],
                                 "doc_id long, text string")
    items = spark.createDataFrame([(1, "forty Two"), (2, "is forty two today"), (3, "forty"), (4, "answer the"), (5, "")],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id): (r.similarity, r.start, r.n_words) for r in decontamination.find_contamination(docs, items).collect()}
    assert got == {(1, 1): (1.0, 3, 2), (1, 2): (1.0, 2, 4), (1, 3): (1.0, 3, 1), (2, 3): (1.0, 0, 1)}
    assert sorted(r.doc_id for r in decontamination.drop_contaminated(docs, items).collect()) == [3, 4, 5]


def test_near_duplicates(spark):
    docs = common.table(spark, SF, "documents")
    prints = {}
    for r in docs.collect():
        w = (r.text or "").encode().lower().split()
        shingles = [b" ".join(w[k:k + 3]) for k in range(max(1, len(w) - 2))] if w else []
        h = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], np.uint64)
        prints[r.doc_id] = sum(1 << b for b in range(64) if 2 * int(((h >> np.uint64(b)) & np.uint64(1)).sum()) > len(h))
    ids = sorted(prints)
    value = np.array([prints[i] for i in ids], np.uint64)
    label = dict(zip(ids, ids))

    def find(x):
        while label[x] != x:
            x = label[x]
        return x
    for k, i in enumerate(ids):
        for j in np.flatnonzero(np.bitwise_count(value ^ value[k]) <= 3):
            a, b = sorted((find(i), find(ids[j])))
            label[b] = a
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash_dedup.near_duplicates(docs).collect()}
    assert got == {i: (f"{prints[i]:016x}", find(i)) for i in ids}
    assert simhash_dedup.keep_one(docs).count() == len({find(i) for i in ids})


def test_position_sets_meet_every_five_positions():
    from itertools import combinations
    sets = [set(s) for s in simhash_dedup.POSITION_SETS]
    assert all(any(s <= set(five) for s in sets) for five in combinations(range(8), 5))


def test_long_postings_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(simhash_dedup, "BLOCK", 4)
    base = 0x0123456789ABCDEF
    values = [base ^ (1 << b) for b in range(60)] + [base ^ (1 << b) ^ (1 << (b + 9) % 60) ^ 7 for b in range(20, 50)]
    prints = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "doc_id long, fingerprint long")
    got = {r.component_id for r in simhash_dedup.fingerprint_components(prints).collect()}
    label = list(range(len(values)))
    for _ in values:
        for a in range(len(values)):
            for b in range(len(values)):
                if (values[a] ^ values[b]).bit_count() <= 3:
                    label[a] = label[b] = min(label[a], label[b])
    assert got == set(label)


def test_components(spark):
    edges = [(1, 2), (2, 3), (9, 8), (8, 7), (7, 3), (20, 21), (5, 5)]
    got = dict(connected_components(spark.createDataFrame(edges, "a long, b long")).collect())
    assert got == {2: 1, 3: 1, 7: 1, 8: 1, 9: 1, 21: 20}


def accuracy(spark, score, label):
    docs, labels = common.table(spark, "/root/testdata/sf0.1", "documents"), common.table(spark, "/root/testdata/sf0.1", "labels")
    truth = {r.doc_id: r[label] for r in labels.collect()}
    rows = [(truth[r.doc_id], r.predicted) for r in score(docs, labels).collect() if r.held_out and r.doc_id in truth]
    hit = sum(a == b == 1 for a, b in rows)
    return 2 * hit / (sum(a for a, _ in rows) + sum(b for _, b in rows)), np.mean([a == b for a, b in rows])


def test_quality_on_held_out_labels(spark):
    _, right = accuracy(spark, quality.score_documents, "quality")
    assert right > 0.97


def test_toxicity_on_held_out_labels(spark):
    f1, right = accuracy(spark, toxicity.score_documents, "toxic")
    assert f1 > 0.9 and right > 0.97


def test_spans_are_byte_offsets():
    import pyarrow as pa
    model = np.zeros(toxicity.BUCKETS + toxicity.EXTRA, np.float32)
    texts = pa.array(["Schön, du idiot! wörtlich", None, ""])
    bucket = next(iter(toxicity.chains(texts)))[2]
    model[bucket[0, 2]] = 9
    model[toxicity.BUCKETS] = -4
    _, spans = toxicity.tag_texts(texts, model)
    cut = [texts[0].as_py().encode()[s["start"]:s["end"]] for s in spans[0]]
    assert cut == [b"idiot"] and spans[1:] == [[], []]


def test_suffix_classes_by_words_of_symbols():
    # several symbols at a time, grams as slices: the same as symbol by symbol, also with NUL bytes and one symbol
    import numpy as np
    from tessera.llm import common, suffix_array as sx

    rng = np.random.default_rng(5)
    for t in range(60):
        kinds = (1, 2, 4)[t % 3]
        content = list(dict.fromkeys(bytes(rng.integers(0, kinds, rng.integers(1, 40)).astype(np.uint8)) for _ in range(6)))
        least = rng.integers(0, 4, len(content))
        window = int(rng.choice([1, 3, 8, 9, 17]))
        held = {}
        for c, d in zip(content, least.tolist()):
            for at in range(len(c) - window + 1):
                held[c[at:at + window]] = min(d, held.get(c[at:at + window], d))
        want = {(k, at) for k, c in enumerate(content) for at in range(len(c) - window + 1)
                if held[c[at:at + window]] < least[k]}
        run, at = sx.smallest_holder(content, least, window)
        assert sorted(zip(run.tolist(), at.tolist())) == sorted(want)
        sums = common.prefix_hash(np.frombuffer(b"".join(content), np.uint8))
        at = np.arange(len(sums) - window)
        assert (common.gram_hash(sums, window) == common.span_hash(sums, at, at + window)).all()
        wide = rng.integers(0, 100_000, 30)          # symbols of more than 16 bits
        assert sx.suffix_array(wide).tolist() == sorted(range(30), key=lambda i: wide[i:].tolist())
