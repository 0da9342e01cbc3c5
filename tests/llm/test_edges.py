"""Nulls, empty and very long texts, ties, repeated rows, empty tables, and
extra columns with clashing names, for every operator and stage."""

import collections
import hashlib

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import (ann, decontamination, fm_index, mixing, quality, sharding, simhash_dedup, suffix_array,
                         toxicity, url_filter)

from .conftest import DOCS, rows


def count(values):
    return collections.Counter(values)


def test_sharding(edge_docs, no_docs):
    got = sharding.assign_shards(edge_docs, 4).collect()
    assert count(r.doc_id for r in got) == count(r[0] for r in rows())
    assert count(r.size for r in got) == count(len((r[1] or "").encode()) + 1 for r in rows())
    of = collections.defaultdict(set)
    for r in got:
        of[r.text_crc32].add(r.shard)
    assert all(len(s) == 1 for s in of.values())
    for s in {r.shard for r in got}:
        assert sorted(r.slot for r in got if r.shard == s) == list(range(sum(r.shard == s for r in got)))
    assert sharding.assign_shards(no_docs).count() == 0


def brute_windows(table, window, split):
    order = sorted(table, key=lambda r: (r[0] is None, r[0] or 0))
    first, out = {}, []
    for i, text, *_ in order:
        seq = split(text or "")
        key = float("inf") if i is None else i
        gone = [False] * len(seq)
        for p in range(len(seq) - window + 1):
            w = tuple(seq[p:p + window])
            if first.setdefault(w, key) < key:
                gone[p:p + window] = [True] * window
        out.append((i, seq, gone))
    return out


def test_substrings(edge_docs, no_docs):
    got = suffix_array.dedup(edge_docs)
    want = []
    for i, seq, gone in brute_windows(rows(), 50, lambda t: t.encode()):
        kept = bytes(b for b, g in zip(seq, gone) if not g)
        spans = sum(g and (p == 0 or not gone[p - 1]) for p, g in enumerate(gone))
        want.append((i, len(seq), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    assert count(tuple(r)[:5] for r in got.collect()) == count(want)
    assert suffix_array.dedup(no_docs).count() == 0


def test_passages(edge_docs, no_docs):
    got = fm_index.dedup(edge_docs)
    want = []
    for i, seq, gone in brute_windows(rows(), 13, lambda t: t.encode().split()):
        kept = b" ".join(w for w, g in zip(seq, gone) if not g)
        want.append((i, len(seq), sum(gone), hashlib.sha256(kept).hexdigest()))
    assert count(tuple(r)[:4] for r in got.collect()) == count(want)
    assert fm_index.dedup(no_docs).count() == 0


def test_neighbours(spark):
    nan, inf = float("nan"), float("inf")
    vectors = [(0, [1.0, 0.0, 2.0]), (0, [1.0, 0.0, 2.0]), (20, [0.0, 1.0, 1.0]), (1, [1.0, 1.0, 1.0]),
               (2, [1.0, 1.0, 1.0]), (3, [0.0, 0.0, 0.0]), (4, None), (5, [nan, 1.0, 1.0]), (6, [inf, 0.0, 0.0]),
               (7, [1.0, None, 1.0]), (None, [1.0, 1.0, 1.0]), (8, [1.0, 1.0]), (40, [0.0, 0.0, 0.0]), (9, [-3.0, 5.0, 1.0])]
    table = spark.createDataFrame([(i, v, "x") for i, v in vectors], "vec_id long, embedding array<double>, score string")
    got = {(r.query_id, r.rank): (r.vec_id, r.score) for r in ann.search(table, F.col("vec_id") % 20 == 0, 3).collect()}
    assert got == {(0, 1): (1, 3.0), (0, 2): (2, 3.0), (0, 3): (20, 2.0),
                   (20, 1): (9, 6.0), (20, 2): (0, 2.0), (20, 3): (1, 2.0)}
    assert ann.search(table.limit(0), F.lit(True)).count() == 0


def test_decontamination(spark, edge_docs, no_docs):
    items = spark.createDataFrame([(1, BASE_ITEM), (2, "short item"), (3, ""), (4, None), (None, BASE_ITEM), (5, BASE_ITEM)],
                                  "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.similarity for r in decontamination.find_contamination(edge_docs, items).collect()}
    assert got == {(i, k): 1.0 for i in (1, 2, 3, 4, None) for k in (1, None, 5)}
    kept = decontamination.drop_contaminated(edge_docs, items)
    assert kept.columns == DOCS.names
    assert count(r.doc_id for r in kept.collect()) == count(
        r[0] for r in rows() if not (r[1] or "").lower().startswith("w0x0 w1x1"))
    assert decontamination.find_contamination(no_docs, items).count() == 0
    assert decontamination.find_contamination(edge_docs, items.limit(0)).count() == 0


BASE_ITEM = " ".join(f"w{i % 37}x{i % 11}" for i in range(10, 60))


def test_near_duplicates(edge_docs, no_docs):
    got = simhash_dedup.near_duplicates(edge_docs).collect()
    of = collections.defaultdict(set)
    for r in got:
        of[r.doc_id].add((r.fingerprint, r.component_id))
    assert len(got) == len(rows())
    assert of[1] == of[2] == of[3] and {c for _, c in of[1]} == {1}
    assert of[5] == of[6] == of[7] and {f for f, _ in of[5]} == {"0" * 16}
    assert len(of[12]) == 1 and len(of[13]) == 2
    kept = simhash_dedup.keep_one(edge_docs)
    assert kept.columns == DOCS.names
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len({(f, c) for _, c, f in ((r.doc_id, r.component_id, r.component_id) for r in got
                                                   if r.component_id is not None)} | {0}) + (ids.count(13) - 1)
    assert simhash_dedup.near_duplicates(no_docs).count() == 0
    assert simhash_dedup.keep_one(no_docs).count() == 0


def test_urls(spark):
    table = [(1, None), (2, ""), (3, "no scheme"), (4, "http://A.Net/x?y#z"), (5, "http://example.net/en/1"),
             (5, "http://example.net/en/1"), (6, "http://net"), (7, "x://example.com/de/?a"), (8, "x://notexample.com/de/"),
             (9, "http://u.org/fr/a://b"), (None, "http://fr.org?/fr/"), (10, "http://example.net/ens/")]
    pages = spark.createDataFrame([(i, u, "h") for i, u in table], "page_id long, url string, host string")
    got = collections.defaultdict(list)
    for r in url_filter.judge_urls(pages).collect():
        got[r.page_id].append((r.host, r.path, r.rule, r.verdict if r.rule else None))
    assert got[1] == got[2] == got[3] == [("", "", None, None)]
    assert got[4] == [("a.net", "/x", "net/", "block")]
    assert got[5] == [("example.net", "/en/1", "example.net/en/", "allow")] * 2
    assert got[6] == [("net", "", None, None)]
    assert got[7] == [("example.com", "/de/", "example.com/de/", "block")]
    assert got[8] == [("notexample.com", "/de/", None, None)]
    assert got[9] == [("u.org", "/fr/a://b", "org/fr/", "allow")]
    assert got[None] == [("fr.org", "", None, None)]
    assert got[10] == [("example.net", "/ens/", "net/", "block")]
    assert url_filter.judge_urls(pages.limit(0)).count() == 0


def test_mixing(edge_docs, no_docs):
    got = mixing.mix_documents(edge_docs).collect()
    assert count(r.doc_id for r in got) == count(r[0] for r in rows())
    assert all(0 <= r.taken <= 2 * r.size for r in got)
    sizes = collections.Counter()
    for r in rows():
        sizes[r[3]] += len((r[1] or "").split())
    targets = {r.target for r in got}
    assert abs(sum(targets) - 1.5 * sum(sizes.values())) < 1e-6 or max(targets) <= 2 * max(sizes.values())
    mixed = mixing.mix_rows(edge_docs)
    assert mixed.columns == DOCS.names
    assert sum(len((r.text or "").split()) for r in mixed.collect()) == sum(r.taken for r in got)
    assert mixing.mix_documents(no_docs).count() == 0
    assert mixing.mix_rows(no_docs).count() == 0


@pytest.mark.parametrize("score", [quality.score_documents, toxicity.score_documents])
def test_scores(edge_docs, no_docs, labels, score):
    got = score(edge_docs, labels).collect()
    assert count(r.doc_id for r in got) == count(r[0] for r in rows())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) and r.held_out is not None for r in got)
    same = collections.defaultdict(set)
    for r in got:
        same[r.doc_id].add(r.score)
    assert same[5] == same[6] == same[7] and same[1] == same[2]
    assert score(no_docs, labels).count() == 0
    assert all(r.score == 0.5 for r in score(edge_docs, labels.limit(0)).collect())


def test_quality_stage_keeps_rows_as_they_are(edge_docs, no_docs, labels):
    kept = quality.keep_good(edge_docs, labels, 0.0)
    assert kept.columns == DOCS.names and count(map(tuple, kept.collect())) == count(rows())
    assert quality.keep_good(no_docs, labels).count() == 0


def test_stages(spark, edge_docs, no_docs, labels, tmp_path):
    labels.write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, BASE_ITEM)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for docs, name in ((edge_docs, "some"), (no_docs, "none")):
        for k, (_, stage) in enumerate(corpus_pipeline.STAGES):
            out = stage(spark, docs, str(tmp_path))
            if k < len(corpus_pipeline.STAGES) - 1:
                assert out.columns == DOCS.names
            out.write.parquet(f"{tmp_path}/{name}{k}.parquet")
            docs = spark.read.parquet(f"{tmp_path}/{name}{k}.parquet")
        assert (docs.count() == 0) == (name == "none")
