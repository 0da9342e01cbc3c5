"""Cross-tokenizer alignment against whole-text encoding and a plain loop."""

import collections
import hashlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import token_alignment as ta
from tessera.llm.common import table
from tessera.llm.queries import QUERIES

from .conftest import DOCS, rows

TK = ta.Tokenizers(ta.tokenizer_path("byte_bpe_50k.json"), ta.tokenizer_path("piece_bpe_32k.model"))


def groups_of(text):
    """Groups of a whole text, without cutting it."""
    v, x = TK.vocabulary, (" " + (text or "")).encode()
    a, b = TK.encode([x])[0] if text else ([], [])
    if not text or ta.spelled(v.a, a) != x or ta.spelled(v.b, b) != x:
        return []
    end_a, end_b = (np.cumsum([len(t[i]) for i in ids]).tolist() for t, ids in ((v.a, a), (v.b, b)))
    out, i, j = [], 0, 0
    for stop in sorted(set(end_a) & set(end_b)):
        k, m = end_a.index(stop, i) + 1, end_b.index(stop, j) + 1
        out.append((a[i:k], b[j:m]))
        i, j = k, m
    return out


def brute(table):
    own = [(i, groups_of(t)) for i, t in table]
    count = collections.Counter()
    for _, groups in own:
        count.update({(x, y) for a, b in groups for x in a for y in b})
    most = collections.Counter()
    for (x, _), n in count.items():
        most[x] = max(most[x], n)
    out = collections.Counter()
    for i, groups in own:
        links = [(x, y) for a, b in groups for x in a for y in b]
        written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
        out[i, sum(len(a) for a, _ in groups), sum(len(b) for _, b in groups), len(groups), len(links),
            sum(count[x] == most[x[0]] for x in links), sum(count[x] for x in links),
            hashlib.sha256(written.encode()).hexdigest() if groups else ""] += 1
    return out


def test_query_matches_whole_text_encoding(spark):
    sf = "/root/testdata/sf0.001"
    own = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    assert collections.Counter(tuple(r) for r in QUERIES["op11_token_alignment"](spark, sf).collect()) == brute(own)


TEXTS = ["<|endoftext|> and </s> <unk> <s>", " leading", "trailing  ", "a  b", "x▁y", "tab\tand\nlines \n\n  end", "日本語 テキスト",
         "don't 'tis 12 345 ½ é́   nbsp　wide", "a\u0000b", "🙂 smile 🙂🙂", "́ mark", "aaaaaaaa" * 40, "word " * 300, "!!!!!!!???" * 9]


def test_edge_cases(spark, edge_docs, no_docs):
    more = [(100 + i, t) for i, t in enumerate(TEXTS)] + [(100, TEXTS[0])]
    every = [(r[0], r[1]) for r in rows()] + more
    docs = edge_docs.unionByName(spark.createDataFrame([(i, t, *[None] * 9) for i, t in more], DOCS))
    assert collections.Counter(tuple(r) for r in ta.align_tokenizers(docs).collect()) == brute(every)
    assert ta.align_tokenizers(no_docs).count() == 0


def test_batches_and_hash_ranges_do_not_matter(spark, monkeypatch):
    docs = table(spark, "/root/testdata/sf0.001", "documents")
    plain = collections.Counter(tuple(r) for r in ta.align_tokenizers(docs).collect())
    for name, value in (("BATCH_BYTES", 20_000), ("SEGMENT_BYTES", 64), ("BLOCK", 8), ("PART_BYTES", 10_000)):
        monkeypatch.setattr(ta, name, value)
    assert collections.Counter(tuple(r) for r in ta.align_tokenizers(docs.repartition(5)).collect()) == plain


def test_identity_map_has_the_same_bytes():
    v = TK.vocabulary
    known = np.flatnonzero(v.identity >= 0)
    assert len(known) > 5000 and all(v.a[i] == v.b[v.identity[i]] for i in known)
    assert v.cuttable and v.identity[50256] == -1


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("aeR's ’é.\n\t ́　日✓19<|>▁"), max_size=40))
def test_cut_texts_are_encoded_as_whole_ones(text):
    out = ta.align_batch(TK, pa.array([1]), pa.array([text]))
    groups = groups_of(text)
    written = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in groups)
    got = {k: v[0] for k, v in out.documents.to_pydict().items()}
    assert got["n_groups"] == len(groups)
    assert got["groups_sha256"] == (hashlib.sha256(written.encode()).hexdigest() if groups else "")


def test_absent_file_raises(spark, no_docs):
    with pytest.raises(Exception):
        ta.align_tokenizers(no_docs, path_a="/nowhere.json")
