"""Spelling variants against brute force over all pairs of words."""

import collections
import re
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tessera.llm import spelling
from tessera.llm.common import table
from tessera.llm.queries import QUERIES

from .conftest import rows


def one_edit(a, b):
    """Whether one inserted, deleted or replaced code point turns a into b."""
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a != b and (a[k + 1:] == b[k + 1:] if len(a) == len(b) else a[k:] == b[k + 1:])


def brute(table):
    count = collections.Counter()
    for i, text in table:
        for w in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            w = "".join(c.lower() if "A" <= c <= "Z" else c for c in w)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            count[w[:h % len(w)] + w[h % len(w) + 1:] if h % 31 == 0 else w] += 1
    words = {w: n for w, n in count.items() if len(w) >= 7 and n >= 2}
    near = collections.defaultdict(list)
    by_length = collections.defaultdict(list)
    for w in words:
        by_length[len(w)].append(w)
    for w in words:
        near[w] = [x for k in (-1, 0, 1) for x in by_length[len(w) + k] if one_edit(w, x)]
    form = {w: x for w in words if near[w] for x in [min(near[w], key=lambda x: (-words[x], x))] if words[x] >= 10 * words[w]}

    def root(w):
        return root(form[w]) if w in form else w
    return {(w, form.get(w), root(w), n, len(near[w]), words[form[w]] if w in form else None) for w, n in words.items()}


def test_query_matches_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    own = [(r.doc_id, r.text) for r in table(spark, sf, "documents").collect()]
    got = [tuple(r) for r in QUERIES["op13_spelling_variants"](spark, sf).collect()]
    assert len(got) == len(set(got)) and set(got) == brute(own) and sum(g[4] for g in got) > 100


def test_edge_cases(spark, edge_docs, no_docs):
    words = ["grammar"] * 400 + ["grammer"] * 30 + ["grammers"] * 2 + ["Grammar"] * 5 + ["éèàçßÿ×"] * 3 + ["short"] * 9
    more = [(None, " ".join(words)), (50, " ".join(words)), (50, " ".join(words)), (51, "x" * 300 + " " + "x" * 301), (52, None)]
    docs = edge_docs.select("doc_id", "text", "size", "_key").unionByName(
        spark.createDataFrame([(i, t, "9", "k") for i, t in more], "doc_id long, text string, size string, _key string"))
    got = {tuple(r) for r in spelling.spelling_variants(docs).collect()}
    assert got == brute([(r[0], r[1]) for r in rows()] + more)
    assert {g[2] for g in got if g[0] == "grammers"} == {"grammar"}
    assert spelling.spelling_variants(no_docs).count() == 0


def test_chains_and_ties(spark):
    table = [("aaaaaaa", 100000), ("aaaaaab", 10000), ("aaaaabb", 1000), ("aaaabbb", 100), ("aaabbbb", 10), ("aabbbbb", 1),
             ("zzzzzzz", 2), ("zzzzzzy", 20), ("zzzzzzx", 20), ("yzzzzzz", 20)]
    got = {r.word: (r.form, r.root, r.n_near, r.form_n) for r in spelling.group_variants(
        spark.createDataFrame(table, "word string, n long")).collect()}
    assert got["aabbbbb"] == ("aaabbbb", "aaaaaaa", 1, 10)
    assert got["zzzzzzz"] == ("yzzzzzz", "yzzzzzz", 3, 20) and got["aaaaaaa"] == (None, "aaaaaaa", 1, None)


@pytest.mark.parametrize("threshold", [4000, 3])
def test_pairs_with_hot_keys(spark, threshold):
    """Few letters, so that keys are shared by very many words; a low threshold deals all of them to grids."""
    rng = np.random.default_rng(3)
    words = sorted({"".join(rng.choice(list("aä"), rng.integers(7, 11))) for _ in range(400)})
    got = [(r.s, r.t) for r in spelling.near_pairs(spark.createDataFrame([(w, 1) for w in words], "word string, n long"),
                                                   threshold=threshold).collect()]
    want = {(a, b) for a in words for b in words if one_edit(a, b) and (len(a), a) < (len(b), b)}
    assert len(got) == len(set(got)) and set(got) == want


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("aZé÷ ×ÿĀ-¿"), max_size=30), min_size=1, max_size=4))
def test_runs_of_letters(texts):
    data = np.frombuffer("".join(texts).encode(), np.uint8)
    off = np.cumsum([0, *(len(t.encode()) for t in texts)])
    starts, ends, doc = spelling.letter_runs(spelling.LOWER[data] if len(data) else data, off)
    got = [(int(d), data[s:e].tobytes().decode()) for s, e, d in zip(starts, ends, doc)]
    assert got == [(d, m) for d, t in enumerate(texts) for m in re.findall("[A-Za-zÀ-ÿ]+", t)]
