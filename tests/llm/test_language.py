"""Language identification: held-out accuracy, solver, edges."""

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from tessera.llm import langid
from tessera.llm.common import table
from tessera.llm.queries import QUERIES

from .conftest import rows

SF = "/root/testdata/sf0.1"


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in table(spark, SF, "documents").select("doc_id", "lang").collect()}
    got = QUERIES["op12_language_id"](spark, SF).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert 0.2 < len(held) / len(got) < 0.3
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.99
    assert all(0 <= r.score <= 1 for r in got)
    wrong = [r.score for r in held if r.lang_pred != truth[r.doc_id]]
    assert not wrong or np.mean(wrong) < np.mean([r.score for r in held])


def test_separating_machine_reaches_the_optimum():
    rng = np.random.default_rng(5)
    x = rng.normal(size=(60, 6))
    sign = np.where(x[:, 0] + 0.5 * rng.normal(size=60) > 0, 1.0, -1.0)
    old = langid.EPOCHS
    langid.EPOCHS = 2000
    try:
        w = langid.separate([(np.arange(6), v) for v in x], sign)
    finally:
        langid.EPOCHS = old
    wide = np.hstack([x, np.ones((60, 1))])
    own = np.append(w[:6], w[-1])

    def loss(v):
        return v @ v / 2 + langid.COST * (np.maximum(0, 1 - sign * (wide @ v)) ** 2).sum()
    best = own.copy()
    for _ in range(4000):
        gap = np.maximum(0, 1 - sign * (wide @ best))
        best -= 1e-3 * (best - 2 * langid.COST * wide.T @ (gap * sign))
    assert loss(own) <= loss(best) * (1 + 1e-4)


def test_grams_against_a_plain_loop():
    texts = ["ab, c!", "", "ä  ßx", "...", "q"]
    column = pa.array(texts)
    want = []
    for t in texts:
        b, squeezed = t.encode(), [0x20]
        for c in [*b, 0x20]:
            c = c if 97 <= c <= 122 or c >= 128 else 0x20
            if c != 0x20 or squeezed[-1] != 0x20:
                squeezed.append(c)
        want.append(sum(max(0, len(squeezed) - n + 1) for n in langid.GRAMS))
    assert [int(c.sum()) for _, c in langid.text_features(column)] == want
    whole = langid.text_features(column)
    for k, t in enumerate(texts):
        (i, c), = langid.text_features(pa.array([t]))
        assert i.tolist() == whole[k][0].tolist() and c.tolist() == whole[k][1].tolist()


def test_several_languages_of_a_family_vote(spark):
    words = {"en": "the of and with this", "de": "der und nicht mit eine", "nl": "het een van niet deze", "sv": "och att det som inte",
             "fr": "les des une est pour", "xx": "qzq zqz qqz zzq qzz"}
    table = [(k * 100 + i, " ".join(w.split()[i % 5:] + w.split()[:i % 5]), lang) for k, (lang, w) in enumerate(words.items()) for i in range(20)]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string")
    model = langid.train(docs)
    assert model.families == ["germanic", "romance", "xx"] and len(model.pairs) == 6
    got = {r.doc_id: r.lang_pred for r in langid.predict(docs, model).collect()}
    assert all(got[i] == lang for i, _, lang in table)


def test_edge_cases(spark, edge_docs, no_docs):
    got = langid.identify_languages(edge_docs).collect()
    assert sorted(str(r.doc_id) for r in got) == sorted(str(r[0]) for r in rows())
    for r in got:
        text = {x[1] for x in rows() if x[0] == r.doc_id}
        if text <= {None, "", "   \n\t "}:
            assert (r.lang_pred, r.score) == ("und", 0.0)
    assert {r.lang_pred for r in got} == {"en", "und"}
    assert langid.identify_languages(no_docs).count() == 0
    unlabelled = edge_docs.withColumn("lang", F.lit(None).cast("string"))
    assert {(r.lang_pred, r.score) for r in langid.identify_languages(unlabelled).collect()} == {("und", 0.0)}
    assert langid.identify_languages(unlabelled.withColumn("lang", F.lit(""))).filter("lang_pred <> 'und'").count() == 0


def test_rows_of_a_language_are_bounded_and_repeated_ones_count_once(spark):
    table = [(1, "same text", "en")] * 50 + [(i, f"text number {i}", "en") for i in range(2, 40)] + [(99, "autre texte", "fr")]
    docs = spark.createDataFrame(table, "doc_id long, text string, lang string").repartition(4)
    every = langid.training_rows(docs, "lang", F.lit(True), 1000).collect()
    assert sum(r.lang == "en" for r in every) == 39
    some = langid.training_rows(docs, "lang", F.lit(True), 10).collect()
    assert sum(r.lang == "en" for r in some) == 10 and sum(r.lang == "fr" for r in some) == 1
    assert {(r.lang, r.key) for r in some} <= {(r.lang, r.key) for r in every}
