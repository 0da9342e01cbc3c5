"""Language identification in two steps: family first, then pairs of languages.

Features are the 2-, 3- and 4-byte grams of the lower-cased text, in which
everything but letters is one space, hashed to ``BUCKETS`` places; a feature's
value is its share of the text's grams. A multinomial model over those grams
predicts the language family (``FAMILIES``; a language not listed there is a
family of its own). Within the family every two languages are separated by a
linear support vector machine of their own (squared hinge loss, dual
coordinate descent), and the language with most votes wins; ties go to the
larger sum of margins, then to the smaller name. All models are linear in
the grams, so a text is scored in one pass over its bytes.

At most ``TRAIN_ROWS`` different rows of each language are learned, the first
by a seeded hash of id and text; a row's features have at most ``BUCKETS``
numbers however long the text is. The grams of a family are counted by an
aggregation, each pair of languages is trained in a task of its own, and only
the models, whose size is set by the number of languages and ``BUCKETS``,
reach the driver and, from there, every task.

Every row gets a prediction. Null texts and texts without a letter get ``und``
and score 0; so does every text where nothing could be learned. Rows with null
or empty ``lang`` or with null text or without a letter are not learned, repeated
rows once. A null ``doc_id`` is in no held-out fold. An empty table gives an
empty result. Only ``doc_id`` and ``text`` (and the label) are read, so other
columns cannot clash.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from tessera.llm.common import checkpointed, maybe_broadcast, small_batches, text_slices
from tessera.llm.quality import fold

BUCKETS = 1 << 15
GRAMS = (2, 3, 4)
TRAIN_ROWS = 600
EPOCHS, COST, SCALE = 30, 1.0, 20.0
SMOOTHING = 0.5
SEED = 12
UNKNOWN = "und"

# Language codes of ISO 639-1 and the branch each belongs to.
FAMILIES = {
    **dict.fromkeys("en de nl af sv da no nb nn is fo fy lb yi".split(), "germanic"),
    **dict.fromkeys("fr es pt it ro ca gl oc rm wa la".split(), "romance"),
    **dict.fromkeys("ru uk be pl cs sk bg mk sr hr bs sl".split(), "slavic"),
    **dict.fromkeys("ga gd cy br gv kw".split(), "celtic"),
    **dict.fromkeys("lt lv".split(), "baltic"),
    **dict.fromkeys("fi et hu se".split(), "uralic"),
    **dict.fromkeys("tr az kk ky uz tk tt ug".split(), "turkic"),
    **dict.fromkeys("hi ur bn pa gu mr ne or as si sa sd".split(), "indic"),
    **dict.fromkeys("fa ps ku tg".split(), "iranian"),
    **dict.fromkeys("ar he am mt ti".split(), "semitic"),
    **dict.fromkeys("ta te kn ml".split(), "dravidian"),
    **dict.fromkeys("id ms tl jv su mg mi".split(), "austronesian"),
    **dict.fromkeys("sw zu xh sn rw st".split(), "bantu"),
}

_LETTER = np.zeros(256, bool)
_LETTER[ord("a"):ord("z") + 1] = True
_LETTER[0x80:] = True


def family_of(lang: str) -> str:
    return FAMILIES.get(lang, lang)


def gram_buckets(data: np.ndarray, off: np.ndarray):
    """Yield ``(buckets, text index)``, one order of grams at a time, of a slice
    of lower-cased texts. Runs of other characters, and the borders of a text,
    count as one space."""
    n = len(off) - 1
    size = np.diff(off) + 2                       # a space before and behind every text
    stop = np.cumsum(size)
    wide = np.full(int(stop[-1]) if n else 0, 0x20, np.uint8)
    doc = np.repeat(np.arange(n), size)
    inside = np.ones(len(wide), bool)
    inside[stop - size] = inside[stop - 1] = False
    wide[inside] = np.where(_LETTER[data], data, 0x20)
    space = wide == 0x20
    keep = ~space
    if len(wide):
        keep[0] = True
        keep[1:] |= ~space[:-1] | (doc[1:] != doc[:-1])
    wide, doc = wide[keep].astype(np.uint64), doc[keep]
    packed = wide
    for k in range(1, max(GRAMS)):
        if len(packed) < 2:
            return
        packed = packed[:-1] | (wide[k:] << np.uint64(8 * k))
        if k + 1 not in GRAMS:
            continue
        whole = doc[k:] == doc[:len(doc) - k]
        h = (packed[whole] + np.uint64(k << 56)) * np.uint64(0x9E3779B97F4A7C15)
        yield (h >> np.uint64(64 - BUCKETS.bit_length() + 1)).astype(np.int64), doc[:len(doc) - k][whole]


def text_features(column: pa.Array) -> list[tuple[np.ndarray, np.ndarray]]:
    """``(buckets, counts)`` of every text of a lower-cased column."""
    out = []
    for i, j, data, off in text_slices(column):
        parts = list(gram_buckets(data, off))
        code = np.concatenate([np.zeros(0, np.int64), *(d * BUCKETS + b for b, d in parts)])
        pair, count = np.unique(code, return_counts=True)
        cut = np.searchsorted(pair, np.arange(1, j - i) * BUCKETS)
        out += zip(np.split((pair % BUCKETS).astype(np.int32), cut), np.split(count, cut))
    return out


def separate(rows: list[tuple[np.ndarray, np.ndarray]], sign: np.ndarray) -> np.ndarray:
    """Weights (the last is the bias) of the linear support vector machine with
    squared hinge loss that separates sparse rows ``(buckets, values)``: dual
    coordinate descent in a fixed order of seeded shuffles."""
    w, alpha = np.zeros(BUCKETS + 1), np.zeros(len(rows))
    rows = [(np.append(i, BUCKETS), np.append(v, 1.0)) for i, v in rows]
    norm = np.array([v @ v for _, v in rows]) + 0.5 / COST
    order = np.random.default_rng(SEED)
    for _ in range(EPOCHS):
        moved = 0.0
        for k in order.permutation(len(rows)):
            i, v = rows[k]
            slope = sign[k] * (w[i] @ v) - 1 + alpha[k] / (2 * COST)
            step = max(alpha[k] - slope / norm[k], 0.0) - alpha[k]
            if step:
                alpha[k] += step
                w[i] += step * sign[k] * v
                moved = max(moved, abs(step))
        if moved < 1e-4:
            break
    return w


@dataclass
class Model:
    """Families and their languages, and one column of gram weights for each
    family and for each pair of languages of one family."""

    families: list[str]
    languages: list[list[str]]            # of each family
    pairs: list[tuple[int, int, int]]     # family, first and second language in it
    weights: np.ndarray                   # BUCKETS x (families + pairs)
    bias: np.ndarray


def has_letter(text: Column) -> Column:
    return F.coalesce(text.rlike(r"\p{L}"), F.lit(False))


def training_rows(docs: DataFrame, label: str, keep: Column, limit: int) -> DataFrame:
    """``(lang, key, text)``: lower-cased texts of the first ``limit`` different
    rows of each language by a seeded hash."""
    text = F.col("text").cast("string")
    rows = docs.filter(keep & F.col(label).isNotNull() & (F.col(label) != "") & has_letter(text)).select(
        F.col(label).alias("lang"), F.xxhash64(F.lit(SEED), "doc_id", text).alias("key"), text.alias("text"))
    first = Window.partitionBy("lang").orderBy("key")
    chosen = checkpointed(rows.select("lang", "key").distinct().withColumn("_place", F.row_number().over(first))
                          .filter(F.col("_place") <= limit).select("lang", "key"))
    return (rows.join(maybe_broadcast(chosen), ["lang", "key"], "left_semi")
            .groupBy("lang", "key").agg(F.first("text").alias("text"))
            .select("lang", "key", F.lower("text").alias("text")))


def feature_rows(rows: DataFrame) -> DataFrame:
    """``(lang, key, buckets, counts, total)`` of :func:`training_rows`."""
    def run(batches):
        for b in batches:
            found = text_features(b.column(2))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array([i for i, _ in found], pa.list_(pa.int32())),
                 pa.array([c for _, c in found], pa.list_(pa.int64())), pa.array([int(c.sum()) for _, c in found], pa.int64())],
                ["lang", "key", "buckets", "counts", "total"])

    return rows.mapInArrow(run, "lang string, key long, buckets array<int>, counts array<long>, total long")


def train(docs: DataFrame, label: str = "lang", keep: Column | None = None, limit: int = TRAIN_ROWS) -> Model:
    """The model learned from rows with a label; ``keep`` selects among them."""
    small_batches(docs.sparkSession)
    keep = F.lit(True) if keep is None else keep
    rows = checkpointed(feature_rows(training_rows(docs, label, keep, limit)))
    names = sorted(r[0] for r in rows.select("lang").distinct().collect())
    families = sorted({family_of(x) for x in names})
    languages = [[x for x in names if family_of(x) == f] for f in families]
    pairs = [(f, a, b) for f, own in enumerate(languages) for a in range(len(own)) for b in range(a + 1, len(own))]
    weights = np.zeros((BUCKETS, len(families) + len(pairs)), np.float32)
    bias = np.zeros(len(families) + len(pairs), np.float32)

    # families: smoothed log shares of their grams, every row weighing the same
    place = F.create_map(*[F.lit(v) for x in names for v in (x, families.index(family_of(x)))]) if names else None
    if len(families) > 1:
        shares = rows.filter("total > 0").select(
            place[F.col("lang")].alias("family"), "total", F.explode(F.arrays_zip("buckets", "counts")).alias("g"))
        sums = shares.groupBy("family", F.col("g.buckets").alias("bucket")).agg(
            F.sum(F.col("g.counts") / F.col("total")).alias("share"))
        mass = np.full((BUCKETS, len(families)), SMOOTHING / BUCKETS)
        for r in sums.collect():
            mass[r.bucket, r.family] += r.share
        weights[:, :len(families)] = np.log(mass / mass.sum(axis=0))

    if pairs:
        number = {(f, a, b): k for k, (f, a, b) in enumerate(pairs)}
        sides = [(languages[f][x], k, 1 if x == a else -1) for (f, a, b), k in number.items() for x in (a, b)]
        table = docs.sparkSession.createDataFrame(sides, "lang string, pair int, sign int")

        def fit(group: pa.Table) -> pa.Table:
            group = group.sort_by([("sign", "ascending"), ("key", "ascending")])
            examples = []
            for i, c in zip(group.column("buckets").to_pylist(), group.column("counts").to_pylist()):
                c = np.array(c, float)
                examples.append((np.array(i, np.int64), SCALE * c / max(c.sum(), 1)))
            w = separate(examples, group.column("sign").to_numpy().astype(float))
            at = np.flatnonzero(w)
            return pa.table({"pair": pa.array(np.full(len(at), group.column("pair")[0].as_py(), np.int32)),
                             "bucket": pa.array(at.astype(np.int32)), "w": pa.array(w[at])})

        fitted = rows.join(F.broadcast(table), "lang").select("pair", "sign", "key", "buckets", "counts") \
            .groupBy("pair").applyInArrow(fit, "pair int, bucket int, w double")
        for r in fitted.collect():
            column = len(families) + r.pair
            if r.bucket == BUCKETS:
                bias[column] = r.w
            else:
                weights[r.bucket, column] = SCALE * r.w
    return Model(families, languages, pairs, weights, bias)


def sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -35, 35)))


def predict_texts(column: pa.Array, model: Model) -> tuple[list[str], np.ndarray]:
    """``(language, score)`` of every text of a lower-cased column with letters.
    The score is the smaller of two shares: that of the family (its logit is the
    lead per gram over the next family) and that of the languages' margin."""
    n, width = len(column), len(model.bias)
    mean = np.zeros((n, width))
    for i, j, data, off in text_slices(column):
        total = np.zeros(j - i)
        for bucket, doc in gram_buckets(data, off):
            if len(doc):
                first = np.flatnonzero(np.append(True, doc[1:] != doc[:-1]))
                mean[i + doc[first]] += np.add.reduceat(model.weights[bucket], first, axis=0, dtype=float)
                total += np.bincount(doc, minlength=j - i)
        mean[i:j] /= np.maximum(total, 1)[:, None]
    mean += model.bias
    score = np.ones(n)
    if len(model.families) > 1:
        order = np.sort(mean[:, :len(model.families)], axis=1)
        score = sigmoid(4 * (order[:, -1] - order[:, -2]))
    family = mean[:, :len(model.families)].argmax(axis=1)
    names = np.array([own[0] for own in model.languages], object)[family]
    for f, own in enumerate(model.languages):
        at = np.flatnonzero(family == f)
        if len(own) < 2 or not len(at):
            continue
        votes, margins = np.zeros((len(at), len(own))), np.zeros((len(at), len(own)))
        lead = np.zeros((len(at), len(own), len(own)))
        for k, (g, a, b) in enumerate(model.pairs):
            if g == f:
                m = mean[at, len(model.families) + k]
                votes[:, a] += m > 0
                votes[:, b] += m <= 0
                margins[:, a] += m
                margins[:, b] -= m
                lead[:, a, b], lead[:, b, a] = m, -m
        rank = np.lexsort((np.broadcast_to(-np.arange(len(own)), votes.shape), margins, votes), axis=1)
        best, next_one = rank[:, -1], rank[:, -2]
        names[at] = np.array(own, object)[best]
        score[at] = np.minimum(score[at], sigmoid(2 * lead[np.arange(len(at)), best, next_one]))
    return names.tolist(), score


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """``(doc_id, lang_pred, score)`` of every row."""
    small_batches(docs.sparkSession)
    # BUCKETS numbers a family and pair; sent as plain values, which need no class where they arrive
    shared = docs.sparkSession.sparkContext.broadcast(
        (model.families, model.languages, model.pairs, model.weights, model.bias))
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches):
        own = Model(*shared.value)
        for b in batches:
            names, score = predict_texts(b.column(1), own) if own.families else ([None] * len(b), np.zeros(len(b)))
            known = pc.and_(b.column(2), pa.array([x is not None for x in names], pa.bool_()))
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pc.if_else(known, pa.array(names, pa.string()), UNKNOWN),
                 pc.if_else(known, pa.array(score), 0.0)], ["doc_id", "lang_pred", "score"])

    text = F.col("text").cast("string")
    rows = docs.select("doc_id", F.lower(text).alias("text"), has_letter(text).alias("_letter"))
    return rows.mapInArrow(run, f"doc_id {kind}, lang_pred string, score double")


def identify_languages(docs: DataFrame) -> DataFrame:
    """``(doc_id, held_out, lang_pred, score)`` with the fold of crc32 mod 4
    equal to 2 held out of training."""
    held = F.coalesce(fold(F.col("doc_id"), 4) == 2, F.lit(False))
    return predict(docs, train(docs, "lang", ~held)).select("doc_id", held.alias("held_out"), "lang_pred", "score")
