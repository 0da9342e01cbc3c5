"""Query registry: name -> ``(spark, sf_dir) -> DataFrame``.

Every query reads the scale-factor tables (through the fixtures of
``tessera.sources.fixtures``) and runs over all of their rows.

Groups: survey (salary rows), itemsets (documents as baskets of words),
ratings / user CF / ALS (customer-part ratings), text (document tokens),
clustering (embedding points; library models and sparse K-means on
documents). Most queries are lazy plans. Iterative or model-based ones
(itemset levels, K-means, ALS, id dictionaries, CF inputs) do their
iterations, checkpoints and fits while the DataFrame is built, and
return the final result lazily; a bench times both together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.numeric import round_half_up
from tessera.operators import cluster, evaluate, itemsets, recommend, survey, text
from tessera.operators.als import als_factors, als_predict
from tessera.operators.bisecting import bisecting_kmeans
from tessera.operators.dictionary import dense_ids, grow_ids
from tessera.operators.exactsum import exact_sums
from tessera.operators.seeding import parallel_seeds
from tessera.sources import fixtures, sinks
from tessera.sources.tables import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def register(name: str):
    def deco(fn: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"duplicate query {name}")
        QUERIES[name] = fn
        return fn
    return deco


# ---------------------------------------------------------------- survey

def _clean(spark, sf_dir):
    return survey.clean_salary_rows(fixtures.salary_rows(spark, sf_dir))


@register("salary_clean_rows")
def q_salary_clean_rows(spark, sf_dir):
    return _clean(spark, sf_dir)


@register("yearly_salary_rows")
def q_yearly_salary_rows(spark, sf_dir):
    return survey.yearly_salary_rows(_clean(spark, sf_dir))


@register("salary_annualised")
def q_salary_annualised(spark, sf_dir):
    return survey.annualise(_clean(spark, sf_dir))


@register("country_counts")
def q_country_counts(spark, sf_dir):
    return survey.country_counts(_clean(spark, sf_dir))


@register("country_counts_with_total")
def q_country_counts_with_total(spark, sf_dir):
    return survey.country_counts_with_total(_clean(spark, sf_dir))


@register("country_salary_minmax")
def q_country_salary_minmax(spark, sf_dir):
    return survey.country_salary_minmax(_clean(spark, sf_dir), compat=True)


@register("country_salary_avg")
def q_country_salary_avg(spark, sf_dir):
    return survey.country_salary_avg(_clean(spark, sf_dir), compat=True)


@register("country_salary_summary")
def q_country_salary_summary(spark, sf_dir):
    return survey.country_salary_summary(_clean(spark, sf_dir), compat=True)


@register("country_salary_summary_safe")
def q_country_salary_summary_safe(spark, sf_dir):
    return survey.country_salary_summary(_clean(spark, sf_dir), compat=False)


# ---------------------------------------------------------------- itemsets

SUPPORT_PERCENT = 40   # of all documents


def _basket_items(spark, sf_dir):
    # Written once: the count, the frequent singles and every level read it.
    return itemsets.clean_basket_items(fixtures.document_baskets(spark, sf_dir)).checkpoint()


def _support(bi):
    return itemsets.default_support(itemsets.basket_count(bi), SUPPORT_PERCENT)


@register("baskets")
def q_baskets(spark, sf_dir):
    return itemsets.baskets(_basket_items(spark, sf_dir))


def _level(spark, sf_dir, k):
    bi = _basket_items(spark, sf_dir)
    s = _support(bi)
    return itemsets.itemsets_as_text(itemsets.level_wise_itemsets(bi, s, max_size=k).filter(F.col("size") == k))


@register("frequent_items")
def q_frequent_items(spark, sf_dir):
    return _level(spark, sf_dir, 1)


@register("frequent_pairs")
def q_frequent_pairs(spark, sf_dir):
    return _level(spark, sf_dir, 2)


@register("frequent_triples")
def q_frequent_triples(spark, sf_dir):
    return _level(spark, sf_dir, 3)


@register("frequent_itemsets")
def q_frequent_itemsets(spark, sf_dir):
    bi = _basket_items(spark, sf_dir)
    return itemsets.itemsets_as_text(itemsets.fpgrowth_itemsets(bi, _support(bi)))


@register("frequent_itemsets_levelwise")
def q_frequent_itemsets_levelwise(spark, sf_dir):
    bi = _basket_items(spark, sf_dir)
    s = _support(bi)
    return itemsets.itemsets_as_text(itemsets.level_wise_itemsets(bi, s))


@register("candidate_support")
def q_candidate_support(spark, sf_dir):
    # SON pass 2: candidates of all sizes, many of them below the support, are
    # counted exactly over every basket
    bi = _basket_items(spark, sf_dir)
    s = _support(bi)
    candidates = itemsets.son_candidates(bi, itemsets.level_wise_itemsets(bi, s), s // 2)
    return itemsets.itemsets_as_text(itemsets.candidate_support(bi, candidates))


@register("itemset_report_lines")
def q_itemset_report_lines(spark, sf_dir):
    bi = _basket_items(spark, sf_dir)
    s = _support(bi)
    return itemsets.itemset_report_lines(itemsets.level_wise_itemsets(bi, s))


# ---------------------------------------------------------------- ratings

def _split(spark, sf_dir):
    return fixtures.ratings_split(spark, sf_dir)


@register("ratings_split")
def q_ratings_split(spark, sf_dir):
    r = fixtures.ratings(spark, sf_dir)
    return r.withColumn("is_test", fixtures.is_test_rating(F.col("user"), F.col("item")))


@register("user_ids")
def q_user_ids(spark, sf_dir):
    return dense_ids(fixtures.ratings(spark, sf_dir), "user", "user_id")


@register("item_ids")
def q_item_ids(spark, sf_dir):
    return dense_ids(fixtures.ratings(spark, sf_dir), "item", "item_id")


def _encoded(spark, sf_dir):
    r = fixtures.ratings(spark, sf_dir)
    users = dense_ids(r, "user", "user_id")
    items = dense_ids(r, "item", "item_id")
    return r.join(users, "user").join(items, "item")


@register("encoded_ratings")
def q_encoded_ratings(spark, sf_dir):
    e = _encoded(spark, sf_dir)
    return e.select("user_id", "item_id", "rating",
                    fixtures.is_test_rating(F.col("user"), F.col("item")).alias("is_test"))


@register("exact_price_sums")
def q_exact_price_sums(spark, sf_dir):
    # correctly rounded sums: the same bits under any partitioning
    rows = table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus", "l_extendedprice")
    sums = exact_sums(rows, ["l_returnflag", "l_linestatus"], "l_extendedprice").checkpoint()
    return sums.select("l_returnflag", "l_linestatus", "n", round_half_up("sum", 2).alias("price_sum"),
                       _r6("mean").alias("price_mean"))


#: Ends of the periods by which the customer dictionary grows.
PERIODS = ("1995-07-01", "1997-01-01", None)


@register("grown_customer_ids")
def q_grown_customer_ids(spark, sf_dir):
    # Customers in the order of their first orders, period after period.
    orders = table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderdate")
    known, start = None, None
    for end in PERIODS:
        period = orders
        if start:
            period = period.filter(F.col("o_orderdate") >= F.lit(start).cast("timestamp"))
        if end:
            period = period.filter(F.col("o_orderdate") < F.lit(end).cast("timestamp"))
        known = grow_ids(known, period, "o_custkey", "cust_id", F.col("o_orderkey")).checkpoint()
        start = end
    return known


@register("user_rating_stats")
def q_user_rating_stats(spark, sf_dir):
    train, _ = _split(spark, sf_dir)
    return recommend.user_rating_stats(train)


# ---------------------------------------------------------------- user CF

def _r6(c):
    return round_half_up(c, 6)


def _cf_inputs(spark, sf_dir):
    """Ratings materialised once in the checkpoint folder (every CF stage
    reads them several times), split into train and test, plus the hot
    items whose joins are salted."""
    r = fixtures.ratings(spark, sf_dir).checkpoint()
    flag = fixtures.is_test_rating(F.col("user"), F.col("item"))
    train, test = r.filter(~flag), r.filter(flag)
    return train, test, recommend.hot_items(train)


def _pairs(spark, sf_dir):
    """Statistics of the pairs that a test row needs: its user and a rater of
    its item."""
    train, test, hot = _cf_inputs(spark, sf_dir)
    needed = recommend.neighbour_lists(train, test, hot).select("u", "raters")
    return recommend.pair_stats(recommend.corated_sums(train, test, hot, needed))


@register("corated_pairs")
def q_corated_pairs(spark, sf_dir):
    return _pairs(spark, sf_dir).select("u", "v", "n")


@register("pair_means")
def q_pair_means(spark, sf_dir):
    # every pair of users with a common item, whether a prediction needs it or not
    train, _, hot = _cf_inputs(spark, sf_dir)
    return recommend.corated_sums(train, None, hot).select("u", "v", "n", _r6("mean1").alias("mean1"),
                                                           _r6("mean2").alias("mean2"))


@register("pearson_weights")
def q_pearson_weights(spark, sf_dir):
    return _pairs(spark, sf_dir).select("u", "v", _r6("w").alias("w"))


@register("cf_neighbours")
def q_cf_neighbours(spark, sf_dir):
    train, test, hot = _cf_inputs(spark, sf_dir)
    return recommend.neighbours(train, test, hot)


def _cf(spark, sf_dir):
    train, test, hot = _cf_inputs(spark, sf_dir)
    lists = recommend.neighbour_lists(train, test, hot)
    pairs = lists.select("u", "raters")
    nbrs = recommend.listed_neighbours(lists, packed=True)
    stats = recommend.pair_stats(recommend.corated_sums(train, test, hot, pairs))
    offsets = recommend.cf_offsets(nbrs, stats)
    ustats = recommend.user_rating_stats(train)
    return train, test, ustats, offsets, recommend.cf_predictions(offsets, ustats)


@register("cf_offsets")
def q_cf_offsets(spark, sf_dir):
    o = _cf(spark, sf_dir)[3]
    return o.select("user", "item", _r6("num").alias("num"), _r6("den").alias("den"))


@register("cf_predictions")
def q_cf_predictions(spark, sf_dir):
    preds = _cf(spark, sf_dir)[4]
    return preds.select("user", "item", _r6("prediction").alias("prediction"))


@register("cf_unpredicted")
def q_cf_unpredicted(spark, sf_dir):
    _, test, _, _, preds = _cf(spark, sf_dir)
    return test.join(preds, ["user", "item"], "left_anti")


def _cf_scored(spark, sf_dir):
    _, test, ustats, offsets, _ = _cf(spark, sf_dir)
    return recommend.cf_complete(test, offsets, ustats, clamp="reference")


@register("cf_predictions_clamped")
def q_cf_predictions_clamped(spark, sf_dir):
    return _cf_scored(spark, sf_dir).select("user", "item", "rating",
                                            _r6("prediction").alias("prediction"))


@register("user_rating_stats_with_test")
def q_user_rating_stats_with_test(spark, sf_dir):
    # the reference's user-based job puts the test ratings into training
    train, test = _split(spark, sf_dir)
    return recommend.user_rating_stats(recommend.with_test(train, test, True))


@register("cf_metrics_lines")
def q_cf_metrics_lines(spark, sf_dir):
    lines = sinks.metrics_lines(_cf_scored(spark, sf_dir)).filter("pos < 5")
    return lines.select("pos", "value")


@register("cf_rmse")
def q_cf_rmse(spark, sf_dir):
    return evaluate.rmse(_cf_scored(spark, sf_dir)).select("n", _r6("rmse").alias("rmse"))


@register("cf_error_histogram")
def q_cf_error_histogram(spark, sf_dir):
    return evaluate.error_histogram(_cf_scored(spark, sf_dir))


# ---------------------------------------------------------------- ALS

def _als(spark, sf_dir):
    r = fixtures.ratings(spark, sf_dir).checkpoint()
    users = dense_ids(r, "user", "user_id")
    items = dense_ids(r, "item", "item_id")
    enc = r.join(users, "user").join(items, "item").withColumn(
        "is_test", fixtures.is_test_rating(F.col("user"), F.col("item")))
    train = enc.filter(~F.col("is_test")).select("user_id", "item_id", "rating").persist()
    test = enc.filter(F.col("is_test")).select("user", "item", "user_id", "item_id", "rating")
    model = recommend.als_fit(train)
    train.unpersist()
    preds = model.transform(test).select("user", "item", "rating", F.col("prediction").cast("double"))
    return test, preds


@register("als_predictions")
def q_als_predictions(spark, sf_dir):
    _, preds = _als(spark, sf_dir)
    return preds


ALS_RANK, ALS_STEPS = 8, 5


@register("als_normal_predictions")
def q_als_normal_predictions(spark, sf_dir):
    # Checked form of the library model: normal equations from stated starting factors.
    r = fixtures.ratings(spark, sf_dir).checkpoint()
    flag = fixtures.is_test_rating(F.col("user"), F.col("item"))
    train, test = r.filter(~flag), r.filter(flag)
    users, items = als_factors(train, ALS_RANK, ALS_STEPS)
    return als_predict(test, users, items).select("user", "item", "rating", _r6("prediction").alias("prediction"))


@register("als_unpredicted")
def q_als_unpredicted(spark, sf_dir):
    test, preds = _als(spark, sf_dir)
    return test.select("user", "item", "rating").join(preds, ["user", "item"], "left_anti")


@register("als_predicted_pairs")
def q_als_predicted_pairs(spark, sf_dir):
    # which test rows get a prediction does not depend on the fit
    _, preds = _als(spark, sf_dir)
    return preds.select("user", "item", "rating")


@register("als_rmse")
def q_als_rmse(spark, sf_dir):
    _, preds = _als(spark, sf_dir)
    return evaluate.rmse(preds)


@register("als_error_histogram")
def q_als_error_histogram(spark, sf_dir):
    _, preds = _als(spark, sf_dir)
    return evaluate.error_histogram(preds)


# ---------------------------------------------------------------- text

def _docs(spark, sf_dir):
    return fixtures.documents(spark, sf_dir)


@register("doc_tokens")
def q_doc_tokens(spark, sf_dir):
    return text.doc_tokens(_docs(spark, sf_dir))


@register("term_idf")
def q_term_idf(spark, sf_dir):
    d = _docs(spark, sf_dir)
    idf = text.term_idf(text.doc_tokens(d), text.doc_count(d))
    return idf.select("token", "df", _r6("idf").alias("idf"))


@register("term_tfidf")
def q_term_tfidf(spark, sf_dir):
    d = _docs(spark, sf_dir)
    t = text.term_tfidf(text.doc_tokens(d), text.doc_count(d))
    return t.select("doc_id", "token", "n", _r6("tfidf").alias("tfidf"))


@register("term_tfidf_mindf2")
def q_term_tfidf_mindf2(spark, sf_dir):
    d = _docs(spark, sf_dir)
    t = text.term_tfidf(text.doc_tokens(d), text.doc_count(d), min_doc_freq=2)
    return t.select("doc_id", "token", "n", _r6("tfidf").alias("tfidf"))


@register("hashed_tf")
def q_hashed_tf(spark, sf_dir):
    return text.term_buckets(_docs(spark, sf_dir))


# ---------------------------------------------------------------- clustering

SEED_IDS = (0, 1, 2, 3, 4)
LLOYD_STEPS = 20
ML_K, ML_ITER = 8, 20
ML_FEATURES = 1 << 20


def _points(spark, sf_dir):
    return fixtures.points(spark, sf_dir)


@register("seed_points")
def q_seed_points(spark, sf_dir):
    return cluster.seed_points(_points(spark, sf_dir), SEED_IDS).select("cluster_id", "id")


def _nearest_seed(spark, sf_dir):
    pts = _points(spark, sf_dir)
    seeds = cluster.seed_points(pts, SEED_IDS).collect()
    cluster.require_seeds([r["id"] for r in seeds], SEED_IDS)
    return cluster.assign_nearest(pts, [(r["cluster_id"], r["v"]) for r in seeds])


@register("nearest_seed_assign")
def q_nearest_seed_assign(spark, sf_dir):
    a = _nearest_seed(spark, sf_dir)
    return a.select("id", "cluster_id", _r6("dist2").alias("dist2"))


@register("centroid_update")
def q_centroid_update(spark, sf_dir):
    m = cluster.centroid_means(_nearest_seed(spark, sf_dir))
    return m.select("cluster_id", "dim", _r6("value").alias("value"))


def _lloyd(spark, sf_dir, steps=LLOYD_STEPS):
    assigned, _ = cluster.lloyd_kmeans(_points(spark, sf_dir), SEED_IDS, steps)
    return assigned


@register("lloyd_kmeans_3iter")
def q_lloyd_kmeans_3iter(spark, sf_dir):
    return _lloyd(spark, sf_dir, 3).select("id", "cluster_id", _r6("dist2").alias("dist2"))


@register("cluster_sizes")
def q_cluster_sizes(spark, sf_dir):
    return cluster.cluster_sizes(_lloyd(spark, sf_dir), len(SEED_IDS))


@register("cluster_errors")
def q_cluster_errors(spark, sf_dir):
    e = cluster.cluster_errors(_lloyd(spark, sf_dir), len(SEED_IDS))
    return e.select("cluster_id", _r6("error").alias("error"))


@register("cluster_wsse")
def q_cluster_wsse(spark, sf_dir):
    return cluster.wsse(_lloyd(spark, sf_dir)).select(_r6("wsse").alias("wsse"))


@register("cluster_report")
def q_cluster_report(spark, sf_dir):
    e = cluster.cluster_errors(_lloyd(spark, sf_dir), len(SEED_IDS))
    return e.select("cluster_id", "size", _r6("error").alias("error"))


def _seed_clusters(spark, sf_dir):
    # Documents on their nearest seed document (word-count vectors): the
    # clustering the hand-written job reports terms for.
    d, toks, ent = _text_entries(spark, sf_dir, "tf")
    assigned, _ = cluster.sparse_lloyd(d, ent, TEXT_SEEDS, 0)
    return assigned, toks


@register("cluster_top_terms")
def q_cluster_top_terms(spark, sf_dir):
    assigned, toks = _seed_clusters(spark, sf_dir)
    return cluster.cluster_terms(assigned, toks, 10, descending=True)


@register("cluster_rare_terms")
def q_cluster_rare_terms(spark, sf_dir):
    assigned, toks = _seed_clusters(spark, sf_dir)
    return cluster.cluster_terms(assigned, toks, 10, descending=False)


def _library(spark, sf_dir, algorithm):
    d = _docs(spark, sf_dir)
    tf = text.hashed_tf(d, ML_FEATURES).checkpoint()  # read by the IDF fit and transform
    feats = text.idf_transform(tf).select("doc_id", "words", "features")
    model, pred = cluster.library_clusters(feats.select("doc_id", "features"), algorithm,
                                           ML_K, ML_ITER, seed=42)
    # the reference's library report lists the least frequent terms (Q7)
    toks = text.tokens_from_words(cluster.library_assign(model, feats), beside=["cluster_id"])
    rep = cluster.library_report(pred, model.clusterCenters(), toks, ML_K, descending=False)
    out = rep.select("cluster_id", "size", "error", F.array_join("terms", ",").alias("terms"))
    return out.checkpoint()


@register("kmeans_ml")
def q_kmeans_ml(spark, sf_dir):
    return _library(spark, sf_dir, "kmeans")


@register("bisecting_kmeans_ml")
def q_bisecting_kmeans_ml(spark, sf_dir):
    return _library(spark, sf_dir, "bisecting")


# ------------------------------------------------ text K-means (sparse)

TEXT_SEEDS = (0, 1, 2, 3, 4)
TEXT_STEPS = 20


def _r3(c):
    return round_half_up(c, 3)


def _text_entries(spark, sf_dir, weighting):
    d = _docs(spark, sf_dir)
    toks = text.doc_tokens(d)   # counted anew by every reader: cheaper than to write and read again
    ent = text.term_vectors(toks, text.doc_count(d), weighting).checkpoint()
    return d, toks, ent


@register("text_seed_assign_tf")
def q_text_seed_assign_tf(spark, sf_dir):
    # The hand-written job's observable result: every document on its
    # nearest seed document, word-count vectors (exact integers).
    d, _, ent = _text_entries(spark, sf_dir, "tf")
    assigned, _ = cluster.sparse_lloyd(d, ent, TEXT_SEEDS, 0)
    return assigned


def _text_kmeans(spark, sf_dir):
    d, toks, ent = _text_entries(spark, sf_dir, "tfidf")
    assigned, _ = cluster.sparse_lloyd(d, ent, TEXT_SEEDS, TEXT_STEPS)
    return assigned, toks


@register("text_kmeans_tfidf")
def q_text_kmeans_tfidf(spark, sf_dir):
    assigned, _ = _text_kmeans(spark, sf_dir)
    return assigned.select("doc_id", "cluster_id", _r3("dist2").alias("dist2"))


SEEDED_K, SEEDING_ROUNDS, SEEDING_FACTOR = 5, 3, 2


@register("text_seeded_tfidf")
def q_text_seeded_tfidf(spark, sf_dir):
    # Seeds drawn in parallel rounds by distance, every document on its nearest one.
    d, _, ent = _text_entries(spark, sf_dir, "tfidf")
    seeds = parallel_seeds(d, ent, SEEDED_K, SEEDING_ROUNDS, SEEDING_FACTOR)
    assigned, _ = cluster.sparse_lloyd(d, ent, seeds, 0)
    seed = F.get(F.array(*[F.lit(i) for i in seeds]), F.col("cluster_id") - 1)
    return assigned.select("doc_id", "cluster_id", seed.cast("bigint").alias("seed_id"), _r3("dist2").alias("dist2"))


BISECT_K, BISECT_STEPS = 5, 10


@register("text_bisecting_tfidf")
def q_text_bisecting_tfidf(spark, sf_dir):
    # Checked form of the library model: documents by repeated splits under
    # stated seeds and tie rules, TF-IDF over the exact vocabulary.
    d, _, ent = _text_entries(spark, sf_dir, "tfidf")
    assigned, _ = bisecting_kmeans(d, ent, BISECT_K, BISECT_STEPS)
    return assigned.select("doc_id", "node", "cluster_id", _r3("dist2").alias("dist2"))


HASHED_FEATURES = 15_000   # the reference's feature count


def _hashed_kmeans(spark, sf_dir):
    d = _docs(spark, sf_dir)
    ent = text.term_buckets(d).select(
        "doc_id", F.pmod("bucket", F.lit(HASHED_FEATURES)).alias("idx"), "n").groupBy("doc_id", "idx").agg(
        F.sum("n").cast("double").alias("val")).checkpoint()
    return cluster.sparse_lloyd(d, ent, TEXT_SEEDS, TEXT_STEPS, dim="idx")[0]


@register("text_kmeans_hashed")
def q_text_kmeans_hashed(spark, sf_dir):
    return _hashed_kmeans(spark, sf_dir).select("doc_id", "cluster_id", _r3("dist2").alias("dist2"))


@register("text_cluster_report")
def q_text_cluster_report(spark, sf_dir):
    assigned, toks = _text_kmeans(spark, sf_dir)
    k = len(TEXT_SEEDS)
    errs = cluster.cluster_errors(assigned, k)
    terms = cluster.cluster_terms(assigned, toks, 10, descending=True).groupBy("cluster_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))),
                                 lambda s: s["term"]), ",").alias("terms"))
    return errs.join(terms, "cluster_id", "left").select(
        "cluster_id", "size", _r3("error").alias("error"), "terms")
