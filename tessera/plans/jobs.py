"""End-to-end jobs on the reference's file formats.

Each job reads the input files a user of the reference already has,
runs the DataFrame operators and writes the report in the reference's
shape. They are thin compositions of :mod:`tessera.operators`.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tessera.operators import cluster, itemsets, recommend, survey, text
from tessera.operators.dictionary import dense_ids
from tessera.sources import files, sinks
from tessera.session import configure


def survey_counts(spark: SparkSession, csv_path: str, out_path: str) -> None:
    """Respondents per country with a leading ``Total`` row."""
    configure(spark)
    clean = survey.clean_salary_rows(files.read_survey_csv(spark, csv_path))
    counts = survey.country_counts_with_total(clean)
    total_first = F.col("Country") != "Total"
    sinks.write_csv_report(counts, out_path, sort_cols=[total_first, "Country"])


def survey_summary(spark: SparkSession, csv_path: str, out_path: str, compat: bool = True) -> None:
    """``Country, n, min, max, avg`` per country."""
    configure(spark)
    clean = survey.clean_salary_rows(files.read_survey_csv(spark, csv_path))
    sinks.write_csv_report(survey.country_salary_stats(clean, compat), out_path, sort_cols=["Country"])


def frequent_itemsets(spark: SparkSession, lines_path: str, support: int, out_path: str,
                      method: str = "fpgrowth") -> None:
    """All itemsets with absolute support >= ``support``, as text."""
    configure(spark)
    bi = itemsets.clean_basket_items(files.read_basket_lines(spark, lines_path)).checkpoint()
    if method == "fpgrowth":
        found = itemsets.fpgrowth_itemsets(bi, support)
    else:
        found = itemsets.level_wise_itemsets(bi, support)
    sinks.write_itemset_report(itemsets.itemset_report_lines(found), out_path)


def cluster_documents(spark: SparkSession, text_path: str, algorithm: str, k: int,
                      iterations: int, out_path: str, seed_ids=None,
                      num_features: int = 1 << 20, hashed_features: int | None = None,
                      seed: int = 42) -> None:
    """Cluster one-document-per-line text and write the JSON report.

    ``algorithm``: ``"K"`` library K-means and ``"B"`` bisecting K-means
    on hashed TF-IDF (least frequent terms listed, as the reference's
    library job does); ``"T"`` / ``"W"`` Lloyd's K-means on TF-IDF / word
    counts from ``seed_ids`` (default: k distinct documents drawn
    pseudo-randomly with ``seed``), most frequent terms listed. ``hashed_features`` (e.g. 15000) makes ``T``
    / ``W`` cluster hashed vectors of that many buckets instead of the
    exact vocabulary.
    """
    configure(spark)
    docs = files.read_document_lines(spark, text_path).checkpoint()
    if algorithm in ("K", "B"):
        tf = text.hashed_tf(docs, num_features).checkpoint()
        feats = text.idf_transform(tf).select("doc_id", "words", "features")
        model, pred = cluster.library_clusters(
            feats.select("doc_id", "features"), "kmeans" if algorithm == "K" else "bisecting",
            k, iterations)
        toks = text.tokens_from_words(cluster.library_assign(model, feats), beside=["cluster_id"])
        rep = cluster.library_report(pred, model.clusterCenters(), toks, k, descending=False)
        name = "K-Means" if algorithm == "K" else "Bisecting K-Means"
    else:
        toks = text.doc_tokens(docs).checkpoint()
        seeds = list(seed_ids) if seed_ids is not None else cluster.pick_seeds(docs, "doc_id", k, seed)
        if hashed_features:
            from tessera.functions.vectors import sparse_entries

            feats = text.hashed_features(docs, hashed_features, tfidf=algorithm == "T")
            ent = sparse_entries(feats.select("doc_id", "features"), "features")
            assigned, _ = cluster.sparse_lloyd(docs, ent.checkpoint(), seeds, iterations, dim="idx")
        else:
            ent = text.term_vectors(toks, text.doc_count(docs), "tfidf" if algorithm == "T" else "tf")
            assigned, _ = cluster.sparse_lloyd(docs, ent.checkpoint(), seeds, iterations)
        errs = cluster.cluster_errors(assigned, k)
        terms = cluster.cluster_terms(assigned, toks, 10, descending=True).groupBy("cluster_id").agg(
            F.transform(F.array_sort(F.collect_list(F.struct("rank", "term"))),
                        lambda s: s["term"]).alias("terms"))
        rep = errs.join(terms, "cluster_id", "left")
        name = "K-Means"
    sinks.write_cluster_report(cluster.report_json(rep, name), out_path)


def user_based_cf(spark: SparkSession, train_path: str, test_path: str, out_path: str,
                  metrics_path: str, include_test: bool = False,
                  clamp: str = "reference") -> None:
    """User-based Pearson CF predictions and metrics for a test file."""
    configure(spark)
    raw_train, raw_test = files.read_ratings_csv(spark, train_path), files.read_ratings_csv(spark, test_path)
    everything = raw_train.unionByName(raw_test)
    users, items = dense_ids(everything, "user", "user_id"), dense_ids(everything, "item", "item_id")

    def encode(df):
        return df.join(users, "user").join(items, "item").select(
            F.col("user_id").alias("user"), F.col("item_id").alias("item"), "rating")

    train, test = encode(raw_train).checkpoint(), encode(raw_test).checkpoint()
    train = recommend.with_test(train, test, include_test)
    hot = recommend.hot_items(train)
    lists = recommend.neighbour_lists(train, test, hot)
    stats = recommend.pair_stats(recommend.corated_sums(train, test, hot, lists.select("u", "raters")))
    ustats = recommend.user_rating_stats(train)
    scored = recommend.cf_complete(test, recommend.cf_offsets(recommend.listed_neighbours(lists, packed=True), stats), ustats, clamp).checkpoint()
    decoded = (
        scored.join(users.withColumnRenamed("user", "user_name"), scored.user == users.user_id)
        .join(items.withColumnRenamed("item", "item_name"), scored.item == items.item_id)
        .select(F.col("user_name").alias("user"), F.col("item_name").alias("item"), "rating", "prediction")
    )
    sinks.write_predictions(decoded, out_path, metrics_path)


def als_cf(spark: SparkSession, train_path: str, test_path: str, out_path: str, metrics_path: str,
           rank: int = 20, iterations: int = 20, reg: float = 0.3, seed: int = 42) -> None:
    """ALS predictions (pairs of unseen users or items are dropped, as in
    the reference) and metrics for a test file."""
    configure(spark)
    raw_train, raw_test = files.read_ratings_csv(spark, train_path), files.read_ratings_csv(spark, test_path)
    everything = raw_train.unionByName(raw_test)
    users, items = dense_ids(everything, "user", "user_id"), dense_ids(everything, "item", "item_id")
    train = raw_train.join(users, "user").join(items, "item").select("user_id", "item_id", "rating").persist()
    test = raw_test.join(users, "user").join(items, "item")
    model = recommend.als_fit(train, rank, iterations, reg, seed)
    scored = model.transform(test).select("user", "item", "rating",
                                          F.col("prediction").cast("double")).checkpoint()
    sinks.write_predictions(scored, out_path, metrics_path)
    train.unpersist()
