"""File readers, report sinks and the end-to-end jobs on tiny files."""

import glob
import json
import os

from tessera.plans import jobs
from tessera.sources import files


def _read_parts(path, pattern="part-*"):
    out = []
    for f in sorted(glob.glob(os.path.join(path, pattern))):
        with open(f) as fh:
            out.append(fh.read())
    return "".join(out)


def _write(tmp_path, name, text):
    p = tmp_path / name
    p.write_text(text)
    return str(p)


SURVEY = """Respondent,Country,Salary,SalaryType,Other
1,Iran,"240,000,000",Monthly,x
2,Iran,"1,000",Yearly,x
3,Spain,1000000000,Monthly,x
4,Spain,abc,Yearly,x
5,Spain,0.0,Weekly,x
6,Spain,NA,Yearly,x
7,"Korea, South",50,NA,x
"""


def test_survey_jobs(spark, tmp_path):
    csv = _write(tmp_path, "survey.csv", SURVEY)
    jobs.survey_counts(spark, csv, str(tmp_path / "counts"))
    lines = _read_parts(str(tmp_path / "counts")).splitlines()
    assert lines[0] == "Total,6" and '"Korea, South",1' in lines
    jobs.survey_summary(spark, csv, str(tmp_path / "summary"))
    summary = _read_parts(str(tmp_path / "summary")).splitlines()
    assert summary[0].startswith("Iran,2,-1414967296,1000,")


def test_itemset_job_text_format(spark, tmp_path):
    lines = "".join(f"{b},{w}\n" for b, ws in enumerate(["a b c", "a b", "a c", "b c", "a b c"])
                    for w in ws.split())
    path = _write(tmp_path, "baskets.txt", lines)
    for method in ("fpgrowth", "levelwise"):
        out = str(tmp_path / f"fi_{method}")
        jobs.frequent_itemsets(spark, path, 3, out, method=method)
        assert _read_parts(out + "/size=1") == "(a)\n(b)\n(c)\n"
        assert _read_parts(out + "/size=2") == "(a,b)\n(a,c)\n(b,c)\n"


def test_document_lines_ids_in_order(spark, tmp_path):
    path = _write(tmp_path, "docs.txt", "x y\nz\n\nw w\n")
    rows = files.read_document_lines(spark, path).orderBy("doc_id").collect()
    assert [(r["doc_id"], r["text"]) for r in rows] == [(0, "x y"), (1, "z"), (2, ""), (3, "w w")]


def test_cluster_job_reports(spark, tmp_path):
    docs = ["apple banana apple", "banana apple", "car road car", "road car", "apple car"]
    path = _write(tmp_path, "docs.txt", "\n".join(docs) + "\n")
    for algo in ("W", "T", "K", "B"):
        out = str(tmp_path / f"rep_{algo}")
        jobs.cluster_documents(spark, path, algo, 2, 5, out, seed_ids=[0, 2], num_features=64)
        rep = json.loads(_read_parts(out))
        sizes = [c["size"] for c in rep["Clusters"]]
        assert sum(sizes) == 5 and [c["id"] for c in rep["Clusters"]] == [1, 2]
        assert abs(sum(c["error"] ** 2 for c in rep["Clusters"]) - rep["WSSE"]) < 1e-6
    out = str(tmp_path / "rep_W_hashed")
    jobs.cluster_documents(spark, path, "W", 2, 0, out, seed_ids=[0, 2], hashed_features=15000)
    rep = json.loads(_read_parts(out))
    # word counts against seed documents: integer squared distances
    assert rep["WSSE"] == int(rep["WSSE"]) and sum(c["size"] for c in rep["Clusters"]) == 5


RATINGS_TRAIN = "user_id,business_id,stars\n" + "".join(
    f"u{u},b{b},{(u * 7 + b * 3) % 5 + 1}\n" for u in range(12) for b in range(10) if (u + b) % 3)
RATINGS_TEST = "user_id,business_id,stars\n" + "".join(
    f"u{u},b{b},{(u * 7 + b * 3) % 5 + 1}\n" for u in range(12) for b in range(10) if (u + b) % 3 == 0)


def test_recommender_jobs(spark, tmp_path):
    tr = _write(tmp_path, "train.csv", RATINGS_TRAIN)
    te = _write(tmp_path, "test.csv", RATINGS_TEST)
    n_test = RATINGS_TEST.count("\n") - 1
    jobs.user_based_cf(spark, tr, te, str(tmp_path / "cf"), str(tmp_path / "cf_metrics"))
    preds = _read_parts(str(tmp_path / "cf")).splitlines()
    assert len(preds) == n_test and preds == sorted(preds, key=lambda l: l.split(",")[:2])
    metrics = _read_parts(str(tmp_path / "cf_metrics")).splitlines()
    assert metrics[0].startswith(">=0 and <1: ") and metrics[-1].startswith("RMSE: ")
    assert sum(int(m.split(": ")[1]) for m in metrics[:5]) == n_test
    jobs.als_cf(spark, tr, te, str(tmp_path / "als"), str(tmp_path / "als_metrics"), rank=3, iterations=5)
    assert len(_read_parts(str(tmp_path / "als")).splitlines()) == n_test


def test_reader_edge_cases(spark, tmp_path):
    baskets = _write(tmp_path, "b.txt", "1,apple\n1,pear,extra,fields\nshortline\n2, pear \n3,\"hello\n4,\"x, y\"\n")
    rows = sorted(tuple(r) for r in files.read_basket_lines(spark, baskets).collect())
    assert rows == [("1", "apple"), ("1", "pear"), ("2", " pear "), ("3", '"hello'), ("4", '"x')]   # trimmed later
    assert files.count_rejected_baskets(spark, baskets) == 1
    ratings = _write(tmp_path, "r.csv", "user_id,business_id,stars,text\nu1,b1,4.0,good\nu2,b2,abc,bad\nu3,b3,2,x\n")
    got = sorted(tuple(r) for r in files.read_ratings_csv(spark, ratings).collect())
    assert got == [("u1", "b1", 4.0), ("u3", "b3", 2.0)]
    assert files.count_rejected_ratings(spark, ratings) == 1
    survey_csv = _write(tmp_path, "s.csv", 'Country,Salary,SalaryType\n"Korea, South","1,000",Monthly\n')
    r = files.read_survey_csv(spark, survey_csv).first()
    assert (r["Country"], r["Salary"], r["SalaryType"]) == ("Korea, South", "1,000", "Monthly")


def test_large_report_keeps_global_order_across_parts(spark, tmp_path):
    from tessera.sources import sinks

    df = spark.createDataFrame([(i * 7919 % 1000, f"r{i}") for i in range(1000)], "k long, v string").repartition(6)
    out = str(tmp_path / "sorted")
    key = "spark.sql.adaptive.coalescePartitions.enabled"
    old = spark.conf.get(key)
    spark.conf.set(key, "false")   # keep several parts at this tiny size
    try:
        sinks.write_csv_report(df, out, sort_cols=["k"], n_files=None)
    finally:
        spark.conf.set(key, old)
    parts = sorted(glob.glob(os.path.join(out, "part-*")))
    keys = [int(line.split(",")[0]) for p in parts for line in open(p).read().splitlines()]
    assert len(parts) > 1 and keys == sorted(keys) and len(keys) == 1000
