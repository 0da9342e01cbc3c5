import __spark_entry__ as E

from tessera.plans.catalog import QUERIES


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["Country", "n", "min_salary", "max_salary", "avg_salary"]


def test_registry_and_oracle_keys():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 50


def test_no_python_udf_in_plans(spark):
    for name in ["country_salary_summary", "pearson_weights", "cf_rmse", "term_tfidf",
                 "cluster_top_terms", "frequent_pairs", "nearest_seed_assign"]:
        plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
        assert "PythonUDF" not in plan and "ArrowEvalPython" not in plan and "BatchEvalPython" not in plan, name
