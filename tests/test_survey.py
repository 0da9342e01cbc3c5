from tessera.operators import survey

ROWS = [
    (1, "Iran", "240,000,000", "Monthly"),   # wraps in int32
    (2, "Iran", "1,000", "Yearly"),
    (3, "Spain", "1000000000", "Monthly"),   # wraps
    (4, "Spain", "abc", "Yearly"),           # garbage: avg counts 0.0
    (5, "Spain", "0.0", "Weekly"),           # passes the textual filter
    (6, "Spain", "NA", "Yearly"),            # dropped
    (7, "Chad", "0", "Yearly"),              # dropped
    (8, "Chad", "99,999,999,999", "NA"),     # over int32
    (9, None, "5", "Yearly"),
]
SCHEMA = "resp_id long, Country string, Salary string, SalaryType string"


def _clean(spark):
    return survey.clean_salary_rows(spark.createDataFrame(ROWS, SCHEMA))


def test_clean_rows_textual_filter(spark):
    ids = sorted(r[0] for r in _clean(spark).select("resp_id").collect())
    assert ids == [1, 2, 3, 4, 5, 8, 9]


def test_compat_summary_reproduces_reference_quirks(spark):
    out = {r["Country"]: r for r in survey.country_salary_summary(_clean(spark), compat=True).collect()}
    # Chad has no int32-parseable non-zero salary: gone, like the inner joins
    assert "Chad" not in out
    assert out["Iran"]["min_salary"] == -1414967296 and out["Iran"]["max_salary"] == 1000
    assert out["Spain"]["n"] == 3 and out["Spain"]["min_salary"] == -884901888
    # average over 3 rows: 12e9 + 0.0 (abc) + 0.0 (0.0 weekly)
    assert out["Spain"]["avg_salary"] == 4.0e9


def test_safe_summary_uses_64_bits(spark):
    out = {r["Country"]: r for r in survey.country_salary_summary(_clean(spark), compat=False).collect()}
    assert out["Iran"]["max_salary"] == 2_880_000_000
    assert out["Spain"]["avg_salary"] == 6.0e9       # abc excluded
    assert out["Chad"]["min_salary"] is None and out["Chad"]["n"] == 1


def test_counts_with_total(spark):
    rows = survey.country_counts_with_total(_clean(spark)).collect()
    assert rows[0]["Country"] == "Total" and rows[0]["n"] == 7
    assert sum(r["n"] for r in rows[1:]) == 7


def test_very_large_and_non_finite_salaries(spark):
    rows = [(1, "A", "1E78", "Yearly"), (2, "A", "5", "Yearly"), (3, "B", "1E39", "Monthly"), (4, "B", "7", "Yearly"),
            (5, "C", "NaN", "Yearly"), (6, "C", "Infinity", "Weekly"), (7, "C", "90", "Yearly"), (8, "C", "1E400", "Yearly")]
    clean = survey.clean_salary_rows(spark.createDataFrame(rows, SCHEMA))
    out = {r["Country"]: r["avg_salary"] for r in survey.country_salary_summary(clean, compat=True).collect()}
    assert out == {"A": 5e77, "B": 6e39, "C": 22.5}
    out = {r["Country"]: r["avg_salary"] for r in survey.country_salary_summary(clean, compat=False).collect()}
    assert out["C"] == 90.0
