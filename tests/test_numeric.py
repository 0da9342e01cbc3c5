from tessera.functions.numeric import round_half_up, safe_div, to_int32, wrap_int32
from tessera.functions.text import nonempty_tokens, split_spaces


def test_to_int32_edge_strings(spark):
    vals = ["1000.50", "99999999999", "-52", "abc", "1e3", "0.0", "-1.9", "2147483647",
            "2147483648", "1" * 44, "NA", "12."]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, s string")
    got = [r[0] for r in df.orderBy("i").select(to_int32("s")).collect()]
    assert got == [1000, None, -52, None, None, 0, -1, 2147483647, None, None, None, 12]


def test_wrap_int32_golden(spark):
    df = spark.createDataFrame([(240_000_000 * 12,), (10**9 * 12,), (777_777_777 * 12,),
                                (99_999_999 * 52,), (-5,)], "x bigint")
    got = [r[0] for r in df.select(wrap_int32("x")).collect()]
    assert got == [-1414967296, -884901888, 743398732, 905032652, -5]


def test_round_half_up_and_safe_div(spark):
    df = spark.createDataFrame([(1.005, 2.0, 0.0)], "x double, a double, b double")
    r = df.select(round_half_up("x", 2).alias("r"), safe_div("a", "b", 0.01).alias("d")).first()
    assert r["r"] == 1.01 and r["d"] == 0.01


def test_single_space_split(spark):
    df = spark.createDataFrame([("a  b  ",), ("   ",), ("",)], "t string")
    rows = df.select(split_spaces("t").alias("s"), nonempty_tokens("t").alias("n")).collect()
    assert rows[0]["s"] == ["a", "", "b"] and rows[0]["n"] == ["a", "b"]
    assert rows[1]["n"] == []
    assert rows[1]["s"] == [] and rows[2]["s"] == [""]


def test_round_half_up_keeps_what_has_no_decimals(spark):
    vals = [1e29, -5.54e74, float("inf"), float("nan"), 2.0 ** 53, 2.5]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vals)], "i int, x double")
    got = [r[0] for r in df.orderBy("i").select(round_half_up("x", 0)).collect()]
    assert got[:3] == vals[:3] and got[3] != got[3] and got[4:] == [2.0 ** 53, 3.0]
