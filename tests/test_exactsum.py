import math
import random
import struct
from fractions import Fraction

import pytest

from tessera.operators.exactsum import exact_sums

SCHEMA = "k string, x double"


def bits(x):
    return None if x is None else "nan" if math.isnan(x) else struct.pack(">d", x)


def values():
    rnd = random.Random(9)
    wide = [rnd.choice([-1, 1]) * math.ldexp(rnd.random(), rnd.randint(-1080, 1015)) for _ in range(600)]
    near = [rnd.uniform(-1e6, 1e6) for _ in range(600)]
    edge = [5e-324, -5e-324, 1.7976931348623157e308, -1.7976931348623157e308, 2.0 ** 32, 2.0 ** -32, 0.0, -0.0, 0.1, 1 / 3]
    edge += [s * math.ldexp(1.0, e) * (1 + d) for e in range(-1050, 1020, 32) for s in (1, -1) for d in (0, 2 ** -52)]
    salaries = [1e78, 0.1, -1e78, 0.2, 3.0, 1e16, 1.0, -1e16]
    return ([("wide", x) for x in wide] + [("near", x) for x in near] + [("edge", x) for x in edge]
            + [("salary", x) for x in salaries] + [("nulls", None), ("half", None), ("half", 2.5), (None, 4.0)])


@pytest.mark.parametrize("parts", [1, 7, 200])
def test_equals_the_rounded_exact_sum_in_every_layout(spark, parts):
    rows = values()
    random.Random(parts).shuffle(rows)
    got = {r["k"]: r for r in exact_sums(spark.createDataFrame(rows, SCHEMA).repartition(parts), ["k"], "x").collect()}
    assert got.keys() == {k for k, _ in rows}
    for key, r in got.items():
        own = [x for k, x in rows if k == key and x is not None]
        assert r["n"] == len(own)
        if own:
            exact = sum(map(Fraction, own))
            assert bits(r["sum"]) == bits(exact.numerator / exact.denominator)
            mean = exact / len(own)
            assert bits(r["mean"]) == bits(mean.numerator / mean.denominator)
        else:
            assert r["sum"] is None and r["mean"] is None


def test_values_that_are_no_numbers_overflow_and_nothing(spark):
    inf, nan, big = float("inf"), float("nan"), 1.7976931348623157e308
    rows = [("nan", nan), ("nan", 1.0), ("inf", inf), ("inf", -5.0), ("both", inf), ("both", -inf), ("minus", -inf),
            ("over", big), ("over", big)]
    got = {r["k"]: (r["sum"], r["mean"]) for r in exact_sums(spark.createDataFrame(rows, SCHEMA), ["k"], "x").collect()}
    assert all(math.isnan(x) for key in ("nan", "both") for x in got[key])
    assert got["inf"] == (inf, inf) and got["minus"] == (-inf, -inf) and got["over"] == (inf, big)
    assert exact_sums(spark.createDataFrame([], SCHEMA), ["k"], "x").count() == 0
